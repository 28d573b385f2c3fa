"""Lazy plans from the source tables to the Silver and Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delivery_lake.functions import pack_id, unpack_id
from delivery_lake.operators import cleaning, enrich, kpis
from delivery_lake.sources import files, testdata


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Source tables derived from the test data, through the Silver rules."""
    return cleaning.clean_tables(testdata.source_tables(spark, sf_dir))


# Keys that the facts are dealt out by: the first join or aggregation of each is on it.
DEALT_BY = {"orders": "customer_id", "order_items": "order_id", "payments": "order_id", "reviews": "order_id"}


def dealt_facts(tables: dict[str, DataFrame], names: list[str] | None = None, hot_rows: int = files.HOT_ROWS) -> dict[str, DataFrame] | None:
    """Silver facts with packed ids, dealt out by their keys; None where more than ``hot_rows`` rows may
    have one key and would come to one task: duplicates and orders are then aggregated in every map task
    before a shuffle, as ``silver_tables`` and the operators on it do."""
    names = names or list(DEALT_BY)
    # orders without a customer stay; facts without an order belong to no order
    counted = [(tables[t] if t == "orders" else tables[t].where(F.col(DEALT_BY[t]).isNotNull()), DEALT_BY[t]) for t in names]
    if files.most_rows(counted) > hot_rows:
        return None
    return {t: cleaning.clean_packed(t, tables[t], DEALT_BY[t], keep_null_keys=t == "orders") for t in names}


def wide_of(tables: dict[str, DataFrame], hot_rows: int = files.HOT_ROWS) -> DataFrame:
    """The Gold wide table of typed source tables."""
    facts = dealt_facts(tables, hot_rows=hot_rows)
    if facts is None:
        return enrich.orders_enriched(cleaning.clean_tables(tables))
    lookups = cleaning.clean_tables({t: tables[t] for t in enrich.LOOKUP_KEYS})
    for t in ("customers", "sellers", "products"):
        lookups[t] = lookups[t].withColumn(enrich.LOOKUP_KEYS[t], pack_id(enrich.LOOKUP_KEYS[t]))
    return enrich.orders_enriched(lookups | facts, packed=True)


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold wide table (C09-C14) as one lazy plan, after one job that looks for a hot order or customer."""
    return wide_of(testdata.source_tables(spark, sf_dir))


def items_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C01 from the source tables."""
    items = testdata.order_items(spark, sf_dir)
    facts = dealt_facts({"order_items": items}, ["order_items"])
    if facts is None:
        return enrich.items_by_order(cleaning.clean_table("order_items", items))
    return enrich.items_by_order(facts["order_items"], colocated=True).withColumn("order_id", unpack_id("order_id"))


def gold_tables(wide: DataFrame) -> dict[str, DataFrame]:
    """The five Gold outputs from one wide table (persist or write ``wide`` first when all
    five are computed, so the joins run once)."""
    return {
        "orders_enriched": wide,
        "delivery_kpis_by_state": kpis.kpis_by_state(wide),
        "delivery_kpis_by_seller": kpis.kpis_by_seller(wide),
        "delivery_kpis_by_category": kpis.kpis_by_category(wide),
        "ml_dataset": enrich.ml_dataset(wide),
    }
