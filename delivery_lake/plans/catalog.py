"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator key, and the
matching DuckDB SQL where the result is SQL-checkable.

Every query reads the whole test tables (through the derivation in ``sources.testdata``);
none samples, caps or filters rows to stay cheap. Column names match the SQL exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delivery_lake.operators import certificates, cleaning, enrich, infer, kpis, ml, profile
from delivery_lake.plans import gold
from delivery_lake.plans.oracle import analysis_sql, segment_sql, with_ctes
from delivery_lake.plans.pipeline import run_pipeline, write_silver
from delivery_lake.schemas import (
    CATEGORICAL_FEATURES,
    DATE_COLUMNS,
    DECLARED,
    FOREST_PARAMS,
    GOLD_INPUTS,
    GOLD_TABLES,
    KINDS,
    MANIFEST,
    ML_COLUMNS,
    MONTH_COLUMN,
    NULL_TOKENS,
    NUMBER_PATTERN,
    NUMERIC_FEATURES,
    TIMESTAMP_PATTERN,
    TYPES_OF_KINDS,
    WHOLE_PATTERN,
)
from delivery_lake.session import scratch_dir, shuffles_freed
from delivery_lake.sources import files, testdata

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_ctes(sql)
        return fn
    return deco


def _silver(spark, sf):
    return gold.silver_tables(spark, sf)


def _wide(spark, sf):
    return gold.wide_orders(spark, sf)


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once into the shared folder, compressed (a ``checkpoint()`` keeps rows as they lie in memory)."""
    path = f"{scratch_dir(df.sparkSession, label)}/table"
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", files.LAYER_COMPRESSION).parquet(path)
    return df.sparkSession.read.parquet(path)


ORDER_DATES = DATE_COLUMNS["orders"]


def _types_sql(table: str, columns: list[str], tag: str) -> str:
    """Position, name, type and number of values of each column of ``table``, read as text."""
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    parts = []
    for i, c in enumerate(columns):
        text = f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if any(c in d for d in DATE_COLUMNS.values()) else f"CAST({c} AS VARCHAR)"
        parts.append(f"""SELECT {tag}, {i} AS position, '{c}' AS column_name, k, n_values FROM (
  SELECT coalesce(bit_or(k), 0) AS k, count(*) FILTER (WHERE k > 0) AS n_values FROM (
    SELECT CASE WHEN v IS NULL OR v IN ({tokens}) THEN 0 WHEN lower(v) IN ('true', 'false') THEN {KINDS['boolean']}
                WHEN regexp_matches(v, '{WHOLE_PATTERN}') AND TRY_CAST(v AS BIGINT) IS NOT NULL THEN {KINDS['bigint']}
                WHEN regexp_matches(v, '{NUMBER_PATTERN}') THEN {KINDS['double']}
                WHEN regexp_matches(v, '{TIMESTAMP_PATTERN}') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN {KINDS['timestamp']}
                ELSE {KINDS['string']} END AS k FROM (SELECT {text} AS v FROM {table})))""")
    name = " ".join(f"WHEN {bits} THEN '{t}'" for bits, t in TYPES_OF_KINDS.items())
    return f"SELECT * EXCLUDE (k), CASE k {name} ELSE 'string' END AS dtype FROM (" + "\nUNION ALL\n".join(parts) + ")"

# Parameters of the filter queries (fixed values of the checked queries).
DATE_RANGE = ("1996-01-01", "1997-12-31")
STATES = ["NATION_1", "NATION_7", "NATION_13"]
CATEGORIES = ["economy", "standard", "unknown"]
FILTER_OUT = ["order_id", "order_status", "order_purchase_timestamp", "customer_state", "main_product_category"]

# ---------------------------------------------------------------------------------------------
# B: cleaning
# ---------------------------------------------------------------------------------------------


@register("b01_colnames", "SELECT * FROM src_orders")
def b01_colnames(spark, sf):
    o = testdata.orders(spark, sf)
    raw_header = o.toDF(*[f"  {c.upper()} " for c in o.columns])
    return cleaning.standardize_columns(raw_header)


@register("b02_dedup", "SELECT DISTINCT * FROM src_order_items")
def b02_dedup(spark, sf):
    items = testdata.order_items(spark, sf)
    return cleaning.drop_full_duplicates(items.unionByName(items))


@register("b02_by_hash", "SELECT DISTINCT * FROM src_reviews")
def b02_by_hash(spark, sf):
    """Reviews and a few copies of them: only rows whose hash repeats are compared whole."""
    reviews = testdata.reviews(spark, sf)
    return cleaning.drop_duplicates_by_hash(reviews.unionByName(reviews.where(F.col("order_id") < "05")))


@register("b03_dates", """
SELECT order_id, order_purchase_timestamp,
       CASE WHEN order_id NOT LIKE '0%' THEN order_approved_at END AS order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
FROM src_orders""")
def b03_dates(spark, sf):
    o = testdata.orders(spark, sf)
    as_text = {c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("NA")) for c in ORDER_DATES}
    text = o.withColumns(as_text).withColumn(
        "order_approved_at",
        F.when(F.col("order_id").startswith("0"), F.lit("not a date")).otherwise(F.col("order_approved_at")))
    return cleaning.convert_dates(text, "orders").select("order_id", *ORDER_DATES)


@register("b04_promised_days", "SELECT order_id, estimated_delivery_days FROM s_orders")
def b04_promised_days(spark, sf):
    return _silver(spark, sf)["orders"].select("order_id", "estimated_delivery_days")


@register("b05_delay_days", "SELECT order_id, delay_days FROM s_orders")
def b05_delay_days(spark, sf):
    return _silver(spark, sf)["orders"].select("order_id", "delay_days")


@register("b06_late_flag", "SELECT order_id, late_delivery FROM s_orders")
def b06_late_flag(spark, sf):
    return _silver(spark, sf)["orders"].select("order_id", "late_delivery")


@register("b07_negative_review", "SELECT * FROM s_reviews")
def b07_negative_review(spark, sf):
    return _silver(spark, sf)["reviews"]


@register("b08_volume", "SELECT product_id, product_volume_cm3 FROM s_products")
def b08_volume(spark, sf):
    return _silver(spark, sf)["products"].select("product_id", "product_volume_cm3")


@register("b09_clean_orders", "SELECT * FROM s_orders")
def b09_clean_orders(spark, sf):
    return _silver(spark, sf)["orders"]


@register("b10_bool_norm", "SELECT order_id, late_delivery, negative_review FROM g_wide")
def b10_bool_norm(spark, sf):
    w = _wide(spark, sf).select("order_id", "late_delivery", "negative_review")
    # as text, the way a CSV or database copy holds them: 'True'/'False' and '1'/'0'
    late_txt = F.when(F.col("late_delivery"), "True").when(~F.col("late_delivery"), "False")
    neg_txt = F.col("negative_review").cast("int").cast("string")
    return cleaning.normalize_booleans(w.withColumns({"late_delivery": late_txt, "negative_review": neg_txt}))


# ---------------------------------------------------------------------------------------------
# C: order-level enrichment
# ---------------------------------------------------------------------------------------------


@register("c01_items_by_order", "SELECT * FROM g_items_agg")
def c01_items_by_order(spark, sf):
    return gold.items_by_order(spark, sf)


@register("c02_main_seller", "SELECT * FROM g_main_seller")
def c02_main_seller(spark, sf):
    s = _silver(spark, sf)
    return enrich.main_seller(s["order_items"], s["sellers"])


@register("c03_translate", "SELECT * FROM g_products")
def c03_translate(spark, sf):
    s = _silver(spark, sf)
    return enrich.translate_products(s["products"], s["category_translation"])


@register("c04_item_category", "SELECT * FROM g_items")
def c04_item_category(spark, sf):
    s = _silver(spark, sf)
    return enrich.item_categories(s["order_items"], s["products"], s["category_translation"])


@register("c05_main_category", "SELECT * FROM g_main_cat")
def c05_main_category(spark, sf):
    s = _silver(spark, sf)
    return enrich.main_category(enrich.item_categories(s["order_items"], s["products"], s["category_translation"]))


@register("c06_payments_by_order", "SELECT * FROM g_pay_agg")
def c06_payments_by_order(spark, sf):
    return enrich.payments_by_order(_silver(spark, sf)["payments"])


@register("c07_main_payment", "SELECT * FROM g_main_pay")
def c07_main_payment(spark, sf):
    return enrich.main_payment(_silver(spark, sf)["payments"])


@register("c08_reviews_by_order", "SELECT * FROM g_rev_agg")
def c08_reviews_by_order(spark, sf):
    return enrich.reviews_by_order(_silver(spark, sf)["reviews"])


@register("c09_orders_enriched", "SELECT * FROM g_wide")
def c09_orders_enriched(spark, sf):
    return _wide(spark, sf)


@register("c09_colocated", "SELECT * FROM g_wide")
def c09_colocated(spark, sf):
    """The wide table over written Silver tables in buckets of the order id: no exchange on it."""
    root, batch = scratch_dir(spark, "lake"), "cleaning_20240101_000000"
    buckets, _ = write_silver(_sources(spark, sf), root, batch)
    silver = files.silver_scan(spark, root, GOLD_INPUTS, batch)
    return enrich.orders_enriched(silver, enrich.check_lookups(silver), bool(buckets))


@register("c10_month", "SELECT order_id, purchase_month FROM g_wide")
def c10_month(spark, sf):
    return _wide(spark, sf).select("order_id", "purchase_month")


@register("c11_weekday", "SELECT order_id, purchase_dayofweek FROM g_wide")
def c11_weekday(spark, sf):
    return _wide(spark, sf).select("order_id", "purchase_dayofweek")


@register("c12_year_month", "SELECT order_id, purchase_year_month FROM g_wide")
def c12_year_month(spark, sf):
    return _wide(spark, sf).select("order_id", "purchase_year_month")


@register("c13_delivery_days", "SELECT order_id, delivery_days FROM g_wide")
def c13_delivery_days(spark, sf):
    return _wide(spark, sf).select("order_id", "delivery_days")


@register("c14_fill_unknown", "SELECT order_id, main_product_category FROM g_wide")
def c14_fill_unknown(spark, sf):
    return _wide(spark, sf).select("order_id", "main_product_category")


@register("c15_ml_dataset", "SELECT * FROM g_ml")
def c15_ml_dataset(spark, sf):
    return enrich.ml_dataset(_wide(spark, sf))


# ---------------------------------------------------------------------------------------------
# D: KPIs and dashboard queries
# ---------------------------------------------------------------------------------------------

_FILTER_SQL = "SELECT " + ", ".join(FILTER_OUT) + " FROM g_wide WHERE "


@register("d01_date_filter", _FILTER_SQL + f"""
CAST(order_purchase_timestamp AS DATE) BETWEEN DATE '{DATE_RANGE[0]}' AND DATE '{DATE_RANGE[1]}'""")
def d01_date_filter(spark, sf):
    return kpis.filter_dates(_wide(spark, sf), *DATE_RANGE).select(*FILTER_OUT)


@register("d01_by_month", _FILTER_SQL + f"""
CAST(order_purchase_timestamp AS DATE) BETWEEN DATE '{DATE_RANGE[0]}' AND DATE '{DATE_RANGE[1]}'""")
def d01_by_month(spark, sf):
    """The date filter over the wide table's month layout: other months' files are not read."""
    path = files.write_by_month(_wide(spark, sf), f"{scratch_dir(spark, 'gold')}/by_month")
    return kpis.filter_dates(files.read_by_month(spark, path), *DATE_RANGE, month=MONTH_COLUMN).select(*FILTER_OUT)


@register("d02_state_filter", _FILTER_SQL + "customer_state IN (" + ", ".join(f"'{s}'" for s in STATES) + ")")
def d02_state_filter(spark, sf):
    return kpis.filter_states(_wide(spark, sf), STATES).select(*FILTER_OUT)


@register("d03_category_filter",
          _FILTER_SQL + "main_product_category IN (" + ", ".join(f"'{s}'" for s in CATEGORIES) + ")")
def d03_category_filter(spark, sf):
    return kpis.filter_categories(_wide(spark, sf), CATEGORIES).select(*FILTER_OUT)


@register("d04_delivered", "SELECT order_id, late_delivery, delivery_days, delay_days FROM g_delivered")
def d04_delivered(spark, sf):
    return kpis.delivered(_wide(spark, sf)).select("order_id", "late_delivery", "delivery_days", "delay_days")


@register("d05_kpi_state", segment_sql(["customer_state"], False))
def d05_kpi_state(spark, sf):
    return kpis.kpis_by_state(_wide(spark, sf))


@register("d06_kpi_seller", segment_sql(["main_seller_id", "main_seller_state"], False))
def d06_kpi_seller(spark, sf):
    tables = _silver(spark, sf)
    return kpis.kpis_by_main_seller(enrich.orders_with_facts(tables), tables["sellers"])


@register("d07_kpi_category", segment_sql(["main_product_category"], False))
def d07_kpi_category(spark, sf):
    return kpis.kpis_by_category(_wide(spark, sf))


_SEGMENT_OUT = ["dimension", "label", "orders_count", "late_rate", "avg_delivery_days", "avg_delay_days",
                "avg_review_score", "negative_review_rate", "priority_score"]


@register("d08_segment", "\nUNION ALL\n".join(
    f"SELECT '{d}' AS dimension, " + ", ".join(_SEGMENT_OUT[1:]) + f" FROM ({analysis_sql(d)})"
    for d in ["customer_state", "main_product_category", "seller"]))
def d08_segment(spark, sf):
    return kpis.segment_analysis_all(_wide(spark, sf)).select(*_SEGMENT_OUT)


@register("d09_seller_label", f"SELECT main_seller_id, main_seller_state, label FROM ({analysis_sql('seller')})")
def d09_seller_label(spark, sf):
    return kpis.segment_analysis(_wide(spark, sf), "seller").select("main_seller_id", "main_seller_state", "label")


@register("d10_priority", f"SELECT label, orders_count, priority_score FROM ({analysis_sql('main_product_category')})")
def d10_priority(spark, sf):
    return kpis.segment_analysis(_wide(spark, sf), "main_product_category").select(
        "label", "orders_count", "priority_score")


@register("d11_topn", f"""
SELECT * FROM ({analysis_sql('seller')}) WHERE orders_count >= 50
ORDER BY late_rate DESC NULLS LAST, label, main_seller_id, main_seller_state LIMIT 15""")
def d11_topn(spark, sf):
    return kpis.top_segments(kpis.segment_analysis(_wide(spark, sf), "seller"), "late_rate", 15, 50)


@register("d12_alerts", "\nUNION ALL\n".join(
    f"""SELECT * FROM (SELECT '{d}' AS dimension, label, orders_count, late_rate, negative_review_rate, priority_score
    FROM ({analysis_sql(d)}) WHERE orders_count >= 100
    ORDER BY priority_score DESC NULLS LAST, label, {keys} LIMIT 5)"""
    for d, keys in [("customer_state", "customer_state"), ("main_product_category", "main_product_category"),
                    ("seller", "main_seller_id, main_seller_state")]))
def d12_alerts(spark, sf):
    return kpis.alerts(_wide(spark, sf))


@register("d13_exec", """
SELECT count(*) AS total_orders,
       count(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
       avg(CASE WHEN order_status = 'delivered' THEN CAST(late_delivery AS INTEGER) END) * 100 AS late_rate,
       avg(CASE WHEN order_status = 'delivered' THEN delivery_days END) AS avg_delivery_days,
       avg(CASE WHEN order_status = 'delivered' THEN review_score END) AS avg_review_score,
       avg(CASE WHEN order_status = 'delivered' THEN CAST(negative_review AS INTEGER) END) * 100 AS negative_review_rate
FROM g_wide""")
def d13_exec(spark, sf):
    return kpis.executive_kpis(_wide(spark, sf))


@register("d14_monthly", """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS purchase_year_month, count(order_id) AS orders_count
FROM g_wide WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1""")
def d14_monthly(spark, sf):
    return kpis.monthly_orders(_wide(spark, sf))


@register("d15_impact", """
SELECT late_delivery, count(order_id) AS orders_count, avg(review_score) AS avg_review_score,
       avg(CAST(negative_review AS INTEGER)) * 100 AS negative_review_rate,
       CASE WHEN late_delivery THEN 'En retard' ELSE 'À l''heure ou en avance' END AS delivery_status
FROM g_delivered WHERE late_delivery IS NOT NULL GROUP BY late_delivery""")
def d15_impact(spark, sf):
    return kpis.lateness_impact(_wide(spark, sf))


@register("d16_bounds", """
SELECT min(order_purchase_timestamp) AS min_date, max(order_purchase_timestamp) AS max_date FROM g_wide""")
def d16_bounds(spark, sf):
    return kpis.date_bounds(_wide(spark, sf))


@register("d17_distinct", """
SELECT DISTINCT 'customer_state' AS dimension, customer_state AS value FROM g_wide WHERE customer_state IS NOT NULL
UNION ALL
SELECT DISTINCT 'main_product_category', main_product_category FROM g_wide WHERE main_product_category IS NOT NULL""")
def d17_distinct(spark, sf):
    return kpis.distinct_values_all(_wide(spark, sf), ["customer_state", "main_product_category"])


@register("d18_report", """
SELECT label, CAST(round(orders_count) AS BIGINT) AS orders_count,
       CAST(round(late_rate, 2) AS VARCHAR) || ' %' AS late_rate,
       round(avg_delivery_days, 2) AS avg_delivery_days, round(avg_delay_days, 2) AS avg_delay_days,
       round(avg_review_score, 2) AS avg_review_score,
       CAST(round(negative_review_rate, 2) AS VARCHAR) || ' %' AS negative_review_rate,
       round(priority_score, 2) AS priority_score
FROM (SELECT * FROM (""" + analysis_sql("customer_state") + """) WHERE orders_count >= 50
      ORDER BY late_rate DESC NULLS LAST, label, customer_state LIMIT 15)""")
def d18_report(spark, sf):
    top = kpis.top_segments(kpis.segment_analysis(_wide(spark, sf), "customer_state"), "late_rate", 15, 50)
    return kpis.report_table(top)


# ---------------------------------------------------------------------------------------------
# E: exploration and data profile
# ---------------------------------------------------------------------------------------------

def _sources(spark, sf):
    return testdata.source_tables(spark, sf)


def _summary_sql() -> str:
    parts = []
    for name in testdata.DERIVATIONS:
        cols = list(DECLARED[name])
        parts.append(f"SELECT '{name}' AS table_name, count(*) AS rows, {len(cols)} AS columns, "
                     f"'{', '.join(cols)}' AS column_names FROM src_{name}")
    return "\nUNION ALL\n".join(parts)


def _missing_sql() -> str:
    parts = []
    for name in testdata.DERIVATIONS:
        for c in DECLARED[name]:
            parts.append(
                f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
                f"count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
                f"round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 100, 2) AS missing_rate "
                f"FROM src_{name} HAVING count(*) FILTER (WHERE {c} IS NULL) > 0")
    return "\nUNION ALL\n".join(parts)


@register("e01_summary", _summary_sql())
def e01_summary(spark, sf):
    return profile.table_summary(_sources(spark, sf))


@register("e02_dtypes", "\nUNION ALL\n".join(_types_sql("src_" + t, list(DECLARED[t]), f"'{t}' AS table_name") for t in testdata.DERIVATIONS))
def e02_dtypes(spark, sf):
    """Types inferred from every value of the Bronze text."""
    root, manifest = _bronze(spark, sf)
    return infer.table_types(files.scan(spark, root, "bronze", list(manifest)))


@register("e03_missing", _missing_sql())
def e03_missing(spark, sf):
    return profile.missing_values(_sources(spark, sf))


@register("e04_preview", "SELECT * FROM src_orders ORDER BY order_id LIMIT 5")
def e04_preview(spark, sf):
    return profile.preview(testdata.orders(spark, sf), "order_id", 5)


@register("e05_month_spine", """
WITH e05_counts AS (
  SELECT last_day(order_purchase_timestamp) AS m, count(*) AS n
  FROM s_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1),
e05_spine AS (
  SELECT last_day(CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP),
                                              CAST(date_trunc('month', hi) AS TIMESTAMP),
                                              INTERVAL 1 MONTH)) AS DATE)) AS m
  FROM (SELECT min(m) AS lo, max(m) AS hi FROM e05_counts))
SELECT CAST(s.m AS TIMESTAMP) AS order_purchase_timestamp, coalesce(c.n, 0) AS orders_count
FROM e05_spine s LEFT JOIN e05_counts c ON s.m = c.m""")
def e05_month_spine(spark, sf):
    return profile.orders_by_month_end(_silver(spark, sf)["orders"])


@register("e06_status_share", """
SELECT order_status, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 2) AS percentage
FROM s_orders WHERE order_status IS NOT NULL GROUP BY order_status""")
def e06_status_share(spark, sf):
    return profile.value_share(_silver(spark, sf)["orders"], "order_status")


@register("e07_naive_late", """
SELECT count(*) AS delivered_orders,
       avg(CAST(coalesce(delay_days > 0, false) AS INTEGER)) * 100 AS late_rate
FROM s_orders WHERE order_status = 'delivered'""")
def e07_naive_late(spark, sf):
    return profile.naive_late_rate(_silver(spark, sf)["orders"])


@register("e08_naive_impact", """
SELECT coalesce(o.delay_days > 0, false) AS late_delivery, count(o.order_id) AS orders_count,
       avg(r.review_score) AS avg_review_score,
       avg(CAST(coalesce(r.review_score <= 2, false) AS INTEGER)) * 100 AS negative_review_rate
FROM s_orders o LEFT JOIN s_reviews r ON o.order_id = r.order_id
WHERE o.order_status = 'delivered' GROUP BY 1""")
def e08_naive_impact(spark, sf):
    s = _silver(spark, sf)
    return profile.naive_impact(s["orders"], s["reviews"])


@register("e09_top_categories", """
SELECT coalesce(p.product_category_name_english, 'unknown') AS product_category_name_english,
       count(i.order_id) AS items_count, count(DISTINCT i.order_id) AS orders_count,
       CAST(coalesce(sum(i.price), 0) AS DOUBLE) AS revenue
FROM s_order_items i LEFT JOIN g_products p ON i.product_id = p.product_id
GROUP BY 1 ORDER BY items_count DESC, 1 LIMIT 15""")
def e09_top_categories(spark, sf):
    s = _silver(spark, sf)
    return profile.top_categories(s["order_items"], s["products"], s["category_translation"])


@register("e10_state_delay", """
SELECT c.customer_state, count(o.order_id) AS orders_count,
       avg(CAST(coalesce(o.delay_days > 0, false) AS INTEGER)) * 100 AS late_rate,
       avg(o.delay_days) AS avg_delay_days
FROM s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id
WHERE o.order_status = 'delivered' AND c.customer_state IS NOT NULL GROUP BY 1""")
def e10_state_delay(spark, sf):
    s = _silver(spark, sf)
    return profile.state_delay(s["orders"], s["customers"])


@register("e11_seller_pairs", """
SELECT seller_id, seller_state, count(DISTINCT order_id) AS orders_count,
       avg(CAST(late AS INTEGER)) * 100 AS late_rate, avg(delay_days) AS avg_delay_days
FROM (SELECT o.order_id, coalesce(o.delay_days > 0, false) AS late, o.delay_days, p.seller_id, s.seller_state
      FROM s_orders o
      LEFT JOIN (SELECT DISTINCT order_id, seller_id FROM s_order_items) p ON o.order_id = p.order_id
      LEFT JOIN s_sellers s ON p.seller_id = s.seller_id
      WHERE o.order_status = 'delivered')
WHERE seller_id IS NOT NULL AND seller_state IS NOT NULL
GROUP BY 1, 2 HAVING count(DISTINCT order_id) >= 50
ORDER BY late_rate DESC, seller_id, seller_state LIMIT 15""")
def e11_seller_pairs(spark, sf):
    s = _silver(spark, sf)
    return profile.seller_pairs(s["orders"], s["order_items"], s["sellers"])


# ---------------------------------------------------------------------------------------------
# A: sources, sinks, snapshots. Each run writes under its own folder of the checkpoint root.
# ---------------------------------------------------------------------------------------------

def _landing(spark, sf) -> tuple[str, dict[str, str]]:
    """Raw CSV files of the nine derived tables in a fresh folder, and their manifest."""
    root = scratch_dir(spark, "landing")
    tables = testdata.source_tables(spark, sf, together=True)
    files.write_landing(tables, root)
    return root, {t: MANIFEST[t] for t in tables}


def _bronze(spark, sf, batches=("ingestion_20240101_000000",)) -> tuple[str, dict[str, str]]:
    landing, manifest = _landing(spark, sf)
    root = scratch_dir(spark, "lake")
    for b in batches:
        files.ingest_bronze(spark, landing, root, b, manifest)
    return root, manifest


def _tagged_sql(prefix: str, extra: dict[str, list[str]] | None = None, batch: str | None = None) -> str:
    """Every row of every table as (table, text of its columns): timestamps to the second."""
    parts = []
    for t in testdata.DERIVATIONS:
        cols = [*DECLARED[t], *(extra or {}).get(t, [])]
        text = [f"coalesce({_text_sql(t, c)}, '<null>')" for c in cols]
        tag = f"'{batch}' AS batch_id, " if batch else ""
        parts.append(f"SELECT '{t}' AS table_name, {tag}{' || chr(124) || '.join(text)} AS row_text FROM {prefix}{t}")
    return "\nUNION ALL\n".join(parts)


def _text_sql(table: str, c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c in DATE_COLUMNS.get(table, []) else f"CAST({c} AS VARCHAR)"


def _tagged(tables: dict[str, DataFrame], extra: dict[str, list[str]] | None = None, **tags: str) -> DataFrame:
    parts = []
    for t, df in tables.items():
        cols = [*DECLARED[t], *(extra or {}).get(t, [])]
        types = dict(df.dtypes)
        text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") if types[c] == "timestamp_ntz" else F.col(c).cast("string") for c in cols]
        parts.append(df.select(F.lit(t).alias("table_name"), *[F.lit(v).alias(k) for k, v in tags.items()],
                               F.concat_ws("|", *[F.coalesce(x, F.lit("<null>")) for x in text]).alias("row_text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Columns that the Silver rules add.
_SILVER_EXTRA = {"orders": ["estimated_delivery_days", "delay_days", "late_delivery"], "reviews": ["negative_review"],
                 "products": ["product_volume_cm3"]}


@register("a01_manifest", "SELECT * FROM (VALUES " + ", ".join(
    f"('{t}', '{f}', {'false' if t == 'geolocation' else 'true'})" for t, f in MANIFEST.items())
    + ") AS m(table_name, file_name, present)")
def a01_manifest(spark, sf):
    """Eight of the nine files have been delivered: the ninth is reported as missing."""
    root = scratch_dir(spark, "landing")
    files.write_landing({t: df for t, df in _sources(spark, sf).items() if t != "geolocation"}, root)
    return files.manifest_status(spark, root, MANIFEST)


@register("a02_bronze", _tagged_sql("src_"))
def a02_bronze(spark, sf):
    root, manifest = _bronze(spark, sf)
    return _tagged(files.scan(spark, root, "bronze", list(manifest)))


@register("a02_bronze_stream", _tagged_sql("src_"))
def a02_bronze_stream(spark, sf):
    from delivery_lake.streaming.bronze_stream import read_stream_table, stream_ingest

    landing, manifest = _landing(spark, sf)
    root = scratch_dir(spark, "lake")
    stream_ingest(spark, landing, root, "ingestion_20240101_000000", manifest)
    return _tagged({t: read_stream_table(spark, root, t) for t in manifest})


@register("a03_latest_batch", _tagged_sql("src_", batch="ingestion_20240301_000000"))
def a03_latest_batch(spark, sf):
    root, manifest = _bronze(spark, sf, ("ingestion_20240101_000000", "ingestion_20240301_000000"))
    latest = files.latest_batch(spark, root, "bronze", list(manifest))
    return _tagged(files.scan(spark, root, "bronze", list(manifest), latest), batch_id=latest)


@register("a04_typed_scan", _tagged_sql("src_"))
def a04_typed_scan(spark, sf):
    root, manifest = _bronze(spark, sf)
    return _tagged(files.typed_scan(spark, root, "bronze", list(manifest)))


@register("a05_silver", _tagged_sql("s_", _SILVER_EXTRA))
def a05_silver(spark, sf):
    root, manifest = _bronze(spark, sf)
    raw = files.scan(spark, root, "bronze", list(manifest))
    files.write_tables(cleaning.clean_tables(raw, by_hash=True), root, "silver", "cleaning_20240101_000000")
    return _tagged(files.scan(spark, root, "silver", list(manifest)), _SILVER_EXTRA)


def _gold_sql() -> dict[str, str]:
    return {"orders_enriched": "SELECT * FROM g_wide",
            "delivery_kpis_by_state": segment_sql(["customer_state"], False),
            "delivery_kpis_by_seller": segment_sql(["main_seller_id", "main_seller_state"], False),
            "delivery_kpis_by_category": segment_sql(["main_product_category"], False),
            "ml_dataset": "SELECT * FROM g_ml"}


_KPI_TYPES = {"orders_count": "bigint", "late_rate": "double", "avg_delivery_days": "double", "avg_delay_days": "double",
              "avg_review_score": "double", "negative_review_rate": "double"}
_ORDER_TYPES = {"order_id": "string", "customer_id": "string", "order_status": "string", "late_delivery": "boolean",
                **{c: "timestamp_ntz" for c in DATE_COLUMNS["orders"]}}
#: Columns of each Gold table that are compared, with their types in the CSV copy.
_GOLD_TYPES = {
    "orders_enriched": {**_ORDER_TYPES, "estimated_delivery_days": "bigint", "delay_days": "bigint", "customer_state": "string",
                        "item_count": "bigint", "product_count": "bigint", "seller_count": "bigint", "total_price": "double",
                        "total_freight": "double", "avg_price": "double", "main_seller_id": "string", "main_seller_city": "string",
                        "main_seller_state": "string", "main_product_category": "string", "payment_value": "double",
                        "payment_installments": "int", "payment_types_count": "bigint", "payment_type": "string",
                        "review_score": "double", "negative_review": "boolean", "purchase_month": "int", "purchase_dayofweek": "int",
                        "purchase_year_month": "string", "delivery_days": "bigint"},
    "delivery_kpis_by_state": {"customer_state": "string", **_KPI_TYPES},
    "delivery_kpis_by_seller": {"main_seller_id": "string", "main_seller_state": "string", **_KPI_TYPES},
    "delivery_kpis_by_category": {"main_product_category": "string", **_KPI_TYPES},
    "ml_dataset": {"order_id": "string", "late_delivery": "boolean", "customer_state": "string", "main_seller_state": "string",
                   "main_product_category": "string", "item_count": "bigint", "product_count": "bigint", "seller_count": "bigint",
                   "total_price": "double", "total_freight": "double", "payment_value": "double", "payment_installments": "int",
                   "payment_type": "string", "estimated_delivery_days": "bigint", "purchase_month": "int", "purchase_dayofweek": "int"},
}


def _long_sql(tables: dict[str, str]) -> str:
    """Gold tables by row key and column: text and whole numbers as text, doubles as numbers."""
    parts = []
    for t, q in tables.items():
        key = next(iter(_GOLD_TYPES[t]))
        for c, kind in list(_GOLD_TYPES[t].items())[1:]:
            text = "CAST(NULL AS VARCHAR)" if kind == "double" else f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if kind == "timestamp_ntz" else f"CAST({c} AS VARCHAR)"
            number = f"CAST({c} AS DOUBLE)" if kind == "double" else "CAST(NULL AS DOUBLE)"
            parts.append(f"SELECT '{t}' AS table_name, {key} AS row_key, '{c}' AS column_name, {text} AS text_value, {number} AS number_value FROM ({q})")
    return "\nUNION ALL\n".join(parts)


def _long(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for t, df in tables.items():
        key, *cols = _GOLD_TYPES[t]
        cells = []
        for c in cols:
            kind = _GOLD_TYPES[t][c]
            text = F.lit(None).cast("string") if kind == "double" else F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind == "timestamp_ntz" else F.col(c).cast("string")
            number = F.col(c).cast("double") if kind == "double" else F.lit(None).cast("double")
            cells.append(F.struct(F.lit(c).alias("column_name"), text.alias("text_value"), number.alias("number_value")))
        part = df.select(F.lit(t).alias("table_name"), F.col(key).alias("row_key"), F.inline(F.array(*cells)))
        out = part if out is None else out.unionByName(part)
    return out


@register("a06_gold_csv", _long_sql(_gold_sql()))
def a06_gold_csv(spark, sf):
    out = scratch_dir(spark, "gold-csv")
    wide = _written(_wide(spark, sf), "wide")
    files.export_gold_csv(gold.gold_tables(wide), out, "gzip")
    read = {}
    for t, types in _GOLD_TYPES.items():
        raw = files.read_raw_csv(spark, f"{out}/{GOLD_TABLES[t]}", multi_line=False)
        read[t] = raw.select(*[F.col(c).cast(k).alias(c) for c, k in types.items()])
    return _long(read)


@register("a09_fallback", "SELECT *, 'gold' AS data_source FROM g_wide")
def a09_fallback(spark, sf):
    root = scratch_dir(spark, "lake")
    files.write_tables({"orders_enriched": _wide(spark, sf)}, root, "gold", "gold_20240101_000000")

    def database():
        raise ConnectionError("no database configured")

    readers = [
        ("database", database),
        ("deployed csv", lambda: files.read_raw_csv(spark, f"{root}/deploy/orders_enriched.csv")),
        ("gold", files.latest_gold_reader(spark, root)),
    ]
    df, label, _, _ = files.load_orders_with_fallback(spark, readers)
    return df.withColumn("data_source", F.lit(label))


# ---------------------------------------------------------------------------------------------
# F: machine learning. A fitted model is kept per (data folder, model kind) in this process.
# ---------------------------------------------------------------------------------------------

# Rule used as "prediction" for the SQL-checkable evaluation queries.
RULE_MAX_PROMISED_DAYS = 25


def _ml_data(spark, sf):
    return ml.coerce_target(enrich.ml_dataset(_wide(spark, sf)))


def _split(spark, sf, wide=None):
    """The split of the ML table (of ``wide``, where that is written already). The ML table is written once into
    the shared checkpoint folder, but for that of a written ``wide``: the split reads it three times and training
    many more. Each query makes its own split and model, so its work does not depend on what ran before in the
    process."""
    data = _written(_ml_data(spark, sf), "ml") if wide is None else ml.coerce_target(enrich.ml_dataset(wide))
    return _written(ml.stratified_split(data), "split")


def _train(split):
    return split.where(~F.col("is_test"))


def _test(split):
    return split.where(F.col("is_test"))


def _prepared(split):
    """The fitted preprocessing alone (everything in front of the classifier)."""
    from pyspark.ml import Pipeline

    train = ml.with_class_weights(_train(split))
    return Pipeline(stages=ml.build_pipeline(train).getStages()[:-1]).fit(train)


def _rule_predictions(spark, sf, days=RULE_MAX_PROMISED_DAYS):
    rule = (F.col("estimated_delivery_days") <= days).cast("double")
    return _ml_data(spark, sf).withColumn("prediction", F.coalesce(rule, F.lit(0.0)))


_RULE_SQL = (f"SELECT *, CAST(late_delivery AS INTEGER) AS y, "
             f"coalesce(CAST(estimated_delivery_days <= {RULE_MAX_PROMISED_DAYS} AS INTEGER), 0) AS p FROM g_ml")

_SPLIT_SQL = """
f_hash AS (SELECT *, CAST(late_delivery AS DOUBLE) AS label, md5('42:' || CAST(order_id AS VARCHAR)) AS h FROM g_ml),
f_split AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, order_id)
              <= floor(count(*) OVER (PARTITION BY label) * 0.2 + 0.5) AS is_test
  FROM f_hash)"""


@register("f01_target", "SELECT *, CAST(late_delivery AS DOUBLE) AS label FROM g_ml")
def f01_target(spark, sf):
    return _ml_data(spark, sf)


@register("f02_features", f"""
SELECT feature, kind, CAST(row_number() OVER (PARTITION BY kind ORDER BY position) - 1 AS INTEGER) AS position FROM (
  SELECT column_name AS feature, position, CASE WHEN dtype IN ('bigint', 'double') THEN 'numeric' ELSE 'categorical' END AS kind
  FROM ({_types_sql("g_ml", ML_COLUMNS, "'ml' AS table_name")}) WHERE column_name NOT IN ('order_id', 'late_delivery'))""")
def f02_features(spark, sf):
    """Features of the ML table read as text, typed by its values."""
    data = enrich.ml_dataset(_wide(spark, sf))
    return ml.feature_table(data.select(*[F.col(c).cast("string").alias(c) for c in data.columns]))


@register("f03_class_share", """
SELECT late_delivery, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 2) AS percentage
FROM g_ml WHERE late_delivery IS NOT NULL GROUP BY late_delivery""")
def f03_class_share(spark, sf):
    return profile.value_share(enrich.ml_dataset(_wide(spark, sf)), "late_delivery")


@register("f04_split", "WITH " + _SPLIT_SQL + "\nSELECT order_id, label, is_test FROM f_split")
def f04_split(spark, sf):
    return _split(spark, sf).select("order_id", "label", "is_test")


def _median_sql(c: str) -> str:
    return f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM f_split WHERE NOT is_test)"


def _stats_sql() -> str:
    parts = []
    for c in NUMERIC_FEATURES:
        parts.append(f"""SELECT '{c}' AS feature, med AS median,
  round(avg(coalesce(CAST({c} AS DOUBLE), med)), 6) AS mean,
  round(stddev_samp(coalesce(CAST({c} AS DOUBLE), med)), 6) AS stddev
FROM f_split, (SELECT {_median_sql(c)} AS med)
WHERE NOT is_test GROUP BY med""")
    return "WITH " + _SPLIT_SQL + "\n" + "\nUNION ALL\n".join(parts)


@register("f05_impute_scale", _stats_sql())
def f05_impute_scale(spark, sf):
    rows = ml.fitted_stats(_prepared(_split(spark, sf)), NUMERIC_FEATURES)
    stats = spark.createDataFrame(rows, "feature string, median double, mean double, stddev double")
    return stats.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


def _slots_sql() -> str:
    """Per categorical feature: value -> slot by descending train count (ties: value), and the fill."""
    ctes = []
    for c in CATEGORICAL_FEATURES:
        ctes.append(f"""m_{c} AS (SELECT {c} AS v FROM f_split WHERE NOT is_test AND {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
t_{c} AS (SELECT coalesce({c}, (SELECT v FROM m_{c})) AS v, count(*) AS n FROM f_split WHERE NOT is_test GROUP BY 1),
i_{c} AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS slot FROM t_{c} WHERE v IS NOT NULL)""")
    return "WITH " + _SPLIT_SQL + ",\n" + ",\n".join(ctes)


_SLOT_COLUMNS = ", ".join(f"i_{c}.slot AS {c}_slot, (SELECT count(*) FROM i_{c}) AS {c}_slots" for c in CATEGORICAL_FEATURES)
_SLOT_JOINS = " ".join(f"LEFT JOIN i_{c} ON coalesce(g.{c}, (SELECT v FROM m_{c})) = i_{c}.v" for c in CATEGORICAL_FEATURES)


@register("f06_onehot", f"{_slots_sql()}\nSELECT g.order_id, {_SLOT_COLUMNS} FROM g_ml g {_SLOT_JOINS}")
def f06_onehot(spark, sf):
    from pyspark.ml.functions import vector_to_array

    split = _split(spark, sf)  # every row of the ML table, as written
    out = _prepared(split).transform(split).withColumns(
        {c: vector_to_array(f"{c}__ohe") for c in CATEGORICAL_FEATURES})
    slot = lambda c: F.nullif(F.array_position(c, F.lit(1.0)), F.lit(0)) - 1
    return out.select("order_id", *[x for c in CATEGORICAL_FEATURES for x in (
        slot(c).alias(f"{c}_slot"), F.size(c).cast("long").alias(f"{c}_slots"))])


def _assemble_sql() -> str:
    stats = ", ".join(f"(SELECT {_median_sql(c)}) AS med_{c}" for c in NUMERIC_FEATURES)
    moments = ", ".join(f"avg(coalesce(CAST({c} AS DOUBLE), med_{c})) AS mean_{c}, stddev_samp(coalesce(CAST({c} AS DOUBLE), med_{c})) AS std_{c}"
                        for c in NUMERIC_FEATURES)
    scaled = ", ".join(f"round((coalesce(CAST(g.{c} AS DOUBLE), med_{c}) - mean_{c}) / std_{c}, 6) AS {c}" for c in NUMERIC_FEATURES)
    slots, before = [], "0"
    for c in CATEGORICAL_FEATURES:
        slots.append(f"{before} + i_{c}.slot AS {c}_at")
        before += f" + (SELECT count(*) FROM i_{c})"
    return (f"{_slots_sql()},\nf_med AS (SELECT {stats}),\nf_mom AS (SELECT {moments} FROM f_split, f_med WHERE NOT is_test)\n"
            f"SELECT g.order_id, {scaled}, {', '.join(slots)}, {before} AS slots FROM g_ml g {_SLOT_JOINS}, f_med, f_mom")


@register("f07_assemble", _assemble_sql())
def f07_assemble(spark, sf):
    """The assembled vector: scaled numbers, then where the ones are among the one-hot slots."""
    from pyspark.ml.functions import vector_to_array

    split = _split(spark, sf)  # every row of the ML table, as written
    out = _prepared(split).transform(split).select("order_id", vector_to_array("features").alias("v"), *[
        F.size(vector_to_array(f"{c}__ohe")).alias(f"n_{c}") for c in CATEGORICAL_FEATURES])
    n = len(NUMERIC_FEATURES)
    columns = [F.round(F.col("v")[i], 6).alias(c) for i, c in enumerate(NUMERIC_FEATURES)]
    start = F.lit(0)
    for c in CATEGORICAL_FEATURES:
        own = F.slice("v", start + n + 1, F.col(f"n_{c}"))
        columns.append((start + F.nullif(F.array_position(own, F.lit(1.0)), F.lit(0)) - 1).alias(f"{c}_at"))
        start = start + F.col(f"n_{c}")
    return out.select("order_id", *columns, (F.size("v") - n).cast("long").alias("slots"))


@register("f08_forest", "WITH " + _SPLIT_SQL + """
SELECT order_id, label, true AS same, true AS leaves_kept, true AS depth_kept FROM f_split WHERE is_test""")
def f08_forest(spark, sf):
    """Every test row routed through the exported trees gets the model's probability; leaves and depth
    are within the forest's settings."""
    split = _split(spark, sf)
    return certificates.forest_certificate(
        ml.fit(_train(split), "forest"), _test(split), ["order_id", "label"],
        FOREST_PARAMS["minInstancesPerNode"], FOREST_PARAMS["maxDepth"])


@register("f09_logistic", _slots_sql() + ",\nf_names AS (" + " UNION ALL ".join(
    [f"SELECT {i} AS a, 0 AS b, '{c}' AS feature" for i, c in enumerate(NUMERIC_FEATURES)]
    + [f"SELECT {len(NUMERIC_FEATURES) + i}, slot, '{c}=' || v FROM i_{c}" for i, c in enumerate(CATEGORICAL_FEATURES)]
    + ["SELECT 1000, 0, 'intercept'"]) + """)
SELECT CAST(row_number() OVER (ORDER BY a, b) - 1 AS INTEGER) AS position, feature, true AS stationary FROM f_names""")
def f09_logistic(spark, sf):
    """The first-order condition of every coefficient over the training rows."""
    train = _train(_split(spark, sf))
    return certificates.optimality(
        ml.fit(train, "logistic"), train, NUMERIC_FEATURES, CATEGORICAL_FEATURES).drop("slope")


def _in_range():
    """A prediction is 0 or 1, its probability in 0 to 1, and the class the likelier one."""
    p, y = F.col("late_probability"), F.col("prediction")
    return (y.isin(0.0, 1.0) & p.between(0.0, 1.0) & ((y == 1.0) == (p > 0.5))).alias("in_range")


@register("f10_predict", "WITH " + _SPLIT_SQL + "\nSELECT order_id, label, true AS in_range FROM f_split WHERE is_test")
def f10_predict(spark, sf):
    split = _split(spark, sf)
    return ml.predict(ml.fit(_train(split), "forest"), _test(split)).select("order_id", "label", _in_range())


_REPORT_CTES = f"""f_rule AS ({_RULE_SQL}),
f_c AS (
  SELECT count(*) FILTER (WHERE y = 0 AND p = 0) AS tp0, count(*) FILTER (WHERE y = 0) AS sup0,
         count(*) FILTER (WHERE p = 0) AS pred0,
         count(*) FILTER (WHERE y = 1 AND p = 1) AS tp1, count(*) FILTER (WHERE y = 1) AS sup1,
         count(*) FILTER (WHERE p = 1) AS pred1
  FROM f_rule),
f_m AS (
  SELECT *, CASE WHEN pred0 > 0 THEN tp0 / pred0 ELSE 0.0 END AS p0,
            CASE WHEN sup0 > 0 THEN tp0 / sup0 ELSE 0.0 END AS r0,
            CASE WHEN pred1 > 0 THEN tp1 / pred1 ELSE 0.0 END AS p1,
            CASE WHEN sup1 > 0 THEN tp1 / sup1 ELSE 0.0 END AS r1
  FROM f_c),
f_f AS (
  SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
            CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1
  FROM f_m)"""
_REPORT_SQL = """SELECT '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, sup0 AS support FROM f_f
UNION ALL SELECT '1', p1, r1, f1, sup1 FROM f_f
UNION ALL SELECT 'accuracy', NULL, NULL,
  CASE WHEN sup0 + sup1 > 0 THEN (tp0 + tp1) / (sup0 + sup1) ELSE 0.0 END, sup0 + sup1 FROM f_f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, sup0 + sup1 FROM f_f
UNION ALL SELECT 'weighted avg',
  CASE WHEN sup0 + sup1 > 0 THEN (p0 * sup0 + p1 * sup1) / (sup0 + sup1) ELSE 0.0 END,
  CASE WHEN sup0 + sup1 > 0 THEN (r0 * sup0 + r1 * sup1) / (sup0 + sup1) ELSE 0.0 END,
  CASE WHEN sup0 + sup1 > 0 THEN (f0 * sup0 + f1 * sup1) / (sup0 + sup1) ELSE 0.0 END, sup0 + sup1 FROM f_f"""


@register("f11_report", f"WITH {_REPORT_CTES}\n{_REPORT_SQL}")
def f11_report(spark, sf):
    return ml.classification_report(_rule_predictions(spark, sf))


@register("f12_confusion", f"""
WITH f_rule AS ({_RULE_SQL})
SELECT y AS true_label, count(*) FILTER (WHERE p = 0) AS predicted_0, count(*) FILTER (WHERE p = 1) AS predicted_1
FROM f_rule GROUP BY y""")
def f12_confusion(spark, sf):
    return ml.confusion_matrix(_rule_predictions(spark, sf))


@register("f13_model_io", "WITH " + _SPLIT_SQL + "\nSELECT order_id, label, true AS same FROM f_split WHERE is_test")
def f13_model_io(spark, sf):
    """Saved and loaded again, the model predicts the same on every test row."""
    split = _split(spark, sf)
    model, test = ml.fit(_train(split)), _test(split)
    loaded = ml.load_model(ml.save_model(model, f"{scratch_dir(spark, 'models')}/forest"))
    before = ml.predict(model, test).withColumnsRenamed({"prediction": "p", "late_probability": "q"})
    same = F.col("prediction").eqNullSafe(F.col("p")) & F.col("late_probability").eqNullSafe(F.col("q"))
    return ml.predict(loaded, test).join(before, ["order_id", "label"]).select("order_id", "label", same.alias("same"))


@register("f14_metrics", f"""WITH {_REPORT_CTES}
SELECT 'run_1' AS run_id, 'report' AS kind, class_label, precision, recall, f1_score, CAST(support AS BIGINT) AS support,
       CAST(NULL AS BIGINT) AS predicted_0, CAST(NULL AS BIGINT) AS predicted_1 FROM ({_REPORT_SQL})
UNION ALL
SELECT 'run_1', 'confusion', CAST(y AS VARCHAR), NULL, NULL, NULL, NULL, count(*) FILTER (WHERE p = 0), count(*) FILTER (WHERE p = 1)
FROM f_rule GROUP BY y""")
def f14_metrics(spark, sf):
    pred = _rule_predictions(spark, sf)
    path = f"{scratch_dir(spark, 'metrics')}/metrics"
    for _ in range(2):  # a run that is written again replaces its rows
        ml.save_metrics(ml.classification_report(pred), ml.confusion_matrix(pred), path, "run_1")
    return spark.read.parquet(path)


@register("f15_score", "SELECT order_id, true AS in_range FROM g_wide")
def f15_score(spark, sf):
    # training and scoring read it: the features of every order, and what picks the ML table's rows
    wide = _written(_wide(spark, sf).select("order_status", *ML_COLUMNS), "wide")
    return ml.predict(ml.fit(_train(_split(spark, sf, wide))), wide, keep=["order_id"]).select("order_id", _in_range())


# Promised days of the rules that F16 compares.
COMPARE_DAYS = (15, 20, 25, 30)


def _compare_sql() -> str:
    parts = [f"""SELECT 'rule_{d}' AS model, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND p = 0) AS fn
FROM (SELECT CAST(late_delivery AS INTEGER) AS y, coalesce(CAST(estimated_delivery_days <= {d} AS INTEGER), 0) AS p FROM g_ml)"""
             for d in COMPARE_DAYS]
    return "WITH f_cmp AS (" + "\nUNION ALL\n".join(parts) + """),
f_rates AS (SELECT *, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS q FROM f_cmp)
SELECT model, r AS recall_late, q AS precision_late, CASE WHEN q + r > 0 THEN 2 * q * r / (q + r) ELSE 0.0 END AS f1_late,
       fp AS false_positives, fn AS false_negatives FROM f_rates"""


@register("f16_compare", _compare_sql())
def f16_compare(spark, sf):
    return ml.compare_models([ml.late_class_summary(_rule_predictions(spark, sf, d), f"rule_{d}") for d in COMPARE_DAYS])


# ---------------------------------------------------------------------------------------------
# G: the whole pipeline
# ---------------------------------------------------------------------------------------------

def _pipeline_sql() -> str:
    gold = _gold_sql()
    counts = [f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS rows FROM {prefix}{t}"
              for layer, prefix in (("bronze", "src_"), ("silver", "s_")) for t in testdata.DERIVATIONS]
    counts += [f"SELECT 'gold' AS layer, '{t}' AS table_name, count(*) AS rows FROM ({q})" for t, q in gold.items()]
    counts.append("SELECT 'ml' AS layer, 'test_rows' AS table_name, count(*) AS rows FROM f_split WHERE is_test")
    rows = " UNION ALL ".join(f"SELECT layer, table_name, CAST(NULL AS VARCHAR) AS row_key, 'rows' AS column_name, CAST(rows AS VARCHAR) AS text_value, CAST(NULL AS DOUBLE) AS number_value FROM ({c})"
                              for c in counts)
    return ("WITH " + _SPLIT_SQL + "\n" + rows + "\nUNION ALL\nSELECT 'gold', table_name, row_key, column_name, text_value, number_value FROM ("
            + _long_sql(gold) + ")")


@register("g01_pipeline", _pipeline_sql())
def g01_pipeline(spark, sf):
    """Row counts of every written table and all cells of the written Gold tables."""
    landing, manifest = _landing(spark, sf)
    root = scratch_dir(spark, "lake")
    summary, info = run_pipeline(spark, landing, root, manifest, stamp="20240101_000000")
    null = F.lit(None)
    counts = summary.where("table_name <> 'metrics'").select(
        "layer", "table_name", null.cast("string").alias("row_key"), F.lit("rows").alias("column_name"),
        F.col("rows").cast("string").alias("text_value"), null.cast("double").alias("number_value"))
    cells = _long(files.scan(spark, root, "gold", list(_GOLD_TYPES), info["batches"]["gold"]))
    return counts.unionByName(cells.select(F.lit("gold").alias("layer"), "*"))
