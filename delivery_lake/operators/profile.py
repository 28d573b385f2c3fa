"""Exploration and data-profile queries.

These follow the exploratory analysis: they use the *naive* late flag (``delay_days > 0``,
missing date = on time), which differs from the Silver ``late_delivery`` on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from delivery_lake.operators.enrich import translate_products, unique_lookup
from delivery_lake.schemas import DELIVERED, SELLER_PAIRS_MIN_ORDERS, SELLER_PAIRS_ROWS, TOP_CATEGORIES, UNKNOWN


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, number of columns and column names per table, most rows first; one job for all."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows",
            F.lit(len(df.columns)).alias("columns"),
            F.lit(", ".join(df.columns)).alias("column_names"))
        for name, df in tables.items()
    ]).orderBy(F.col("rows").desc(), "table_name")


def missing_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and column with any null: missing count and rate (%, 2 decimals), highest first.

    One aggregation per table counts the nulls of all its columns in a single pass; the
    one-row result is unpivoted."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        long = counts.unpivot("_rows", df.columns, "column_name", "missing_count")
        parts.append(long.where(F.col("missing_count") > 0).select(
            F.lit(name).alias("table_name"), "column_name", "missing_count",
            F.round(F.col("missing_count") / F.col("_rows") * 100, 2).alias("missing_rate")))
    return _union(parts).orderBy(F.col("missing_rate").desc(), F.col("missing_count").desc(), "table_name", "column_name")


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by ``key`` (key order replaces file order)."""
    return df.orderBy(key).limit(n)


def orders_by_month_end(orders: DataFrame, column: str = "order_purchase_timestamp") -> DataFrame:
    """Orders per calendar month labelled by the month's last day, months without
    orders filled with 0. Aggregate first; the month spine is built from the (tiny) result."""
    ts = F.col(column)
    counts = (orders.where(ts.isNotNull())
              .groupBy(F.last_day(ts).alias("month_end"))
              .agg(F.count(F.lit(1)).alias("orders_count")))
    spine = (counts.agg(F.min("month_end").alias("lo"), F.max("month_end").alias("hi"))
             .select(F.explode(F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"),
                                          F.expr("INTERVAL 1 MONTH"))).alias("m"))
             .select(F.last_day("m").alias("month_end")))
    return (spine.join(counts, "month_end", "left")
            .select(F.col("month_end").cast("timestamp_ntz").alias(column),
                    F.coalesce("orders_count", F.lit(0)).alias("orders_count")))


def value_share(df: DataFrame, column: str, name: str = "percentage") -> DataFrame:
    """Share of each non-null value in %, rounded to 2. The window runs over the
    aggregated counts (one row per distinct value), never over raw rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())
    return counts.select(column, F.round(F.col("_n") / total * 100, 2).alias(name))


def naive_late(orders: DataFrame) -> DataFrame:
    """Delivered orders with the naive flag ``delay_days > 0`` (missing date -> false)."""
    return (orders.where(F.col("order_status") == DELIVERED)
            .withColumn("late_delivery", F.coalesce(F.col("delay_days") > 0, F.lit(False))))


def naive_late_rate(orders: DataFrame) -> DataFrame:
    """Delivered orders and their naive late rate (%)."""
    return naive_late(orders).agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        (F.avg(F.col("late_delivery").cast("int")) * 100).alias("late_rate"))


def naive_impact(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Delivered orders ⟕ review rows, by naive late flag: rows, mean score, negative %.

    Counts review rows (an order with two reviews counts twice; one without counts once with a
    missing score, which is not negative). Reviews are first reduced to one row per order
    (partial aggregation), so the join is 1:1 and a hot order cannot skew it."""
    per_order = (reviews.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("review_score").alias("_score_sum"),
        F.count("review_score").alias("_score_n"),
        F.count_if(F.col("review_score") <= 2).alias("_neg")))
    d = naive_late(orders).select("order_id", "late_delivery").join(per_order, "order_id", "left")
    rows = F.coalesce(F.col("_rows"), F.lit(1))
    return d.groupBy("late_delivery").agg(
        F.sum(rows).alias("orders_count"),
        (F.sum("_score_sum") / F.sum("_score_n")).cast("double").alias("avg_review_score"),
        (F.sum(F.coalesce(F.col("_neg"), F.lit(0))) / F.sum(rows) * 100).cast("double").alias("negative_review_rate"))


def top_categories(items: DataFrame, products: DataFrame, translation: DataFrame,
                   n: int = TOP_CATEGORIES) -> DataFrame:
    """Per English category (untranslated -> 'unknown'): items, distinct orders, revenue;
    the ``n`` categories with most items (ties by name)."""
    p = translate_products(products, translation).select("product_id", "product_category_name_english")
    cat = F.coalesce(F.col("product_category_name_english"), F.lit(UNKNOWN))
    return (items.join(p, "product_id", "left")
            .groupBy(cat.alias("product_category_name_english"))
            .agg(F.count("order_id").alias("items_count"),
                 F.count_distinct("order_id").alias("orders_count"),
                 F.coalesce(F.sum("price"), F.lit(0)).cast("double").alias("revenue"))
            .orderBy(F.col("items_count").desc(), "product_category_name_english")
            .limit(n))


def state_delay(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Naive late % and mean delay days by customer state (null state dropped), latest first."""
    d = naive_late(orders).join(customers.select("customer_id", "customer_state"), "customer_id", "left")
    return (d.where(F.col("customer_state").isNotNull()).groupBy("customer_state")
            .agg(F.count("order_id").alias("orders_count"),
                 (F.avg(F.col("late_delivery").cast("int")) * 100).alias("late_rate"),
                 F.avg("delay_days").cast("double").alias("avg_delay_days"))
            .orderBy(F.col("late_rate").desc(), "customer_state"))


def seller_pairs(orders: DataFrame, items: DataFrame, sellers: DataFrame,
                 min_orders: int = SELLER_PAIRS_MIN_ORDERS, n: int = SELLER_PAIRS_ROWS) -> DataFrame:
    """Late % by seller over all distinct (order, seller) pairs of delivered orders,
    sellers with at least ``min_orders`` orders, the ``n`` latest (ties by seller id).

    Aggregated by seller id before the seller's state is looked up: the distinct count shuffles on
    (seller, order) after a partial aggregation, so a hot seller is spread over all tasks, and the
    lookup joins one row per seller. Rows without seller or seller state drop out."""
    pairs = items.where(F.col("order_id").isNotNull() & F.col("seller_id").isNotNull()) \
        .select("order_id", "seller_id").distinct()
    d = naive_late(orders).select("order_id", "late_delivery", "delay_days").join(pairs, "order_id")
    g = d.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("orders_count"),
        (F.avg(F.col("late_delivery").cast("int")) * 100).alias("late_rate"),
        F.avg("delay_days").cast("double").alias("avg_delay_days"))
    known = unique_lookup(sellers.where(F.col("seller_state").isNotNull()), "seller_id", ["seller_state"])
    return (g.where(F.col("orders_count") >= min_orders).join(known, "seller_id")
            .select("seller_id", "seller_state", "orders_count", "late_rate", "avg_delay_days")
            .orderBy(F.col("late_rate").desc(), "seller_id", "seller_state")
            .limit(n))
