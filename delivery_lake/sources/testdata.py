"""The nine source tables, derived from the driver's test tables.

The original data set is not available; its tables are derived deterministically from the
TPC-H-style parquet files (orders, lineitem, customer, supplier, part, nation, events). The
same derivation is written in DuckDB SQL in ``plans/oracle.py``. All work is lazy Spark plans
over the whole input tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derivation (see FIXTURES.md): modulus rules that plant edge cases.
SELLER_DROP_MOD = 20          # suppliers with s_suppkey % 20 = 0 have no seller row
CITY_MOD = 7                  # seller_city = 'CITY_' || s_suppkey % 7
CATEGORY_NULL_MOD = 25        # product category null when p_partkey % 25 = 0
LENGTH_NULL_MOD = 40          # product length null when p_partkey % 40 = 0
CANCELED_MOD = 100            # open orders with o_orderkey % 100 = 0 are canceled
UNDATED_MOD = 60              # delivered orders with o_orderkey % 60 = 0 lack a delivery date
NO_PAYMENT_MOD = 30           # orders with l_orderkey % 30 = 0 have no payments
ZIP_MOD = 100                 # geolocation zip prefix = c_custkey % 100
PAYMENT_TYPES = {"A": "credit_card", "N": "boleto", "R": "voucher"}
UNTRANSLATED_TYPE = "PROMO"   # part types containing this word have no translation

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def read_test_table(spark: SparkSession, sf_dir: str, name: str, order: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.sortWithinPartitions(order) if order else df


def text_id(kind: str, key: Column) -> Column:
    """The source system's ids are 32-character texts: the md5 of the kind and the test table's key."""
    return F.md5(F.concat(F.lit(f"{kind}-"), key.cast("string")))


def _plus(ts: Column, unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount, ts)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_test_table(spark, sf_dir, "customer")
    n = read_test_table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        text_id("customer", F.col("c_custkey")).alias("customer_id"), F.col("n_name").alias("customer_state"))


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_test_table(spark, sf_dir, "supplier")
    n = read_test_table(spark, sf_dir, "nation")
    return (s.where(F.col("s_suppkey") % SELLER_DROP_MOD != 0)
            .join(n, s.s_nationkey == n.n_nationkey)
            .select(text_id("seller", F.col("s_suppkey")).alias("seller_id"),
                    F.concat(F.lit("CITY_"), (F.col("s_suppkey") % CITY_MOD).cast("string")).alias("seller_city"),
                    F.col("n_name").alias("seller_state")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_test_table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        text_id("product", k).alias("product_id"),
        F.when(k % CATEGORY_NULL_MOD != 0, F.col("p_type")).alias("product_category_name"),
        F.when(k % LENGTH_NULL_MOD != 0, size).cast("double").alias("product_length_cm"),
        (size % 7 + 1).cast("double").alias("product_height_cm"),
        (size % 5 + 1).cast("double").alias("product_width_cm"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_test_table(spark, sf_dir, "part")
    return (p.where(~F.col("p_type").contains(UNTRANSLATED_TYPE))
            .select(F.col("p_type").alias("product_category_name"))
            .distinct()
            .select("product_category_name",
                    F.lower("product_category_name").alias("product_category_name_english")))


def orders(spark: SparkSession, sf_dir: str, order: str | None = None) -> DataFrame:
    o = read_test_table(spark, sf_dir, "orders", order)
    k = F.col("o_orderkey")
    day0 = F.col("o_orderdate").cast("timestamp_ntz")
    status = (F.when(F.col("o_orderstatus").isin("F", "P"), F.lit("delivered"))
              .when(k % CANCELED_MOD == 0, F.lit("canceled"))
              .otherwise(F.lit("shipped")))
    purchase = _plus(day0, "SECOND", (k * 37) % 86400)
    priority_digit = F.substring("o_orderpriority", 1, 1).cast("int")
    return o.select(
        text_id("order", k).alias("order_id"),
        text_id("customer", F.col("o_custkey")).alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        _plus(purchase, "HOUR", k % 48).alias("order_approved_at"),
        _plus(purchase, "DAY", 1 + k % 6).alias("order_delivered_carrier_date"),
        F.when((status == "delivered") & (k % UNDATED_MOD != 0),
               _plus(purchase, "HOUR", (k * 7919) % 960)).alias("order_delivered_customer_date"),
        _plus(day0, "DAY", 10 + 5 * priority_digit).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str, order: str | None = None) -> DataFrame:
    li = read_test_table(spark, sf_dir, "lineitem", order)
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select(
        text_id("order", F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        text_id("product", F.col("l_partkey")).alias("product_id"),
        text_id("seller", F.col("l_suppkey")).alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(18,2)")).cast("decimal(18,2)").alias("freight_value"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipping_limit_date"),
    )


def payments(spark: SparkSession, sf_dir: str, order: str | None = None) -> DataFrame:
    li = read_test_table(spark, sf_dir, "lineitem", order)
    ptype = F.col("l_returnflag")
    for flag, name in PAYMENT_TYPES.items():
        ptype = F.when(F.col("l_returnflag") == flag, F.lit(name)).otherwise(ptype)
    return li.where(F.col("l_orderkey") % NO_PAYMENT_MOD != 0).select(
        text_id("order", F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        ptype.alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_value"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_test_table(spark, sf_dir, "events")
    eid, ts = F.col("event_id"), F.col("ts").cast("timestamp_ntz")
    return e.select(
        text_id("order", eid - eid % 2).alias("order_id"),
        (1 + F.floor("value") % 5).cast("int").alias("review_score"),
        ts.alias("review_creation_date"),
        _plus(ts, "HOUR", eid % 72).alias("review_answer_timestamp"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: places repeat, so the table has full duplicates."""
    c = read_test_table(spark, sf_dir, "customer")
    n = read_test_table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.lpad((F.col("c_custkey") % ZIP_MOD).cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        F.col("n_name").alias("geolocation_state"))


DERIVATIONS = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "reviews": reviews,
    "products": products,
    "sellers": sellers,
    "category_translation": category_translation,
    "geolocation": geolocation,
}


# Tables that can be exported with a customer's orders, an order's items and payments together.
TOGETHER = {"orders": "o_custkey", "order_items": "l_orderkey", "payments": "l_orderkey"}


def source_tables(spark: SparkSession, sf_dir: str, together: bool = False) -> dict[str, DataFrame]:
    """The nine source tables as lazy, typed DataFrames. ``together``: each task gives its rows in the order of
    ``TOGETHER``, so that equal ids lie side by side in the files written; the rows are the same."""
    return {name: fn(spark, sf_dir, TOGETHER[name]) if together and name in TOGETHER else fn(spark, sf_dir)
            for name, fn in DERIVATIONS.items()}
