"""The wide table over facts dealt out by packed ids: same rows as by the text ids, also where ids are no
hexadecimal digits; a hot key keeps the other path; layers are written without a sort and compressed."""

import glob
import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from delivery_lake.functions import pack_id, packed_tokens_to_null, unpack_id
from delivery_lake.operators import cleaning, enrich
from delivery_lake.plans import gold
from delivery_lake.schemas import NULL_TOKENS
from delivery_lake.sources import files, testdata

HEX = "0123456789abcdef"
IDS = ["", "NA", "a", "é" * 8, "x" * 15, "x" * 16, "x" * 17, "x" * 32, HEX * 2, HEX.upper() * 2, HEX * 2 + "\n", HEX + "0" * 15, "NA\0", "0" * 32, "0" * 16]
DAY = dt.datetime(2024, 1, 1, 12)
D = decimal.Decimal


def rows(df, columns=None):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_packed_ids_are_distinct_and_come_back(spark):
    df = spark.createDataFrame([(t,) for t in [*IDS, *NULL_TOKENS, None]], "t string").distinct()
    got = df.select("t", pack_id("t").alias("b"), unpack_id(pack_id("t")).alias("u"), packed_tokens_to_null(pack_id("t")).alias("n")).collect()
    assert all(r.t == r.u for r in got)
    assert len({bytes(r.b) for r in got if r.b is not None}) == len(got) - 1
    assert {r.t for r in got if r.n is None} == {*NULL_TOKENS, None}
    assert all(len(r.b) == 16 for r in got if r.t in (HEX * 2, "0" * 32))


def odd_tables(spark, sf):
    """Ids of all kinds, nulls, missing-value tokens, full duplicates, ties and orders whose first item has no category."""
    t = testdata.source_tables(spark, sf)
    ids = ["o1", HEX * 2, "f" * 32, "F" * 32, "NA", None]
    products = [HEX * 2, "p", "0" * 32, "zz", None, "none"]
    orders = [(o, c, "delivered", DAY, DAY, DAY, DAY, DAY) for o, c in zip(ids, ["c1", "NA", HEX * 2, None, "c1", "c1"])]
    items = [(o, n, products[(n + k) % 6], s, D("5.00"), D("1.00"), DAY) for k, o in enumerate(ids) for n in (1, 2, 2, 3)
             for s in ("a" * 32, "A" * 32, "")]
    t["orders"] = spark.createDataFrame(orders * 2, t["orders"].schema)
    t["order_items"] = spark.createDataFrame(items + items[:9], t["order_items"].schema)
    t["payments"] = spark.createDataFrame([(o, n, "card", n, D(n)) for o in ids for n in (1, 1, 2)], t["payments"].schema)
    t["reviews"] = spark.createDataFrame([(o, n, DAY, DAY) for o in ids for n in (1, 1, 5)], t["reviews"].schema)
    t["customers"] = spark.createDataFrame([("c1", "S1"), (HEX * 2, "S2"), ("NA", "S3"), (None, "S4")], t["customers"].schema)
    t["sellers"] = spark.createDataFrame([("A" * 32, "x", "T1"), ("a" * 32, "y", "T2")], t["sellers"].schema)
    t["products"] = spark.createDataFrame([(HEX * 2, "K1", 1.0, 1.0, 1.0), ("p", None, 1.0, 1.0, 1.0), ("zz", "K2", 1.0, 1.0, 1.0),
                                           ("0" * 32, "K3", 1.0, 1.0, 1.0), (None, "K1", 1.0, 1.0, 1.0)], t["products"].schema)
    t["category_translation"] = spark.createDataFrame([("K1", "k1"), ("K2", "k2")], t["category_translation"].schema)
    return t


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_dealt_wide_table_has_the_rows_of_the_plain_one(spark, sf_small, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        tables = odd_tables(spark, sf_small)
        want = enrich.orders_enriched(cleaning.clean_tables(tables))
        got = gold.wide_of(tables)
        assert got.dtypes == want.dtypes
        assert rows(got) == rows(want)
        assert rows(gold.wide_orders(spark, sf_small)) == rows(enrich.orders_enriched(gold.silver_tables(spark, sf_small)))
        assert rows(gold.items_by_order(spark, sf_small)) == rows(enrich.items_by_order(gold.silver_tables(spark, sf_small)["order_items"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_items_are_shuffled_once_for_all_readers(spark, sf_small):
    """Sums, seller, counts and category share the items' shuffle; before, each moved all items."""
    df = gold.wide_orders(spark, sf_small)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [x for x in plan.splitlines() if "FileScan" in x and "lineitem.parquet" in x]
    assert len(scans) == 2  # items and payments


def test_hot_key_keeps_the_partial_aggregation(spark, sf_small):
    tables = odd_tables(spark, sf_small)
    assert files.most_rows([(tables["payments"].where("order_id is not null"), "order_id")]) == 3
    assert gold.dealt_facts(tables, hot_rows=2) is None
    assert rows(gold.wide_of(tables, hot_rows=2)) == rows(gold.wide_of(tables))


def test_layers_are_compressed_and_written_without_a_sort(spark, sf_small, tmp_path):
    orders = testdata.orders(spark, sf_small)
    root = str(tmp_path)
    files.write_layer(orders, root, "bronze", "orders", "ingestion_1")
    files.write_layer(orders.limit(5), root, "bronze", "orders", "ingestion_2")
    files.write_layer(orders, root, "bronze", "orders", "ingestion_1")
    assert rows(files.read_layer(spark, root, "bronze", "orders", "ingestion_1").drop("batch_id")) == rows(orders)
    assert files.read_layer(spark, root, "bronze", "orders", "ingestion_2").count() == 5
    assert all(".zstd." in f for f in glob.glob(f"{root}/bronze/orders/batch_id=*/*.parquet"))
    files.write_landing({"orders": orders}, f"{root}/landing")
    parts = glob.glob(f"{root}/landing/orders.csv/part-*")
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    plain = files.write_csv(orders, f"{root}/plain")
    size = lambda names: sum(os.path.getsize(f) for f in names)
    assert size(parts) < 0.7 * size(glob.glob(f"{plain}/part-*"))
    assert rows(files.read_raw_csv(spark, f"{root}/landing/orders.csv", multi_line=False)) == rows(files.read_raw_csv(spark, plain))


def test_landing_of_ids_takes_less_than_plain_gzip(spark, tmp_path):
    ids = spark.range(20_000).select(*[F.md5(F.concat(F.lit(k), F.col("id").cast("string"))).alias(k) for k in ("order_id", "product_id", "seller_id")])
    ids = ids.coalesce(1)
    files.write_landing({"order_items": ids}, f"{tmp_path}/landing")
    ids.write.option("header", True).option("compression", "gzip").csv(f"{tmp_path}/plain")
    size = lambda folder: sum(os.path.getsize(f) for f in glob.glob(f"{folder}/part-*.csv.gz"))
    landed = glob.glob(f"{tmp_path}/landing/*.csv")[0]
    assert 0 < size(landed) < 0.95 * size(f"{tmp_path}/plain")
    assert rows(files.read_raw_csv(spark, landed, multi_line=False)) == rows(ids)


def test_pieces_of_quoted_csv_are_compressed(spark, tmp_path):
    from delivery_lake.session import checkpoint_root
    from delivery_lake.sources.quoted_csv import read_quoted_csv

    pieces = lambda: set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/csv-pieces-*/pieces/part-*"))
    (tmp_path / "r.csv").write_text("a,b\n" + "".join(f"{i},text {i}\n" for i in range(5000)))
    before = pieces()
    assert read_quoted_csv(spark, str(tmp_path / "r.csv")).count() == 5000
    assert pieces() - before and all(".zstd." in f for f in pieces() - before)


def test_bronze_keeps_equal_ids_together(spark, tmp_path):
    """Each task puts its rows in order by the id that repeats: the same rows take less room."""
    order = F.md5((F.col("id") % 50_000).cast("string"))
    payments = spark.range(200_000).select(order.alias("order_id"), (F.col("id") / 50_000).cast("int").alias("payment_sequential")).coalesce(1)
    landing, root = files.write_landing({"payments": payments}, f"{tmp_path}/landing"), f"{tmp_path}/lake"
    files.ingest_bronze(spark, landing, root, "ingestion_1", {"payments": "payments.csv"})
    path = f"{root}/bronze/payments/batch_id=ingestion_1"
    ids = [[r[0] for r in spark.read.parquet(f).select("order_id").collect()] for f in glob.glob(f"{path}/*.parquet")]
    assert ids and all(x == sorted(x) for x in ids)
    raw = files.read_raw_csv(spark, f"{landing}/payments.csv", multi_line=False)
    assert rows(files.scan(spark, root, "bronze", ["payments"])["payments"]) == rows(raw)
    raw.withColumn("source_file", F.lit("payments.csv")).write.option("compression", "zstd").parquet(f"{tmp_path}/as_read")
    size = lambda folder: sum(os.path.getsize(f) for f in glob.glob(f"{folder}/*.parquet"))
    assert size(path) < 0.6 * size(f"{tmp_path}/as_read")


def test_landing_tables_together_have_the_same_rows(spark, sf_small):
    plain, together = testdata.source_tables(spark, sf_small), testdata.source_tables(spark, sf_small, together=True)
    for t, df in plain.items():
        assert rows(together[t]) == rows(df)
        assert ("Sort [" in together[t]._jdf.queryExecution().executedPlan().toString()) == (t in testdata.TOGETHER)


def test_landing_reviews_are_compressed_and_read_in_splits(spark, tmp_path):
    from delivery_lake.sources.quoted_csv import lines_of, read_quoted_csv

    text = F.concat(F.lit('say "it"\n\n'), F.md5(F.col("id").cast("string")), F.lit(",\nend"))
    reviews = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("order_id"), F.when(F.col("id") % 3 > 0, text).alias("comment")).coalesce(1)
    path = f"{files.write_landing({'reviews': reviews}, f'{tmp_path}/landing')}/reviews.csv"
    parts = glob.glob(f"{path}/part-*")
    assert len(parts) == 1 and parts[0].endswith(".bz2")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        assert lines_of(spark, path).rdd.getNumPartitions() > 3
        found = rows(read_quoted_csv(spark, path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == rows(reviews)


def test_silver_of_stored_tables_moves_hashes_only(spark, sf_small, tmp_path):
    """``by_hash``: the same Silver rows; no whole rows are shuffled where few have copies, and an order's stay together."""
    items, geo = testdata.order_items(spark, sf_small), testdata.geolocation(spark, sf_small)
    raw = {"order_items": items.unionByName(items.where("order_id < '02'")), "geolocation": geo}  # few and many copies
    for t, df in raw.items():
        df.select(*[F.col(c).cast("string") for c in df.columns]).write.parquet(f"{tmp_path}/{t}")
    stored = {t: spark.read.parquet(f"{tmp_path}/{t}") for t in raw}
    plain, by_hash = cleaning.clean_tables(stored), cleaning.clean_tables(stored, by_hash=True)
    for t in raw:
        assert rows(by_hash[t]) == rows(plain[t])
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(order_id")
    moved = by_hash["order_items"]._jdf.queryExecution().executedPlan().toString()
    assert count(plain["order_items"]) == 1 and count(by_hash["order_items"]) == 1 and "BroadcastHashJoin" in moved  # that of the copies
