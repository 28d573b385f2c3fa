"""Bucketed Silver tables: same rows, no exchange on the order id, a hot order is not bucketed."""

import re
import time

import pytest
from pyspark.sql import functions as F

from delivery_lake.operators import cleaning, enrich
from delivery_lake.plans.pipeline import write_silver
from delivery_lake.schemas import BUCKETED_TABLES, GOLD_INPUTS
from delivery_lake.sources import files, testdata

BATCH = "cleaning_20240101_000000"


def rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def lake(spark, sf_small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    sources = testdata.source_tables(spark, sf_small)
    twice = {t: df.unionByName(df) if t == "order_items" else df for t, df in sources.items()}  # full duplicates go
    return root, sources, write_silver(twice, root, BATCH)[0]


def test_buckets_hold_the_same_rows(spark, lake):
    root, sources, buckets = lake
    assert set(buckets) == set(BUCKETED_TABLES) and len(set(buckets.values())) == 1
    clean = cleaning.clean_tables(sources)
    silver = files.silver_scan(spark, root, GOLD_INPUTS, BATCH)
    for t in BUCKETED_TABLES:
        columns = clean[t].columns
        assert sorted(silver[t].columns) == sorted(columns)
        assert rows(silver[t], columns) == rows(clean[t], columns)
        # plain readers see the same table, with its batch
        assert rows(files.read_layer(spark, root, "silver", t, BATCH), columns) == rows(clean[t], columns)


def test_joins_on_the_order_id_need_no_exchange(spark, lake):
    root, _, _ = lake
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = files.silver_scan(spark, root, GOLD_INPUTS, BATCH)
        wide = enrich.orders_enriched(silver, enrich.check_lookups(silver), colocated=True)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        parts = [enrich.payment_summary(silver["payments"]), enrich.reviews_by_order(silver["reviews"]),
                 silver["orders"].join(enrich.reviews_by_order(silver["reviews"]), "order_id", "left")]
        part_plans = [p._jdf.queryExecution().executedPlan().toString() for p in parts]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = re.findall(r"Exchange hashpartitioning\(order_id", plan)
    # one: the category pick, whose items have been moved to their products
    assert len(moved) == 1 and "Expand" not in plan
    assert not any("Exchange" in p for p in part_plans)
    assert wide.count() == silver["orders"].count()


def test_layout_survives_the_session(spark, lake):
    """Another session declares the buckets again from the batch's mark."""
    root, _, buckets = lake
    path = f"{files.layer_path(root, 'silver', 'orders')}/batch_id={BATCH}"
    spark.sql(f"DROP TABLE {files._bucket_table(path)}")  # an external table: its files stay
    again = files.silver_scan(spark, root, ["orders", "reviews"], BATCH)
    assert again["orders"].count() > 0
    plan = again["orders"].join(enrich.reviews_by_order(again["reviews"]), "order_id")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString() or "BroadcastExchange" in plan._jdf.queryExecution().executedPlan().toString()
    assert files.batch_buckets(spark, root, "silver", BATCH) == buckets


def test_a_hot_order_is_not_put_in_one_bucket(spark, sf_small, tmp_path):
    root = str(tmp_path)
    sources = testdata.source_tables(spark, sf_small)
    hot = F.when(F.col("order_id") < "5", F.lit("0" * 32)).otherwise(F.col("order_id"))
    sources["order_items"] = sources["order_items"].withColumn("order_id", hot)
    assert write_silver(sources, root, BATCH, hot_rows=500)[0] == {}
    silver = files.silver_scan(spark, root, GOLD_INPUTS, BATCH)
    assert rows(silver["order_items"], ["order_id", "price"]) == rows(cleaning.clean_table("order_items", sources["order_items"]), ["order_id", "price"])


def test_unused_item_counts_read_the_items_once(spark, sf_small):
    """A query that needs main sellers only reads lineitem once for the items, once for the payments."""
    wide = enrich.orders_with_facts(cleaning.clean_tables(testdata.source_tables(spark, sf_small)))
    plan = wide.select("order_id", "main_seller_id", "main_product_category")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice") >= 1 and plan.count("Expand") == 0
    scans = wide.select("order_id", "main_seller_id")._sc._jvm.PythonSQLUtils.explainString(
        wide.select("order_id", "main_seller_id")._jdf.queryExecution(), "formatted")
    assert len(re.findall(r"Location: InMemoryFileIndex \[[^\]]*lineitem.parquet", scans)) == 1


def test_checked_lookups_are_joined_as_they_are(spark, sf_small):
    tables = cleaning.clean_tables(testdata.source_tables(spark, sf_small))
    unique = enrich.check_lookups(tables)
    assert unique == {"customers", "sellers", "products", "category_translation"}
    plain, checked = enrich.orders_enriched(tables), enrich.orders_enriched(tables, unique)
    assert rows(plain, plain.columns) == rows(checked, plain.columns)
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("SortAggregate")
    assert count(checked) < count(plain)
    doubled = {**tables, "products": tables["products"].unionByName(tables["products"].withColumn("product_height_cm", F.lit(0.0)))}
    assert enrich.check_lookups(doubled) == unique - {"products"}
    assert rows(enrich.orders_enriched(doubled, enrich.check_lookups(doubled)), plain.columns) == rows(plain, plain.columns)


def test_months_outside_the_range_are_not_read(spark, sf_small, tmp_path):
    from delivery_lake.operators import kpis
    from delivery_lake.plans import gold
    from delivery_lake.schemas import MONTH_COLUMN

    wide = gold.wide_orders(spark, sf_small)
    late = F.when(F.col("order_id") < "01", F.lit(None)).when(F.col("order_id") < "02", F.lit("1996-02-29 23:59:59")).when(
        F.col("order_id") < "03", F.lit("1996-03-01 00:00:00")).when(F.col("order_id") < "04", F.lit("1996-04-30 23:59:59.999999"))
    wide = wide.withColumn("order_purchase_timestamp", F.when(F.col("order_id") < "04", late.cast("timestamp_ntz")).otherwise(F.col("order_purchase_timestamp")))
    wide = wide.withColumn(MONTH_COLUMN, F.date_format("order_purchase_timestamp", "yyyy-MM"))
    plain = str(tmp_path / "plain")
    wide.write.parquet(plain)
    wide = spark.read.parquet(plain)
    path = files.write_by_month(wide, str(tmp_path / "by_month"))
    by_month = files.read_by_month(spark, path)
    columns = ["order_id", "order_purchase_timestamp", MONTH_COLUMN]
    assert rows(by_month, columns) == rows(wide, columns)
    found = kpis.filter_dates(by_month, "1996-03-01", "1996-04-30", month=MONTH_COLUMN)
    assert rows(found, columns) == rows(kpis.filter_dates(wide, "1996-03-01", "1996-04-30"), columns) != []
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert re.search(rf"PartitionFilters: \[isnotnull\({MONTH_COLUMN}", plan)
    assert {f.split(f"{MONTH_COLUMN}=")[1][:7] for f in found.inputFiles()} >= {"1996-03", "1996-04"}
    read = {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    assert {f.split(f"{MONTH_COLUMN}=")[1][:7] for f in read} == {"1996-03", "1996-04"}
    months = kpis.monthly_orders(by_month, MONTH_COLUMN).collect()
    assert months == kpis.monthly_orders(wide).collect()
    assert months[0].purchase_year_month < months[-1].purchase_year_month


def test_facts_are_dealt_out_with_packed_ids(spark):
    """Rows lie by the text's hash, as buckets of it do, what moves is the packed id, and duplicates go in place."""
    ids = ["0123456789abcdef" * 2, "F" * 32, "x" * 16, "", "NA", "é", None]
    df = spark.createDataFrame([(o, p, n) for o in ids for p in ids for n in (1, 1, 2)], "order_id string, product_id string, order_item_id int")
    by_text = df.repartition(5, "order_id").withColumn("part", F.spark_partition_id())
    dealt = cleaning.dealt_out(df, 5, "order_id")
    assert rows(dealt.withColumn("part", F.spark_partition_id()), by_text.columns) == rows(by_text, by_text.columns)
    plan = cleaning.drop_full_duplicates(dealt)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert re.search(r"Exchange hashpartitioning\(CASE WHEN .*, 5\)", plan)


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    from delivery_lake.session import FREE_SHUFFLES, shuffles_freed

    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    held = lambda: {n for n in env.blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if n.startswith("shuffle_")}
    before, was = held(), spark.conf.get(FREE_SHUFFLES)
    rows_ = spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_freed(spark):
        rows_.write.parquet(str(tmp_path / "freed"))
    until = time.time() + 20  # they are removed beside the query
    while not held() <= before and time.time() < until:
        time.sleep(0.2)
    assert held() <= before and spark.conf.get(FREE_SHUFFLES) == was
    assert spark.read.parquet(str(tmp_path / "freed")).count() == 7
    rows_.write.parquet(str(tmp_path / "kept"))
    assert held() - before
