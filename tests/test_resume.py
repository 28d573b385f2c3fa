"""Runs that stopped go on; values lost in parsing are counted; copies are found by their hashes."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from delivery_lake.operators import cleaning, kpis
from delivery_lake.plans import pipeline
from delivery_lake.schemas import GOLD_TABLES, MANIFEST
from delivery_lake.sources import files, testdata


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def written(root, layer):
    return {str(p): p.stat().st_mtime_ns for p in Path(root, layer).rglob("*.parquet")}


def test_a_stopped_run_goes_on(spark, sf_small, tmp_path, monkeypatch):
    sources = testdata.source_tables(spark, sf_small)
    landing = files.write_landing(sources, str(tmp_path / "landing"))
    root, whole = str(tmp_path / "lake"), str(tmp_path / "whole")
    stamp = "20240101_000000"

    def broken(wide):
        raise RuntimeError("lost the cluster")

    monkeypatch.setitem(pipeline.GOLD_OUTPUTS, "delivery_kpis_by_category", broken)
    with pytest.raises(RuntimeError, match="lost the cluster"):
        pipeline.run_pipeline(spark, landing, root, MANIFEST, stamp=stamp, train=False)
    monkeypatch.undo()
    assert pipeline.unfinished_stamp(spark, root) == stamp
    with pytest.raises(FileNotFoundError):
        files.latest_batch(spark, root, "gold")  # Gold was begun, it is not complete
    before = {layer: written(root, layer) for layer in ("bronze", "silver")}
    _, info = pipeline.run_pipeline(spark, landing, root, MANIFEST, train=False, resume=True)
    assert info["skipped"] == ["bronze", "silver"] and info["batches"]["gold"] == f"gold_{stamp}"
    assert {layer: written(root, layer) for layer in ("bronze", "silver")} == before
    assert pipeline.unfinished_stamp(spark, root) is None
    pipeline.run_pipeline(spark, landing, whole, MANIFEST, stamp=stamp, train=False)
    for t in GOLD_TABLES:
        assert rows(files.read_layer(spark, root, "gold", t)) == rows(files.read_layer(spark, whole, "gold", t))
    # a finished run that is resumed writes nothing again
    gold = written(root, "gold")
    _, info = pipeline.run_pipeline(spark, landing, root, MANIFEST, stamp=stamp, train=False, resume=True)
    assert info["skipped"] == ["bronze", "silver", "gold"] and written(root, "gold") == gold


def landing_with_losses(spark, sf_small, folder, bad):
    """Orders with some unreadable approval dates (and some missing ones, which are no loss)."""
    sources = testdata.source_tables(spark, sf_small)
    orders = sources["orders"]
    hit = F.col("order_id") < bad
    text = F.date_format("order_approved_at", "yyyy-MM-dd HH:mm:ss")
    sources["orders"] = orders.withColumn("order_approved_at", F.when(hit, F.lit("soon")).when(F.col("order_id") > "f8", F.lit("NA")).otherwise(text))
    return files.write_landing(sources, folder), orders.where(hit).count(), orders.count()


def test_values_lost_in_parsing_are_counted(spark, sf_small, tmp_path):
    landing, lost, n = landing_with_losses(spark, sf_small, str(tmp_path / "landing"), "05")
    assert 0 < lost < 0.05 * n
    root = str(tmp_path / "lake")
    files.ingest_bronze(spark, landing, root, "ingestion_1", MANIFEST)
    raw = files.scan(spark, root, "bronze", list(MANIFEST), "ingestion_1")
    _, found = pipeline.write_silver(raw, root, "cleaning_1")
    assert found == {("orders", "order_approved_at"): (lost, n)}
    silver = files.silver_scan(spark, root, ["orders"], "cleaning_1")["orders"]
    assert not [c for c in silver.columns if c.startswith("_raw_")] and silver.count() == n


def test_too_many_lost_values_stop_the_run(spark, sf_small, tmp_path):
    landing, lost, n = landing_with_losses(spark, sf_small, str(tmp_path / "landing"), "5")
    root = str(tmp_path / "lake")
    with pytest.raises(ValueError, match=f"orders.order_approved_at: {lost} of {n}"):
        pipeline.run_pipeline(spark, landing, root, MANIFEST, stamp="20240101_000000", train=False)
    assert files.committed_batches(spark, root, "silver") == [] and len(files.committed_batches(spark, root, "bronze")) == 1


def test_counting_losses_adds_no_shuffle(spark, sf_small):
    orders = testdata.orders(spark, sf_small)
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert count(cleaning.clean_table("orders", text, {})) == count(cleaning.clean_table("orders", text))


@pytest.mark.parametrize("most", [1.0, 0.0])
def test_duplicates_by_hash(spark, sf_small, most, monkeypatch):
    """The rows of plain deduplication; hashes that collide are compared whole."""
    reviews = testdata.reviews(spark, sf_small)
    odd = spark.createDataFrame([(None, None, 0.0), (None, None, -0.0), ("a", None, float("nan")), ("a", None, float("nan")), (None, "a", 1.0), ("", "", 1.0), ("", None, 1.0)],
                                "x string, y string, z double")
    for df in (reviews.unionByName(reviews.where("review_score < 3")).withColumn("batch_id", F.lit("b")), odd, odd.limit(0)):
        assert rows(cleaning.drop_duplicates_by_hash(df, most)) == rows(cleaning.drop_full_duplicates(df))
    real = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(7)))
    assert rows(cleaning.drop_duplicates_by_hash(reviews, 1.0)) == rows(reviews.distinct())


def test_rows_without_copies_are_not_shuffled(spark, sf_small):
    reviews = testdata.reviews(spark, sf_small)
    wide = reviews.withColumn("comment", F.repeat("order_id", 20))
    df = cleaning.drop_duplicates_by_hash(wide.unionByName(wide.where("order_id < '02'")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") <= 1  # that of the copies
