"""Streaming Bronze ingest: same rows as the batch ingest; a second run adds nothing."""

from delivery_lake.sources import files, testdata
from delivery_lake.streaming.bronze_stream import read_stream_table, stream_ingest_table


def test_available_now_ingest_is_incremental(spark, sf_small, tmp_path):
    orders = testdata.orders(spark, sf_small)
    landing = files.write_landing({"orders": orders}, str(tmp_path / "landing"))
    root = str(tmp_path / "lake")
    stream_ingest_table(spark, landing, root, "orders", "b1")
    first = read_stream_table(spark, root, "orders").count()
    assert first == orders.count()
    stream_ingest_table(spark, landing, root, "orders", "b1")
    assert read_stream_table(spark, root, "orders").count() == first


def test_stream_then_batch_and_second_lake(spark, sf_small, tmp_path):
    """A batch ingest beside a stream is visible, and another lake gets all files of its own."""
    orders = testdata.orders(spark, sf_small)
    landing = files.write_landing({"orders": orders}, str(tmp_path / "landing"))
    for lake in ("one", "two"):
        root = str(tmp_path / lake)
        stream_ingest_table(spark, landing, root, "orders", "b1")
        files.ingest_bronze(spark, landing, root, "ingestion_20240101_000000", {"orders": "orders.csv"})
        assert read_stream_table(spark, root, "orders").count() == orders.count()
        assert files.read_layer(spark, root, "bronze", "orders").count() == orders.count()
