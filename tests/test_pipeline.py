"""T5: end to end in a temporary folder: CSV -> Bronze -> Silver -> Gold -> model."""

from pyspark.sql import functions as F

from delivery_lake.operators import ml
from delivery_lake.plans import gold
from delivery_lake.plans.pipeline import run_pipeline
from delivery_lake.schemas import MANIFEST
from delivery_lake.sources import files, testdata


def test_pipeline_end_to_end(spark, sf_small, tmp_path):
    tables = testdata.source_tables(spark, sf_small)
    landing = files.write_landing(tables, str(tmp_path / "landing"))
    manifest = {t: MANIFEST[t] for t in tables}
    root = str(tmp_path / "lake")
    summary, info = run_pipeline(spark, landing, root, manifest, stamp="20240101_000000",
                                 csv_export_dir=str(tmp_path / "export"))
    rows = {(r.layer, r.table_name): r.rows for r in summary.collect()}
    n_orders = testdata.orders(spark, sf_small).count()
    assert rows[("bronze", "orders")] == n_orders
    assert rows[("gold", "orders_enriched")] == n_orders
    assert rows[("ml", "metrics")] == 7
    assert files.latest_batch(spark, root, "gold", ["orders_enriched"]) == "gold_20240101_000000"
    # the written Gold table equals the in-memory plan
    written = files.read_layer(spark, root, "gold", "orders_enriched").drop("batch_id")
    mem = gold.wide_orders(spark, sf_small)
    cols = ["order_id", "late_delivery", "main_seller_id", "main_product_category", "payment_type", "delivery_days"]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(written.select(*cols).collect(), key=key) == sorted(mem.select(*cols).collect(), key=key)
    assert ml.load_model(info["model_path"]) is not None
    kpi_csv = files.read_raw_csv(spark, info["csv"]["delivery_kpis_by_state"]).collect()
    counts = [int(r.orders_count) for r in kpi_csv]
    assert len(kpi_csv) == rows[("gold", "delivery_kpis_by_state")]
    assert sum(counts) > 0


def test_manifest_lists_all_missing(spark, tmp_path):
    import pytest

    with pytest.raises(FileNotFoundError) as e:
        files.check_manifest(spark, str(tmp_path), MANIFEST, all_missing=True)
    assert "geolocation.csv" in str(e.value) and "sellers.csv" in str(e.value)
    assert ml.load_model(str(tmp_path / "none")) is None
    assert files.manifest_status(spark, str(tmp_path)).where(F.col("present")).count() == 0


def test_jdbc_partitioned_read_needs_bounds(spark):
    import pytest

    from delivery_lake.sources import jdbc

    with pytest.raises(ValueError):
        jdbc.jdbc_read(spark, "jdbc:none://nowhere", "orders_enriched", partition_column="order_id")


def test_fallback_chain_reports_source_batch_and_errors(spark, tmp_path):
    import pytest

    root = str(tmp_path / "lake")
    files.write_tables({"orders_enriched": spark.createDataFrame([("1", "delivered")], "order_id string, order_status string")},
                       root, "gold", "gold_20240101_000000")

    def database():
        raise ConnectionError()  # an error without text

    readers = [("database", database),
               ("deployed csv", lambda: files.read_raw_csv(spark, str(tmp_path / "missing.csv"))),
               ("gold", files.latest_gold_reader(spark, root))]
    df, label, batch, errors = files.load_orders_with_fallback(spark, readers)
    assert (label, batch, len(errors), df.count()) == ("gold", "gold_20240101_000000", 2, 1)
    with pytest.raises(RuntimeError):
        files.load_orders_with_fallback(spark, readers[:2])


def test_dashboard_views_from_written_gold(spark, sf_small, tmp_path):
    from delivery_lake.plans.dashboard import dashboard_views

    path = str(tmp_path / "gold_csv")
    files.write_csv(gold.wide_orders(spark, sf_small), path)
    orders = files.read_raw_csv(spark, path)  # all text, as a CSV copy of the Gold table
    views = dashboard_views(orders, "1995-01-01", "2001-12-31", states=None, categories=None, require_data=True)
    assert set(views) == {"executive", "monthly", "impact", "analysis", "report", "alerts", "date_bounds"}
    exec_row = views["executive"].first()
    mem = gold.wide_orders(spark, sf_small)
    assert exec_row.total_orders == mem.where("order_purchase_timestamp < '2002-01-01'").count()
    assert views["impact"].count() == 2
    assert views["alerts"].count() > 0


def test_pipeline_script(spark, sf_small, tmp_path, capsys):
    import pytest

    from scripts.run_pipeline import main

    with pytest.raises(SystemExit):
        main(["--root", str(tmp_path / "x")])  # no source given
    assert main(["--from-testdata", sf_small, "--root", str(tmp_path / "lake"), "--stamp", "20240101_000000",
                 "--no-train"]) == 0
    out = capsys.readouterr().out
    assert "orders_enriched" in out and "gold_20240101_000000" in out
    assert spark.range(1).count() == 1  # the shared session is still alive


def test_half_written_batch_is_not_read(spark, tmp_path):
    import pytest

    root = str(tmp_path / "lake")
    old = {t: spark.createDataFrame([("old",)], "v string") for t in ("orders", "payments")}
    files.write_tables(old, root, "bronze", "ingestion_20240101_000000")
    files.write_layer(spark.createDataFrame([("new",)], "v string"), root, "bronze", "orders", "ingestion_20240201_000000")
    got = files.scan(spark, root, "bronze", ["orders", "payments"])
    assert [got[t].first().v for t in ("orders", "payments")] == ["old", "old"]
    files.write_layer(spark.createDataFrame([("new",)], "v string"), root, "bronze", "payments", "ingestion_20240201_000000")
    files.commit_batch(spark, root, "bronze", "ingestion_20240201_000000")
    got = files.scan(spark, root, "bronze", ["orders", "payments"])
    assert [got[t].first().v for t in ("orders", "payments")] == ["new", "new"]
    with pytest.raises(FileNotFoundError):
        files.latest_batch(spark, root, "bronze", ["orders", "reviews"])


def test_pipeline_on_text_ids(spark, tmp_path):
    """32-character ids and a score written as 5.0 reach Gold; a duplicate seller stops the run."""
    import json

    import pytest

    from scripts.run_pipeline import main

    a, b, c, p, s = ("a" * 32, "b" * 32, "c" * 32, "d" * 32, "e" * 32)
    t = "2018-01-02 10:00:00"
    source = tmp_path / "src"
    source.mkdir()
    tables = {
        "customers": f"customer_id,customer_state\n{c},SP\n",
        "orders": ("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
                   f"order_delivered_customer_date,order_estimated_delivery_date\n{a},{c},delivered,{t},{t},{t},2018-01-20 10:00:00,"
                   f"2018-01-10 00:00:00\n{b},{c},delivered,{t},{t},{t},2018-01-05 10:00:00,2018-01-10 00:00:00\n"),
        "order_items": f"order_id,order_item_id,product_id,seller_id,price,freight_value,shipping_limit_date\n{a},1,{p},{s},10.50,1.25,{t}\n",
        "payments": f"order_id,payment_sequential,payment_type,payment_installments,payment_value\n{a},1,boleto,1.0,11.75\n",
        "reviews": f"order_id,review_score,review_creation_date,review_answer_timestamp\n{a},1.0,{t},{t}\n{b},5.0,{t},{t}\n",
        "products": f"product_id,product_category_name,product_length_cm,product_height_cm,product_width_cm\n{p},x,1,2,3\n",
        "sellers": f"seller_id,seller_city,seller_state\n{s},town,RJ\n",
        "category_translation": "product_category_name,product_category_name_english\nx,thing\n",
    }
    for name, text in tables.items():
        (source / f"in_{name}.csv").write_text(text)
    (tmp_path / "manifest.json").write_text(json.dumps({n: f"in_{n}.csv" for n in tables}))
    args = ["--source", str(source), "--manifest", str(tmp_path / "manifest.json"), "--no-train"]
    assert main([*args, "--root", str(tmp_path / "lake"), "--stamp", "20240101_000000"]) == 0
    rows = {r.order_id: r for r in files.read_layer(spark, str(tmp_path / "lake"), "gold", "orders_enriched").collect()}
    assert (rows[a].customer_state, rows[a].main_seller_id, rows[a].main_seller_state, rows[a].main_product_category) == ("SP", s, "RJ", "thing")
    assert (rows[a].total_price, rows[a].payment_installments, rows[a].late_delivery, rows[a].negative_review) == (10.5, 1, True, True)
    assert (rows[b].review_score, rows[b].negative_review, rows[b].late_delivery, rows[b].main_seller_id) == (5.0, False, False, None)
    kpi = files.read_layer(spark, str(tmp_path / "lake"), "gold", "delivery_kpis_by_seller").collect()
    assert [(r.main_seller_id, r.orders_count) for r in kpi] == [(s, 1)]
    with open(source / "in_sellers.csv", "a") as f:
        f.write(f"{s},other town,RJ\n")
    with pytest.raises(ValueError, match="duplicate seller_id"):
        main([*args, "--root", str(tmp_path / "lake2"), "--stamp", "20240101_000000"])


def test_metrics_rerun_and_broken_model(spark, tmp_path):
    import pytest

    pred = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0)], "label double, prediction double")
    for _ in range(2):
        ml.save_metrics(ml.classification_report(pred), ml.confusion_matrix(pred), str(tmp_path / "m"), "r1")
    assert spark.read.parquet(str(tmp_path / "m")).count() == 7
    (tmp_path / "broken").mkdir()
    with pytest.raises(Exception):
        ml.load_model(str(tmp_path / "broken"))


def test_checkpoint_folder_is_required_off_local_masters():
    import pytest

    from delivery_lake import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
