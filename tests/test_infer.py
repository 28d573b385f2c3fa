"""Types from the data: the narrowest type of every column, features by these types."""

import pytest
from pyspark.sql import functions as F

from delivery_lake.operators import enrich, infer, ml
from delivery_lake.plans import gold

CASES = {
    "whole": (["1", "-20", "+3", None, "007"], "bigint", 4),
    "long_whole": (["1", "99999999999999999999"], "double", 2),
    "number": (["1", "2.5", "1e-3", ".5", "NA"], "double", 4),
    "truth": (["True", "false", "", "TRUE"], "boolean", 3),
    "truth_and_number": (["true", "1"], "string", 2),
    "time": (["2024-01-31", "2024-01-31 10:20:30", "2024-01-31T10:20:30.5", "nan"], "timestamp", 3),
    "no_time": (["2024-02-30", "2024-01-01"], "string", 2),
    "time_and_number": (["2024-01-01", "5"], "string", 2),
    "words": (["a", "1", "2.0"], "string", 3),
    "java_numbers": (["1d", "2f"], "string", 2),
    "nothing": ([None, "", "NULL", "n/a"], "double", 0),
    "year": (["2024", "2023"], "bigint", 2),
}


@pytest.fixture(scope="module")
def text(spark):
    n = max(len(v) for v, *_ in CASES.values())
    rows = [tuple(v[i] if i < len(v) else None for v, *_ in CASES.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CASES)).repartition(2)


def test_types_of_text_columns(text):
    got = {r.column_name: (r.dtype, r.n_values, r.position) for r in infer.column_types(text).collect()}
    assert got == {c: (t, n, i) for i, (c, (_, t, n)) in enumerate(CASES.items())}


def test_one_scan_and_no_python(text, tmp_path):
    path = str(tmp_path / "text")
    text.write.parquet(path)
    df = infer.column_types(text.sparkSession.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan and "SortAggregate" not in plan


def test_cast_by_inferred_types(text):
    typed = dict(infer.cast_inferred(text).dtypes)
    assert typed["whole"] == typed["year"] == "bigint" and typed["number"] == typed["nothing"] == "double"
    assert typed["time"] == "timestamp_ntz" and typed["truth"] == "boolean" and typed["words"] == "string"
    assert infer.cast_inferred(text).agg(F.sum("whole")).first()[0] == 1 - 20 + 3 + 7


def test_no_rows_and_no_columns(spark, text):
    assert {r.dtype for r in infer.column_types(text.limit(0)).collect()} == {"double"}
    assert infer.column_types(spark.range(2).select()).count() == 0


def test_features_by_their_types(spark, sf_small):
    data = enrich.ml_dataset(gold.wide_orders(spark, sf_small))
    extra = data.withColumns({"empty": F.lit(None).cast("double"), "added": F.col("total_price") * 2, "note": F.col("customer_state"), "flag": F.lit(True)})
    as_text = extra.select(*[F.col(c).cast("string").alias(c) for c in extra.columns])
    num, cat = ml.feature_columns(infer.cast_inferred(as_text))
    assert num == [*ml.feature_columns(data)[0], "empty", "added"] and cat == [*ml.feature_columns(data)[1], "note", "flag"]
    assert ml.feature_columns(extra) == (num, cat)
    assert "order_id" not in num + cat and "late_delivery" not in num + cat
