"""T4: physical-plan checks: no Python UDFs, pushdown and pruning reach the scan, no
single-partition exchange under aggregations of raw rows."""

import pytest

import __spark_entry__ as entry
from delivery_lake.operators import kpis
from delivery_lake.plans import gold

PLAN_KEYS = [k for k in sorted(entry.queries()) if k[0] in "bcde"]


def plan_text(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("key", PLAN_KEYS)
def test_no_python_udf(spark, sf_small, key):
    text = plan_text(entry.queries()[key](spark, sf_small))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in text


def test_date_filter_pushed_to_parquet(spark, sf_small, tmp_path):
    path = str(tmp_path / "wide")
    gold.wide_orders(spark, sf_small).write.parquet(path)
    df = kpis.filter_dates(spark.read.parquet(path), "1996-01-01", "1996-12-31").select("order_id")
    text = plan_text(df)
    assert "PushedFilters: [IsNotNull(order_purchase_timestamp), GreaterThanOrEqual(order_purchase_timestamp" in text
    assert "ReadSchema: struct<order_id:string,order_purchase_timestamp:timestamp_ntz>" in text


def test_kpi_plans_have_no_single_partition_exchange(spark, sf_small):
    wide = gold.wide_orders(spark, sf_small)
    for df in (kpis.kpis_by_state(wide), kpis.kpis_by_seller(wide), wide):
        assert "SinglePartition" not in plan_text(df)


def test_wide_table_scans_prune_columns(spark, sf_small):
    text = plan_text(gold.wide_orders(spark, sf_small))
    # lineitem is read for items and payments: never its unused columns
    for unused in ("l_quantity", "l_discount", "l_linestatus"):
        assert unused not in text


def test_first_row_picks_need_no_expand(spark, sf_small):
    text = plan_text(gold.wide_orders(spark, sf_small))
    # distinct counts expand only their own aggregation (items: 1 Expand, payments: none)
    assert text.count("Expand (") <= 1


def test_order_level_aggregations_combine_map_side(spark, sf_small):
    # every order-level aggregate has a partial step before its shuffle, so a hot order is
    # reduced in each map task; the first-row picks use the struct minimum, not a window
    text = plan_text(gold.wide_orders(spark, sf_small))
    for fn in ("partial_min(", "partial_count(", "partial_sum(", "partial_avg(", "partial_max("):
        assert fn in text
    assert "Window" not in text and "row_number" not in text


def test_alerts_one_aggregation_and_map_side_top_n(spark, sf_small):
    text = plan_text(entry.queries()["d12_alerts"](spark, sf_small)).split("\n\n")[0]
    # one grouping-sets aggregation for the three dimensions; top-n limited in every task
    assert text.count("WindowGroupLimit") >= 2
    assert "Union" not in text


def test_unused_lookups_are_dropped(spark, sf_small):
    """Orders per month and the date range read the orders alone: the lookups are unique."""
    for df in (kpis.monthly_orders(gold.wide_orders(spark, sf_small)), kpis.date_bounds(gold.wide_orders(spark, sf_small))):
        text = plan_text(df)
        assert "orders.parquet" in text
        assert not any(f"{t}.parquet" in text for t in ("lineitem", "supplier", "events", "customer"))
