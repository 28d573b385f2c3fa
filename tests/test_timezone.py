"""Results do not depend on the session time zone: timestamps are wall-clock (TIMESTAMP_NTZ)."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from delivery_lake.functions import floor_days


@pytest.fixture
def other_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def test_floor_days_across_dst_change(other_zone):
    # 24.5 wall-clock hours across the spring-forward night: one whole day
    df = other_zone.createDataFrame([(dt.datetime(2018, 3, 12, 1, 30), dt.datetime(2018, 3, 11, 1, 0))],
                                    "a timestamp_ntz, b timestamp_ntz")
    assert df.select(floor_days("a", "b")).first()[0] == 1
    # a wall-clock time inside the skipped hour (02:30 does not exist in this zone that night)
    gap = other_zone.createDataFrame([(dt.datetime(2018, 3, 12, 2, 45), dt.datetime(2018, 3, 11, 2, 30))],
                                     "a timestamp_ntz, b timestamp_ntz")
    assert gap.select(floor_days("a", "b")).first()[0] == 1  # 24.25 wall-clock hours


@pytest.mark.parametrize("key", ["b09_clean_orders", "c09_orders_enriched", "d01_date_filter", "e05_month_spine"])
def test_queries_equal_in_any_session_zone(spark, sf_small, key):
    q = entry.queries()[key]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        a = q(spark, sf_small).toPandas()
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        b = q(spark, sf_small).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cols = sorted(a.columns)
    key_cols = [c for c in cols if c.endswith("_id")] or cols
    a = a[cols].sort_values(key_cols).reset_index(drop=True)
    b = b[cols].sort_values(key_cols).reset_index(drop=True)
    assert a.equals(b)
