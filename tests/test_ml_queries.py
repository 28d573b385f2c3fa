"""The ML queries read the tables as they are when they are called, and make the wide table once."""

import pytest
from pyspark.sql import functions as F

from delivery_lake.plans import catalog, gold


@pytest.fixture(scope="module")
def wide(spark, sf_small):
    made = gold.wide_orders(spark, sf_small).cache()
    yield made
    made.unpersist()  # plans that later tests look into must not read it


def test_split_follows_the_tables(spark, wide, monkeypatch):
    """What an earlier query of the process found at the same place must not come back."""
    found = []
    for part in (wide.where(F.crc32("order_id") % 2 == 0), wide):
        monkeypatch.setattr(catalog, "_wide", lambda spark, sf, part=part: part)
        found.append({r.order_id for r in catalog.f04_split(spark, "/some/place").collect()})
    assert found[0] < found[1] == {r.order_id for r in wide.where("late_delivery is not null").select("order_id").collect()}


@pytest.mark.parametrize("query", ["f05_impute_scale", "f06_onehot", "f07_assemble", "f15_score"])
def test_wide_table_is_made_once_by_each_query(spark, wide, monkeypatch, query):
    made = []
    monkeypatch.setattr(catalog, "_wide", lambda spark, sf: made.append(sf) or wide)
    for times in (1, 2):
        assert catalog.QUERIES[query](spark, "/some/place").count() > 0
        assert len(made) == times


def test_scoring_writes_the_features_once(spark, wide, monkeypatch):
    """Every order is scored from a table of the features alone; the ML table is not written beside it."""
    written, write = {}, catalog._written
    monkeypatch.setattr(catalog, "_wide", lambda spark, sf: wide)
    monkeypatch.setattr(catalog, "_written", lambda df, label: written.setdefault(label, write(df, label)))
    got = catalog.f15_score(spark, "/some/place").collect()
    assert sorted(r.order_id for r in got) == sorted(r.order_id for r in wide.select("order_id").collect())
    assert all(r.in_range for r in got)
    assert written["wide"].columns == ["order_status", *catalog.ML_COLUMNS]
    assert list(written) == ["wide", "split"]
