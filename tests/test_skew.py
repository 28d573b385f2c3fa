"""A hot key holding a third of all rows: results stay whole and exact (brute force in pandas)."""

from decimal import Decimal

from pyspark.sql import functions as F

from delivery_lake.operators import cleaning, enrich, kpis
from delivery_lake.sources import testdata

HOT = "0" * 32


def _skewed_tables(spark, sf):
    src = testdata.source_tables(spark, sf)
    third = lambda c: F.substring(c, 1, 1).isin(*"01234")  # noqa: E731 - ids are hashes: 5 of 16
    hot = lambda c: F.when(third(c), F.lit(HOT)).otherwise(F.col(c))
    # a third of all items and payments belong to one order; a third of the orders to one customer
    src["order_items"] = src["order_items"].withColumn("order_id", hot("order_id"))
    src["payments"] = src["payments"].withColumn("order_id", hot("order_id"))
    src["orders"] = src["orders"].withColumn(
        "customer_id", F.when(third("order_id"), F.lit(HOT)).otherwise(F.col("customer_id")))
    hot_customer = src["customers"].limit(1).withColumn("customer_id", F.lit(HOT))
    src["customers"] = src["customers"].unionByName(hot_customer)
    first = src["orders"].orderBy("order_id").limit(1).withColumn("order_id", F.lit(HOT))
    src["orders"] = src["orders"].unionByName(first)
    return cleaning.clean_tables(src)


def test_hot_order_items_exact(spark, sf_small):
    t = _skewed_tables(spark, sf_small)
    items = t["order_items"].toPandas()
    got = {r.order_id: r for r in enrich.items_by_order(t["order_items"]).collect()}
    hot = items[items.order_id == HOT]
    assert len(hot) > len(items) / 4
    r = got[HOT]
    assert r.item_count == hot.order_item_id.notna().sum()
    assert r.product_count == hot.product_id.nunique()
    assert r.seller_count == hot.seller_id.nunique()
    assert Decimal(str(r.total_price)) == sum(hot.price.dropna())
    top = hot.sort_values(["price", "order_item_id", "product_id", "seller_id"],
                          ascending=[False, True, True, True], na_position="last").iloc[0]
    seller = {x.order_id: x.main_seller_id for x in enrich.main_seller(t["order_items"], t["sellers"]).collect()}
    assert seller[HOT] == top.seller_id
    assert len(got) == items.order_id.nunique()


def test_hot_customer_and_order_wide_table(spark, sf_small):
    t = _skewed_tables(spark, sf_small)
    wide = enrich.orders_enriched(t)
    orders = t["orders"].toPandas()
    assert wide.count() == len(orders)
    pays = t["payments"].toPandas()
    hot_pay = float(sum(pays[pays.order_id == HOT].payment_value.dropna()))
    row = wide.where(F.col("order_id") == HOT).first()
    assert row.payment_value == hot_pay
    by_state = kpis.kpis_by_state(wide).agg(F.sum("orders_count")).first()[0]
    assert by_state == int((orders.order_status == "delivered").sum())


def test_hot_seller_is_reduced_before_the_lookup(spark, sf_small):
    """With broadcasts off, a partial aggregation and an exchange stand below the seller join."""
    import re

    from delivery_lake.operators import profile

    t = cleaning.clean_tables(testdata.source_tables(spark, sf_small))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df, key in ((kpis.kpis_by_main_seller(enrich.orders_with_facts(t), t["sellers"]), "main_seller_id"),
                        (profile.seller_pairs(t["orders"], t["order_items"], t["sellers"]), "seller_id")):
            plan = df._jdf.queryExecution().sparkPlan().toString().splitlines()
            join = next(i for i, x in enumerate(plan) if "Join [" in x and key in x)
            below = "\n".join(plan[join:])
            assert re.search(rf"Aggregate\(keys=\[{key}#", below.split("Join [", 2)[1])
            assert "functions=[partial_" in below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
