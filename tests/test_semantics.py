"""One hand-made row set per semantic trap (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.types import IntegerType

from delivery_lake.functions import bool_from_text, floor_days, late_flag, negative_review
from delivery_lake.operators import cleaning, enrich, kpis, ml, profile
from delivery_lake.sources import files

T = dt.datetime


def ts(s):
    return T.fromisoformat(s)


ORDERS_SCHEMA = ("order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp_ntz, "
                 "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
                 "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
ITEMS_SCHEMA = ("order_id bigint, order_item_id int, product_id bigint, seller_id bigint, price decimal(18,2), "
                "freight_value decimal(18,2), shipping_limit_date timestamp_ntz")


def _tables(spark, orders, items=(), customers=None, payments=(), reviews=(), products=(), sellers=(),
            translation=()):
    customers = customers if customers is not None else sorted({(o[1], "S1") for o in orders})
    t = {
        "orders": spark.createDataFrame(orders, ORDERS_SCHEMA),
        "customers": spark.createDataFrame(customers, "customer_id bigint, customer_state string"),
        "order_items": spark.createDataFrame(list(items), ITEMS_SCHEMA),
        "payments": spark.createDataFrame(list(payments), "order_id bigint, payment_sequential int, payment_type string, "
                                                          "payment_installments int, payment_value decimal(18,2)"),
        "reviews": spark.createDataFrame(list(reviews), "order_id bigint, review_score int, "
                                                        "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"),
        "products": spark.createDataFrame(list(products), "product_id bigint, product_category_name string, "
                                                          "product_length_cm double, product_height_cm double, product_width_cm double"),
        "sellers": spark.createDataFrame(list(sellers), "seller_id bigint, seller_city string, seller_state string"),
        "category_translation": spark.createDataFrame(list(translation), "product_category_name string, "
                                                                         "product_category_name_english string"),
    }
    return cleaning.clean_tables(t)


def _order(oid, status="delivered", purchase="2018-01-01 10:00:00", delivered=None, estimated="2018-01-10 00:00:00",
           customer=1):
    p = ts(purchase) if purchase else None
    return (oid, customer, status, p, p, p, ts(delivered) if delivered else None, ts(estimated) if estimated else None)


def test_floor_days_and_late_flag_one_hour(spark):
    orders = [_order(1, delivered="2018-01-09 23:00:00"), _order(2, delivered="2018-01-10 01:00:00")]
    o = _tables(spark, orders)["orders"]
    got = {r.order_id: (r.delay_days, r.late_delivery) for r in o.collect()}
    assert got["1"] == (-1, False)
    assert got["2"] == (0, True)
    naive = {r.order_id: r.late_delivery for r in profile.naive_late(o).collect()}
    assert naive["2"] is False  # the naive flag needs a whole day of delay


def test_late_flag_unknown(spark):
    orders = [_order(1, delivered=None), _order(2, status="shipped", delivered="2018-01-12 00:00:00")]
    o = _tables(spark, orders)["orders"]
    assert {r.order_id: r.late_delivery for r in o.collect()} == {"1": None, "2": None}


def test_bad_date_text(spark):
    df = spark.createDataFrame([(1, "not a date"), (2, "NA"), (3, ""), (4, "2018-01-02 03:04:05")],
                               "order_id bigint, order_purchase_timestamp string")
    out = {r.order_id: r.order_purchase_timestamp for r in cleaning.convert_dates(df, "orders").collect()}
    assert out == {1: None, 2: None, 3: None, 4: ts("2018-01-02 03:04:05")}


def test_null_score_not_negative(spark):
    df = spark.createDataFrame([(1, None), (2, 2), (3, 3)], "order_id bigint, review_score int")
    out = {r.order_id: r.negative_review for r in cleaning.add_negative_review(df).collect()}
    assert out == {1: False, 2: True, 3: False}


def test_all_null_prices_and_price_ties(spark):
    items = [
        (1, 2, 10, 7, None, None, None), (1, 1, 11, 8, None, None, None),        # all null prices
        (2, 1, 12, 5, 50.0, 1.0, None), (2, 2, 13, 6, 50.0, 1.0, None),          # equal top price
        (2, 3, 14, 4, 10.0, 1.0, None),
    ]
    from decimal import Decimal
    items = [tuple(Decimal(str(v)) if isinstance(v, float) else v for v in r) for r in items]
    t = _tables(spark, [_order(1), _order(2)], items=items)
    s = {r.order_id: r for r in enrich.items_by_order(t["order_items"]).collect()}
    assert s["1"].total_price == 0.0 and s["1"].avg_price is None and s["1"].item_count == 2
    seller = {r.order_id: r.main_seller_id for r in enrich.main_seller(t["order_items"], t["sellers"]).collect()}
    assert seller == {"1": "8", "2": "5"}


def test_first_item_with_category(spark):
    items = [(1, 1, 10, 1, None, None, None), (1, 2, 11, 1, None, None, None), (1, 3, 12, 1, None, None, None)]
    products = [(10, None, 1.0, 1.0, 1.0), (11, "Z", 1.0, 1.0, 1.0), (12, "Y", 1.0, 1.0, 1.0)]
    translation = [("Z", "z"), ("Y", "y")]
    t = _tables(spark, [_order(1)], items=items, products=products, translation=translation)
    wide = enrich.orders_enriched(t)
    assert wide.select("main_product_category").first()[0] == "z"


def test_null_category_matches_null_translation(spark):
    products = spark.createDataFrame([(1, None)], "product_id bigint, product_category_name string")
    translation = spark.createDataFrame([(None, "no name")], "product_category_name string, product_category_name_english string")
    assert enrich.translate_products(products, translation).first().product_category_name_english == "no name"


def test_seller_without_state(spark):
    from decimal import Decimal
    items = [(1, 1, 10, 99, Decimal("5.00"), Decimal("1.00"), None)]
    t = _tables(spark, [_order(1)], items=items, sellers=[(99, "C", None)])
    wide = enrich.orders_enriched(t)
    assert kpis.kpis_by_seller(wide).count() == 0
    seg = kpis.segment_analysis(wide, "seller").collect()
    assert len(seg) == 1 and seg[0].label == "99 / unknown"


def test_null_state_dropped_or_kept(spark):
    t = _tables(spark, [_order(1, customer=1), _order(2, customer=2)], customers=[(1, "S1"), (2, None)])
    wide = enrich.orders_enriched(t)
    assert kpis.kpis_by_state(wide).count() == 1
    assert kpis.segment_analysis(wide, "customer_state").count() == 2


def test_duplicate_customer_raises(spark):
    t = _tables(spark, [_order(1)], customers=[(1, "S1"), (1, "S2")])
    with pytest.raises(ValueError, match="duplicate customer_id in customers: 1"):
        enrich.check_lookups(t)
    assert enrich.orders_enriched(t).count() == 1  # the lookup itself never multiplies orders


def test_duplicate_seller_raises_and_null_ids_do_not(spark):
    items = [(1, 1, 10, 7, None, None, None)]
    t = _tables(spark, [_order(1)], items=items, sellers=[(7, "A", "S1"), (7, "B", "S1")])
    with pytest.raises(ValueError, match="duplicate seller_id in sellers: 7"):
        enrich.check_lookups(t)
    assert enrich.orders_enriched(t).count() == 1
    ok = _tables(spark, [_order(1)], items=items, customers=[(None, "S1"), (None, "S2"), (1, "S1")],
                 sellers=[(None, "A", "S1"), (None, "B", "S1"), (7, "B", "S1")])
    enrich.check_lookups(ok)
    assert enrich.orders_enriched(ok).count() == 1


def test_duplicate_product_does_not_multiply_items(spark):
    items = [(1, 1, 10, 7, Decimal("5.00"), None, None)]
    t = _tables(spark, [_order(1)], items=items, products=[(10, "Z", 1.0, 1.0, 1.0), (10, "Y", 1.0, 1.0, 1.0)],
                translation=[("Z", "z"), ("Y", "y"), ("Z", "zz")])
    row = enrich.orders_enriched(t).first()
    assert (row.item_count, row.total_price, row.main_product_category) == (1, 5.0, "y")


def test_integer_text(spark):
    df = spark.createDataFrame([("5.0",), ("1e1",), ("3",), ("2.5",), ("NA",), ("x",), (None,)], "review_score string")
    out = cleaning.cast_declared(df, {"review_score": IntegerType()})
    assert [r[0] for r in out.collect()] == [5, 10, 3, None, None, None, None]


def test_exact_median(spark):
    values = [3.0, 1.0, 1.0, 1e9, 2.0, None, -5.0]
    df = spark.createDataFrame([(v, 7.0, None) for v in values], "a double, b double, c double")
    assert ml.exact_medians(df, ["a", "b", "c"], buckets=4) == {"a": 1.5, "b": 7.0, "c": None}
    wide = spark.range(1001).selectExpr("cast(id * id * 0.1 as double) as a")
    assert ml.exact_medians(wide, ["a"], buckets=8)["a"] == pytest.approx(25000.0)


def test_empty_month(spark):
    orders = [_order(1, purchase="2018-01-15 00:00:00"), _order(2, purchase="2018-03-15 00:00:00")]
    t = _tables(spark, orders)
    wide = enrich.orders_enriched(t)
    assert kpis.monthly_orders(wide).count() == 2
    filled = {r.order_purchase_timestamp: r.orders_count for r in profile.orders_by_month_end(t["orders"]).collect()}
    assert filled == {ts("2018-01-31 00:00:00"): 1, ts("2018-02-28 00:00:00"): 0, ts("2018-03-31 00:00:00"): 1}


def test_monday_is_zero(spark):
    wide = enrich.orders_enriched(_tables(spark, [_order(1, purchase="2018-01-01 12:00:00")]))
    assert wide.first().purchase_dayofweek == 0


def test_boolean_text(spark):
    df = spark.createDataFrame([("True",), ("1",), ("1.0",), ("",), (None,), ("FALSE",), ("0",)], "v string")
    assert [r[0] for r in df.select(bool_from_text("v")).collect()] == [True, True, None, None, None, False, False]


def test_csv_quoted_newline_and_quote(spark, tmp_path):
    text = 'line one\nline "two"'
    df = spark.createDataFrame([(1, text)], "id bigint, review_comment string")
    path = files.write_csv(df, str(tmp_path / "reviews.csv"))
    back = files.read_raw_csv(spark, path).collect()
    assert back[0].review_comment == text and back[0].id == "1"


def test_report_without_predicted_positive(spark):
    pred = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    rep = {r.class_label: r for r in ml.classification_report(pred).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].recall == 0.0 and rep["1"].f1_score == 0.0
    assert rep["accuracy"].f1_score == pytest.approx(2 / 3)


def test_expression_helpers(spark):
    df = spark.createDataFrame([(ts("2018-01-10 01:00:00"), ts("2018-01-10 00:00:00"), "delivered", None)],
                               "a timestamp_ntz, b timestamp_ntz, s string, score int")
    r = df.select(floor_days("b", "a").alias("d"), late_flag("s", "a", "b").alias("late"),
                  negative_review("score").alias("neg")).first()
    assert (r.d, r.late, r.neg) == (-1, True, False)


def test_column_names_standardised(spark):
    df = spark.createDataFrame([(1,)], "` Order_ID ` int")
    assert cleaning.standardize_columns(df).columns == ["order_id"]
    clash = spark.createDataFrame([(1, 2)], "`A` int, `a ` int")
    with pytest.raises(ValueError):
        cleaning.standardize_columns(clash)


def test_full_duplicates_compare_raw_text(spark):
    df = spark.createDataFrame([("2018-01-01 00:00:00",), ("2018-01-01 00:00:00",), ("2018-01-01T00:00:00",)],
                               "shipping_limit_date string")
    out = cleaning.clean_table("order_items", df)
    assert out.count() == 2 and dict(out.dtypes)["shipping_limit_date"] == "timestamp_ntz"


def test_filters(spark):
    orders = [_order(1, purchase="2018-01-01 00:00:00"), _order(2, purchase="2018-01-31 23:59:59"),
              _order(3, purchase="2018-02-01 00:00:00"), _order(4, purchase=None)]
    wide = enrich.orders_enriched(_tables(spark, orders))
    got = sorted(r.order_id for r in kpis.filter_dates(wide, "2018-01-01", "2018-01-31").collect())
    assert got == ["1", "2"]
    assert kpis.filter_states(wide, []).count() == 4
    assert kpis.filter_states(wide, ["S1"]).count() == 4
    assert kpis.filter_categories(wide, ["nothing"]).count() == 0
    with pytest.raises(ValueError):
        kpis.require_rows(kpis.filter_categories(wide, ["nothing"]))
