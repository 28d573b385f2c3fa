"""Independent DuckDB SQL for every checkable query.

The views ``region nation customer supplier part orders lineitem events ...`` are the raw
test tables. The CTEs below re-derive the source tables, the Silver rules and the Gold wide
table in plain SQL, written independently of the Spark code: first-row picks use
``row_number()`` windows where the Spark side uses ``min_by`` aggregates.
"""

from __future__ import annotations

_MICROS_PER_DAY = "CAST(86400000000 AS DOUBLE)"


def _days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / {_MICROS_PER_DAY}) AS BIGINT)"


def _id(kind: str, key: str) -> str:
    return f"md5('{kind}-' || CAST({key} AS VARCHAR))"


SOURCE_CTES = f"""
src_customers AS (
  SELECT {_id('customer', 'c.c_custkey')} AS customer_id, n.n_name AS customer_state
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
src_sellers AS (
  SELECT {_id('seller', 's.s_suppkey')} AS seller_id, 'CITY_' || CAST(s.s_suppkey % 7 AS VARCHAR) AS seller_city,
         n.n_name AS seller_state
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE s.s_suppkey % 20 <> 0),
src_products AS (
  SELECT {_id('product', 'p_partkey')} AS product_id,
         CASE WHEN p_partkey % 25 <> 0 THEN p_type END AS product_category_name,
         CAST(CASE WHEN p_partkey % 40 <> 0 THEN p_size END AS DOUBLE) AS product_length_cm,
         CAST(p_size % 7 + 1 AS DOUBLE) AS product_height_cm,
         CAST(p_size % 5 + 1 AS DOUBLE) AS product_width_cm
  FROM part),
src_category_translation AS (
  SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
  FROM part WHERE p_type NOT LIKE '%PROMO%'),
src_orders0 AS (
  SELECT o_orderkey AS k, {_id('order', 'o_orderkey')} AS order_id, {_id('customer', 'o_custkey')} AS customer_id,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN 'delivered'
              WHEN o_orderkey % 100 = 0 THEN 'canceled' ELSE 'shipped' END AS order_status,
         CAST(o_orderdate AS TIMESTAMP) AS day0,
         CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey * 37 % 86400 AS BIGINT)) AS purchase,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio
  FROM orders),
src_orders AS (
  SELECT order_id, customer_id, order_status,
         purchase AS order_purchase_timestamp,
         purchase + to_hours(CAST(k % 48 AS BIGINT)) AS order_approved_at,
         purchase + to_days(CAST(1 + k % 6 AS INTEGER)) AS order_delivered_carrier_date,
         CASE WHEN order_status = 'delivered' AND k % 60 <> 0
              THEN purchase + to_hours(CAST(k * 7919 % 960 AS BIGINT)) END AS order_delivered_customer_date,
         day0 + to_days(CAST(10 + 5 * prio AS INTEGER)) AS order_estimated_delivery_date
  FROM src_orders0),
src_order_items AS (
  SELECT {_id('order', 'l_orderkey')} AS order_id, l_linenumber AS order_item_id, {_id('product', 'l_partkey')} AS product_id,
         {_id('seller', 'l_suppkey')} AS seller_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS freight_value,
         CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date
  FROM lineitem),
src_payments AS (
  SELECT {_id('order', 'l_orderkey')} AS order_id, l_linenumber AS payment_sequential,
         CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                           WHEN 'R' THEN 'voucher' ELSE l_returnflag END AS payment_type,
         l_linenumber AS payment_installments, CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_value
  FROM lineitem WHERE l_orderkey % 30 <> 0),
src_reviews AS (
  SELECT {_id('order', '(event_id - event_id % 2)')} AS order_id,
         CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS INTEGER) AS review_score,
         CAST(ts AS TIMESTAMP) AS review_creation_date,
         CAST(ts AS TIMESTAMP) + to_hours(CAST(event_id % 72 AS BIGINT)) AS review_answer_timestamp
  FROM events),
src_geolocation AS (
  SELECT lpad(CAST(c.c_custkey % 100 AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix, n.n_name AS geolocation_state
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

SILVER_CTES = f"""
s_customers AS (SELECT DISTINCT * FROM src_customers),
s_sellers AS (SELECT DISTINCT * FROM src_sellers),
s_products AS (
  SELECT *, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
  FROM (SELECT DISTINCT * FROM src_products)),
s_category_translation AS (SELECT DISTINCT * FROM src_category_translation),
s_geolocation AS (SELECT DISTINCT * FROM src_geolocation),
s_orders AS (
  SELECT *,
    {_days('order_estimated_delivery_date', 'order_purchase_timestamp')} AS estimated_delivery_days,
    {_days('order_delivered_customer_date', 'order_estimated_delivery_date')} AS delay_days,
    CASE WHEN order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
              AND order_estimated_delivery_date IS NOT NULL
         THEN order_delivered_customer_date > order_estimated_delivery_date END AS late_delivery
  FROM (SELECT DISTINCT * FROM src_orders)),
s_order_items AS (SELECT DISTINCT * FROM src_order_items),
s_payments AS (SELECT DISTINCT * FROM src_payments),
s_reviews AS (
  SELECT *, coalesce(review_score <= 2, false) AS negative_review
  FROM (SELECT DISTINCT * FROM src_reviews))"""

GOLD_CTES = f"""
g_products AS (
  SELECT p.*, t.product_category_name_english
  FROM s_products p LEFT JOIN s_category_translation t
    ON p.product_category_name IS NOT DISTINCT FROM t.product_category_name),
g_items AS (
  SELECT i.*, p.product_category_name_english
  FROM s_order_items i LEFT JOIN g_products p ON i.product_id = p.product_id),
g_items_agg AS (
  SELECT order_id, count(order_item_id) AS item_count,
         count(DISTINCT product_id) AS product_count, count(DISTINCT seller_id) AS seller_count,
         CAST(coalesce(sum(price), 0) AS DOUBLE) AS total_price,
         CAST(coalesce(sum(freight_value), 0) AS DOUBLE) AS total_freight,
         CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
  FROM s_order_items WHERE order_id IS NOT NULL GROUP BY order_id),
g_main_seller0 AS (
  SELECT order_id, seller_id AS main_seller_id FROM (
    SELECT order_id, seller_id, row_number() OVER (
      PARTITION BY order_id ORDER BY price DESC NULLS LAST, order_item_id, product_id, seller_id) AS rn
    FROM s_order_items WHERE order_id IS NOT NULL) WHERE rn = 1),
g_main_seller AS (
  SELECT m.order_id, m.main_seller_id, s.seller_city AS main_seller_city, s.seller_state AS main_seller_state
  FROM g_main_seller0 m LEFT JOIN s_sellers s ON m.main_seller_id = s.seller_id),
g_main_cat AS (
  SELECT order_id, product_category_name_english AS main_product_category FROM (
    SELECT order_id, product_category_name_english, row_number() OVER (
      PARTITION BY order_id ORDER BY order_item_id, product_id, seller_id) AS rn
    FROM g_items WHERE order_id IS NOT NULL AND product_category_name_english IS NOT NULL) WHERE rn = 1),
g_pay_agg AS (
  SELECT order_id, CAST(coalesce(sum(payment_value), 0) AS DOUBLE) AS payment_value,
         max(payment_installments) AS payment_installments,
         count(DISTINCT payment_type) AS payment_types_count
  FROM s_payments WHERE order_id IS NOT NULL GROUP BY order_id),
g_main_pay AS (
  SELECT order_id, payment_type FROM (
    SELECT order_id, payment_type, row_number() OVER (
      PARTITION BY order_id ORDER BY payment_value DESC NULLS LAST, payment_sequential, payment_type) AS rn
    FROM s_payments WHERE order_id IS NOT NULL) WHERE rn = 1),
g_rev_agg AS (
  SELECT order_id, avg(review_score) AS review_score, bool_or(negative_review) AS negative_review
  FROM s_reviews WHERE order_id IS NOT NULL GROUP BY order_id),
g_wide AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
         o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
         o.estimated_delivery_days, o.delay_days, o.late_delivery,
         c.customer_state,
         ia.item_count, ia.product_count, ia.seller_count, ia.total_price, ia.total_freight, ia.avg_price,
         ms.main_seller_id, ms.main_seller_city, ms.main_seller_state,
         coalesce(mc.main_product_category, 'unknown') AS main_product_category,
         pa.payment_value, pa.payment_installments, pa.payment_types_count, mp.payment_type,
         ra.review_score, ra.negative_review,
         CAST(month(o.order_purchase_timestamp) AS INTEGER) AS purchase_month,
         CAST(isodow(o.order_purchase_timestamp) - 1 AS INTEGER) AS purchase_dayofweek,
         strftime(o.order_purchase_timestamp, '%Y-%m') AS purchase_year_month,
         {_days('o.order_delivered_customer_date', 'o.order_purchase_timestamp')} AS delivery_days
  FROM s_orders o
  LEFT JOIN s_customers c ON o.customer_id = c.customer_id
  LEFT JOIN g_items_agg ia ON o.order_id = ia.order_id
  LEFT JOIN g_main_seller ms ON o.order_id = ms.order_id
  LEFT JOIN g_main_cat mc ON o.order_id = mc.order_id
  LEFT JOIN g_pay_agg pa ON o.order_id = pa.order_id
  LEFT JOIN g_main_pay mp ON o.order_id = mp.order_id
  LEFT JOIN g_rev_agg ra ON o.order_id = ra.order_id),
g_delivered AS (SELECT * FROM g_wide WHERE order_status = 'delivered'),
g_ml AS (
  SELECT order_id, late_delivery, customer_state, main_seller_state, main_product_category, item_count,
         product_count, seller_count, total_price, total_freight, payment_value, payment_installments,
         payment_type, estimated_delivery_days, purchase_month, purchase_dayofweek
  FROM g_wide WHERE order_status = 'delivered' AND late_delivery IS NOT NULL)"""

ALL_CTES = ",".join([SOURCE_CTES, SILVER_CTES, GOLD_CTES])


def with_ctes(select: str) -> str:
    """Prefix the shared CTEs; a query that starts with its own WITH has its CTEs appended."""
    body = select.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ALL_CTES},\n{body[5:]}"
    return f"WITH {ALL_CTES}\n{select}"


def kpi_select(keys: str) -> str:
    return f"""count(order_id) AS orders_count,
      avg(CAST(late_delivery AS INTEGER)) * 100 AS late_rate,
      avg(delivery_days) AS avg_delivery_days,
      avg(delay_days) AS avg_delay_days,
      avg(review_score) AS avg_review_score,
      avg(CAST(negative_review AS INTEGER)) * 100 AS negative_review_rate"""


def segment_sql(keys: list[str], keep_null: bool) -> str:
    k = ", ".join(keys)
    where = "" if keep_null else "WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"SELECT {k}, {kpi_select(k)} FROM g_delivered {where} GROUP BY {k}"


PRIORITY = "CAST(orders_count * (late_rate / 100) * (negative_review_rate / 100) AS DOUBLE)"
SELLER_LABEL = ("coalesce(substr(CAST(main_seller_id AS VARCHAR), 1, 8), 'unknown') || ' / ' || "
                "coalesce(CAST(main_seller_state AS VARCHAR), 'unknown')")


def analysis_sql(dimension: str) -> str:
    """Segment analysis (D08) for one dimension, with label and priority."""
    if dimension == "seller":
        base = segment_sql(["main_seller_id", "main_seller_state"], True)
        label = SELLER_LABEL
    else:
        base = segment_sql([dimension], True)
        label = f"coalesce(CAST({dimension} AS VARCHAR), 'unknown')"
    return f"SELECT *, {label} AS label, {PRIORITY} AS priority_score FROM ({base})"
