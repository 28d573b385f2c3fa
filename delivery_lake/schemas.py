"""Declared tables, columns and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced).
# ---------------------------------------------------------------------------------------------

# Source manifest: logical table -> file name, in the original order.
MANIFEST = {
    "customers": "customers.csv",
    "geolocation": "geolocation.csv",
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "payments": "payments.csv",
    "reviews": "reviews.csv",
    "products": "products.csv",
    "sellers": "sellers.csv",
    "category_translation": "category_translation.csv",
}

# Tables with free text that may hold quoted line breaks (review comments): their files are cut into
# splits by ``sources.quoted_csv``, the others' by Spark's CSV reader.
MULTILINE_TABLES = {"reviews"}

# Columns parsed as timestamps per table.
DATE_COLUMNS = {
    "orders": [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "order_items": ["shipping_limit_date"],
    "reviews": ["review_creation_date", "review_answer_timestamp"],
}

# Text read as missing (the default missing-value tokens of the pandas CSV reader).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Boolean text normalisation: lower-cased text -> value; anything else is unknown.
BOOL_TRUE_TOKENS = ["true", "1"]
BOOL_FALSE_TOKENS = ["false", "0"]

# A review is negative at or below this score.
NEGATIVE_REVIEW_MAX_SCORE = 2

# Status of a delivered order.
DELIVERED = "delivered"

# Fill value for a missing main category and for missing segment labels.
UNKNOWN = "unknown"

# Labels of the lateness-impact table, by late flag.
IMPACT_LABELS = {False: "À l'heure ou en avance", True: "En retard"}

# Dashboard defaults: minimum orders and rows for the ranked segment table, and for alerts.
TOPN_MIN_ORDERS = 50
TOPN_ROWS = 15
ALERT_MIN_ORDERS = 100
ALERT_ROWS = 5

# Notebook defaults: top categories, and minimum orders / rows for the seller ranking.
TOP_CATEGORIES = 15
SELLER_PAIRS_MIN_ORDERS = 50
SELLER_PAIRS_ROWS = 15

# Segment dimensions of the dashboard: name -> grouping columns.
SEGMENT_DIMENSIONS = {
    "customer_state": ["customer_state"],
    "main_product_category": ["main_product_category"],
    "seller": ["main_seller_id", "main_seller_state"],
}

# The ML table: fixed column order.
ML_COLUMNS = [
    "order_id",
    "late_delivery",
    "customer_state",
    "main_seller_state",
    "main_product_category",
    "item_count",
    "product_count",
    "seller_count",
    "total_price",
    "total_freight",
    "payment_value",
    "payment_installments",
    "payment_type",
    "estimated_delivery_days",
    "purchase_month",
    "purchase_dayofweek",
]
ML_TARGET = "late_delivery"
ML_ID = "order_id"
NUMERIC_FEATURES = [
    "item_count",
    "product_count",
    "seller_count",
    "total_price",
    "total_freight",
    "payment_value",
    "payment_installments",
    "estimated_delivery_days",
    "purchase_month",
    "purchase_dayofweek",
]
CATEGORICAL_FEATURES = ["customer_state", "main_seller_state", "main_product_category", "payment_type"]

# Model settings: forest and logistic regression, split share and seed.
FOREST_PARAMS = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 20, "seed": 42}
LOGISTIC_MAX_ITER = 1000
LOGISTIC_TOL = 1e-4
TEST_SHARE = 0.2
SPLIT_SEED = 42

# Gold outputs: table name -> CSV file name.
GOLD_TABLES = {
    "orders_enriched": "orders_enriched.csv",
    "delivery_kpis_by_state": "delivery_kpis_by_state.csv",
    "delivery_kpis_by_seller": "delivery_kpis_by_seller.csv",
    "delivery_kpis_by_category": "delivery_kpis_by_category.csv",
    "ml_dataset": "ml_dataset.csv",
}

# Batch folder prefixes of the three layers.
LAYER_PREFIX = {"bronze": "ingestion_", "silver": "cleaning_", "gold": "gold_"}

# ---------------------------------------------------------------------------------------------
# Declared types of the evidenced columns. Further columns pass through unchanged.
# ---------------------------------------------------------------------------------------------

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()
_TS, _M = T.TimestampNTZType(), T.DecimalType(18, 2)

DECLARED = {
    "customers": {"customer_id": _S, "customer_state": _S},
    "orders": {
        "order_id": _S,
        "customer_id": _S,
        "order_status": _S,
        "order_purchase_timestamp": _TS,
        "order_approved_at": _TS,
        "order_delivered_carrier_date": _TS,
        "order_delivered_customer_date": _TS,
        "order_estimated_delivery_date": _TS,
    },
    "order_items": {
        "order_id": _S,
        "order_item_id": _I,
        "product_id": _S,
        "seller_id": _S,
        "price": _M,
        "freight_value": _M,
        "shipping_limit_date": _TS,
    },
    "payments": {
        "order_id": _S,
        "payment_sequential": _I,
        "payment_type": _S,
        "payment_installments": _I,
        "payment_value": _M,
    },
    "reviews": {
        "order_id": _S,
        "review_score": _I,
        "review_creation_date": _TS,
        "review_answer_timestamp": _TS,
    },
    "products": {
        "product_id": _S,
        "product_category_name": _S,
        "product_length_cm": _D,
        "product_height_cm": _D,
        "product_width_cm": _D,
    },
    "sellers": {"seller_id": _S, "seller_city": _S, "seller_state": _S},
    "category_translation": {"product_category_name": _S, "product_category_name_english": _S},
    "geolocation": {"geolocation_zip_code_prefix": _S, "geolocation_state": _S},
}

# Tables read by the Gold build (geolocation is ingested and cleaned but never used).
GOLD_INPUTS = [
    "customers", "orders", "order_items", "payments", "reviews", "products", "sellers",
    "category_translation",
]

# Silver tables that the Gold build joins on the order id: written in buckets of this key.
BUCKET_KEY = "order_id"
BUCKETED_TABLES = ["orders", "order_items", "payments", "reviews"]

# Tables whose ingested rows are put in order by this column in each task: ids are most of their bytes, and equal ones
# that lie together take few.
TOGETHER_BY = {"orders": "customer_id", "order_items": "order_id", "payments": "order_id"}

# Column that the wide table's month layout is partitioned by.
MONTH_COLUMN = "purchase_year_month"

# ---------------------------------------------------------------------------------------------
# Types from the data: kinds of text values as bits, the patterns that tell them, and the types of
# joined kinds (any other mixture is text).
# ---------------------------------------------------------------------------------------------
KINDS = {"boolean": 1, "bigint": 2, "double": 4, "timestamp": 8, "string": 16}
WHOLE_PATTERN = r"^[+-]?[0-9]+$"
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"
TYPES_OF_KINDS = {0: "double", 1: "boolean", 2: "bigint", 4: "double", 6: "double", 8: "timestamp"}
