"""Column-level helpers (Spark built-in expressions only, no Python UDFs)."""

from delivery_lake.functions.dates import floor_days, parse_timestamp, weekday_monday0, year_month
from delivery_lake.functions.flags import (
    bool_from_text,
    late_flag,
    negative_review,
    null_tokens_to_null,
    pct_of_true,
)
from delivery_lake.functions.ids import pack_id, packed_tokens_to_null, unpack_id

__all__ = [
    "floor_days",
    "parse_timestamp",
    "weekday_monday0",
    "year_month",
    "bool_from_text",
    "late_flag",
    "negative_review",
    "null_tokens_to_null",
    "pack_id",
    "packed_tokens_to_null",
    "pct_of_true",
    "unpack_id",
]
