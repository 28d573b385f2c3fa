"""Flag and rate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delivery_lake.schemas import (
    BOOL_FALSE_TOKENS,
    BOOL_TRUE_TOKENS,
    DELIVERED,
    NEGATIVE_REVIEW_MAX_SCORE,
    NULL_TOKENS,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens_to_null(c) -> Column:
    """Text equal to a missing-value token becomes null (exact match, as the CSV reader)."""
    col = _col(c)
    return F.when(~col.isin(NULL_TOKENS), col)


def late_flag(status="order_status", delivered="order_delivered_customer_date",
              estimated="order_estimated_delivery_date") -> Column:
    """Three-valued lateness: ``delivered > estimated`` for delivered orders with both dates,
    otherwise null. Compares instants: one hour late is late although the day delay is 0."""
    s, d, e = _col(status), _col(delivered), _col(estimated)
    known = (s == F.lit(DELIVERED)) & d.isNotNull() & e.isNotNull()
    return F.when(known, d > e)


def negative_review(score="review_score") -> Column:
    """Score at or below the negative threshold; a missing score is not negative."""
    return F.coalesce(_col(score) <= F.lit(NEGATIVE_REVIEW_MAX_SCORE), F.lit(False))


def bool_from_text(c) -> Column:
    """Lower-cased text of the value: true/1 -> true, false/0 -> false, anything else null."""
    t = F.lower(_col(c).cast("string"))
    return F.when(t.isin(BOOL_TRUE_TOKENS), F.lit(True)).when(t.isin(BOOL_FALSE_TOKENS), F.lit(False))


def pct_of_true(flag) -> Column:
    """Share of true among the non-null flags, in percent (aggregate expression)."""
    return F.avg(_col(flag).cast("int")) * F.lit(100)
