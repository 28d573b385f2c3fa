"""Date and time expressions.

All timestamps are TIMESTAMP_NTZ (wall clock), so none of these depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delivery_lake.functions.flags import null_tokens_to_null

_MICROS_PER_DAY = 86_400_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _micros_of_day(c: Column) -> Column:
    seconds = F.date_part(F.lit("SECOND"), c)  # DECIMAL(8,6): seconds with the microseconds
    return ((F.hour(c).cast("bigint") * 3600 + F.minute(c) * 60) * 1_000_000
            + (seconds * 1_000_000).cast("bigint"))


def floor_days(later, earlier) -> Column:
    """Whole days of ``later - earlier``, rounded towards minus infinity.

    One hour early is -1, one hour late is 0. ``datediff``/``timestampdiff(DAY)`` truncate
    towards zero and are wrong for negative spans. Null if either side is null.

    The span is computed from wall-clock fields only (calendar days between the dates plus the
    difference of the times of day, in microseconds), so it is exact and independent of the
    session time zone, daylight-saving changes included."""
    a, b = _col(later), _col(earlier)
    micros = (F.datediff(F.to_date(a), F.to_date(b)).cast("bigint") * _MICROS_PER_DAY
              + _micros_of_day(a) - _micros_of_day(b))
    return F.floor(micros / F.lit(_MICROS_PER_DAY)).cast("bigint")


def parse_timestamp(c) -> Column:
    """Lenient parse of timestamp text: missing-value tokens and unparseable text become null
    (ANSI-safe ``try_cast``; a plain cast would raise)."""
    return null_tokens_to_null(_col(c)).try_cast("timestamp_ntz")


def year_month(c) -> Column:
    """Calendar month as ``yyyy-MM`` text; null for a null timestamp."""
    return F.date_format(_col(c), "yyyy-MM")


def weekday_monday0(c) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(c))
