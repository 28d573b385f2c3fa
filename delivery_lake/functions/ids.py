"""Text ids in a short form for shuffles: 32 hexadecimal digits as 16 bytes, any other text kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delivery_lake.schemas import NULL_TOKENS

HEX_ID_BYTES = 16


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pack_id(c) -> Column:
    """Binary form of a text, a different one for every text: 32 lower-case hexadecimal digits become 16
    bytes; other texts their UTF-8 bytes, with one more byte at the end from 16 bytes on. Null stays null.
    The order of packed texts is not that of the texts."""
    text = _col(c)
    utf8 = F.encode(text, "UTF-8")
    digits = F.unhex(F.when(text.rlike("^[0-9a-f]{32}\\z"), text))
    return F.coalesce(digits, F.when(F.length(utf8) < HEX_ID_BYTES, utf8).otherwise(F.concat(utf8, F.lit(bytearray(b"\0")))))


def unpack_id(c) -> Column:
    """The text of ``pack_id``'s binary."""
    b = _col(c)
    n = F.length(b)
    return (F.when(n == HEX_ID_BYTES, F.lower(F.hex(b)))
            .otherwise(F.decode(F.when(n < HEX_ID_BYTES, b).otherwise(F.substring(b, F.lit(1), n - 1)), "UTF-8")))


def packed_tokens_to_null(c) -> Column:
    """``null_tokens_to_null`` for packed text (the tokens are shorter than 16 bytes)."""
    b = _col(c)
    return F.when(~b.isin([F.lit(bytearray(t.encode())) for t in NULL_TOKENS]), b)
