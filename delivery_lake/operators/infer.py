"""Column types from the data (E02, F02): the narrowest type that every value of a text column fits.

Each value has a kind: truth value, whole number, number, timestamp or other text; missing values (null
and the missing-value tokens) have none. Kinds are bits, joined by ``bit_or`` in one hash aggregation per
table for all its columns (partial aggregates, one row out), so a table is read once at any size. A
column's type is the least upper bound of its kinds: whole numbers and numbers are numbers, any other
mixture is text. A column without values is a column of numbers, as in the original."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delivery_lake.functions import null_tokens_to_null
from delivery_lake.schemas import KINDS, NUMBER_PATTERN, TIMESTAMP_PATTERN, TYPES_OF_KINDS, WHOLE_PATTERN


def value_kind(c: Column) -> Column:
    """Bit of the narrowest type that a text value fits; 0 for a missing value."""
    v = null_tokens_to_null(c)
    return (F.when(v.isNull(), F.lit(0))
            .when(F.lower(v).isin("true", "false"), F.lit(KINDS["boolean"]))
            .when(v.rlike(WHOLE_PATTERN) & v.try_cast("bigint").isNotNull(), F.lit(KINDS["bigint"]))
            .when(v.rlike(NUMBER_PATTERN), F.lit(KINDS["double"]))
            .when(v.rlike(TIMESTAMP_PATTERN) & v.try_cast("timestamp_ntz").isNotNull(), F.lit(KINDS["timestamp"]))
            .otherwise(F.lit(KINDS["string"])))


def type_of_kinds(mask: Column) -> Column:
    """Type name for the joined kinds of a column."""
    out = F.lit("string")
    for bits, name in TYPES_OF_KINDS.items():
        out = F.when(mask == bits, F.lit(name)).otherwise(out)
    return out


def column_types(df: DataFrame) -> DataFrame:
    """``position, column_name, dtype, n_values`` (values that are not missing) for every column, read as
    text: one aggregation, one row a column."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "position int, column_name string, dtype string, n_values long")
    kinds = [value_kind(F.col(f"`{c}`").cast("string")) for c in df.columns]
    coded = df.select(*[k.alias(f"k{i}") for i, k in enumerate(kinds)])
    joined = coded.agg(*[x for i in range(len(kinds)) for x in (F.bit_or(f"k{i}").alias(f"k{i}"), F.count_if(F.col(f"k{i}") > 0).alias(f"n{i}"))])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), type_of_kinds(F.coalesce(f"k{i}", F.lit(0))).alias("dtype"),
                     F.col(f"n{i}").alias("n_values")) for i, c in enumerate(df.columns)]
    return joined.select(F.inline(F.array(*rows)))


def table_types(tables: dict[str, DataFrame]) -> DataFrame:
    """``column_types`` of several tables, with the table's name."""
    return reduce(DataFrame.unionByName, [column_types(df).select(F.lit(t).alias("table_name"), "*") for t, df in tables.items()])


def cast_inferred(df: DataFrame) -> DataFrame:
    """The text columns of ``df`` in the types that their values have; missing-value tokens become null. A
    row a column comes to the driver; other columns pass through."""
    text = [c for c, t in df.dtypes if t == "string"]
    found = {r["column_name"]: r["dtype"] for r in column_types(df.select(*[F.col(f"`{c}`") for c in text])).collect()}
    cast = {c: null_tokens_to_null(F.col(f"`{c}`")) for c in text}
    return df.withColumns({c: v if found[c] == "string" else v.try_cast("timestamp_ntz" if found[c] == "timestamp" else found[c]) for c, v in cast.items()})
