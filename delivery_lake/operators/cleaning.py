"""Silver rules: column names, duplicates, dates and derived order/review/product columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_lake.functions import (
    bool_from_text,
    null_tokens_to_null,
    floor_days,
    late_flag,
    negative_review,
    pack_id,
    packed_tokens_to_null,
    unpack_id,
    parse_timestamp,
)
from delivery_lake.schemas import DATE_COLUMNS, DECLARED
from delivery_lake.session import scratch_dir, shuffles_freed

# Provenance columns added by the ingest; never part of a duplicate key.
PROVENANCE = ("batch_id", "source_file")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name. Two names that collide after that raise."""
    names = [c.strip().lower() for c in df.columns]
    seen = set()
    for orig, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"column name collision after standardising: {orig!r} -> {new!r}")
        seen.add(new)
    if names == df.columns:
        return df
    return df.toDF(*names)


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """Drop rows equal in every data column (nulls compare equal).

    One shuffle on all data columns; provenance columns are not part of the key (one value
    per group is kept)."""
    keys = [c for c in df.columns if c not in PROVENANCE]
    if len(keys) == len(df.columns):
        return df.dropDuplicates()
    return df.dropDuplicates(keys)


def drop_duplicates_by_hash(df: DataFrame, most_copies: float = 0.1) -> DataFrame:
    """B02 for wide rows of which few have copies: the rows of ``drop_full_duplicates``, in two phases.

    First 64 bits of every row are counted, which shuffles 8 bytes a row and its count, and the hashes that repeat
    are written (a small table). Then only rows with such a hash are shuffled and compared whole: copies are
    verified, never trusted to a hash; all other rows go through as they are. The repeated hashes reach
    the rows by a join, broadcast only if Spark finds them small enough. Where more than
    ``most_copies`` of the rows have a repeated hash there is nothing to save, and all are compared."""
    keys = [c for c in df.columns if c not in PROVENANCE]
    row_hash = F.xxhash64(*keys).alias("_hash")
    path = f"{scratch_dir(df.sparkSession, 'repeated')}/hashes"
    counted = df.select(row_hash).groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    seen = Observation("repeated")
    with shuffles_freed(df.sparkSession):
        (counted.observe(seen, F.sum("n").alias("rows"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("copies"))
         .where("n > 1").select("_hash", F.lit(True).alias("_again")).write.parquet(path))
    found = dict(seen.get)
    if (found["copies"] or 0) > most_copies * (found["rows"] or 0):
        return drop_full_duplicates(df)
    marked = df.select("*", row_hash).join(df.sparkSession.read.parquet(path), "_hash", "left")
    alone = marked.where(F.col("_again").isNull()).select(*df.columns)
    return alone.unionByName(marked.where("_again").select(*df.columns).dropDuplicates(keys))


def convert_dates(df: DataFrame, table: str) -> DataFrame:
    """Lenient parse of the known timestamp columns of ``table`` that exist.

    Text goes through the null tokens and ``try_cast``; already typed columns are cast to
    TIMESTAMP_NTZ."""
    cols = [c for c in DATE_COLUMNS.get(table, []) if c in df.columns]
    if not cols:
        return df
    types = dict(df.dtypes)
    repl = {}
    for c in cols:
        if types[c] == "string":
            repl[c] = parse_timestamp(c)
        elif types[c] != "timestamp_ntz":
            repl[c] = F.col(c).cast("timestamp_ntz")
    return df.withColumns(repl) if repl else df


def add_estimated_delivery_days(df: DataFrame) -> DataFrame:
    """Whole days promised, floor(estimated - purchase), for every status."""
    return df.withColumn("estimated_delivery_days",
                         floor_days("order_estimated_delivery_date", "order_purchase_timestamp"))


def add_delay_days(df: DataFrame) -> DataFrame:
    """Whole days of delay, floor(delivered - estimated); one hour early is -1."""
    return df.withColumn("delay_days",
                         floor_days("order_delivered_customer_date", "order_estimated_delivery_date"))


def add_late_flag(df: DataFrame) -> DataFrame:
    """Three-valued late flag (see ``late_flag``)."""
    return df.withColumn("late_delivery", late_flag())


def clean_orders(df: DataFrame) -> DataFrame:
    return add_late_flag(add_delay_days(add_estimated_delivery_days(df)))


def add_negative_review(df: DataFrame) -> DataFrame:
    """Score <= 2; a missing score counts as not negative."""
    if "review_score" not in df.columns:
        return df
    return df.withColumn("negative_review", negative_review("review_score"))


def add_product_volume(df: DataFrame) -> DataFrame:
    """Length * height * width when all three columns exist; null if any is null."""
    dims = ["product_length_cm", "product_height_cm", "product_width_cm"]
    if not all(c in df.columns for c in dims):
        return df
    return df.withColumn("product_volume_cm3",
                         F.col(dims[0]).cast("double") * F.col(dims[1]).cast("double") * F.col(dims[2]).cast("double"))


TABLE_RULES: dict[str, list[Callable[[DataFrame], DataFrame]]] = {
    "orders": [clean_orders],
    "reviews": [add_negative_review],
    "products": [add_product_volume],
}


def clean_table(table: str, df: DataFrame, losses: dict[str, Observation] | None = None,
                by_hash: bool = False) -> DataFrame:
    """B01 -> B02 -> declared types -> B03 -> the table's own rules. Duplicates are removed
    on the raw values, before anything is parsed (two spellings of one instant stay two rows).
    On already typed input the casts are no-ops.

    With ``losses``, the values that parsing turns into null are counted while the table is written
    (see ``parse_observed``). ``by_hash``: duplicates are looked for by ``drop_duplicates_by_hash``, a job of its
    own, which moves 8 bytes a row instead of whole rows; for stored tables, as they are read twice."""
    df = standardize_columns(df)
    df = drop_duplicates_by_hash(df) if by_hash else drop_full_duplicates(df)

    def parse(raw: DataFrame) -> DataFrame:
        dates = set(DATE_COLUMNS.get(table, []))
        return convert_dates(cast_declared(raw, {c: t for c, t in DECLARED.get(table, {}).items() if c not in dates}), table)

    df = parse(df) if losses is None else parse_observed(table, df, parse, losses)
    for rule in TABLE_RULES.get(table, []):
        df = rule(df)
    return df


def clean_tables(tables: dict[str, DataFrame], losses: dict[str, Observation] | None = None,
                 by_hash: bool = False) -> dict[str, DataFrame]:
    return {name: clean_table(name, df, losses, by_hash) for name, df in tables.items()}


# Text ids that ``clean_packed`` shortens.
PACKED_IDS = ("order_id", "customer_id", "product_id", "seller_id")


def dealt_out(df: DataFrame, parts: int, key: str) -> DataFrame:
    """``df.repartition(parts, key)`` with text ids in ``pack_id``'s form on the way: half the bytes are moved.
    Rows go by the key's text, so they lie as buckets of it do and Spark knows the partitioning by it."""
    ids = [c for c, t in df.dtypes if c in PACKED_IDS and t == "string"]
    if key not in ids:
        return df.repartition(parts, key)
    packed = df.withColumns({c: pack_id(c) for c in ids}).repartition(parts, unpack_id(key))
    return packed.withColumns({c: unpack_id(c) for c in ids})


def clean_packed(table: str, df: DataFrame, key: str, keep_null_keys: bool = False) -> DataFrame:
    """``clean_table`` with ids in ``pack_id``'s form and rows dealt out by ``key`` before duplicates are
    dropped: whoever joins or groups by the key next needs no further shuffle, and an id takes half the bytes
    in this one. All rows of a key come to one task (see ``files.most_rows``). Rows without a key are left
    out; with ``keep_null_keys`` they stay, and a missing-value token stays in the key."""
    df = standardize_columns(df)
    ids = [c for c in PACKED_IDS if c in df.columns]
    if not keep_null_keys:
        df = df.where(null_tokens_to_null(key).isNotNull())
    columns = df.columns
    dealt = df.withColumns({c: pack_id(c) for c in ids}).repartition(key)
    # B02; the condition on the count holds for every row. It keeps Spark from leaving this step out for readers
    # that distinct rows are the same to: each of them would shuffle columns of its own instead of sharing one
    # shuffle with the others
    df = dealt.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 0").drop("_copies")
    # the key's column stays as it is: Spark knows the partitioning by it
    df = df.withColumns({c: packed_tokens_to_null(c) for c in ids if c != key})
    dates = set(DATE_COLUMNS.get(table, []))
    df = convert_dates(cast_declared(df, {c: t for c, t in DECLARED.get(table, {}).items() if c not in dates and c not in ids}), table)
    for rule in TABLE_RULES.get(table, []):
        df = rule(df)
    return df


def parse_observed(table: str, df: DataFrame, parse: Callable[[DataFrame], DataFrame], losses: dict[str, Observation]) -> DataFrame:
    """``parse(df)``, and in ``losses[table]`` an observation of it: per text column how many values were
    there (no missing-value token) and are null now. The counts come with the job that writes the
    table: no second pass, no shuffle. A task that is run again after a lost executor may count twice, so
    they are at least the true ones."""
    text = [c for c, t in df.dtypes if t == "string" and c in DECLARED.get(table, {}) and c not in PROVENANCE]
    if not text:
        return parse(df)
    kept = parse(df.withColumns({f"_raw_{c}": null_tokens_to_null(c) for c in text}))
    losses[table] = Observation(f"losses-{table}")
    lost = [F.count_if(F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in text]
    return kept.observe(losses[table], F.count(F.lit(1)).alias("_rows"), *lost).drop(*[f"_raw_{c}" for c in text])


def lost_values(losses: dict[str, Observation]) -> dict[tuple[str, str], tuple[int, int]]:
    """(values lost, rows) of every (table, column) that lost some. The tables must have been written."""
    out = {}
    for table, seen in losses.items():
        counts = dict(seen.get)
        rows = counts.pop("_rows", 0)
        out |= {(table, c): (n, rows) for c, n in counts.items() if n}
    return out


def check_losses(losses: dict[str, Observation], most: float) -> dict[tuple[str, str], tuple[int, int]]:
    """``lost_values``; raises if a column lost more than the share ``most`` of its rows."""
    found = lost_values(losses)
    bad = [f"{t}.{c}: {n} of {rows}" for (t, c), (n, rows) in sorted(found.items()) if n > most * rows]
    if bad:
        raise ValueError(f"values that cannot be read: {'; '.join(bad)}")
    return found


def normalize_booleans(df: DataFrame, columns: Iterable[str] = ("late_delivery", "negative_review")) -> DataFrame:
    """Boolean-like text (true/false/1/0, any case) to BOOLEAN, anything else null.
    Typed BOOLEAN columns are kept as they are."""
    types = dict(df.dtypes)
    repl = {c: bool_from_text(c) for c in columns if c in types and types[c] != "boolean"}
    return df.withColumns(repl) if repl else df


# Measures the dashboard averages; read as numbers when the input is text (CSV copy).
DASHBOARD_MEASURES = ["delivery_days", "delay_days", "review_score", "estimated_delivery_days"]


def normalize_orders(df: DataFrame) -> DataFrame:
    """Dashboard input normalisation: purchase time parsed, boolean columns normalised, text
    measures read as numbers (missing-value tokens and bad text -> null)."""
    types = dict(df.dtypes)
    if types.get("order_purchase_timestamp") == "string":
        df = df.withColumn("order_purchase_timestamp", parse_timestamp("order_purchase_timestamp"))
    measures = {c: null_tokens_to_null(c).try_cast("double") for c in DASHBOARD_MEASURES if types.get(c) == "string"}
    if measures:
        df = df.withColumns(measures)
    return normalize_booleans(df)


def cast_declared(df: DataFrame, declared: dict[str, T.DataType]) -> DataFrame:
    """Typed scan helper: declared columns ``try_cast`` to their type (text via null tokens),
    other columns pass through unchanged."""
    types = dict(df.dtypes)
    repl = {}
    for c, dtype in declared.items():
        if c not in types:
            continue
        src = F.col(c)
        if types[c] == "string":
            src = null_tokens_to_null(src)
            if isinstance(dtype, T.BooleanType):
                repl[c] = bool_from_text(src)
                continue
            if isinstance(dtype, T.IntegralType):
                # "5.0" and "1e1" are whole numbers too; text that is no whole number -> null
                number = src.try_cast("double")
                repl[c] = F.when(number == F.rint(number), number).try_cast(dtype)
                continue
        repl[c] = src.try_cast(dtype)
    return df.withColumns(repl) if repl else df
