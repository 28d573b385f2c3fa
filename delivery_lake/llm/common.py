"""Helpers shared by the text operators: inputs, blocks of documents, written intermediate tables."""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delivery_lake.session import checkpoint_root

#: Bytes of stored input that one block of documents stands for. Blocks bound what a task holds:
#: their number follows the input, so a block stays a few megabytes of text at any scale.
BLOCK_BYTES = 4 << 20
#: Input bytes per part when symbols, windows or fingerprints are dealt out by hash.
PART_BYTES = 2 << 20
#: Rows and bytes of an Arrow batch (see ``modest_batches``).
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def modest_batches(df: DataFrame) -> DataFrame:
    """Arrow batches of at most BATCH_ROWS rows and BATCH_BYTES in this session, where the user has left
    Spark's larger defaults: two tasks an executor then hold megabytes of rows, not hundreds."""
    conf = df.sparkSession.conf
    for key, usual, ours in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", str(BATCH_ROWS)),
                             ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", f"{BATCH_BYTES}b")):
        if conf.get(key, usual) == usual:
            conf.set(key, ours)
    return df


def row_column(batch, name: str):
    """A column of an Arrow batch, or the field of its column ``row``."""
    import pyarrow.compute as pc

    return batch.column(name) if name in batch.schema.names else pc.struct_field(batch.column("row"), name)


def as_row(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All columns in one struct ``row``, ``doc_id`` and ``text`` as long and string inside it where they
    are there: operators add columns beside it without a clash of names, and no text is sent twice."""
    kinds = {"doc_id": "long", "text": "string"}
    field = lambda c: (F.col(f"`{c}`").cast(kinds[c]) if c in kinds else F.col(f"`{c}`")).alias(c)
    return modest_batches(docs.select(F.struct(*[field(c) for c in columns or docs.columns]).alias("row")))


def from_row(df: DataFrame, docs: DataFrame, **other: Column) -> list[Column]:
    """The columns of ``docs`` out of ``row``, in their order and types; ``other`` replaces some."""
    return [(other[c] if c in other else F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` only: other columns, whatever their names, go no further."""
    return modest_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))


def input_bytes(df: DataFrame) -> int:
    """Stored size of the input as the optimizer knows it from the files (no job is run)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def count_for(df: DataFrame, bytes_each: int, least: int) -> int:
    """How many blocks or parts an input gets: proportional to its size, never under ``least``.

    Where the size is not known (the optimizer then reports an upper bound), rows are counted and
    taken as a kilobyte each."""
    size = input_bytes(df)
    if size > 1 << 55:
        size = df.count() << 10
    return max(least, math.ceil(size / bytes_each))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared checkpoint folder and reread: cuts the lineage, survives lost executors."""
    path = f"{checkpoint_root(df.sparkSession)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the fold of a document (null for a null id)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(modulus))


def held_out(doc_id: str, modulus: int) -> Column:
    """True for documents of the held-out fold (remainder 2); a null id is never held out."""
    return F.coalesce(remainder(doc_id, modulus) == 2, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of each 64-bit word (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def as_bytes(column) -> list:
    """An Arrow string column as Python ``bytes`` (no decoding); nulls become empty."""
    import pyarrow as pa

    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(batch, rows: int = 256):
    """Smaller slices of an Arrow batch, so that working arrays stay small."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)
