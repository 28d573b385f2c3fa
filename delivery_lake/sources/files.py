"""File layers: raw CSV landing zone, Bronze / Silver / Gold snapshots.

Every layer is one parquet table per logical table, partitioned by ``batch_id``; a batch is a
full snapshot. Readers resolve the batch once and pass it on, so the stages of one run never
mix snapshots. Paths may be any Hadoop file system URI (shared storage on a cluster).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_lake.operators.cleaning import cast_declared
from delivery_lake.schemas import BUCKET_KEY, DECLARED, GOLD_TABLES, LAYER_PREFIX, MANIFEST, MONTH_COLUMN, MULTILINE_TABLES, TOGETHER_BY
from delivery_lake.session import shuffles_freed
from delivery_lake.sources.quoted_csv import read_quoted_csv

CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Independent per-table writes are submitted as concurrent Spark jobs: small dimension tables
# then run alongside the large fact tables instead of leaving executors idle between jobs.
WRITE_CONCURRENCY = 4
# Folder of a layer with one file per complete batch (Spark's readers skip names with "_"): empty, or
# the bucket numbers of its bucketed tables as JSON.
COMMITS = "_batches"
# Stored bytes that a bucket stands for, and the most rows that one key may have: a bucket is read by one
# task, so tables with a hotter key are not bucketed (Gold then shuffles partial aggregates instead).
BUCKET_BYTES = 128 << 20
HOT_ROWS = 2_000_000
# Hash ranges in which the rows of a key are counted: every map task sends at most one number for each.
HOT_RANGES = 65_536
# Layers are kept as Parquet with this compression: ids are hexadecimal text, of which it takes half.
LAYER_COMPRESSION = "zstd"
# A gzipped CSV file can't be split by its readers: landing files hold at most this many rows.
LANDING_ROWS = 2_000_000
# For compressed CSV: short chance matches inside hexadecimal ids cost more bits than their digits do.
GZIP_STRATEGY = {"zlib.compress.strategy": "FILTERED"}


def run_concurrently(tasks: dict[str, callable], workers: int = WRITE_CONCURRENCY) -> dict:
    """Run independent Spark actions from a small thread pool; results by name. The first
    failure is raised after all submitted actions finished."""
    if workers <= 1 or len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (file-system metadata only)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def new_batch_id(layer: str, now: dt.datetime | None = None) -> str:
    """Batch id of a layer snapshot: prefix + ``YYYYmmdd_HHMMSS`` (sorts by time)."""
    return LAYER_PREFIX[layer] + (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


# --- A01 -----------------------------------------------------------------------------------------

def manifest_status(spark: SparkSession, source_dir: str, manifest: dict[str, str] = MANIFEST) -> DataFrame:
    """One row per manifest entry with its presence in ``source_dir``."""
    rows = [(t, f, path_exists(spark, f"{source_dir.rstrip('/')}/{f}")) for t, f in manifest.items()]
    return spark.createDataFrame(rows, "table_name string, file_name string, present boolean")


def check_manifest(spark: SparkSession, source_dir: str, manifest: dict[str, str] = MANIFEST,
                   all_missing: bool = True) -> None:
    """Raise if files are missing: all missing names (ingest) or the first one (later stages)."""
    missing = [f for f in manifest.values() if not path_exists(spark, f"{source_dir.rstrip('/')}/{f}")]
    if missing:
        shown = missing if all_missing else missing[:1]
        raise FileNotFoundError(f"missing source files in {source_dir}: {', '.join(shown)}")


# --- landing zone (raw CSV, as delivered by the source system) ----------------------------------------

def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> str:
    """CSV with header; timestamps as ``yyyy-MM-dd HH:mm:ss``; quotes doubled inside quoted text."""
    writer = (df.write.mode(mode).option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
              .option("timestampFormat", CSV_TIMESTAMP_FORMAT).option("escape", '"').option("compression", compression))
    if compression != "none":
        writer = writer.option("maxRecordsPerFile", LANDING_ROWS).options(**GZIP_STRATEGY)
    writer.csv(path)
    return path


def write_landing(tables: dict[str, DataFrame], landing_dir: str) -> str:
    """Raw source files: each table as ``<landing>/<manifest file name>``, compressed; those with quoted line
    breaks with bzip2, so that ``read_quoted_csv`` still reads them in splits."""
    run_concurrently({name: (lambda df=df, name=name: write_csv(df, f"{landing_dir.rstrip('/')}/{MANIFEST[name]}",
                                                                compression="bzip2" if name in MULTILINE_TABLES else "gzip"))
                      for name, df in tables.items()})
    return landing_dir


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw CSV as all-STRING columns (no inference), doubled quotes kept. ``multi_line`` keeps
    quoted line breaks but makes each file one task; ``read_quoted_csv`` reads such files in splits."""
    return (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
            .option("inferSchema", False).csv(path))


# --- A02 / A05 / A06 writers, A03 / A04 readers --------------------------------------------------------

def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def write_layer(df: DataFrame, root: str, layer: str, table: str, batch_id: str) -> str:
    """Append one snapshot of ``table`` to ``layer`` (parquet, partitioned by ``batch_id``).
    Writing the same batch again replaces only that partition. The partition's folder is written by
    itself: a write by partition column would sort all rows by their one batch id first."""
    path = layer_path(root, layer, table)
    (df.drop("batch_id").write.mode("overwrite").option("compression", LAYER_COMPRESSION)
     .parquet(f"{path}/batch_id={batch_id}"))
    return path


def ingest_bronze(spark: SparkSession, source_dir: str, root: str, batch_id: str | None = None,
                  manifest: dict[str, str] = MANIFEST) -> str:
    """Every manifest file into Bronze, values kept verbatim as text, with the source file
    name and the batch id. Checks the manifest first (all missing files listed). Each task puts its rows in order
    by the id that repeats (``TOGETHER_BY``): nothing is shuffled, and a task holds a split or a landing file."""
    check_manifest(spark, source_dir, manifest, all_missing=True)
    batch_id = batch_id or new_batch_id("bronze")

    def ingest(table: str, file_name: str) -> str:
        path = f"{source_dir.rstrip('/')}/{file_name}"
        raw = read_quoted_csv(spark, path) if table in MULTILINE_TABLES else read_raw_csv(spark, path, multi_line=False)
        if TOGETHER_BY.get(table) in raw.columns:
            raw = raw.sortWithinPartitions(TOGETHER_BY[table])
        return write_layer(raw.withColumn("source_file", F.lit(file_name)), root, "bronze", table, batch_id)

    run_concurrently({t: (lambda t=t, f=f: ingest(t, f)) for t, f in manifest.items()})
    commit_batch(spark, root, "bronze", batch_id)
    return batch_id


def commit_batch(spark: SparkSession, root: str, layer: str, batch_id: str, buckets: dict[str, int] | None = None) -> None:
    """Mark a batch as complete, after its last table. Readers take complete batches only, so a run
    that stopped half-way is never mixed with an older one. The mark keeps the numbers of buckets."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/{layer}/{COMMITS}/{batch_id}")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(buckets).encode() if buckets else b""))
    out.close()


def batch_buckets(spark: SparkSession, root: str, layer: str, batch_id: str) -> dict[str, int]:
    """Numbers of buckets of the bucketed tables of a complete batch."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/{layer}/{COMMITS}/{batch_id}")
    if not fs.exists(p):
        return {}
    stream = fs.open(p)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return json.loads(text) if text else {}


# --- bucketed Silver tables --------------------------------------------------------------------------

def most_rows(tables: list[tuple[DataFrame, str]], ranges: int = HOT_RANGES) -> int:
    """No value of its key has more rows than this in any of the ``(table, key)`` pairs: rows are counted per
    hash range of the key, so a map task sends at most ``ranges`` numbers whatever the number of keys. Null
    is a value here."""
    counts = [df.groupBy(F.lit(i).alias("t"), F.pmod(F.xxhash64(key), F.lit(ranges)).alias("r")).agg(F.count(F.lit(1)).alias("n"))
              for i, (df, key) in enumerate(tables)]
    return reduce(DataFrame.unionByName, counts).agg(F.max("n")).first()[0] or 0


def bucket_count(tables: list[DataFrame], key: str = BUCKET_KEY, bucket_bytes: int = BUCKET_BYTES, hot_rows: int = HOT_ROWS) -> int:
    """One number of buckets for tables that are joined on ``key``: by the size of the largest, at
    least as many as a shuffle makes (or Spark would shuffle again). 0 (no buckets) where one value of the key
    may have more than ``hot_rows`` rows in a table (``most_rows``)."""
    spark = tables[0].sparkSession
    if most_rows([(df, key) for df in tables]) > hot_rows:
        return 0
    size = max(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for df in tables)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(min(size, 1 << 60) / bucket_bytes) if size < 1 << 55 else 0)


def _bucket_table(path: str) -> str:
    return "lake_" + hashlib.md5(path.encode()).hexdigest()


def write_bucketed(df: DataFrame, root: str, layer: str, table: str, batch_id: str, buckets: int, key: str = BUCKET_KEY) -> str:
    """One snapshot of ``table`` as ``write_layer`` writes it, in ``buckets`` buckets sorted by ``key``.
    ``df`` should come hash-partitioned on the key into as many partitions: then each bucket is one
    file and nothing more is shuffled. Plain readers see an ordinary Parquet folder."""
    path = f"{layer_path(root, layer, table)}/batch_id={batch_id}"
    (df.write.mode("overwrite").format("parquet").option("compression", LAYER_COMPRESSION).bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(_bucket_table(path)))
    return path


def read_bucketed(spark: SparkSession, root: str, layer: str, table: str, batch_id: str, buckets: int, key: str = BUCKET_KEY) -> DataFrame:
    """A bucketed snapshot with its layout: joins and aggregations on the key need no exchange."""
    path = f"{layer_path(root, layer, table)}/batch_id={batch_id}"
    name = _bucket_table(path)
    if not spark.catalog.tableExists(name):  # written by another session: declare it again
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def committed_batches(spark: SparkSession, root: str, layer: str) -> list[str]:
    fs, p = _fs(spark, f"{root.rstrip('/')}/{layer}/{COMMITS}")
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def latest_batch(spark: SparkSession, root: str, layer: str, tables: list[str] | None = None) -> str:
    """Greatest id (lexicographic) of the complete batches that hold all of ``tables``: one batch
    for all tables of a read. Error if there is none."""
    found = committed_batches(spark, root, layer)
    for t in tables or []:
        have = {n.split("=", 1)[1] for n in list_dirs(spark, layer_path(root, layer, t)) if n.startswith("batch_id=")}
        found = [b for b in found if b in have]
    if not found:
        raise FileNotFoundError(f"no complete {layer} batch{' of ' + ', '.join(tables) if tables else ''} under {root}")
    return max(found)


def read_layer(spark: SparkSession, root: str, layer: str, table: str, batch_id: str | None = None) -> DataFrame:
    """One snapshot of a layer table (partition-pruned to ``batch_id``; the latest complete one if
    omitted)."""
    batch_id = batch_id or latest_batch(spark, root, layer, [table])
    return (spark.read.parquet(layer_path(root, layer, table))
            .where(F.col("batch_id") == batch_id))


def scan(spark: SparkSession, root: str, layer: str, tables: list[str], batch_id: str | None = None,
         keep_provenance: bool = False) -> dict[str, DataFrame]:
    """The tables of one snapshot as stored (Bronze: all text): all from the same batch."""
    batch_id = batch_id or latest_batch(spark, root, layer, tables)
    out = {}
    for t in tables:
        df = read_layer(spark, root, layer, t, batch_id)
        out[t] = df if keep_provenance else df.drop("batch_id", "source_file")
    return out


def typed_scan(spark: SparkSession, root: str, layer: str, tables: list[str], batch_id: str | None = None,
               keep_provenance: bool = False) -> dict[str, DataFrame]:
    """The tables of one snapshot with declared columns ``try_cast`` to their types
    (missing-value tokens -> null, bad text -> null); other columns pass through."""
    raw = scan(spark, root, layer, tables, batch_id, keep_provenance)
    return {t: cast_declared(df, DECLARED.get(t, {})) for t, df in raw.items()}


def write_tables(tables: dict[str, DataFrame], root: str, layer: str, batch_id: str,
                 buckets: dict[str, int] | None = None, check: Callable[[], object] | None = None) -> dict[str, str]:
    """A05 (Silver) / A06 (Gold): one parquet table per name, in one batch (concurrent jobs), which is
    marked complete after the last one. Tables named in ``buckets`` are bucketed; if ``check`` raises,
    the batch stays incomplete."""
    buckets = buckets or {}

    def write(name: str, df: DataFrame) -> str:
        if buckets.get(name):
            return write_bucketed(df, root, layer, name, batch_id, buckets[name])
        return write_layer(df, root, layer, name, batch_id)

    spark = next(iter(tables.values())).sparkSession
    with shuffles_freed(spark):  # readers read what was written
        out = run_concurrently({name: (lambda df=df, name=name: write(name, df)) for name, df in tables.items()})
    if check:
        check()
    commit_batch(spark, root, layer, batch_id, buckets)
    return out


def silver_scan(spark: SparkSession, root: str, tables: list[str], batch_id: str | None = None) -> dict[str, DataFrame]:
    """The Silver tables of one snapshot as stored (they are typed), bucketed ones with their layout."""
    batch_id = batch_id or latest_batch(spark, root, "silver", tables)
    buckets = batch_buckets(spark, root, "silver", batch_id)
    return {t: read_bucketed(spark, root, "silver", t, batch_id, buckets[t]) if buckets.get(t)
            else read_layer(spark, root, "silver", t, batch_id).drop("batch_id") for t in tables}


def write_by_month(wide: DataFrame, path: str, column: str = MONTH_COLUMN) -> str:
    """The wide table partitioned by purchase month (rows without a date in a partition of their own).

    Rows are rebalanced by month first: Spark splits a large month over several files and puts small
    ones together in a task, so there is neither one task for a hot month nor a file a month and task."""
    (wide.hint("rebalance", column).write.mode("overwrite").option("compression", LAYER_COMPRESSION)
     .partitionBy(column).parquet(path))
    return path


def read_by_month(spark: SparkSession, path: str, column: str = MONTH_COLUMN) -> DataFrame:
    """The wide table written by month; the month is read as text."""
    schema = spark.read.option("basePath", path).parquet(path).schema
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == column else f for f in schema])
    return spark.read.schema(text).parquet(path)


def export_gold_csv(tables: dict[str, DataFrame], out_dir: str, compression: str = "none") -> dict[str, str]:
    """A06 CSV export: header, KPI tables sorted by ``orders_count`` descending (the file order
    is the only place a sort is kept)."""
    def export(name: str, df: DataFrame) -> str:
        if "orders_count" in df.columns:
            df = df.orderBy(F.col("orders_count").desc())
        return write_csv(df, f"{out_dir.rstrip('/')}/{GOLD_TABLES.get(name, name + '.csv')}", compression=compression)

    return run_concurrently({name: (lambda name=name, df=df: export(name, df)) for name, df in tables.items()})


# --- A09 -------------------------------------------------------------------------------------------

def load_orders_with_fallback(spark: SparkSession, readers: list[tuple[str, callable]]
                              ) -> tuple[DataFrame, str, str | None, list[str]]:
    """The first reader that works, in order (e.g. database, deployed CSV, latest Gold).

    Each reader is ``(label, fn)``; ``fn()`` returns a DataFrame or ``(DataFrame, batch id)``. One row
    is read inside the ``try`` so that a source that is missing or can't be read fails here. Returns
    (data, source label, batch id or None, the whole error texts of the sources tried before)."""
    errors = []
    for label, fn in readers:
        try:
            got = fn()
            df, batch = got if isinstance(got, tuple) else (got, None)
            df.head(1)  # reads a row: a source that is there but can't be read fails here
            return df, label, batch, errors
        except Exception as e:  # noqa: BLE001 - try the next source
            errors.append(f"{label}: {type(e).__name__}: {e}")
    raise RuntimeError("no data source available: " + " | ".join(errors))


def latest_gold_reader(spark: SparkSession, root: str, table: str = "orders_enriched"):
    """Reader for ``load_orders_with_fallback``: the latest Gold snapshot and its batch id."""
    def read():
        batch = latest_batch(spark, root, "gold", [table])
        return read_layer(spark, root, "gold", table, batch).drop("batch_id"), batch
    return read
