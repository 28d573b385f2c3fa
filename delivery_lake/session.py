"""Spark session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

def build_session(master: str | None = None, app_name: str = "delivery_lake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs. On a cluster pass ``master=None`` and let
    spark-submit decide; only missing settings are filled in."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written layers.

    On a cluster this is ``spark.checkpoint.dir`` as configured for the application (a shared
    file system). Only in a local session where it is unset (tests) a fresh local folder is created
    and registered, so that every later call agrees on it; on a cluster a missing setting raises, as
    other machines would not see this one's folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="delivery-lake-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique sub-folder of the checkpoint root for one run of one job."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


# Spark's setting that a query's shuffle files go when it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin and end in here leave no shuffle files behind: for tables that are written once and read
    as written from then on. Else the files stay until the driver's garbage collection finds the plan unused."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
