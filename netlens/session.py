"""Spark session helpers.

The library never creates data on the driver; it only needs a session with
sensible shuffle settings and a *shared* checkpoint folder for the iterative
path operators.  On a cluster ``spark.checkpoint.dir`` is set by the platform
and must be used as-is; a private folder is only picked where it is unset and
the master is ``local`` (tests); any other master without it is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "netlens") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# shuffle partitions that the writing of a large table starts with (above 200 a map task would hold its whole
# output in memory); AQE puts small ones together, up to this size
LARGE_TABLE_PARTITIONS = 200
LARGE_TABLE_PARTITION_MB = 24
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def materialize(df, name: str = "t", large: bool = False):
    """Cut lineage by writing ``df`` as a Parquet table under the shared
    checkpoint folder and reading it back.  One computation (a reliable RDD
    checkpoint computes its input twice unless cached), columnar re-reads
    with pruning and pushdown, and the files outlive any executor.

    With ``large`` its shuffles start with at least ``LARGE_TABLE_PARTITIONS`` partitions, put together
    up to ``LARGE_TABLE_PARTITION_MB``, so that the sorts and aggregates of a task stay in memory where
    the session's own number is that of a small cluster's cores."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/tables/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in (_INITIAL_PARTITIONS, _ADVISORY_SIZE)} if large else {}
    if large:
        most = max(LARGE_TABLE_PARTITIONS, int(before[_INITIAL_PARTITIONS] or 0),
                   int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.conf.set(_INITIAL_PARTITIONS, str(most))
        spark.conf.set(_ADVISORY_SIZE, _smaller(before[_ADVISORY_SIZE], LARGE_TABLE_PARTITION_MB))
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.parquet(path)


_UNITS = {"b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40, "p": 2**50}


def _smaller(size: str | None, mb: int) -> str:
    """The smaller of a size as Spark's settings give it (``64m``, ``8MB``, bytes) and a number of MB, in bytes."""
    found = re.fullmatch(r"(\d+)([bkmgtp]?)b?", (size or "").strip().lower())
    own = int(found[1]) * _UNITS[found[2] or "b"] if found else mb * 2**20
    return f"{min(own, mb * 2**20)}b"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a private one only if
    the session has none (tests).  Never a machine-local folder on a cluster:
    the cluster config names a shared one and we keep it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="netlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
