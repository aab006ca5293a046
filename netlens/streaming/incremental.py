"""Incremental topology ingestion with Structured Streaming.

The service being replaced re-reads "today's" discoveries on a schedule and
upserts them (S3 + U2).  Here new discovery files are a streaming source; each
micro-batch is merged into the stored edge snapshot with the batch merge
operator and written as a new snapshot version:

    files (link rows) --readStream--> foreachBatch(merge_edges) --> snapshot/v=<batch>

* replay: the sink folder is keyed by ``batch_id``, and a batch reads the newest
  complete version *before* its own.  A batch that is replayed, because it ended
  before its commit was recorded, computes its version again from the same input
  and overwrites it; it never reads what it overwrites.
* the snapshot is read back from storage for every batch (never kept on the
  driver); lineage is cut by the write itself.
* with ``buckets`` the snapshot is a ``VersionedTable``: a batch rewrites only the parts (relation and
  key bucket) that its links fall into, however large the rest is.
* late / repeated discoveries of one edge within a batch are reduced by the
  merge's per-key ``max_by`` (last discovery wins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.expr import link_type_key
from ..operators.merge import merge_edges
from ..schema import EDGE_KEY
from ..sources.versions import VersionedTable


def latest_version(spark: SparkSession, snapshot_root: str, before: int | None = None) -> str | None:
    """Path of the newest complete snapshot version under ``snapshot_root``,
    below ``before`` if given (listing through the Hadoop file system of the
    session; no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(snapshot_root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return None
    versions = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            versions.append(int(name[2:]))
    versions = [v for v in versions if before is None or v < before]
    return f"{snapshot_root}/v={max(versions)}" if versions else None


def write_version(spark: SparkSession, batch: DataFrame, batch_id: int, snapshot_root: str,
                  initial: DataFrame, vertices: DataFrame, run_ts: str, order: list[str]) -> None:
    """Merge one micro-batch into the newest earlier version and write its own."""
    cur = latest_version(spark, snapshot_root, before=batch_id)
    snap = spark.read.schema(initial.schema).parquet(cur) if cur else initial
    merged, _ = merge_edges(snap, batch, vertices, run_ts, order=order)
    merged.write.mode("overwrite").parquet(f"{snapshot_root}/v={batch_id}")


def merge_parts(table: VersionedTable, batch: DataFrame, version: int, vertices: DataFrame, run_ts: str,
                order: list[str]) -> list[tuple[str, int]]:
    """U2 on the parts of a stored edge table that a batch touches; returns them."""
    batch = batch.withColumn("link_type_key", link_type_key())
    return table.merge(batch, version, lambda stored, rows: merge_edges(stored, rows, vertices, run_ts, order=order)[0])


def start_edge_merge_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                            vertices: DataFrame, snapshot_root: str, checkpoint_dir: str,
                            initial: DataFrame, run_ts: str, order: list[str],
                            available_now: bool = True, files_per_batch: int | None = None,
                            buckets: int | None = None):
    """Start the streaming merge.  ``initial`` is the edge snapshot used when
    no version exists yet (it fixes the snapshot schema).  With ``buckets`` the snapshot is kept in
    parts, and ``initial`` becomes its version -1."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)
    parts = buckets and VersionedTable(spark, snapshot_root, EDGE_KEY, initial.schema, buckets)
    if parts and not parts.versions():
        parts.merge(initial, -1, lambda _, rows: rows)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if parts:
            merge_parts(parts, batch, batch_id, vertices, run_ts, order)
        else:
            write_version(spark, batch, batch_id, snapshot_root, initial, vertices, run_ts, order)

    w = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
