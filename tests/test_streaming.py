"""Streaming incremental merge equals the sequential batch merges."""

import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from netlens import schema as S
from netlens.operators.merge import merge_edges
from netlens.sources.versions import VersionedTable
from netlens.streaming.incremental import latest_version, merge_parts, start_edge_merge_stream, write_version

ORDER = ["last_discovery_ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
TS = "2002-01-01 00:00:00"


def test_stream_merge_matches_batch(fx, spark):
    rows = (fx.link_rows().withColumn("link_count", F.lit(1).cast("long"))
            .withColumn("status", F.lit("ACTIVE")).withColumn("is_deleted", F.lit(False)))
    d1 = F.lit("1996-01-01").cast("timestamp_ntz")
    d2 = F.lit("1999-01-01").cast("timestamp_ntz")
    initial = fx.edges(fx.link_rows().filter(F.col("last_discovery_ts") < d1))
    chunk1 = rows.filter((F.col("last_discovery_ts") >= d1) & (F.col("last_discovery_ts") < d2))
    chunk2 = rows.filter(F.col("last_discovery_ts") >= d2)
    live = fx.vertices().filter(~F.col("is_deleted"))

    root = tempfile.mkdtemp(prefix="netlens-stream-")
    src = f"{root}/incoming"
    chunk1.coalesce(1).write.parquet(f"{src}/b1")
    chunk2.coalesce(1).write.mode("append").parquet(f"{src}/b1")
    q = start_edge_merge_stream(spark, f"{src}/b1", chunk1.schema, live, f"{root}/snapshot",
                                f"{root}/ckpt", initial, TS, ORDER, files_per_batch=1)
    q.awaitTermination(300)
    got = spark.read.parquet(latest_version(spark, f"{root}/snapshot"))

    a, _ = merge_edges(initial, chunk1, live, TS, order=ORDER)
    want, _ = merge_edges(a, chunk2, live, TS, order=ORDER)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_replayed_batch_gives_the_same_version(fx, spark):
    rows = (fx.link_rows().withColumn("link_count", F.lit(1).cast("long"))
            .withColumn("status", F.lit("ACTIVE")).withColumn("is_deleted", F.lit(False)))
    day = F.lit("1998-01-01").cast("timestamp_ntz")
    initial = fx.edges(fx.link_rows().filter(F.col("last_discovery_ts") < day))
    batch, live = rows.filter(F.col("last_discovery_ts") >= day), fx.vertices().filter(~F.col("is_deleted"))
    root = tempfile.mkdtemp(prefix="netlens-replay-")
    first = batch.filter("l_orderkey % 2 = 0")
    write_version(spark, first, 0, root, initial, live, TS, ORDER)
    write_version(spark, batch, 1, root, initial, live, TS, ORDER)
    want = spark.read.parquet(f"{root}/v=1").collect()
    write_version(spark, batch, 1, root, initial, live, TS, ORDER)  # the commit was lost
    assert latest_version(spark, root).endswith("v=1")
    assert sorted(map(str, spark.read.parquet(f"{root}/v=1").collect())) == sorted(map(str, want))


def _parts(root):
    return {p.relative_to(root).as_posix(): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")
            if "manifest" not in p.as_posix()}


def test_a_small_batch_rewrites_only_the_parts_it_touches(fx, spark):
    rows = (fx.link_rows().withColumn("link_count", F.lit(1).cast("long"))
            .withColumn("status", F.lit("ACTIVE")).withColumn("is_deleted", F.lit(False)))
    day = F.lit("1998-01-01").cast("timestamp_ntz")
    initial = fx.edges(fx.link_rows().filter(F.col("last_discovery_ts") < day))
    later, live = rows.filter(F.col("last_discovery_ts") >= day), fx.vertices().filter(~F.col("is_deleted"))
    root = tempfile.mkdtemp(prefix="netlens-parts-")
    table = VersionedTable(spark, root, S.EDGE_KEY, initial.schema, buckets=8)
    table.merge(initial, 0, lambda _, new: new)
    assert table.read().exceptAll(initial).count() == 0 and table.read().count() == initial.count()
    before = _parts(root)
    small = later.filter("l_orderkey < 300 and relation = 'LLDP'").limit(3)
    batch = spark.createDataFrame(small.collect(), small.schema)
    touched = merge_parts(table, batch, 1, live, TS, ORDER)
    assert 0 < len(touched) <= 3 and len({b for _, b in touched}) < 8
    after = _parts(root)
    assert {p: after[p] for p in before} == before  # no file of the first version was written again
    assert len({p.split("/")[1:3][0] + p.split("/")[2] for p in after if p.startswith("v=1/")}) == len(touched)
    want, _ = merge_edges(initial, batch, live, TS, order=ORDER)
    assert table.read().exceptAll(want).count() == 0 and table.read().count() == want.count()
    again = merge_parts(table, batch, 1, live, TS, ORDER)  # the commit was lost
    assert sorted(again) == sorted(touched) and table.read().exceptAll(want).count() == 0
    assert table.read(0).exceptAll(initial).count() == 0  # the version before is still there
    merge_parts(table, later, 2, live, TS, ORDER)
    all_, _ = merge_edges(want, later, live, TS, order=ORDER)
    assert table.read().exceptAll(all_).count() == 0 and table.read().count() == all_.count()


def test_stream_into_parts(fx, spark):
    rows = (fx.link_rows().withColumn("link_count", F.lit(1).cast("long"))
            .withColumn("status", F.lit("ACTIVE")).withColumn("is_deleted", F.lit(False)))
    day = F.lit("1998-01-01").cast("timestamp_ntz")
    initial = fx.edges(fx.link_rows().filter(F.col("last_discovery_ts") < day))
    batch, live = rows.filter(F.col("last_discovery_ts") >= day), fx.vertices().filter(~F.col("is_deleted"))
    root = tempfile.mkdtemp(prefix="netlens-parts-stream-")
    batch.coalesce(1).write.parquet(f"{root}/in")
    q = start_edge_merge_stream(spark, f"{root}/in", batch.schema, live, f"{root}/snapshot", f"{root}/ckpt",
                                initial, TS, ORDER, buckets=4)
    q.awaitTermination(300)
    got = VersionedTable(spark, f"{root}/snapshot", S.EDGE_KEY, initial.schema, buckets=4).read()
    want, _ = merge_edges(initial, batch, live, TS, order=ORDER)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
