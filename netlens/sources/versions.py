"""Stored tables in versions, of which a merge rewrites only the parts it touches.

A table is split by (relation, bucket of the key's hash).  Version ``n`` is a folder ``v=n`` that holds
only the parts written by it, and a small manifest, ``manifest/v=n``, that names for every part the version
which holds its newest rows.  A merge

1. finds the parts that the batch's keys fall into (at most relations x buckets rows),
2. reads those parts of the version before, merges, and writes them under ``v=n``,
3. writes the manifest: the parts of the version before, with the touched ones replaced.

The manifest is the commit: readers follow it, so a merge that is lost half-way is not seen, and one that is
repeated reads the version before its own and writes the same again.  Files of untouched parts stay where they
are, whatever the size of the table, and earlier versions can still be read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RELATION, BUCKET = "__relation", "__bucket"


class VersionedTable:
    """A table under ``root`` whose rows have a ``relation`` and the given key; ``buckets`` is part of its
    layout and must stay the same."""

    def __init__(self, spark: SparkSession, root: str, key: list[str], schema, buckets: int = 64):
        self.spark, self.root, self.schema, self.buckets = spark, root.rstrip("/"), schema, buckets
        self._hashed = [c for c in key if c != "relation"]

    def _part(self) -> list[Column]:
        relation = F.concat(F.lit("_"), F.coalesce("relation", F.lit("")))  # an empty folder name would read as null
        hashed = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in self._hashed])
        return [relation.alias(RELATION), F.pmod(hashed, F.lit(self.buckets)).cast("int").alias(BUCKET)]

    def versions(self) -> list[int]:
        """The committed versions, oldest first."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            return []
        found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v=")]
        return sorted(int(p.getName()[2:]) for p in found
                      if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def manifest(self, version: int) -> DataFrame:
        """(__relation, __bucket, version): one row a part."""
        return self.spark.read.parquet(f"{self.root}/manifest/v={version}")

    def read(self, version: int | None = None, parts: list | None = None) -> DataFrame:
        """The rows of a version (the newest if None), or of some of its parts only."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else None)
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        at: dict[int, dict[str, list[int]]] = {}
        wanted = None if parts is None else {(r, b) for r, b in parts}
        for row in self.manifest(version).collect():  # at most relations x buckets rows
            if wanted is None or (row[RELATION], row[BUCKET]) in wanted:
                at.setdefault(row["version"], {}).setdefault(row[RELATION], []).append(row[BUCKET])
        out = self.spark.createDataFrame([], self.schema)
        for v, relations in sorted(at.items()):
            rows = (self.spark.read.schema(f"{self._ddl()}, {RELATION} string, {BUCKET} int")
                    .parquet(f"{self.root}/v={v}"))
            keep = None
            for relation, buckets in sorted(relations.items()):
                here = (F.col(RELATION) == relation) & F.col(BUCKET).isin(buckets)
                keep = here if keep is None else keep | here
            out = out.unionByName(rows.filter(keep).drop(RELATION, BUCKET))  # a partition filter
        return out

    def _ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)

    def merge(self, batch: DataFrame, version: int,
              merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[tuple[str, int]]:
        """Write ``version``: ``merge(stored rows, batch)`` for the parts that ``batch`` touches, all others as
        in the newest version before it.  Returns the touched parts."""
        before = [v for v in self.versions() if v < version]
        touched = [(r[RELATION], r[BUCKET]) for r in
                   batch.select(*self._part()).distinct().collect()]  # at most relations x buckets rows
        stored = self.read(before[-1], touched) if before else self.spark.createDataFrame([], self.schema)
        made = merge(stored, batch).select(*[f.name for f in self.schema.fields])
        path = f"{self.root}/v={version}"
        # one shuffle by part, so that a part is a few files however many tasks merged it
        (made.withColumns({c: x for c, x in zip((RELATION, BUCKET), self._part(), strict=True)})
         .repartition(RELATION, BUCKET).write.mode("overwrite").partitionBy(RELATION, BUCKET).parquet(path))
        written = (self.spark.read.schema(f"{self._ddl()}, {RELATION} string, {BUCKET} int").parquet(path)
                   .select(RELATION, BUCKET).distinct().withColumn("version", F.lit(version)))
        gone = self.spark.createDataFrame(touched, f"{RELATION} string, {BUCKET} int")
        old = (self.manifest(before[-1]).join(gone, [RELATION, BUCKET], "left_anti") if before
               else written.limit(0))
        old.unionByName(written).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v={version}")
        return touched
