"""Exact document de-duplication by progressive refinement (built-in functions only).

1. group by length;
2. among lengths that occur twice or more, group by (length, hash of a prefix);
3. among those groups, hash the full text and group by it.

What one step found is handed to the next as a bit table of fixed size
(``common.bit_table``), broadcast to the scan.  So a text is never shuffled: it is
tested where it is read, and its full hash is computed only if its length and
prefix occur elsewhere.  Only (id, length, digest) rows move.  A group of any size
is reduced map-side; the join that brings its result back to its rows is over
narrow rows, which adaptive execution can split.

Defined results: null text counts as empty, so null and empty texts are one group.
Of equal texts the largest id stays; null ids are smaller than any id, and a group
of null ids only keeps a null.  Rows with the same id and text are each other's
copies: all of them are counted in ``group_size`` and all carry ``kept`` of that id.
Only the id, the text and ``carry`` are read, so further columns cannot clash.  An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_table, flag_members, stored, text_of


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 128, carry: Sequence[Column] = ()) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, keep_id, group_size, kept, then ``carry``.

    ``carry`` are aliased columns over ``docs`` that travel with the row (keep them
    narrow; a text put here would be shuffled).
    """
    text = text_of(text_col)
    size = F.octet_length(text)
    lengths = docs.select(size.cast("long").alias("__n"))
    repeated = (lengths.groupBy("__n").count().filter("count > 1")
                .select(F.xxhash64("__n").alias("__key")))

    by_length = flag_members(docs.select(size.cast("long").alias("__n"), text.alias("__t"),
                                         F.xxhash64(size.cast("long")).alias("__k")),
                             "__k", bit_table(repeated, "__key"), "__maybe")
    repeated = (by_length.filter("__maybe")
                .select(F.xxhash64("__n", F.substring("__t", 1, prefix_chars)).alias("__p"))
                .groupBy("__p").count().filter("count > 1").select(F.col("__p").alias("__key")))

    extra = [c.alias(f"__c{i}") for i, c in enumerate(carry)]
    names = [docs.select(c).columns[0] for c in carry]
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__t"),
                       F.xxhash64(size.cast("long"),
                                  F.substring(text, 1, prefix_chars)).alias("__k"), *extra)
    kept_cols = ["__id", *[f"__c{i}" for i in range(len(extra))]]
    rows = stored(flag_members(rows, "__k", bit_table(repeated, "__key"), "__maybe")
                  .select(*kept_cols,
                          F.expr("if(__maybe, sha2(__t, 256), null)").alias("__full")),
                  "exact_dedup")

    # a table of its own, so that the join below deals both sides anew and a large group's
    # partition can be split
    groups = stored(rows.filter("__full is not null").groupBy("__full")
                    .agg(F.max("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
                    "exact_groups")
    shared = rows.filter("__full is not null").join(groups, "__full")
    alone = (rows.filter("__full is null")
             .withColumns({"keep_id": F.col("__id"), "group_size": F.lit(1).cast("long")}))
    both = shared.drop("__full").unionByName(alone.drop("__full"))
    return both.select(F.col("__id").alias(id_col), "keep_id", "group_size",
                       F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       *[F.col(f"__c{i}").alias(n) for i, n in enumerate(names)])
