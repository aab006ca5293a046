"""Line de-duplication by a suffix array over line sequences (built-in functions only).

A document is a sequence of lines (blank lines belong to the line before them).  The
suffixes of all sequences are ranked by distributed prefix doubling: round 0 ranks
positions by their line, round ``k`` by the pair of ranks at the position and
``2^(k-1)`` lines on, so equal ranks mean equal runs of ``2^k`` lines and ranks are in
suffix order.  Only positions whose run occurs twice or more go on to the next round:
a longer run that repeats starts where a shorter one does.  The rounds end when no
run repeats, which is after the logarithm of the longest repeated run, not at a limit.

The positions of one rank are the longest-common-prefix interval of depth ``2^k``.
All of them but the first, by (id, text hash, line), start a later copy.  Neighbouring
starts of one depth join into one stretch of lines, and the stretches of all depths
together are the maximal repeated runs: a run of any length is the union of its two
blocks of the largest power of two.  A run counts if it has two lines or more, or is
one line of at least ``min_chars`` characters.  Its later copies are deleted.

Every round is a window within a document (a shift), an aggregate by rank pair that
reduces map-side, a range sort of the distinct pairs and a join, all over rows of a
few longs; a line that a third of the documents hold is one row in the sort, and the
join's large side can be split.  Each round is a table in the checkpoint folder.

Defined results: null text counts as empty, and stays as it is if nothing is deleted.
A text all of whose lines are later copies becomes empty; no row is dropped.  Lines
are compared without the white space around them.  A repeat within one document goes
like any other.  Rows equal in id and text are one document: what stays in one stays
in all.  Extra columns are kept; internal names start with two underscores, and an
output that has the name of a column replaces it.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of

MIN_CHARS = 10
SPACES = " \t\r\n\f\v"


def lines_of(text: Column) -> Column:
    """The lines of a text, each with the blank lines behind it."""
    return F.split(text, r"\n(?=[^\n]*\S)")


def _place() -> Column:
    return F.struct("__d", "__h", "__i")


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of keys ``by`` that occur twice or more, with the key's rank (``__r``, in key
    order) and whether an earlier row has the key (``__later``)."""
    keys = (rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.min(_place()).alias("__first"))
            .filter("__n > 1").drop("__n")
            .repartitionByRange(*by).sortWithinPartitions(*by)
            # ranges are in order, so the row number within a range behind the range's
            # number is, too; the table below fixes it
            .withColumn("__r", F.monotonically_increasing_id()))
    keys = stored(keys, "line_ranks")
    return (rows.join(keys, by).withColumn("__later", ~_place().eqNullSafe(F.col("__first")))
            .drop("__first", *by))


def _stretches(later: DataFrame, size: int) -> DataFrame:
    """(__d, __h, __from, __to): neighbouring starts of blocks of ``size`` lines, joined."""
    at = Window.partitionBy("__d", "__h").orderBy("__i")
    return (later.select("__d", "__h", "__i").distinct()
            .withColumn("__g", F.col("__i") - F.row_number().over(at))
            .groupBy("__d", "__h", "__g")
            .agg(F.min("__i").alias("__from"), (F.max("__i") + size - 1).alias("__to"))
            .drop("__g"))


def suffix_rounds(lines: DataFrame) -> list[DataFrame]:
    """Round ``k``: (__d, __h, __i, __r, __later), the positions whose run of ``2^k`` lines
    repeats.  Round 0 also has ``__chars``.  ``lines``: (__d, __h, __i, __line, __chars)."""
    rounds = [stored(_ranked(lines, ["__line"]), "line_round")]
    while not rounds[-1].isEmpty():
        shift = 1 << (len(rounds) - 1)
        ahead = (Window.partitionBy("__d", "__h").orderBy("__i").rangeBetween(shift, shift))
        pairs = (rounds[-1].select("__d", "__h", "__i", F.col("__r").alias("__r1"),
                                   F.min("__r").over(ahead).alias("__r2"))
                 .filter("__r2 is not null"))
        rounds.append(stored(_ranked(pairs, ["__r1", "__r2"]), "line_round"))
    return rounds[:-1]


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(__d, __h, __from, __to): stretches of lines, by number, that are later copies."""
    text = text_of(text_col)
    split = docs.select(F.col(id_col).alias("__d"), F.xxhash64(text).alias("__h"),
                        F.posexplode(lines_of(text)).alias("__i", "__l"))
    line = F.btrim("__l", F.lit(SPACES))
    lines = stored(split.select("__d", "__h", "__i", F.unhex(F.md5(line)).alias("__line"),
                                F.char_length(line).alias("__chars"))
                   .filter("__chars > 0"), "lines")
    out = None
    for k, r in enumerate(suffix_rounds(lines)):
        later = r.filter(F.col("__later"))
        found = _stretches(later.filter(F.col("__chars") >= min_chars) if k == 0 else later, 1 << k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return lines.select("__d", "__h", F.col("__i").alias("__from"), F.col("__i").alias("__to"))
    return out


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the later copies of repeated line runs in ``text_col``, with
    ``n_lines`` (before) and ``n_removed``."""
    runs = (repeated_runs(docs, id_col, text_col, min_chars).groupBy("__d", "__h")
            .agg(F.collect_list(F.struct("__from", "__to")).alias("__runs")))  # one document's
    rest = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    text = text_of(text_col)
    gone = F.expr("array_distinct(flatten(transform(coalesce(__runs, array()),"
                  " r -> sequence(r.__from, r.__to))))")
    joined = (docs.select(F.struct(*[F.col(c) for c in rest]).alias("__doc"),  # names cannot clash
                          F.col(id_col).alias("__id"), F.xxhash64(text).alias("__t"))
              .join(runs, F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__t") == F.col("__h")),
                    "left")
              .select("__doc", gone.alias("__gone"),
                      lines_of(text_of(f"__doc.{text_col}")).alias("__lines")))
    left = F.expr("array_join(transform(array_except(sequence(0, size(__lines) - 1), __gone),"
                  " i -> __lines[i]), '\n')")
    kept = [F.col("__doc").getField(c) for c in rest]
    return joined.select(*[(F.when(F.size("__gone") > 0, left).otherwise(k) if c == text_col else k)
                           .alias(c) for c, k in zip(rest, kept, strict=True)],
                         F.size("__lines").cast("long").alias("n_lines"),
                         F.size("__gone").cast("long").alias("n_removed"))
