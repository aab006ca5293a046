"""Target-distribution importance resampling with segment de-duplication.

A text's features are its runs of 1 to ``max_run`` consecutive words, each put into a
bucket by the crc32 of its UTF-8 bytes.  A bucket's gain is the logarithm of how much
more often the target's features fall into it than the corpus's; a text's weight is the
sum of its features' gains.  Gumbel noise drawn from the id is added to the weight, and
the highest scores are drawn: a sample without replacement whose chances follow the
weights.

The separator newline cuts texts into lines, and no word crosses it.

1. Lines are grouped over the whole corpus; the features within a line are made and
   counted once for each distinct line and multiplied by its occurrences.
2. Runs that cross lines are added separately, from the first and last words of
   the lines (with ``max_run`` 1 there are none, and that pass is left out).
3. Weights are added up line by line too: a batch works a distinct line out once.

Counts by bucket are the only thing that reaches the driver (``buckets`` numbers for
corpus and target each).  The draw needs ranks over all documents: narrow rows are
range-partitioned by score, partitions are counted, and ranks within the partitions
that hold drawn rows are shifted by the rows before them, so no task sorts everything.

Defined results: null and empty texts have no words, no features and weight 0.  Very
long texts cost their lines.  Ties of score go to the smaller id; null ids come last and
hash as the empty text, and rows of one id and score go by features, further ones in
any order.  Repeated rows count, and may be drawn, each for itself.  Only id and text are
read, so other columns, whatever their names, do not matter.  An empty corpus gives no
rows; an empty target gives gains that favour rare features.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of

BUCKETS, MAX_RUN, MIN_WORDS, PERCENT, SEED = 10000, 1, 20, 10, 2024
REMEMBERED = 1 << 19  # features whose buckets a task remembers
LINE_BYTES = 1 << 24  # bytes of lines whose sums a task remembers

_UPPER = bytes(range(65, 91))
_KEPT = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_FOLD = bytes(c + 32 if c in _UPPER else c if c in _KEPT else 32 for c in range(256))


def words_of(line: bytes) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and all characters beyond ASCII."""
    return line.translate(_FOLD).split()


class _Buckets(dict):
    """Feature -> bucket."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[feature] = at = crc32(feature) % self.buckets
        return at


def _runs(words: list[bytes], max_run: int) -> list[bytes]:
    out = list(words)
    for size in range(2, max_run + 1):
        out += [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
    return out


def _crossing(lines: list[list[bytes]], max_run: int) -> list[bytes]:
    """The runs that lie on more than one line; of a long line only its ends can be in one."""
    reach, words, line_of = max_run - 1, [], []
    for k, line in enumerate(lines):
        ends = line if len(line) <= 2 * reach else [*line[:reach], None, *line[-reach:]]
        words += ends
        line_of += [k] * len(ends)
    out = []
    for size in range(2, max_run + 1):
        for i in range(len(words) - size + 1):
            run = words[i:i + size]
            if line_of[i] != line_of[i + size - 1] and None not in run:
                out.append(b" ".join(run))
    return out


def _bucket_rows(total: np.ndarray):
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])],
                                      ["bucket", "n"])


def bucket_counts(docs: DataFrame, text_col: str = "text", max_run: int = MAX_RUN,
                  buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket (``buckets`` numbers)."""
    texts = docs.select(text_of(text_col).alias("text"))
    lines = (texts.select(F.explode(F.split("text", "\n", -1)).alias("line"))
             .groupBy("line").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("line").cast("binary").alias("line"), "n"))

    def within(batches):
        total, bucket = np.zeros(buckets, np.int64), _Buckets(buckets)
        for b in batches:
            found, sizes = [], []
            for line in b.column(0).to_pylist():
                runs = _runs(words_of(line), max_run)
                found += map(bucket.__getitem__, runs)
                sizes.append(len(runs))
            times = np.repeat(b.column(1).to_numpy(), sizes)
            np.add.at(total, np.array(found, np.int64), times)
        yield _bucket_rows(total)

    def across(batches):
        total, bucket = np.zeros(buckets, np.int64), _Buckets(buckets)
        for b in batches:
            for text in b.column(0).to_pylist():
                lines = [words_of(x) for x in text.encode().split(b"\n")]
                for run in _crossing(lines, max_run):
                    total[bucket[run]] += 1
        yield _bucket_rows(total)

    counts = lines.mapInArrow(within, "bucket int, n long")
    if max_run > 1:
        counts = counts.unionByName(texts.mapInArrow(across, "bucket int, n long"))
    out = np.zeros(buckets, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets``
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down, by bucket."""
    m, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(
        (float(t) + 1) * (float(s_all) + m) / ((float(s) + 1) * (float(t_all) + m))))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def text_weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id",
                 text_col: str = "text", max_run: int = MAX_RUN) -> DataFrame:
    """(id_col, n_words, n_features, weight) of every row; nothing is shuffled."""
    texts = docs.select(F.col(id_col).alias("__id"), text_of(text_col).cast("binary").alias("__t"))
    kind = texts.schema["__id"].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast(gains)

    def run(batches):
        gain, bucket = shared.value.tolist(), _Buckets(len(shared.value))
        known: dict[bytes, tuple[int, int, int]] = {}
        size = 0

        def line_sums(line):
            words = words_of(line)
            runs = _runs(words, max_run)
            return len(words), len(runs), sum([gain[bucket[r]] for r in runs])

        for b in batches:
            sums: list[list[int]] = [[], [], []]
            for text in b.column(1).to_pylist():
                of_text = [0, 0, 0]
                lines = text.split(b"\n")
                for line in lines:
                    if (made := known.get(line)) is None:
                        known[line] = made = line_sums(line)
                        size += len(line)
                    for k in range(3):
                        of_text[k] += made[k]
                if max_run > 1:
                    crossing = _crossing([words_of(x) for x in lines], max_run)
                    of_text[1] += len(crossing)
                    of_text[2] += sum([gain[bucket[r]] for r in crossing])
                for k in range(3):
                    sums[k].append(of_text[k])
                if size > LINE_BYTES:
                    known.clear()
                    size = 0
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(s, pa.int64()) for s in sums)],
                [id_col, "n_words", "n_features", "weight"])

    return texts.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_features long, weight long")


def with_score(weights: DataFrame, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """``weights`` with ``score``: the weight and thousandths of the id's Gumbel noise."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weights.withColumn("score", F.col("weight") + noise.cast("long"))


def draw(scored: DataFrame, id_col: str = "doc_id", min_words: int = MIN_WORDS,
         percent: int = PERCENT) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the highest scores, ``percent`` of the rows
    with ``min_words`` words or more; null for the rest."""
    scored = stored(scored, "resample_scores")
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("n_features").desc(),
             F.col("__tie").asc()]
    ranges = stored(scored.filter(F.col("n_words") >= min_words)
                    .withColumn("__tie", F.monotonically_increasing_id())
                    .repartitionByRange(*order)
                    .withColumn("__part", F.spark_partition_id()), "resample_ranges")
    before = (ranges.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
              .withColumn("__before", F.expr(  # one row a partition
                  "sum(__rows) over (order by __part rows unbounded preceding) - __rows")))
    sizes = before.collect()
    quota = percent * sum(r["__rows"] for r in sizes) // 100
    first_out = min((r["__part"] for r in sizes if r["__before"] >= quota), default=None)
    inside = ranges if first_out is None else ranges.filter(F.col("__part") < first_out)
    ranked = (inside.join(F.broadcast(before.drop("__rows")), "__part")
              .withColumn("rank", F.row_number().over(
                  Window.partitionBy("__part").orderBy(*order)).cast("long") + F.col("__before"))
              .withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank"))))
    out = [*scored.columns, "rank"]
    none = F.lit(None).cast("long")
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", none)
    result = ranked.select(*out).unionByName(rest.select(*out))
    if first_out is not None:
        result = result.unionByName(ranges.filter(F.col("__part") >= first_out)
                                    .withColumn("rank", none).select(*out))
    return result


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", max_run: int = MAX_RUN, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(id_col, n_words, n_features, weight, score, rank) of every row of ``docs``."""
    gains = bucket_gains(bucket_counts(docs, text_col, max_run, buckets),
                         bucket_counts(target, target_text_col, max_run, buckets))
    weights = text_weights(docs, gains, id_col, text_col, max_run)
    return draw(with_score(weights, id_col, seed), id_col, min_words, percent)
