"""Substring de-duplication by sliding sentence spans.

A text is cut into sentences (after ``.``, ``!`` or ``?`` before white space, and at
line ends), and a sentence of more than 50 characters into parts of over 24, after
``,``, ``;`` or ``:`` and after words of eight characters or more.  So a passage that
begins and ends anywhere in other sentences is cut alike wherever it stands, but for its
first part; "sentences" below are these parts.  A span is a shortest run of consecutive sentences, from a sentence
onwards or back from one, that holds at least ``min_sentences`` sentences and
``min_words`` words, or ``long_words`` words however few its sentences.  Taking the
shortest runs in both directions is enough: every longer repeated run is the union of
the ones inside it, and all of them repeat with it.  Spans are compared by the hash
of their lower-cased words.

1. All spans' hashes are counted (combined within each batch, then by Spark); those
   that occur twice or more set bits in a table of 16 bits a hash, 64 MB at most, which
   is broadcast.  Where it is full, more places go into the join of the next step.
2. A second pass over the texts keeps the spans that hit the table, now with a
   128-bit hash and their place.  The first place of each hash, by (id, text hash,
   sentence), is joined back; every other occurrence marks its sentences.
3. The marked sentences are cut out of the texts.  Only texts whose hash is in the bit
   table of the marked ones are shuffled.

Nothing is paired within a group, so a span that a third of the documents share
costs a row an occurrence.

Defined results: null text counts as empty and gives an empty text.  A repeat within
one document goes like any other, unless ``within`` is false: then a span is a copy only
outside the document of its first place.  Very long texts are one row of work, in
proportion to their length.  Rows equal in id and text are one document: what
stays in one stays in all of them.  Ties cannot occur, as places are distinct.  Only
id and text are read, so further columns cannot clash.  An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_array, bit_table, bits_for, flag_members, probe, stored, text_of

MIN_SENTENCES, MIN_WORDS, LONG_WORDS = 3, 25, 50
MAX_BITS, MARK_BITS = 1 << 29, 1 << 25  # ceilings of the bit tables: 64 MB and 4 MB
BREAK = re.compile(r"[.!?\n](?:(?<=\n)|[.!?]*(?=\s))\s*")
PART, LONG_SENTENCE, SHORT_PART = re.compile(r"(?:[,;:]|\S{8})\s+"), 50, 24


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence, or part of a long one, with the white space behind it;
    together the text."""
    ends, at = [], 0
    for end in [*[m.end() for m in BREAK.finditer(text)], len(text)]:
        while end - at > LONG_SENTENCE and (m := PART.search(text, at + SHORT_PART, end)) and m.end() < end:
            at = m.end()
            ends.append(at)
        if end > at:
            ends.append(end)
        at = end
    return list(zip([0, *ends], ends, strict=False))


class Spans:
    """The spans of one text: ``runs`` of sentence numbers (first, last)."""

    def __init__(self, text: str, min_sentences: int, min_words: int, long_words: int):
        self.cuts = sentences(text)
        lower = text.lower()
        keys = ([lower[a:b].split() for a, b in self.cuts] if len(lower) == len(text) else
                [text[a:b].lower().split() for a, b in self.cuts])
        words = np.cumsum([0, *map(len, keys)])
        joined = [" ".join(k).encode() for k in keys]
        self._at = np.cumsum([0, *(len(j) + 1 for j in joined)]).tolist()
        self._bytes = b" ".join(joined)

        # from each sentence on, and back from each, the shortest run that is long enough
        n = len(keys)
        ends = np.arange(1, n + 1)
        few = np.searchsorted(words, words[1:] - min_words, side="right") - 1
        few = np.minimum(few, ends - min_sentences)
        many = np.searchsorted(words, words[1:] - long_words, side="right") - 1
        start = np.minimum(np.maximum(few, many), ends - 1)  # -1 where none is
        back = np.flatnonzero(start >= 0)
        few = np.searchsorted(words, words[:-1] + min_words, side="left") - 1
        few = np.maximum(few, np.arange(n) + min_sentences - 1)
        many = np.searchsorted(words, words[:-1] + long_words, side="left") - 1
        end = np.maximum(np.minimum(few, many), np.arange(n))
        on = np.flatnonzero(end < n)
        packed = np.unique(np.concatenate([start[back] * (n + 1) + back, on * (n + 1) + end[on]]))
        self.runs = list(zip((packed // (n + 1)).tolist(), (packed % (n + 1)).tolist(), strict=True))

    def bytes_of(self, run: tuple[int, int]) -> bytes:
        return self._bytes[self._at[run[0]]:self._at[run[1] + 1] - 1]

    def hashes(self) -> np.ndarray:
        digest, data, at = xxhash.xxh3_64_intdigest, self._bytes, self._at
        return np.array([digest(data[at[a]:at[b + 1] - 1]) for a, b in self.runs], np.uint64)


def _without(text: str, cuts: list[tuple[int, int]], gone: set[int]) -> str:
    return "".join(text[a:b] for i, (a, b) in enumerate(cuts) if i not in gone)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
                   long_words: int = LONG_WORDS, within: bool = True) -> DataFrame:
    """(__id, __h, first, last): every non-first occurrence of a span, by sentence numbers."""
    limits = (min_sentences, min_words, long_words)
    texts = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__t"))
    kind = texts.schema["__id"].dataType.simpleString()

    def count(batches):
        for b in batches:
            seen: Counter[int] = Counter()
            for t in b.column(0):
                seen.update(Spans(t.as_py(), *limits).hashes().view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()),
                                              pa.array(seen.values(), pa.int64())], ["h", "n"])

    twice = stored(texts.select("__t").mapInArrow(count, "h long, n long").groupBy("h")
                   .agg(F.sum("n").alias("n")).filter("n > 1").select("h"), "spans_twice")
    words = texts.sparkSession.sparkContext.broadcast(
        bit_array(twice, "h", bits_for(twice.count(), MAX_BITS)))

    def places(batches):
        for b in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for k, t in enumerate(b.column(2)):
                spans = Spans(t.as_py(), *limits)
                if not spans.runs:
                    continue
                for i in np.flatnonzero(probe(words.value, spans.hashes())):
                    run = spans.runs[i]
                    full = xxhash.xxh3_128_digest(spans.bytes_of(run))
                    for col, v in zip(rows, (k, None, int.from_bytes(full[:8], "big", signed=True),
                                             int.from_bytes(full[8:], "big", signed=True), *run),
                                      strict=True):
                        col.append(v)
            at = pa.array(rows[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(rows[2], pa.int64()),
                 pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int32()),
                 pa.array(rows[5], pa.int32())], ["__id", "__h", "hi", "lo", "first", "last"])

    found = stored(texts.select("__id", F.xxhash64("__t").alias("__h"), "__t").mapInArrow(
        places, f"__id {kind}, __h long, hi long, lo long, first int, last int"), "spans")
    place = F.struct("__id", "__h", "first")
    # a table of its own, so that the join below deals both sides anew and a frequent span's
    # partition can be split
    firsts = stored(found.groupBy("hi", "lo")
                    .agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").drop("n"), "span_firsts")
    same = place.eqNullSafe(F.col("origin")) if within else (
        F.col("__id").eqNullSafe(F.col("origin.__id")) & (F.col("__h") == F.col("origin.__h")))
    return (found.join(firsts, ["hi", "lo"]).filter(~same)
            .select("__id", "__h", "first", "last"))


def span_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
               long_words: int = LONG_WORDS, within: bool = True) -> DataFrame:
    """(id_col, text_col, n_sentences, n_removed) for every row of ``docs``."""
    marks = stored(repeated_spans(docs, id_col, text_col, min_sentences, min_words, long_words, within)
                   .groupBy("__id", "__h")
                   .agg(F.collect_set(F.struct("first", "last")).alias("runs"))  # a document's own
                   .select(F.col("__id").alias("__m_id"), F.col("__h").alias("__m_h"), "runs"), "span_marks")
    bits = bits_for(marks.count(), MARK_BITS)
    texts = flag_members(docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__t"))
                         .withColumn("__h", F.xxhash64("__t")), "__h", bit_table(marks, "__m_h", bits), "__may", bits)
    marked = texts.filter("__may").join(
        marks, F.col("__id").eqNullSafe(F.col("__m_id")) & (F.col("__h") == F.col("__m_h")), "left"
    ).select("__id", "__t", "runs").unionByName(
        texts.filter("not __may").select("__id", "__t", F.lit(None).cast(marks.schema["runs"].dataType).alias("runs")))
    kind = texts.schema["__id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            out, n, gone_n = [], [], []
            for t, runs in zip(b.column(1), b.column(2), strict=True):
                text = t.as_py()
                cuts = sentences(text)
                gone = {i for r in runs.as_py() or () for i in range(r["first"], r["last"] + 1)}
                out.append(_without(text, cuts, gone) if gone else text)
                n.append(len(cuts))
                gone_n.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out, pa.string()), pa.array(n, pa.int64()),
                 pa.array(gone_n, pa.int64())], [id_col, text_col, "n_sentences", "n_removed"])

    return marked.mapInArrow(
        cut, f"`{id_col}` {kind}, `{text_col}` string, n_sentences long, n_removed long")
