"""Phrase collocation mining by SON partitioning, level by level.

Lower-cased (A-Z) texts are split at ``.,;:!?`` and line ends into pieces, pieces into
words; a phrase is 1 to ``max_words`` consecutive words of a piece.  Everything is
counted per language.

1. The texts are written once with a shard number: the number of the task that wrote
   them modulo ``shards``.
2. Each shard is mined completely.  A phrase with ``min_count`` occurrences in all has
   at least ``min_count * n_i / n`` in some shard, where ``n_i`` of the language's ``n``
   words stand; that is the shard's local support.  Tasks count the phrases of k words
   whose first and last k - 1 words may be locally frequent, and Spark adds up a shard's
   tasks, so a shard may be of any size.
3. The locally frequent phrases of all shards together are the candidates.  A last pass
   counts every candidate exactly over all texts, by its words.

What is frequent goes from one level to the next as a bit table of the phrases' hashes:
16 bits a phrase, at most ``MAX_BITS`` (32 MB).  It never misses a phrase; one that it
lets through by chance is counted like any other and fails the support in the end, so
results are exact, also where the table is full.

``collocations`` then takes the phrases of 2 words and more, finds each one's worst cut
by exact (decimal) arithmetic, drops those that a longer phrase explains, and ranks per
language.

Tasks hold one chunk of text, its words, and a bounded buffer of counts.  Frequent
phrases are added up within tasks before the shuffle.

Defined results: null and empty texts hold no phrases.  A null language is ``und``.
Very long texts are cut into chunks at piece ends, which changes nothing.  Ties of cuts
go to the shorter first part, ties of ranks to the greater count, then to the lesser
phrase by bytes.  Repeated rows count each time.  Only language and text are read, so
other columns, whatever their names, do not matter.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_array, bits_for, probe, stored, text_of

SHARDS, MIN_COUNT, MAX_WORDS = 8, 100, 5
MAX_BITS = 1 << 28
CHUNK = 1 << 22  # bytes of text worked on at once
BUFFER = 1 << 20  # counts that a task gathers before it hands them on
REMEMBERED = 1 << 18  # candidates that a task counts before it hands them on
ROWS = 1 << 16  # counts in a record batch

_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(_ENDS + b"\t", b"." * len(_ENDS) + b" ")
_END = re.compile(b"[" + re.escape(_ENDS) + b"]")
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Tokens:
    """The words of a chunk of text: ``ids`` by position (``end`` closes a piece), two
    independent hashes by id."""

    def __init__(self, chunk: bytes, lang: str):
        spaced = chunk.translate(_FOLD).lower().replace(b".", b" . ").strip(b" ")
        column = pa.array([spaced or b"."], pa.binary()).cast(pa.string())
        coded = pc.ascii_split_whitespace(column).flatten().dictionary_encode()
        self.ids = coded.indices.to_numpy()
        _, offsets, data = coded.dictionary.buffers()
        self._data = data.to_pybytes()
        self._at = np.frombuffer(offsets, np.int32)[:len(coded.dictionary) + 1].tolist()
        seed, digest, data = xxhash.xxh3_64_intdigest(lang.encode()), xxhash.xxh3_128_digest, self._data
        hashes = b"".join([digest(data[a:b], seed) for a, b in zip(self._at, self._at[1:], strict=False)])
        self.hashes = np.frombuffer(hashes, np.uint64).reshape(-1, 2)
        self.inside = self.ids != coded.dictionary.index(".").as_py()

    def phrase(self, ids: list[int]) -> bytes:
        return b" ".join([self._data[self._at[i]:self._at[i + 1]] for i in ids])


def _chunks(texts: list[bytes]):
    """Joined texts of about ``CHUNK`` bytes; a longer text is cut at piece ends."""
    part, size = [], 0
    for t in texts:
        at = 0
        while len(t) - at > CHUNK and (end := _END.search(t, at + CHUNK)):
            yield t[at:end.end()]
            at = end.end()
        part.append(t[at:])
        size += len(t) - at
        if size >= CHUNK:
            yield b".".join(part)
            part, size = [], 0
    if part:
        yield b".".join(part)


def _levels(tokens: _Tokens, up_to: int, column: int = 0):
    """(k, where a phrase of k words starts, hash from each position on), k = 1..up_to."""
    one = tokens.hashes[tokens.ids, column]
    inside, key = tokens.inside, one
    yield 1, inside, key
    for k in range(2, up_to + 1):
        inside = inside[:-1] & tokens.inside[k - 1:]
        key = key[:-1] * _STEP + one[k - 1:]
        key ^= key >> np.uint64(29)
        yield k, inside, key


def _mixed(key: np.ndarray) -> np.ndarray:
    key = key * _MIX
    return key ^ (key >> np.uint64(32))


def _frequent(tokens: _Tokens, level: int, table) -> np.ndarray:
    """Hashes of the phrases of ``level`` words whose first and last ``level`` - 1 words
    ``table`` holds (of one word: all), with repeats."""
    found = None
    for k, inside, key in _levels(tokens, level):
        if k == level:
            ok = inside if found is None else inside & found[:-1] & found[1:]
            return _mixed(key[ok])
        if k == level - 1:
            found = np.zeros(len(key), bool)
            at = np.flatnonzero(inside)
            found[at] = probe(table, _mixed(key[at]))
    return np.zeros(0, np.uint64)


def _tokens(batches):
    """(lang, shard, tokens) of the chunks of batches of (lang, shard, text bytes)."""
    for b in batches:
        frame = b.to_pandas()
        for (lang, shard), rows in frame.groupby(["lang", "shard"], sort=False):
            for chunk in _chunks(rows["text"].tolist()):
                yield lang, int(shard), _Tokens(chunk, lang)


class _Counts:
    """Counts by (lang, shard) and hash, merged when many have gathered."""

    def __init__(self):
        self.parts: dict[tuple, list] = {}
        self.size = 0

    def add(self, group, keys):
        keys, n = np.unique(keys, return_counts=True)
        self.parts.setdefault(group, []).append((keys, n))
        self.size += len(keys)

    def merged(self):
        for group, parts in self.parts.items():
            keys = np.concatenate([p[0] for p in parts])
            n = np.concatenate([p[1] for p in parts])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
            yield group, keys[first], np.add.reduceat(n, first) if len(first) else n

    def rows(self):
        for (lang, shard), keys, n in self.merged():
            for at in range(0, len(keys), ROWS):
                part, times = keys[at:at + ROWS], n[at:at + ROWS]
                size = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(size, np.int64))),
                     pa.array(np.full(size, shard, np.int32)), pa.array(part.view(np.int64)),
                     pa.array(times.astype(np.int64))], ["lang", "shard", "key", "n"])
        self.__init__()

    def shrink(self):
        """True if merging leaves room."""
        merged = list(self.merged())
        self.parts = {g: [(k, n)] for g, k, n in merged}
        self.size = sum(len(k) for _, k, _ in merged)
        return self.size <= BUFFER // 2


def _shard_counts(texts: DataFrame, level: int, table) -> DataFrame:
    """(lang, shard, key, n): occurrences of the possibly frequent phrases of ``level`` words."""
    shared = None if table is None else texts.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        counts = _Counts()
        for lang, shard, tokens in _tokens(batches):
            counts.add((lang, shard), _frequent(tokens, level, shared and shared.value))
            if counts.size > BUFFER and not counts.shrink():
                yield from counts.rows()
        yield from counts.rows()

    return (texts.mapInArrow(run, "lang string, shard int, key long, n long")
            .groupBy("lang", "shard", "key").agg(F.sum("n").alias("n")))


def _candidates(tokens: _Tokens, tables: list):
    """(k, both hashes, occurrences, an example's position) of the phrases that the tables
    let through, by their words (two phrases of one hash stay apart)."""
    found = None
    other = _levels(tokens, len(tables), 1)
    for k, inside, key in _levels(tokens, len(tables)):
        _, _, second = next(other)
        at = np.flatnonzero(inside if found is None else inside & found[:-1] & found[1:])
        mixed = _mixed(key[at])
        hit = probe(tables[k - 1], mixed)
        at, mixed = at[hit], mixed[hit]
        if not len(at):
            return
        found = np.zeros(len(key), bool)
        found[at] = True
        order = np.argsort(mixed)
        second = second[at]
        new = np.flatnonzero(np.concatenate([[True], mixed[order][1:] != mixed[order][:-1]]))
        if (np.repeat(second[order][new], np.diff([*new, len(at)])) != second[order]).any():
            order = np.lexsort((second, mixed))
            new = np.flatnonzero(np.concatenate([[True], (mixed[order][1:] != mixed[order][:-1])
                                                 | (second[order][1:] != second[order][:-1])]))
        first = order[new]
        yield k, mixed[first], second[first], np.diff(np.concatenate([new, [len(at)]])), at[first]


def _exact_counts(texts: DataFrame, tables: list) -> DataFrame:
    """(lang, phrase, k, a): occurrences of every phrase that the tables let through; a task adds
    up what has the same 128-bit hash, Spark what has the same words."""
    shared = texts.sparkSession.sparkContext.broadcast(tables)

    def rows(counts):
        for lang, (_, phrases, sizes, totals) in counts.items():
            for at in range(0, len(phrases), ROWS):
                part = phrases[at:at + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array(sizes[at:at + ROWS], pa.int32()), pa.array(totals[at:at + ROWS], pa.int64())],
                    ["lang", "phrase", "k", "a"])

    def run(batches):
        counts: dict[str, tuple] = {}  # by language: hash -> place, and by place: phrase, k, occurrences
        for lang, _, tokens in _tokens(batches):
            places, phrases, sizes, totals = counts.setdefault(lang, ({}, [], array("i"), array("q")))
            for k, one, two, n, at in _candidates(tokens, shared.value):
                keys = np.column_stack((one, two)).view("V16").ravel().tolist()
                for key, times, start in zip(keys, n.tolist(), at.tolist(), strict=True):
                    if (place := places.get(key)) is None:
                        places[key] = len(phrases)
                        phrases.append(tokens.phrase(tokens.ids[start:start + k].tolist()))
                        sizes.append(k)
                        totals.append(times)
                    else:
                        totals[place] += times
            if sum(len(c[1]) for c in counts.values()) > REMEMBERED:
                yield from rows(counts)
                counts = {}
        yield from rows(counts)

    return (texts.mapInArrow(run, "lang string, phrase string, k int, a long")
            .groupBy("lang", "phrase", "k").agg(F.sum("a").alias("a")))


def _table(keys: DataFrame):
    """The bit table of the ``key`` column: 16 bits a key, 2**16 at least, ``MAX_BITS`` at most."""
    return bit_array(keys, "key", bits_for(keys.count(), MAX_BITS))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     shards: int = SHARDS, lang_col: str = "lang",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, phrase, k, a) of the phrases of 1 to ``max_words`` words that
    occur ``min_count`` times or more, and (lang, n), all words of each language."""
    texts = stored(docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        (F.spark_partition_id() % shards).alias("shard"),
        text_of(text_col).cast("binary").alias("text")), "phrase_texts")
    tables, sizes, totals, table = [], None, None, None
    for level in range(1, max_words + 1):
        counts = _shard_counts(texts, level, table)
        if level == 1:
            counts = stored(counts, "phrase_words")
            sizes = stored(counts.groupBy("lang", "shard").agg(F.sum("n").alias("n_i")), "phrase_sizes")
            totals = stored(sizes.groupBy("lang").agg(F.sum("n_i").alias("n")), "phrase_totals")
            sizes = sizes.join(totals.withColumnRenamed("n", "__all"), "lang")
        wide = "cast({} as decimal(38,0))"
        local = (counts.join(sizes, ["lang", "shard"])
                 .filter(F.expr(f"{wide.format('n')} * {wide.format('`__all`')} >= "
                                f"{wide.format(min_count)} * {wide.format('n_i')}")))
        # the language is part of a key's hash; shards that agree add a key once
        keys = stored(local.select("key").distinct(), "phrase_keys")
        table = _table(keys)
        tables.append(table)
    exact = stored(_exact_counts(texts, tables).filter(F.col("a") >= min_count), "phrases")
    return exact, totals


def _score():
    """floor(1000 * a * n / (l * r)), exact for counts up to 10**14."""
    over = "cast(cast(1000 * cast(a as decimal(19,0)) as decimal(24,0)) * cast(n as decimal(14,0)) as decimal(38,0))"
    below = "cast(cast(l as decimal(19,0)) * cast(r as decimal(19,0)) as decimal(38,0))"
    return F.expr(f"{over} div {below}")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 top: int | None = 2000, absorb_percent: int = 100, shards: int = SHARDS,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the phrases of 2 words and more.

    ``score`` is ``floor(1000 * a * n / (l * r))`` of the worst cut.  A phrase goes if a
    longer one around it has ``absorb_percent`` of its occurrences.  ``top`` ranks are
    returned per language, all if it is None.
    """
    phrases, totals = frequent_phrases(docs, min_count, max_words, shards, lang_col, text_col)
    long = phrases.filter("k > 1")
    part = "array_join(slice(__w, i, s), ' ')"
    inner = (long.filter("k > 2").withColumn("__w", F.split("phrase", " ", -1))
             .select("lang", F.col("a").alias("longer"), F.explode(F.expr(
                 f"flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> {part})))"
             )).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    alone = (long.join(inner, ["lang", "phrase"], "left")
             .filter(f"longer is null or 100 * longer < {int(absorb_percent)} * a").drop("longer"))
    count = phrases.select("lang", F.col("phrase").alias("__part"), F.col("a").alias("__count"))
    cuts = (alone.withColumn("__w", F.split("phrase", " ", -1))
            .select("lang", "phrase", "a", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"), "__w", "k")
            .select("lang", "phrase", "a", "cut",
                    F.expr("array_join(slice(__w, 1, cut), ' ')").alias("head"),
                    F.expr("array_join(slice(__w, cut + 1, k - cut), ' ')").alias("tail")))
    cuts = (cuts.join(count.withColumnsRenamed({"__part": "head", "__count": "l"}), ["lang", "head"])
            .join(count.withColumnsRenamed({"__part": "tail", "__count": "r"}), ["lang", "tail"])
            .join(totals, "lang"))
    worst = (cuts.withColumn("score", _score())
             .groupBy("lang", "phrase", "a", "n")
             .agg(F.min(F.struct("score", "cut", "l", "r")).alias("__cut"))
             .select("lang", "phrase", "a", "__cut.l", "__cut.r", "n", "__cut.score"))
    best = "row_number() over (partition by {} order by score desc, a desc, phrase)"
    if top is not None:  # first within parts of a language, so that no task ranks all its phrases
        worst = (worst.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
                 .withColumn("__rank", F.expr(best.format("lang, __part"))).filter(F.col("__rank") <= top))
    ranked = worst.withColumn("rank", F.expr(best.format("lang")).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
