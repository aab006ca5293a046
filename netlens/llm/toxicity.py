"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Text is folded first: lower case, homoglyphs and accented letters to plain ones,
digits and signs that stand for letters to those (``1``, ``l`` and ``i`` become one
letter, as ``1`` is used for both), everything else to a space.  The lexicon holds
whole words and word beginnings with a weight, the logarithm of how much more often
toxic documents hold them than others.  To hold an entry is to have it at a density,
occurrences in 100 words; each entry has the level of ``LEVELS`` that separates the
labels best, 0 where one occurrence says enough, so a word that long clean documents
hold once can still be one.  It counts in a text from half of its level on.  Exception
phrases are longer words or two words around an entry of level 0 that only documents
which are not toxic hold; a match inside one does not count.  The weights found are added, divided by a power of the text's
length, and turned into a probability.

Learning reads at most ``max_per_class`` labelled documents of either label, those
with the smallest hash of their id (a documented bound; the same rows whatever the
partitions).  Patterns are counted and chosen in Spark; the driver gets the heavy ones,
the hits of the sample's toxic rows and two numbers a sample row.  Scoring covers every row and whole text; the
model is broadcast.  Labels, language, source and id are no inputs of a score.

Defined results: null text counts as empty.  A text without matches, the empty one
too, gets the score of no evidence (below 0.5).  Labels that are null are ignored;
where a document is labelled more than once, toxic wins.  Without labelled rows, or
without toxic ones, every score is 0.  Repeated rows get equal scores.  Other columns are
kept; one that has the score's name is replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bit_array, bits_for, stored, taken_over, train_rows, train_texts, with_column

MAX_PER_CLASS = 8000
MIN_DOCS, MIN_WEIGHT = 4, 3.0
CERTAINTY, CONTEXT = 7.0, 10  # of an entry beside the cover; characters before a match
STEMS, SHORTEST = range(4, 9), 2  # letters of a beginning, of a whole word at least
REMEMBERED = 1 << 16  # patterns that a task keeps at once
LEVELS = (0.0, 0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 2.0, 3.0)

# Signs that are written for a letter, by the letter.
LOOK_ALIKE = {
    "a": "4@аαɑ", "b": "8вβ", "c": "сϲ", "d": "ԁ", "e": "3еεё", "g": "9ɡ", "h": "һн", "i": "1lіιıӏ|",
    "j": "ј", "k": "кκ", "m": "м", "n": "пη", "o": "0оοσ", "p": "рρ", "q": "ԛ", "s": "5$ѕ",
    "t": "7тτ", "u": "υ", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "2ʐ"}
HIDDEN = "­​‌‍⁠﻿"


def _plain(c: str) -> str:
    """The letter below accents and width variants."""
    d = unicodedata.normalize("NFKD", c)
    return "".join(x for x in d if not unicodedata.combining(x)) or c


@lru_cache(maxsize=1)
def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for r in ((0xC0, 0x250), (0x1E00, 0x1F00), (0xFF10, 0xFF5B)):
        for i in range(*r):
            p = _plain(chr(i).lower())
            if p.isascii() and p.isalnum():
                table[i] = p.lower()
    for letter, signs in LOOK_ALIKE.items():
        for s in signs:
            table[ord(s)] = letter
    for i, p in list(table.items()):
        table[i] = "".join(table.get(ord(x), x) if x in "l0123456789" else x for x in p)
    return table | dict.fromkeys(map(ord, HIDDEN)) | dict.fromkeys(range(0x300, 0x370))


_GAPS = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Folded words, each between single spaces."""
    return f" {_GAPS.sub(' ', text.lower().translate(_table())).strip()} "


@dataclass(frozen=True)
class ToxicityModel:
    """entries: (pattern, weight), ' word ' or ' beginning'; exceptions: patterns; levels:
    (pattern, density) of the entries whose level is not 0."""
    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    power: float
    slope: float
    offset: float
    levels: tuple[tuple[str, float], ...] = ()

    def probability(self, weight: float, n_words: int) -> float:
        if not self.entries:
            return 0.0
        z = self.offset + self.slope * weight / (1 + n_words / 100) ** self.power
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


@lru_cache(maxsize=2)
def automaton(entries: tuple, exceptions: tuple):
    found = ahocorasick.Automaton()
    for p, w in entries:
        found.add_word(p, (len(p), w, p))
    for p in exceptions:
        found.add_word(p, (len(p), None, p))
    if len(found):
        found.make_automaton()
    return found


def evidence(model: ToxicityModel, text: str) -> tuple[float, int]:
    """(sum of the weights that count, number of words)."""
    folded = fold(text)
    found = automaton(model.entries, model.exceptions)
    best: dict[int, tuple[int, float, str]] = {}
    safe: list[tuple[int, int]] = []
    if len(found):
        for end, (size, weight, p) in found.iter(folded):
            start = end - size + 1
            if weight is None:
                safe.append((start, end))
            elif weight > best.get(start, (0, 0.0))[1]:
                best[start] = (end, weight, p)
    hits = [(w, p) for s, (e, w, p) in best.items() if not any(a <= s and e <= b for a, b in safe)]
    n_words = folded.count(" ") - 1
    if hits and model.levels:
        times = Counter(p for _, p in hits)
        low = {p for p, level in model.levels if times[p] * 100 < level / 2 * n_words}
        hits = [h for h in hits if h[1] not in low]
    return sum(w for w, _ in hits), n_words


# --- learning ----------------------------------------------------------------------------

def _patterns(folded: str) -> dict[str, int]:
    """Words and beginnings, and how often they occur."""
    out: Counter[str] = Counter()
    for word, n in Counter(folded.split()).items():
        if len(word) >= SHORTEST:
            out[f" {word} "] += n
        for k in STEMS:
            if k <= len(word):
                out[f" {word[:k]}"] += n
    return out


def _level(occurrences: int, n_words: int) -> int:
    """The highest of ``LEVELS`` that so many occurrences among so many words reach."""
    return bisect_right(LEVELS, 100 * occurrences / n_words) - 1


class _Known(dict):
    """Whether a pattern's bit is set, worked out once."""

    def __init__(self, words: np.ndarray):
        super().__init__()
        self.words, self.mask = words, len(words) * 64 - 1

    def __missing__(self, pattern: str) -> bool:
        if len(self) > REMEMBERED:
            self.clear()
        slot = xxhash.xxh64_intdigest(pattern.encode(), 42) & self.mask
        self[pattern] = hit = bool(int(self.words[slot >> 6]) >> (slot & 63) & 1)
        return hit


def _level_counts(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(key, toxic0, other0, toxic1...): in how many documents of either label a candidate has
    at least each level's density.  Tasks leave out most other patterns by a bit table of the
    candidates (16 bits a pattern, 8 MB at most); the join drops the rest."""
    keys = candidates.select(F.xxhash64("key").alias("h"))
    bits = bits_for(keys.count(), 1 << 26)
    shared = rows.sparkSession.sparkContext.broadcast(bit_array(keys, "h", bits))

    def run(batches):
        taken_over("toxicity")
        known, counts = _Known(shared.value), {}
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                folded = fold(t)
                n_words, side = folded.count(" ") - 1, 0 if y == 1 else 1
                for p, n in _patterns(folded).items():
                    if known[p]:
                        at = p, _level(n, n_words)
                        if at not in counts:
                            counts[at] = [0, 0]
                        counts[at][side] += 1
                if len(counts) > REMEMBERED:
                    yield _level_rows(counts)
                    counts = {}
        yield _level_rows(counts)

    sums = [F.sum(F.when(F.col("level") >= k, F.col(side)).otherwise(0)).alias(f"{side}{k}")
            for k in range(len(LEVELS)) for side in ("toxic", "other")]
    return (rows.mapInArrow(run, "key string, level int, toxic long, other long")
            .groupBy("key").agg(*sums).join(candidates.select("key"), "key", "left_semi"))


def _level_rows(counts: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
         pa.array([v[0] for v in counts.values()], pa.int64()),
         pa.array([v[1] for v in counts.values()], pa.int64())], ["key", "level", "toxic", "other"])


def _weight(toxic, other, n_toxic: int, n_other: int):
    return (F.log((toxic + 0.5) / F.lit(n_toxic + 1.0))
            - F.log((other + 0.5) / F.lit(n_other + 1.0)))


def _heavy(levels: DataFrame, n_toxic: int, n_other: int) -> DataFrame:
    """(key, level, toxic, other, weight): the patterns that are heavy enough at some level, each
    at the level that separates the labels best."""
    at = [F.struct((F.col(f"toxic{k}") - 2 * F.col(f"other{k}")).alias("gain"), F.lit(-k).alias("low"),
                   F.lit(float(level)).alias("level"), F.col(f"toxic{k}").alias("toxic"),
                   F.col(f"other{k}").alias("other"),
                   F.round(_weight(F.col(f"toxic{k}"), F.col(f"other{k}"), n_toxic, n_other), 6)
                   .alias("weight")) for k, level in enumerate(LEVELS)]
    fit = F.filter(F.array(*at), lambda r: (r["toxic"] >= min(MIN_DOCS, n_toxic))
                   & (r["weight"] >= MIN_WEIGHT) & (r["other"] <= r["toxic"] / 4))
    return (levels.select("key", F.array_max(fit).alias("best")).filter("best is not null")
            .select("key", "best.level", "best.toxic", "best.other", "best.weight"))


def _phrases(folded: str, entries: tuple) -> set[str]:
    """Words and pairs of neighbours around the matches of ``entries``."""
    words, found, out = folded.split() if entries else [], automaton(entries, ()), set()
    for i, w in enumerate(words):
        if any(True for _ in found.iter(f" {w} ")):
            out.add(f" {w} ")
            near = words[max(0, i - 1):i + 2]
            out.update(f" {a} {b} " for a, b in zip(near, near[1:], strict=False))
    return out


def _document_counts(rows: DataFrame, keys_of) -> DataFrame:
    """(key, toxic, other): in how many documents of either label a key is."""
    def rows_of(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()),
             pa.array([v[0] for v in counts.values()], pa.int64()),
             pa.array([v[1] for v in counts.values()], pa.int64())], ["key", "toxic", "other"])

    def run(batches):
        taken_over("toxicity")
        counts: dict[str, list[int]] = {}
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for k in keys_of(fold(t)):
                    counts.setdefault(k, [0, 0])[0 if y == 1 else 1] += 1
                if len(counts) > REMEMBERED:
                    yield rows_of(counts)
                    counts = {}
        yield rows_of(counts)

    return (rows.mapInArrow(run, "key string, toxic long, other long").groupBy("key")
            .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))


def _lexicon(rows: list) -> tuple[tuple[tuple[str, float], ...], dict]:
    """Entries from the heavy patterns, none the beginning of another, and their levels; of the
    beginnings that stand for nearly the same documents the longest."""
    heavy = {r.key: r for r in rows}
    longer: dict[str, list[str]] = {}
    for key in heavy:
        for n in STEMS:
            if n < len(key.strip()):
                longer.setdefault(key[:n + 1], []).append(key)
    chosen: dict[str, float] = {}
    for key in sorted(heavy, key=lambda k: (len(k.strip()), k)):
        if any(key[:n] in chosen for n in range(STEMS[0] + 1, len(key) + 1)):
            continue
        same = [k for k in longer.get(key, ()) if not k.endswith(" ")
                and heavy[k].toxic >= 0.95 * heavy[key].toxic]
        best = max(same, key=lambda k: (len(k), k), default=key)
        chosen[best] = heavy[best].weight
    return tuple(sorted(chosen.items())), {k: heavy[k].level for k in chosen}


def _cover(entries: tuple, matched: list[list[str]]) -> tuple[tuple[str, float], ...]:
    """The entries that explain toxic documents that no stronger one explains.

    Words that only happen to stand in toxic documents, or in copies of one, stand
    beside a real entry and are left with no documents of their own.  So are some real
    ones, which ``_beyond_chance`` finds.
    """
    weight = dict(entries)
    open_, chosen = [frozenset(m) for m in matched], []
    while True:
        left = Counter(p for m in open_ for p in m)
        best = max(left, key=lambda p: (left[p], weight[p], len(p), p), default=None)
        if best is None or left[best] < MIN_DOCS:
            return tuple(sorted(chosen)) or entries
        chosen.append((best, weight[best]))
        open_ = [m for m in open_ if best not in m]


def _contexts(toxic: DataFrame, entries: tuple) -> dict[str, int]:
    """By entry after how many different pieces of text it stands in the toxic rows; copies of
    a document, however many, count once."""
    def run(batches):
        found, seen = automaton(tuple((p, 0.0) for p, _ in entries), ()), set()
        for b in batches:
            for f in map(fold, b.column(1).to_pylist()):
                for end, (size, _, p) in found.iter(f):
                    start = end - size + 1
                    seen.add((p, f[max(0, start - CONTEXT):start]))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.string()),
                                          pa.array([c for _, c in seen], pa.string())], ["key", "c"])

    rows = toxic.mapInArrow(run, "key string, c string").groupBy("key").agg(F.countDistinct("c").alias("n"))
    return {r.key: r.n for r in rows.collect()}  # one row an entry


def _beyond_chance(entries: tuple, heavy: dict, contexts: dict[str, int], n_candidates: int,
                   n_toxic: int, n_other: int) -> tuple[tuple[str, float], ...]:
    """The entries whose share of toxic documents chance would hardly give to any of so many
    candidates (Chernoff bound over their different contexts)."""
    share = n_toxic / (n_toxic + n_other) if n_other else 0.5
    out = []
    for p, w in entries:
        t, o = min(contexts.get(p, 0), heavy[p].toxic), heavy[p].other
        n = t + o
        bound = sum(k * math.log(k / n / q) for k, q in ((t, share), (o, 1 - share)) if k)
        if t >= MIN_DOCS and bound >= math.log(max(1, n_candidates)) + CERTAINTY:
            out.append((p, w))
    return tuple(out)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """(slope, offset, loss) of a one-variable logistic fit, by Newton steps with a ridge."""
    beta, ridge = np.zeros(2), np.diag([1e-3, 1e-3]) * weight.sum()
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -60, 60)))
        grad = design.T @ (weight * (p - y)) + ridge @ beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge, grad)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(design @ beta, -60, 60))), 1e-12, 1 - 1e-12)
    return float(beta[0]), float(beta[1]), float(
        -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())


def fit_toxicity(docs: DataFrame, labels: DataFrame, train_fold: Column,
                 label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
                 max_per_class: int = MAX_PER_CLASS) -> ToxicityModel:
    """Learn lexicon, exceptions and calibration from the rows where ``train_fold`` holds."""
    chosen = train_rows(labels, label_col, train_fold, max_per_class, id_col)
    sample = stored(train_texts(docs, chosen, id_col, text_col), "toxicity_sample")
    n_of = {r["__y"]: r["count"] for r in sample.groupBy("__y").count().collect()}
    n_toxic, n_other = n_of.get(1, 0), sum(n for y, n in n_of.items() if y != 1)
    none = ToxicityModel((), (), 0.0, 0.0, 0.0)
    if not n_toxic:
        return none

    candidates = stored(_document_counts(sample.filter("__y = 1"), _patterns)
                        .filter(F.col("toxic") >= min(MIN_DOCS, n_toxic)), "toxicity_candidates")
    heavy = _heavy(_level_counts(sample, candidates), n_toxic, n_other).collect()
    entries, level_of = _lexicon(heavy)
    if not entries:
        return none
    def matches(batches):
        found = automaton(tuple((p, p) for p, _ in entries), ())
        for b in batches:
            hits = []
            for f in map(fold, b.column(1).to_pylist()):
                times, n_words = Counter(p for _, (_, p, _) in found.iter(f)), f.count(" ") - 1
                hits.append(sorted(p for p, n in times.items()
                                   if LEVELS[_level(n, n_words)] >= level_of[p]))
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.string()))], ["hits"])

    matched = sample.filter("__y = 1").mapInArrow(matches, "hits array<string>").collect()
    sure = _beyond_chance(entries, {r.key: r for r in heavy}, _contexts(sample.filter("__y = 1"), entries),
                          candidates.count(), n_toxic, n_other)
    entries = tuple(sorted({*sure, *_cover(entries, [r.hits for r in matched])}))
    levels = tuple((p, level_of[p]) for p, _ in entries if level_of[p])
    single = tuple((p, w) for p, w in entries if not level_of[p])
    phrases = _document_counts(sample, lambda f: _phrases(f, single))
    known = {p for p, _ in entries}
    exceptions = tuple(sorted(r.key for r in phrases.filter("toxic = 0 and other >= 2").collect()
                              if r.key not in known))

    raw = ToxicityModel(entries, exceptions, 0.0, 0.0, 0.0, levels)

    def weigh(batches):
        for b in batches:
            made = [evidence(raw, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m[0] for m in made], pa.float64()),
                 pa.array([m[1] for m in made], pa.int64())], ["y", "w", "n"])

    got = sample.mapInArrow(weigh, "y int, w double, n long").collect()
    y = np.array([float(r.y == 1) for r in got])
    w, n = np.array([r.w for r in got]), np.array([r.n for r in got], float)
    # Classes weigh as among all labelled rows of the fold, not as in the sample.
    of = Counter()
    for r in labels.filter(train_fold).groupBy(F.col(label_col).alias("y")).count().collect():
        of[1 if r.y == 1 else 0] += r["count"] if r.y is not None else 0
    share = np.where(y == 1, of[1] / max(1, n_toxic), of[0] / max(1, n_other))
    fits = []
    for power in (0.25, 0.5, 0.75, 1.0):
        slope, offset, loss = _logistic(w / (1 + n / 100) ** power, y, share)
        fits.append((loss, power, slope, offset))
    _, power, slope, offset = min(fits)
    return ToxicityModel(entries, exceptions, power, slope, min(offset, -1e-6), levels)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
                   score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``, the probability of every row; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand short patterns

    def add(b):
        taken_over("toxicity")
        m, texts = shared.value, b.column(b.schema.get_field_index(text_col))
        return pa.array([m.probability(*evidence(m, t.as_py() or "")) for t in texts], pa.float64())

    return with_column(docs, score_col, T.DoubleType(), add)
