"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. All word n-grams of the test items set bits in a table of fixed size (8 MB), which
   is broadcast.  The documents are scanned for them, and for each n-gram the
   different contexts (the word before and the word behind) are counted.  Copying a
   passage any number of times adds one context, so a leak that a third of the
   documents hold does not make its n-grams common.
2. Seeds are the n-grams of at most ``rare_contexts`` contexts, and of every item,
   whatever their counts, its ``least_seeds`` rarest ones and the rarer one of any two
   n-grams that follow each other.  So the seeds cover an item however often edited
   copies of it occur: a copy with one word more than an n-gram in a row has a seed.
3. A second scan finds the seeds.  A passage is the words around seeds, an item's
   length to each side, joined where they overlap.  Passages meet items in a join on
   the seed, which drops at once the pairs that share too few words to reach ``min_score``:
   a passage brings 1,024 bits of its words, an item the bits of its own, so what is
   dropped is sure (each aligned word adds at most ``MATCH``).  A phrase that many items and
   documents share makes no pairs by itself.
4. A pair is aligned word by word (match +2, mismatch -1, gap -1); its score is the
   best local alignment over that of the whole item with itself.

Items are never all sent to a task: both joins are shuffles by seed and by item.

Defined results: null texts count as empty; an item shorter than an n-gram is one
n-gram of its own words, an item without words matches nothing.  Rows that repeat a
document or an item give the pair once.  Null ids are ids like any other.  Only ids
and texts are read, so further columns cannot clash.  Without documents or items
there are no pairs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_array, probe, stored, taken_over, text_of

NGRAM, RARE_CONTEXTS, LEAST_SEEDS, MIN_SCORE = 3, 32, 8, 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BITS, WORD_BITS = 1 << 26, 1024
WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)  # by place in a word; 3 modulo 8, so that places count
_NO_WORD = np.uint64(0)  # before the first and behind the last word of a text
CHUNK = 1 << 18  # characters that are cut into words and hashed at once


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _word_bit(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) % WORD_BITS


@lru_cache(maxsize=1)
def _word_signs() -> np.ndarray:
    """By code point whether ``WORD`` takes it (1 MB)."""
    signs = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    signs[ord("_")] = True
    return signs


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text): a hash of every word of the texts, cut as by ``words_of``, and which text it
    is of.  All words are hashed together, as sums over their characters."""
    lowered = [t.lower() for t in texts]
    chars = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le"), np.uint32)
    inside = _word_signs()[chars]
    edges = np.flatnonzero(np.diff(inside, prepend=False))  # a text ends with a line end, so ends are there
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(firsts[-1] + sizes[-1]) - np.repeat(firsts, sizes)
    powers = np.multiply.accumulate(np.full(sizes.max(), _BASE, np.uint64))
    sign = (chars[inside].astype(np.uint64) + np.uint64(1)) * _MIX
    sign ^= sign >> np.uint64(32)
    sign *= _MIX
    h = np.add.reduceat(sign * powers[place], firsts)
    h ^= h >> np.uint64(32)
    h *= _MIX
    text_ends = np.cumsum([len(t) + 1 for t in lowered])
    return h ^ (h >> np.uint64(29)), np.searchsorted(text_ends, starts, "right")


def _chunks(column) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts): the rows in parts of ``CHUNK`` characters, but for their last text."""
    first, texts, size = 0, [], 0
    for row, t in enumerate(column, 1):
        texts.append(t.as_py())
        size += len(texts[-1])
        if size >= CHUNK:
            yield first, texts
            first, texts, size = row, [], 0
    if texts:
        yield first, texts


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for every ``n`` consecutive word hashes."""
    out = np.full(max(0, len(h) - n + 1), n, np.uint64)
    for k in range(n):
        out = (out ^ h[k:len(h) - n + 1 + k]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def gram_hashes(text: str, n: int) -> np.ndarray:
    """Hashes of the n-grams of ``text``; of all its words if they are fewer than ``n``."""
    h, _ = word_hashes([text])
    return _rolled(h, min(n, len(h))) if len(h) else h


def alignment(item: list[str], passage: list[str]) -> tuple[float, int, int]:
    """(score, first, behind the last): best local alignment of ``item`` within
    ``passage``, from 0 to 1, and the words of ``passage`` that it covers."""
    ids: dict[str, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in item])
    b = np.array([ids.setdefault(w, len(ids)) for w in passage])
    step = np.arange(len(b) + 1) * -GAP
    row, origin = np.zeros(len(b) + 1, np.int64), np.arange(len(b) + 1)
    best, span = 0, (0, 0)
    for x in a:
        diagonal = row[:-1] + np.where(b == x, MATCH, MISMATCH)
        up = row[1:] + GAP
        here = np.concatenate(([0], np.maximum(diagonal, up)))
        came = np.concatenate(([0], np.where(diagonal >= up, origin[:-1], origin[1:])))
        fresh = here <= 0
        here[fresh], came[fresh] = 0, np.arange(len(b) + 1)[fresh]
        # gaps in the item: the best of all starts to the left, less their distance
        lifted = here + step
        top = np.maximum.accumulate(lifted)
        at = np.maximum.accumulate(np.where(lifted == top, np.arange(len(b) + 1), 0))
        row, origin = top - step, came[at]
        k = int(row.argmax())
        if row[k] > best:
            best, span = int(row[k]), (int(origin[k]), k)
    return best / (MATCH * len(a)) if len(a) else 0.0, *span


def _item_lengths(items: DataFrame) -> tuple[int, int]:
    """Words of the shortest item that has any, and of the longest one."""
    def run(batches):
        for b in batches:
            n = [n for t in b.column(0) if (n := len(words_of(t.as_py())))]
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([min(n)], pa.int64()),
                                                  pa.array([max(n)], pa.int64())], ["a", "b"])

    r = items.select("__item").mapInArrow(run, "a long, b long").agg(F.min("a"), F.max("b")).first()
    return r[0] or 0, r[1] or 0


def _item_grams(items: DataFrame, n: int) -> DataFrame:
    """(item, h, at, gram): the n-grams of every item by position; ``h`` tells texts apart."""
    kind = items.schema["item"].dataType.simpleString()

    def run(batches):
        for b in batches:
            grams = [gram_hashes(t.as_py(), n) for t in b.column(2)]
            row = pa.array(np.repeat(np.arange(len(grams)), [len(g) for g in grams]))
            at = np.concatenate([*map(np.arange, map(len, grams)), np.empty(0, np.int64)]).astype(np.int32)
            flat = np.concatenate([*grams, np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(at),
                                              pa.array(flat.view(np.int64))], ["item", "h", "at", "gram"])

    return items.select("item", F.xxhash64("__item").alias("h"), "__item").distinct().mapInArrow(
        run, f"item {kind}, h long, at int, gram long")


def _hits(texts: list[str], sizes: range, bits: np.ndarray) -> Iterator[tuple]:
    """For each n-gram length: (length, first words, hashes) of the n-grams within a text that hit
    the table, and the word hashes of all texts and which text each is of."""
    h, text = word_hashes(texts)
    for k in sizes:
        rolled = _rolled(h, k)
        hit = probe(bits, rolled)
        hit &= text[:len(rolled)] == text[k - 1:]
        if len(at := np.flatnonzero(hit)):
            yield k, at, rolled[at], h, text


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """The different columns of the parts, which have two rows each."""
    both = np.concatenate([*parts, np.empty((2, 0), np.uint64)], axis=1)
    both = both[:, np.lexsort(both)]
    return both[:, np.concatenate(([True], (both[:, 1:] != both[:, :-1]).any(axis=0)))[:both.shape[1]]]


def _contexts(docs: DataFrame, grams: DataFrame, sizes: range) -> DataFrame:
    """(gram, contexts): in how many different contexts the documents have each n-gram."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_array(grams, "gram", BITS))

    def run(batches):
        taken_over("decontam")
        for b in batches:
            pairs: list[np.ndarray] = []
            for _, texts in _chunks(b.column(0)):
                for k, at, found, h, text in _hits(texts, sizes, bits.value):
                    around = np.concatenate(([_NO_WORD], h, [_NO_WORD]))
                    of = np.concatenate(([-1], text, [-1]))
                    before = np.where(of[at] == text[at], around[at], _NO_WORD)
                    behind = np.where(of[at + k + 1] == text[at], around[at + k + 1], _NO_WORD)
                    pairs.append(np.stack([found, before ^ (behind >> np.uint64(1))]))
                if sum(p.shape[1] for p in pairs[1:]) > CHUNK:
                    pairs = [_distinct(pairs)]
            flat = _distinct(pairs).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat[0]), pa.array(flat[1])], ["gram", "context"])

    found = docs.select("__t").mapInArrow(run, "gram long, context long").distinct()
    return found.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts"))


def _passages(docs: DataFrame, seeds: DataFrame, sizes: range, reach: int) -> DataFrame:
    """(doc, h, start, words, grams, bits): the words around seeds, the seeds among them and a
    bit set of the words."""
    kind, n = docs.schema["doc"].dataType.simpleString(), max(sizes, default=0)
    bits = docs.sparkSession.sparkContext.broadcast(bit_array(seeds, "gram", BITS))

    def seeds_by_text(texts: list[str]) -> dict[int, list[tuple[int, int, int]]]:
        """Text -> (first word in it, length, n-gram) of its seeds."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        for k, at, found, _, text in _hits(texts, sizes, bits.value):
            own = text[at]
            first = at - np.searchsorted(text, own)
            for t, i, g in zip(own.tolist(), first.tolist(), found.view(np.int64).tolist(), strict=True):
                out.setdefault(t, []).append((i, k, g))
        return out

    def run(batches):
        taken_over("decontam")
        for b in batches:
            rows, starts, passages, grams, masks = [], [], [], [], []
            for top, texts in _chunks(b.column(2)):
                for t, found in sorted(seeds_by_text(texts).items()):
                    words, group = words_of(texts[t]), []
                    for hit in [*sorted(found), None]:
                        if group and (hit is None or hit[0] - reach > group[-1][0] + n + reach):
                            a = max(0, group[0][0] - reach)
                            rows.append(top + t)
                            starts.append(a)
                            inside = words[a:group[-1][0] + n + reach]
                            passages.append(" ".join(inside))
                            mask = 0
                            for w in set(inside):
                                mask |= 1 << _word_bit(w)
                            masks.append(mask.to_bytes(WORD_BITS // 8, "little"))
                            grams.append(sorted({g for _, _, g in group}))
                            group = []
                        group.append(hit)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(starts, pa.int32()),
                 pa.array(passages, pa.string()), pa.array(grams, pa.list_(pa.int64())),
                 pa.array(list(np.frombuffer(b"".join(masks), np.int64).reshape(-1, WORD_BITS // 64)),
                          pa.list_(pa.int64()))],
                ["doc", "h", "start", "words", "grams", "bits"])

    return docs.select("doc", F.xxhash64("__t").alias("h"), "__t").mapInArrow(
        run, f"doc {kind}, h long, start int, words string, grams array<long>, bits array<long>")


def _item_marks(items: DataFrame, min_score: float) -> DataFrame:
    """(item, marks, need): the bits of an item's words, one a word, and how many words a passage
    must share."""
    kind = items.schema["item"].dataType.simpleString()

    def run(batches):
        for b in batches:
            words = [words_of(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([[_word_bit(w) for w in ws] for ws in words],
                                       pa.list_(pa.int32())),
                 pa.array([min_score * len(ws) for ws in words], pa.float64())], ["item", "marks", "need"])

    return items.distinct().mapInArrow(run, f"item {kind}, marks array<int>, need double")


def _pairs(passages: DataFrame, seeds: DataFrame, items: DataFrame, min_score: float) -> DataFrame:
    """(doc, h, start, item): passages and items that share a seed and may share enough words."""
    marks = _item_marks(items, min_score).select(F.col("item").alias("__item_id"), "marks", "need")
    known = seeds.join(marks, F.col("item").eqNullSafe(F.col("__item_id"))).drop("__item_id")
    shared = "size(filter(marks, m -> bit_get(bits[cast(m div 64 as int)], m % 64) = 1))"
    return (passages.select("doc", "h", "start", "bits", F.explode("grams").alias("gram"))
            .join(known, "gram").filter(F.expr(f"{shared} >= need"))
            .select("doc", "h", "start", "item").distinct())


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", ngram: int = NGRAM,
                       rare_contexts: int = RARE_CONTEXTS, least_seeds: int = LEAST_SEEDS,
                       min_score: float = MIN_SCORE) -> DataFrame:
    """(id_col, item_col, score, first_word, end_word, text_hash): documents that hold a
    copy of an item, exact or edited; the best aligned passage of each pair, by word
    positions.  ``text_hash`` (xxhash64) tells rows of one id apart."""
    texts = docs.select(F.col(id_col).alias("doc"), text_of(text_col).alias("__t"))
    items = benchmark.select(F.col(item_col).alias("item"), text_of(item_text_col).alias("__item"))
    shortest, reach = _item_lengths(items)
    sizes = range(max(1, min(shortest, ngram)), ngram + 1)  # short items are n-grams of their own length
    grams = stored(_item_grams(items, ngram), "decontam_grams")
    counted = (grams.join(_contexts(texts, grams, sizes), "gram", "left")
               .fillna(0, subset=["contexts"]))
    rank = F.dense_rank().over(Window.partitionBy("item").orderBy("contexts", "gram"))
    key, order = F.struct("contexts", "gram"), Window.partitionBy("item", "h").orderBy("at")
    covers = (key <= F.lag(key).over(order)) | (key <= F.lead(key).over(order))
    seeds = stored(counted.withColumns({"rank": rank, "covers": covers})  # windows of one item's n-grams
                   .filter((F.col("contexts") <= rare_contexts) | (F.col("rank") <= least_seeds)
                           | F.col("covers")).select("item", "gram").distinct(), "decontam_seeds")
    passages = stored(_passages(texts, seeds, sizes, reach), "decontam_passages")
    pairs = _pairs(passages, seeds, items, min_score)
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in ("doc", "h", "start")]
    work = (pairs.alias("p").join(passages.alias("q"), same[0] & same[1] & same[2])
            .join(items.distinct().alias("i"), F.col("p.item").eqNullSafe(F.col("i.item")))
            .select("p.doc", "p.h", "p.item", "q.start", "q.words", "__item"))
    doc_kind, item_kind = (work.schema[c].dataType.simpleString() for c in ("doc", "item"))

    def align(batches):
        for b in batches:
            rows, scores, firsts, ends = [], [], [], []
            for row, (start, words, item) in enumerate(zip(*b.columns[3:], strict=True)):
                own, other = words_of(item.as_py()), words.as_py().split(" ")
                shared = (Counter(own) & Counter(other)).total()
                if shared < min_score * len(own):
                    continue  # each aligned word adds at most MATCH
                score, first, end = alignment(own, other)
                if score >= min_score:
                    rows.append(row)
                    scores.append(score)
                    firsts.append(start.as_py() + first)
                    ends.append(start.as_py() + end)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(at) for c in b.columns[:3]), pa.array(scores, pa.float64()),
                 pa.array(firsts, pa.int64()), pa.array(ends, pa.int64())],
                ["doc", "h", "item", "score", "first", "end"])

    found = work.mapInArrow(align, f"doc {doc_kind}, h long, item {item_kind}, score double, "
                                   "first long, end long")
    best = F.max(F.struct("score", (-F.col("first")).alias("f"), (-F.col("end")).alias("e")))
    return (found.groupBy("doc", "h", "item").agg(best.alias("best"))
            .select(F.col("doc").alias(id_col), F.col("item").alias(item_col),
                    F.col("best.score").alias("score"), (-F.col("best.f")).alias("first_word"),
                    (-F.col("best.e")).alias("end_word"), F.col("h").alias("text_hash")))
