"""Language-model scores by deleted interpolation (bigrams).

``P(w | h) = l(b) * c(h, w) / c(h) + (1 - l(b)) * (c(w) + 0.1) / (N + 0.1 (V + 1))``, where
``b`` is the frequency bucket of the context ``h`` (half powers of two of ``c(h)``).  The
weights ``l`` are learned by expectation-maximisation on a deleted part: the counts are
taken without the documents of that part, and the weights are those that make its
tokens likeliest.  The scores then use the counts of all training documents.

Counts are exchanged, not collected and not broadcast:

1. Documents are dealt into chunks of about ``CHUNK_BYTES`` of text by the hash of id
   and text.  A chunk sends the sorted, distinct hashes of its words and word pairs,
   with its own counts, to buckets, which are ranges of the hash.
2. A bucket adds up what it got and answers every chunk with the totals of the keys
   that it asked for, in their order.  No key is repeated in an answer.
3. A chunk meets its answers, has all counts for its tokens, and scores its documents.

A word or pair that is in every document reaches its bucket once a chunk, so a frequent
one is no hot key; the number of buckets and chunks grows with the text.  What the
driver gets is the numbers N and V and, for the weights, a table of (bucket, quantised
ratio of the two estimates), at most some thousand rows whatever the corpus.

Defined results: null text counts as empty; a text without words is one end token.  A
null id is in the training part.  Repeated rows are counted and scored each.  Without
training documents N and V are 0 and every token has probability 1.  Only id and text
are read, so further columns cannot clash.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 1_000_000
ADD = 0.1
END, BEGIN = b" ", b"  "  # no words, as words have no white space
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ONE = np.uint64(1)


class _Hashes(dict):
    """Word -> hash; forgets all when it has become large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


class Tokens:
    """The tokens of some documents: ``starts`` of each, hashes of words (odd) and of pairs
    (even) among the sorted distinct ``keys``."""

    def __init__(self, texts: list[str]):
        end, begin = (np.array([xxhash.xxh64_intdigest(x)], np.uint64) for x in (END, BEGIN))
        parts, sizes = [], []
        for t in texts:
            words = t.encode().lower().split()  # bytes: A-Z and the six ASCII white spaces only
            parts += [np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)), end]
            sizes.append(len(words) + 1)
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        word = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        before = np.concatenate((begin, word[:-1])) if len(word) else word
        before[self.starts] = begin
        pair = before * _A ^ (word + _B) * _B
        pair ^= pair >> np.uint64(31)
        n = len(word)
        self.keys, at = np.unique(np.concatenate((word | _ONE, (pair * _A) & ~_ONE)),
                                  return_inverse=True)
        self.word, self.pair = at[:n], at[n:]
        self._end = np.flatnonzero(self.keys == (end[0] | _ONE))

    def counts(self, weight: np.ndarray) -> np.ndarray:
        """How often each key is, in the documents where ``weight`` is 1."""
        w = np.repeat(weight, self.sizes)
        return np.bincount(np.concatenate((self.word, self.pair)),
                           np.concatenate((w, w)), len(self.keys)).astype(np.uint32)

    def estimates(self, total: np.ndarray, n: int, v: int):
        """Per token: (c(w), c(h), c(h, w), the base probability)."""
        c = total[self.word].astype(np.float64)
        context = np.concatenate(([0.0], c[:-1])) if len(c) else c
        context[self.starts] = total[self._end[0]] if len(self._end) else 0  # documents begun
        return c, context, total[self.pair].astype(np.float64), (c + ADD) / (n + ADD * (v + 1))


def _packed(a: np.ndarray) -> bytes:
    """Bytes by significance, so that leading zeros compress."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _unpacked(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def frequency_bucket(context: np.ndarray) -> np.ndarray:
    return np.floor(2 * np.log2(np.maximum(context, 1))).astype(np.int64)


def _requests(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        tokens = Tokens(docs["__t"].to_pylist())
        part = docs["__part"].to_numpy()
        rest, deleted = tokens.counts(part == 2), tokens.counts(part == 1)
        of = _bucket(tokens.keys, buckets)
        cuts = np.flatnonzero(np.diff(of, prepend=np.uint64(buckets)))
        out: list[list] = [[], [], [], []]
        for a, b in zip(cuts, [*cuts[1:], len(of)], strict=True):
            keys = tokens.keys[a:b]
            gaps = np.diff(keys, prepend=np.uint64(0))
            for col, x in zip(out, (int(of[a]), _packed(gaps), _packed(rest[a:b]),
                                    _packed(deleted[a:b])), strict=True):
                col.append(x)
        chunk = docs["__chunk"][0].as_py()
        return pa.table({"bucket": pa.array(out[0], pa.int64()),
                         "chunk": pa.array([chunk] * len(cuts), pa.int64()),
                         "keys": pa.array(out[1], pa.large_binary()).cast(pa.binary()),
                         "rest": pa.array(out[2], pa.binary()),
                         "deleted": pa.array(out[3], pa.binary())})
    return run


def _answers(asked: pa.Table) -> pa.Table:
    rows = [np.cumsum(_unpacked(x.as_py(), np.uint64), dtype=np.uint64) for x in asked["keys"]]
    at = np.cumsum([0, *map(len, rows)])
    rest, deleted = (np.concatenate([_unpacked(x.as_py(), np.uint32) for x in asked[c]])
                     for c in ("rest", "deleted"))
    keys, where = np.unique(np.concatenate(rows), return_inverse=True)
    rest = np.bincount(where, rest, len(keys)).astype(np.uint64)
    total = rest + np.bincount(where, deleted, len(keys)).astype(np.uint64)
    word = keys & _ONE == _ONE
    chunk = asked["chunk"].to_pylist()
    made = [_packed(total[where[a:b]]) for a, b in zip(at, at[1:], strict=False)]
    # Only chunks of the deleted part need the counts without it.
    made_rest = [_packed(rest[where[a:b]]) if c < 0 else b"" for a, b, c in
                 zip(at, at[1:], chunk, strict=False)]
    sums = [int(total[word].sum()), int((total[word] > 0).sum()),
            int(rest[word].sum()), int((rest[word] > 0).sum())]
    k = len(chunk)
    return pa.table({"bucket": pa.array([*asked["bucket"].to_pylist(), asked["bucket"][0].as_py()],
                                        pa.int64()),
                     "chunk": pa.array([*chunk, None], pa.int64()),
                     "total": pa.array([*made, None], pa.binary()),
                     "rest": pa.array([*made_rest, None], pa.binary()),
                     **{c: pa.array([None] * k + [x], pa.int64())
                        for c, x in zip(("n", "v", "n_rest", "v_rest"), sums, strict=True)}})


def _gathered(answers: pa.Table, column: str) -> np.ndarray:
    """The answered counts in the order of a chunk's keys."""
    order = np.argsort(answers["bucket"].to_numpy())
    got = answers[column].to_pylist()
    return np.concatenate([np.empty(0, np.uint64), *(_unpacked(got[i], np.uint64) for i in order)])


def _histogram(n: int, v: int):
    """Of the tokens of the deleted part: (context bucket, ten times the rounded logarithm of
    the ratio of the estimates, null for a pair not seen; how many)."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(docs["__t"].to_pylist())
        _, context, pair, base = tokens.estimates(_gathered(answers, "rest"), n, v)
        known = context > 0
        bucket = frequency_bucket(context[known])
        with np.errstate(divide="ignore"):
            ratio = np.log(pair[known] / context[known] / base[known])
        step = np.where(pair[known] > 0, np.round(10 * ratio), -9999)
        cells, many = np.unique(np.stack([bucket, step.astype(np.int64)]), axis=1,
                                return_counts=True)
        return pa.table({"bucket": cells[0], "step": cells[1], "many": many})
    return run


def learn_weights(cells: list[tuple[int, int, int]], rounds: int = 200) -> dict[int, float]:
    """Expectation-maximisation: a weight for each bucket from (bucket, step, how many)."""
    weights = {}
    for bucket in sorted({c[0] for c in cells}):
        step, many = (np.array([c[k] for c in cells if c[0] == bucket], float) for k in (1, 2))
        ratio = np.where(step == -9999, 0.0, np.exp(np.minimum(step, 3000) / 10))
        weight = 0.5
        for _ in range(rounds):
            new = (many * (weight * ratio / (weight * ratio + 1 - weight))).sum() / many.sum()
            if abs(new - weight) < 1e-9:
                break
            weight = new
        weights[bucket] = min(float(weight), 0.999999)  # the base keeps a share
    return weights


def _scores(n: int, v: int, weights: dict[int, float], id_col: str):
    table = np.zeros(256)
    last = 0.0
    for b in range(256):  # a bucket without data has the weight of the next smaller one
        last = table[b] = weights.get(b, last)

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(docs["__t"].to_pylist())
        c, context, pair, base = tokens.estimates(_gathered(answers, "total"), n, v)
        weight = np.where(context > 0, table[frequency_bucket(context)], 0.0)
        mixed = weight * pair / np.maximum(context, 1) + (1 - weight) * base
        add = lambda x: np.add.reduceat(x, tokens.starts) if len(x) else x
        return pa.table({
            id_col: docs["__id"], "part": docs["__part"], "n_tokens": pa.array(tokens.sizes),
            "n_known": pa.array(add((c > 0).astype(np.int64)), pa.int64()),
            "train_tokens": pa.array(np.full(len(docs), n), pa.int64()),
            "base_score": pa.array(add(np.log10(base)), pa.float64()),
            "score": pa.array(add(np.log10(mixed)), pa.float64())})
    return run


def lm_scores(docs: DataFrame, held_out: Column, deleted: Column, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``held_out``: rows not learned from; ``deleted``: training rows for the weights.
    """
    text = text_of(text_col)
    size = docs.agg(F.sum(F.octet_length(text).cast("long") + 1)).first()[0] or 1
    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    buckets = max(8, math.ceil(size / 5 / BUCKET_KEYS))
    part = (F.when(F.coalesce(held_out, F.lit(False)), 0)
            .when(F.coalesce(deleted, F.lit(False)), 1).otherwise(2))
    by = F.xxhash64(F.col(id_col), text)
    dealt = docs.select(F.col(id_col).alias("__id"), text.alias("__t"), part.alias("__part"),
                        F.when(part == 1, -1 - F.pmod(by, F.lit(math.ceil(chunks / 10))))
                        .otherwise(F.pmod(by, F.lit(chunks))).alias("__chunk"))
    asked = dealt.groupBy("__chunk").applyInArrow(
        _requests(buckets), "bucket long, chunk long, keys binary, rest binary, deleted binary")
    answers = stored(asked.groupBy("bucket").applyInArrow(
        _answers, "bucket long, chunk long, total binary, rest binary, "
                  "n long, v long, n_rest long, v_rest long"), "lm_counts")
    n, v, n_rest, v_rest = (x or 0 for x in answers.filter("chunk is null").agg(
        *[F.sum(c) for c in ("n", "v", "n_rest", "v_rest")]).first())

    def with_answers(rows: DataFrame, wanted: Column):
        got = answers.filter(wanted).select("chunk", "bucket", "total", "rest")
        return rows.groupBy("__chunk").cogroup(got.groupBy("chunk"))

    cells = (with_answers(dealt.filter("__chunk < 0"), F.col("chunk") < 0)
             .applyInArrow(_histogram(n_rest, v_rest), "bucket long, step long, many long")
             .groupBy("bucket", "step").agg(F.sum("many").alias("many")).collect())
    weights = learn_weights([(r.bucket, r.step, r.many) for r in cells])
    kind = dealt.schema["__id"].dataType.simpleString()
    scored = with_answers(dealt, F.col("chunk").isNotNull()).applyInArrow(
        _scores(n, v, weights, id_col),
        f"`{id_col}` {kind}, part int, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
    return scored.select(id_col, (F.col("part") == 0).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")
