import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from netlens.llm import lm_score as L
from netlens.llm.queries import op2_deleted_interpolation
from tests.conftest import SF001

from .conftest import rows_with_edge_cases, with_clashes


def brute(rows):
    """The rows of the query, from plain counters; rows: (id, text)."""
    low = [(i, re.findall(r"[^\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + ["END"]) for i, t in rows]
    part = [2 if i is None else {0: 0, 1: 1}.get(zlib.crc32(str(i).encode()) % 10, 2) for i, _ in low]

    def count(parts):
        one, two = Counter(), Counter()
        for (_, w), p in zip(low, part, strict=True):
            if p in parts:
                one.update(w)
                two.update(zip(["BEGIN", *w], w, strict=False))
        one["BEGIN"] = one["END"]
        return one, two, sum(v for k, v in one.items() if k != "BEGIN"), sum(v > 0 for k, v in one.items() if k != "BEGIN")

    def parts_of(w, model):
        one, two, n, v = model
        for h, x in zip(["BEGIN", *w], w, strict=False):
            yield one[h], (two[h, x] / one[h] if one[h] else 0), (one[x] + .1) / (n + .1 * (v + 1))

    cells = Counter()
    for (_, w), p in zip(low, part, strict=True):
        if p == 1:
            for c, p2, p1 in parts_of(w, count({2})):
                if c:
                    cells[math.floor(2 * math.log2(c)), round(10 * math.log(p2 / p1)) if p2 else -9999] += 1
    weights = L.learn_weights([(*k, v) for k, v in cells.items()])
    full = count({1, 2})
    out = []
    for (i, w), p in zip(low, part, strict=True):
        base = score = 0.0
        for c, p2, p1 in parts_of(w, full):
            b = math.floor(2 * math.log2(c)) if c else None
            lam = next((weights[k] for k in range(b, -1, -1) if k in weights), 0.0) if c else 0.0
            base += math.log10(p1)
            score += math.log10(lam * p2 + (1 - lam) * p1)
        out.append((i, p == 0, len(w), sum(full[0][x] > 0 for x in w), full[2], base, score))
    return sorted(out, key=str)


def same(got, want):
    got = sorted(map(tuple, got), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), round(r[5], 3))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def parts():
    rem = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    return rem == 0, rem == 1


def test_edge_cases(make_docs, monkeypatch):
    docs = with_clashes(make_docs(), "score", "__t", "part")
    same(L.lm_scores(docs, *parts()).collect(), brute([r[:2] for r in rows_with_edge_cases()]))


def test_empty_table(make_docs):
    assert L.lm_scores(make_docs([]), *parts()).count() == 0


def test_nothing_to_learn_from(make_docs):
    out = L.lm_scores(make_docs([(1, "a b"), (2, None)]), F.lit(True), F.lit(False)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out} == {
        (1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)}


def test_query_and_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(L, "BUCKET_KEYS", 3_000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = op2_deleted_interpolation(spark, SF001)
    same(got.collect(), brute(rows))
    better = got.filter("held_out").agg(F.sum(F.col("score") - F.col("base_score"))).first()[0]
    assert better > 0


def test_weights_by_expectation_maximisation():
    assert L.learn_weights([(3, -9999, 100)])[3] < 0.02
    assert L.learn_weights([(3, 40, 100)])[3] > 0.98
    w = L.learn_weights([(3, 40, 50), (3, -9999, 50)])[3]
    assert w == pytest.approx(0.5, abs=0.02)


def test_packing():
    a = np.array([0, 1, 2**40, 5], np.uint64)
    assert (L._unpacked(L._packed(a), np.uint64) == a).all()
