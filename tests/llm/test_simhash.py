import itertools
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from netlens.llm import simhash as S
from netlens.llm.queries import op10_simhash
from tests.conftest import SF001

from .conftest import rows_with_edge_cases, with_clashes


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = sorted({brute_fingerprint(t) for _, t in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            root[find(a)] = find(b)
    least = {}
    for i, t in rows:
        if i is not None:
            r = find(brute_fingerprint(t))
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{brute_fingerprint(t):016x}", least.get(find(brute_fingerprint(t))))
                   for i, t in rows), key=str)


def hexed(df):
    df = df.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_edge_cases(make_docs):
    docs = with_clashes(make_docs(), "fp", "__h", "fingerprint", "component_id")
    assert hexed(S.simhash_groups(docs)) == brute_components([r[:2] for r in rows_with_edge_cases()])


def test_empty_table(make_docs):
    assert S.simhash_groups(make_docs([])).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id)
                  for r in op10_simhash(spark, SF001).collect()), key=str)
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def crowded(seed, n):
    """Fingerprints of which most differ in few bits from one of three."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    out = base[rng.integers(0, 3, n)]
    for _ in range(4):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(np.concatenate([out, rng.integers(0, 2**63, 40, dtype=np.uint64)]))


def test_descent_finds_all_pairs():
    for seed in range(4):
        a = crowded(seed, 150)
        i, j = S.descend(a, a, 0, 2, True)
        got = [tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True)]
        want = {(x, y) for x, y in itertools.combinations(range(len(a)), 2)
                if int(a[x] ^ a[y]).bit_count() <= 2}
        assert len(got) == len(set(got)) and set(got) == want


def test_crowded_nodes_are_split_and_lose_nothing(spark):
    a = crowded(9, 250)
    fps = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long")
    nodes = S.trie_nodes(fps, leaf=8)
    assert nodes.selectExpr("max(size(fps)) <= 8 and sum(size(fps)) = " + str(len(a))).first()[0]
    stars = S.components(S.links(nodes, S.node_pairs(nodes)))
    got = {r.u: r.root for r in stars.collect()}
    signed = a.view(np.int64)
    root = {int(x): int(x) for x in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for x, y in itertools.combinations(range(len(a)), 2):
        if int(a[x] ^ a[y]).bit_count() <= 2:
            u, v = find(int(signed[x])), find(int(signed[y]))
            root[max(u, v)] = min(u, v)
    assert got == {p: find(p) for p in root if find(p) != p}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "u long, v long")
    assert {(r.u, r.root) for r in S.components(edges).collect()} == {(i, 0) for i in range(1, 61)}
