import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from netlens.llm import collocation
from netlens.llm.collocation import collocations, frequent_phrases
from netlens.llm.queries import REGISTRY
from tests.conftest import SF01

from .conftest import DOCS, rows_with_edge_cases, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, max_words=5):
    """{lang: Counter of phrases}, {lang: words}."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, support, top=None):
    f, n = counted(rows)
    out = []
    for lang, of in f.items():
        often = {p: a for p, a in of.items() if a >= support}
        explained = {p[i:j] for p in often for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                     if j - i < len(p) and often[p] >= often[p[i:j]]}
        found = []
        for p, a in often.items():
            if len(p) > 1 and p not in explained:
                score, _, l, r = min((1000 * a * n[lang] // (of[p[:k]] * of[p[k:]]), k, of[p[:k]], of[p[k:]])
                                     for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, lang, "s", None) for i, (t, lang) in enumerate(rows)],
                                 DOCS).repartition(parts)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["The", "sea", "of", "éa", "É", "x.y", "red", "fox", "run,", "a\tb", "über", "\x00", "end!"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 30))), rng.choice(["en", "de", None]))
            for _ in range(n)]


def test_random_texts_match_brute_force(spark):
    for seed, support in ((1, 5), (2, 20)):
        rows = random_rows(seed)
        assert result(collocations(frame(spark, rows), support, top=None)) == brute(rows, support)
        assert result(collocations(frame(spark, rows), support, top=7)) == brute(rows, support, 7)


def test_every_shard_count_and_buffer_give_the_same(spark, monkeypatch):
    rows = random_rows(3)
    want = brute(rows, 8)
    for shards in (1, 3, 50):
        assert result(collocations(frame(spark, rows, 9), 8, top=None, shards=shards)) == want
    monkeypatch.setattr(collocation, "MAX_BITS", 1 << 6)  # full tables: exact all the same
    assert result(collocations(frame(spark, rows, 9), 8, top=None)) == want


def test_a_long_text_is_cut_at_piece_ends_only():
    text = (" ".join(f"w{i % 7}" for i in range(200)) + ". ").encode() * 50
    whole = list(collocation._chunks([text, b"end"]))
    collocation_chunk, collocation.CHUNK = collocation.CHUNK, 1000
    try:
        parts = list(collocation._chunks([text, b"end"]))
    finally:
        collocation.CHUNK = collocation_chunk
    assert len(whole) == 1 and len(parts) > 20 and all(p.endswith(b".") for p in parts[:-1])
    assert b"".join(parts).replace(b".", b"") == whole[0].replace(b".", b"")


def test_one_hot_text_and_repeated_rows(spark):
    rows = [("alpha beta gamma delta epsilon zeta", "en")] * 400 + random_rows(5, 100)
    assert result(collocations(frame(spark, rows), 30, top=None)) == brute(rows, 30)


def test_edge_cases_clashing_columns_and_empty_table(spark, make_docs):
    docs = with_clashes(make_docs(), "phrase", "k", "a", "n", "shard", "key")
    rows = [(r[1], r[2]) for r in rows_with_edge_cases()]
    assert result(collocations(docs, 3, top=None)) == brute(rows, 3)
    assert collocations(make_docs([])).count() == 0
    assert collocations(make_docs([(1, None), (2, "")]), 1).count() == 0


def test_scores_beyond_64_bits(spark):
    """Counts whose products pass 64 bits are divided exactly."""
    rows = [(3 * 10**9, 4 * 10**13, 5 * 10**9, 7 * 10**9 + 1), (10**10, 9 * 10**13, 10**10, 10**10),
            (2**40 + 1, 2**46 - 1, 2**41 + 3, 2**42 + 5)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select(
        "a", "n", "l", "r", collocation._score().alias("score")).collect()
    assert [v.score for v in got] == [1000 * v.a * v.n // (v.l * v.r) for v in got]


def test_all_frequent_phrases(spark):
    rows = random_rows(7)
    f, n = counted(rows)
    phrases, totals = frequent_phrases(frame(spark, rows), 10)
    assert {(r.lang, r.phrase): r.a for r in phrases.collect()} == {
        (lang, " ".join(p)): a for lang, of in f.items() for p, a in of.items() if a >= 10}
    assert {r.lang: r.n for r in totals.collect()} == {lang: c for lang, c in n.items() if c}


def test_query_matches_sql(spark):
    fn, sql = REGISTRY["op11_collocations"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = sorted(tuple(r[names.index(c)] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
                  for r in cur.fetchall())
    got = result(fn(spark, SF01))
    assert got == want and len(got) > 20


def test_counts_leave_a_task_in_small_batches(monkeypatch):
    from netlens.llm import collocation as module
    monkeypatch.setattr(module, "ROWS", 4)
    counts = module._Counts()
    counts.add(("en", 1), np.array([5, 5, 7, 9, 11, 13, 15], np.uint64))
    counts.add(("en", 1), np.array([7, 1], np.uint64))
    batches = list(counts.rows())
    assert [b.num_rows for b in batches] == [4, 3]
    rows = [r for b in batches for r in b.to_pylist()]
    assert {r["key"]: r["n"] for r in rows} == {1: 1, 5: 2, 7: 2, 9: 1, 11: 1, 13: 1, 15: 1}
    assert {(r["lang"], r["shard"]) for r in rows} == {("en", 1)}
    assert not counts.parts and not counts.size
