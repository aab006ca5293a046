import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np

from netlens.llm.queries import REGISTRY
from netlens.llm.resample import bucket_counts, bucket_gains, draw, resample
from tests.conftest import SF01

from .conftest import DOCS, rows_with_edge_cases, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_run):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return w, [" ".join(w[i:i + k]) for k in range(1, max_run + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, max_run=1, buckets=10000, min_words=20, percent=10):
    def bucket(f):
        return crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x, max_run)[1])
            for texts in ([r[1] for r in rows], target))
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for i, text in rows:
        words, found = features(text, max_run)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(words), len(found), weight, score))
    fit = sorted((r for r in out if r[1] >= min_words),
                 key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2]))
    drawn = fit[:percent * len(fit) // 100]
    place = {}
    for k, r in enumerate(drawn, 1):
        place.setdefault(r, []).append(k)
    return Counter((*r, place[r].pop(0) if place.get(r) else None) for r in out)


def result(df):
    return Counter(tuple(r) for r in df.select(
        df.columns[0], "n_words", "n_features", "weight", "score", "rank").collect())


def target_of(spark, texts):
    return spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "item_id long, text string")


def random_docs(seed, n):
    rng = random.Random(seed)
    vocabulary = ["Sea", "of", "x9", "9", "Été", "ß", "a.b", "-", "the", "THE", "zeal", "fox", "\x00", "\t"]
    return [(i, "\n".join(" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 5, 9])))
                          for _ in range(rng.randint(0, 9)))) for i in range(n)]


def test_random_texts_match_brute_force(spark):
    target = ["the zeal of the fox", "Sea\nsea sea", None]
    rows = random_docs(1, 200) + [(500 + i, "hot line of the sea\n" * 6) for i in range(100)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(5)
    for max_run, buckets, percent in ((1, 10000, 10), (3, 50, 40), (2, 1000, 100)):
        got = resample(docs, target_of(spark, target), max_run=max_run, buckets=buckets, percent=percent)
        assert result(got) == brute(rows, target, max_run, buckets, percent=percent)


def test_counts_of_runs_across_lines(spark):
    rows = random_docs(2, 60)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(3)
    for max_run in (1, 2, 4):
        want = Counter(crc32(f.encode()) % 97 for _, t in rows for f in features(t, max_run)[1])
        assert bucket_counts(docs, "text", max_run, 97).tolist() == [want[b] for b in range(97)]


def test_edge_cases_clashing_columns_and_empty_tables(spark, make_docs):
    rows = [(r[0], r[1]) for r in rows_with_edge_cases()]
    docs = with_clashes(make_docs(), "rank", "score", "weight", "n", "line", "__part")
    got = resample(docs, target_of(spark, ["over the lazy dog"]), min_words=1, percent=50)
    assert result(got) == brute(rows, ["over the lazy dog"], min_words=1, percent=50)
    assert resample(docs, target_of(spark, [])).count() == len(rows)
    assert resample(make_docs([]), target_of(spark, ["x"])).count() == 0


def test_ties_go_to_the_smaller_id_over_many_ranges(spark):
    rows = [(i, 30, 30, 0, 5 if i % 3 else 9) for i in range(1000)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = {r.doc_id: r.rank for r in draw(scored.repartition(7), percent=77).collect()}
    order = sorted(range(1000), key=lambda i: (-rows[i][4], i))
    assert got == {i: k + 1 if k < 770 else None for k, i in enumerate(order)}


def test_gains_are_rounded_down():
    gains = bucket_gains(np.array([3, 0, 7]), np.array([0, 2, 2]))
    assert gains.tolist() == [math.floor(1000 * math.log((t + 1) * 13 / ((s + 1) * 7)))
                              for s, t in ((3, 0), (0, 2), (7, 2))]


def test_query_matches_sql(spark):
    fn, sql = REGISTRY["op12_resample"]
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    df = fn(spark, SF01)
    want = Counter(tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall())
    assert Counter(map(tuple, df.collect())) == want and len(want) > 900
