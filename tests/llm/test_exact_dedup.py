import hashlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from netlens.llm.common import bit_array, bit_table, probe
from netlens.llm.exact_dedup import exact_dedup
from netlens.llm.queries import REGISTRY
from tests.conftest import SF001

from .conftest import rows_with_edge_cases, with_clashes


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep))
    return sorted(out, key=str)


def test_edge_cases_match_brute_force(make_docs):
    docs = with_clashes(make_docs(), "keep_id", "kept", "group_size", "__n", "__t")
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()]
    assert sorted(got, key=str) == brute(rows_with_edge_cases())


def test_same_length_and_prefix_are_told_apart(make_docs):
    a, b = "x" * 500 + "a", "x" * 500 + "b"
    got = {r.doc_id: r.group_size for r in exact_dedup(make_docs([(1, a), (2, b), (3, a)])).collect()}
    assert got == {1: 2, 2: 1, 3: 2}


def test_empty_table(make_docs):
    assert exact_dedup(make_docs([])).count() == 0


def test_query_matches_sql(spark):
    fn, sql = REGISTRY["op6_exact_dedup"]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF001}/documents.parquet')")
    got, want = fn(spark, SF001), con.execute(sql).df()
    assert sorted(map(tuple, got.toPandas()[list(want.columns)].values.tolist())) == sorted(
        map(tuple, want.values.tolist()))
    assert got.filter(F.col("text_sha256").isNull()).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_main_path_has_no_python(make_docs):
    plan = exact_dedup(make_docs())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_bit_table_never_misses(spark):
    keys = spark.range(-500, 500).select(F.xxhash64("id").alias("k"))
    words = bit_array(keys, "k", 1 << 12)
    import numpy as np
    hashes = np.array([r.k for r in keys.collect()], np.int64).view(np.uint64)
    assert probe(words, hashes).all()
    assert bit_table(keys, "k", 1 << 12).count() <= (1 << 12) // 64
