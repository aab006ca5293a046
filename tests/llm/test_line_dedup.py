import re
from collections import defaultdict

from netlens.llm.line_dedup import line_dedup, suffix_rounds
from netlens.llm.queries import op4_line_dedup
from pyspark.sql import functions as F
from tests.conftest import SF001

from .conftest import rows_with_edge_cases, with_clashes

STRIP = " \t\r\n\f\v"


def brute(rows):
    """{(id, text): new text}: every run of two lines, or of one long one, that occurs at an
    earlier place is deleted."""
    docs = sorted({(i, t) for i, t in rows if t}, key=lambda r: (r[0] is not None, r[0] or 0, 0))
    units = {d: re.split(r"\n(?=[^\n]*\S)", d[1]) for d in docs}
    seen, gone = set(), defaultdict(set)
    for d in docs:
        keys = [u.strip(STRIP) for u in units[d]]
        for p in range(len(keys)):
            n = 1
            while p + n <= len(keys) and all(keys[p:p + n]) and tuple(keys[p:p + n]) in seen:
                if n > 1 or len(keys[p]) >= 10:
                    gone[d].update(range(p, p + n))
                n += 1
            seen.update(tuple(keys[p:p + m]) for m in range(1, min(40, len(keys) - p) + 1))
    return {d: "\n".join(u for k, u in enumerate(units[d]) if k not in gone[d]) if gone[d] else d[1]
            for d in docs}


def check(docs, rows):
    want = brute(rows)
    out = line_dedup(docs)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        source = [t for (i, t) in rows if i == r.doc_id]
        assert r.text in [want[r.doc_id, t] if t else t for t in source]
    return out


def test_edge_cases(make_docs):
    rows = [r[:2] for r in rows_with_edge_cases()]
    out = check(with_clashes(make_docs(), "__i", "__runs", "n_lines"), rows)
    assert "n_removed" in out.columns and "source" in out.columns


def test_runs_within_and_across(make_docs):
    body = [f"line number {i} of the body" for i in range(9)]
    rows = [(1, "\n".join(["a", *body, "b"])), (2, "\n".join(["own words here", *body[2:7], "x", "y"])),
            (3, "\n".join(["same line again"] * 21)), (4, "x\ny"), (5, "x"), (6, "\n\n" + body[0] + "\n\n\nz")]
    out = {r.doc_id: r.text for r in check(make_docs(rows), rows).collect()}
    assert out[2] == "own words here\nx\ny"
    assert out[3] == "same line again"
    assert out[4] == ""      # a run of two short lines
    assert out[5] == "x"     # one short line alone is no run
    assert out[6] == "\n\nz"


def test_ranks_are_in_suffix_order(spark):
    seq = "b a b a b a c a b".split()
    lines = spark.createDataFrame([(1, 0, i, w.encode(), 20) for i, w in enumerate(seq)],
                                  "__d long, __h long, __i int, __line binary, __chars int")
    rounds = suffix_rounds(lines)
    assert len(rounds) == 3  # runs of 4 repeat ("b a b a"), runs of 8 do not
    for k, r in enumerate(rounds):
        ranked = sorted((x["__r"], seq[x["__i"]:x["__i"] + (1 << k)]) for x in r.collect())
        assert [w for _, w in ranked] == sorted(w for _, w in ranked)


def test_empty_table(make_docs):
    assert line_dedup(make_docs([])).count() == 0


def test_query_and_plan(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = op4_line_dedup(spark, SF001)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {(r.doc_id, r.text) for r in out.collect()} == {(i, t) for (i, _), t in want.items()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert out.filter(F.col("n_removed") > 0).count() > 0
