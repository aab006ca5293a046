"""The stages against what the operators' own tests establish, each on its own input."""

import base64

import corpus_pipeline as P
from netlens.llm import bpe
from netlens.llm.common import stored, taken_over
from tests.conftest import SF01

from .conftest import with_clashes
from .test_line_dedup import brute as brute_lines
from .test_simhash import brute_components


def test_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    for name, stage in P.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stored(stage(spark, docs, SF01), "t")
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before)
        if name != "byte_bpe":
            assert out.columns == docs.columns
        if name == "line_dedup":
            want = brute_lines(list(before.items()))
            assert {i: r.text for i, r in after.items()} == {i: t for (i, _), t in want.items()} | {
                i: t for i, t in before.items() if not t}
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "simhash_near_dedup":
            assert set(after) == {c for _, _, c in brute_components(list(before.items()))}
        elif name in ("toxicity", "decontamination"):
            assert 0.85 * len(before) < len(after) < len(before)
            assert all(r.text == before[i] for i, r in after.items())
        else:
            assert set(after) == set(before)
        docs = out


def test_edge_cases(spark, make_docs):
    docs = with_clashes(make_docs(), "score", "component_id", "text_hash", "n_removed")
    for name, stage in P.STAGES:
        out = stored(stage(spark, docs, SF01), "t")
        if name != "byte_bpe":
            assert out.columns == docs.columns
        docs = out
    assert docs.count() > 0


def test_empty_table(spark, make_docs):
    docs = make_docs([])
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF01), "t")
    assert docs.count() == 0


def test_workers_forget_other_operators():
    """A Python worker that goes on to another operator drops the token coder."""
    vocab = b"".join(b"%s %d\n" % (base64.b64encode(bytes([i])), i) for i in range(256))
    coder = bpe._coder(vocab, r"\S+|\s+")
    taken_over("bpe", bpe._forget)
    taken_over("bpe", bpe._forget)
    assert bpe._coder(vocab, r"\S+|\s+") is coder
    taken_over("decontam")
    assert bpe._coder.cache_info().currsize == 0
