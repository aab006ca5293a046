import itertools
import re
from collections import Counter

import numpy as np
import pytest
from netlens.llm import line_labels as ll
from netlens.llm.common import table
from netlens.llm.queries import op13_line_quality, remainder
from pyspark.sql import functions as F

from .conftest import rows_with_edge_cases, with_clashes

SF1 = "/root/testdata/sf0.1"


def base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), by definition."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside))


def random_model(seed):
    rng = np.random.default_rng(seed)
    return ll.LineModel(rng.normal(size=ll.N_BINS), rng.normal(size=(2, 2)))


def paths(scores, step):
    return {p: sum(s * b for s, b in zip(scores, p)) + sum(step[a, b] for a, b in zip(p, p[1:]))
            for p in itertools.product((0, 1), repeat=len(scores))}


def test_viterbi_matches_enumeration():
    rng = np.random.default_rng(1)
    for seed in range(40):
        model, scores = random_model(seed), rng.normal(size=1 + seed % 8)
        of = paths(scores, model.step)
        assert tuple(model.decode(scores).astype(int)) == max(of, key=of.get)
    assert len(random_model(1).decode(np.zeros(0))) == 0


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(2)
    step, sizes = rng.normal(size=(2, 2)), [1, 3, 6]
    scores, real = np.zeros((3, 6)), np.zeros((3, 6), bool)
    for k, n in enumerate(sizes):
        scores[k, :n], real[k, :n] = rng.normal(size=n), True
    total, content, pairs = ll._expected(scores, real, step)
    want = np.zeros((2, 2))
    for k, n in enumerate(sizes):
        of = paths(scores[k, :n], step)
        z = np.log(sum(np.exp(v) for v in of.values()))
        assert np.isclose(total[k], z)
        for t in range(n):
            assert np.isclose(content[k, t], sum(np.exp(v - z) for p, v in of.items() if p[t]))
        for p, v in of.items():
            for a, b in zip(p, p[1:]):
                want[a, b] += np.exp(v - z)
    assert np.allclose(pairs, want)


def test_fit_learns_runs():
    """Lines of one look belong to the run that they stand in."""
    rng, sequences, truth = np.random.default_rng(3), [], []
    for _ in range(300):
        label = np.repeat(rng.integers(0, 2, 3), rng.integers(5, 13, 3))
        seen = np.where(rng.random(len(label)) < 0.8, label, 1 - label)
        sequences.append(np.stack([off + seen for off in ll._OFFSETS], axis=1))
        truth.append(label.astype(float))
    model = ll.fit_field(sequences, truth, np.ones(len(sequences)))
    assert model.step[0, 0] + model.step[1, 1] > model.step[0, 1] + model.step[1, 0] + 1
    right = np.concatenate([model.decode(model.bins[s].sum(axis=1)) == t
                            for s, t in zip(sequences, truth)])
    assert right.mean() > 0.85


@pytest.mark.parametrize("words", ["a b a b a b a b", "a a a a a a", "a b c d e", "",
                                   "a b c d e x a b c d e y b c d e x", "é ß é ß é ß é"])
def test_repeated_words(words):
    assert ll.repeated_words(words.encode().split()) == base(words)[-1]


def test_base_statistics_match_definition(spark, make_docs):
    texts = ["x y z\nx y z\n\n \nx y z ", "a b c\x1cd\x85e", "## || <b>\r\n## || <b>\r\n&%$*",
             "one two three four five six " * 9, "ü" * 40 + "\n" + "ü" * 40, "tab\tvt\x0bff\x0ccr\r"]
    got = {r.doc_id: tuple(r)[1:6] for r in
           ll.label_lines(make_docs(list(enumerate(texts))), random_model(1)).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_edge_cases_clashes_and_empty_tables(spark, make_docs):
    docs = with_clashes(make_docs(), "kept", "n_words", "base_failed", "__t", "__id")
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    model = ll.fit_line_model(docs, labels, F.lit(True))
    out = ll.line_quality(docs, model).collect()
    rows = rows_with_edge_cases()
    assert Counter((r.doc_id, *tuple(r)[1:6]) for r in out) == Counter((r[0], *base(r[1])) for r in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
        assert 0 <= r.content_lines <= r.n_lines and 0 <= r.content_words <= r.n_words
    assert ll.fit_line_model(docs, labels.limit(0), F.lit(True)) is None
    kept = {r.doc_id: (r.kept, r.base_failed) for r in ll.line_quality(docs, None).collect()}
    assert all(k != f for k, f in kept.values())
    assert ll.line_quality(make_docs([]), model).count() == 0


def test_base_rules_at_their_limits(make_docs):
    nine, ten = " ".join("abcdefghi"), " ".join("abcdefghij")
    once = " ".join(f"w{i}" for i in range(38)) + " "
    at_20 = "a b c d e " + once + "a b c d e " + "z " * 2  # 10 of 50 words
    over = "a b c d e " + once + "a b c d e"  # 10 of 48 words
    got = {r.doc_id: r.base_failed for r in
           ll.line_quality(make_docs([(1, nine), (2, ten), (3, at_20), (4, over)]), None).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}


def test_held_out_documents(spark):
    """Clean documents that pass the base rules stay, bad ones go (labels not learnt from)."""
    got = (op13_line_quality(spark, SF1).filter(remainder(3) == 1)
           .join(table(spark, SF1, "labels"), "doc_id").collect())
    clean = [r.kept for r in got if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in got if r.quality == 0]
    assert len(clean) > 900 and np.mean(clean) >= 0.995
    assert len(bad) > 150 and np.mean(bad) <= 0.02
