import random

import pyarrow as pa
import pytest

from netlens.llm import decontam
from netlens.llm.decontam import alignment, contaminated_pairs, words_of
from netlens.llm.queries import op9_decontamination
from tests.conftest import SF001

from .conftest import with_clashes


def plain_alignment(item, passage):
    best, rows = 0, [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if a == b else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best / (2 * len(item))


def test_alignment_is_smith_waterman():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 12))] for _ in range(2))
        assert alignment(a, b)[0] == plain_alignment(a, b)
    assert alignment("a b c".split(), "x a b c y".split()) == (1.0, 1, 4)


ITEM = "what is the name of the largest river that flows through the old town of the valley"


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, "tiny item"), (3, None), (4, ""), (1, ITEM), (None, "only null id here"),
                                  (5, "a completely different question about the price of green apples")],
                                 "item_id long, text string")


def test_copies(make_docs, benchmark):
    words = ITEM.split()
    edited = " ".join("EDIT" if k in (4, 9) else w for k, w in enumerate(words))
    shorter = " ".join(w for k, w in enumerate(words) if k not in (3, 8))
    rows = [(1, f"Before it. {ITEM.title()}! After it."), (2, f"x y {edited} z"), (3, f"{shorter} and so on"),
            (4, "the name of the river is not given here, the old town is far"), (5, "a TINY, item!"), (6, None),
            (7, ""), (8, "filler " * 4000 + ITEM + " filler" * 4000), (9, ITEM), (9, ITEM), (10, "only null id here"),
            *[(k, f"hot copy {ITEM}") for k in range(100, 200)]]
    docs = with_clashes(make_docs(rows), "item_id", "score", "gram", "h")
    got = {(r.doc_id, r.item_id) for r in contaminated_pairs(docs, benchmark).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (5, 2), (8, 1), (9, 1), (10, None), *((k, 1) for k in range(100, 200))}


def test_edited_copies_of_a_hot_item(spark, make_docs):
    rng, item = random.Random(5), [f"item{k}" for k in range(40)]
    rows = [(i, " ".join(f"x{rng.randrange(10 ** 6)}" if rng.random() < 0.22 else w for w in item))
            for i in range(1000)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    want = {i for i, t in rows if alignment(item, t.split())[0] >= 0.5}
    assert {r.doc_id for r in contaminated_pairs(make_docs(rows), items, least_seeds=2).collect()} == want


def test_a_phrase_that_all_share_makes_few_pairs(spark, make_docs, monkeypatch):
    """40 items and 300 documents with one phrase in common: 6 documents hold a copy."""
    rng = random.Random(9)

    def text(n):
        return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    items = [(i, f"{text(10)} in the end of the day {text(10)}") for i in range(40)]
    rows = [(d, f"{text(30)} in the end of the day {text(30)}") for d in range(300)]
    rows += [(1000 + d, f"{text(20)} {items[d][1]} {text(20)}") for d in range(6)]
    made, plain = [], decontam._pairs

    def counted(*args):
        made.append(plain(*args))
        return made[-1]
    monkeypatch.setattr(decontam, "_pairs", counted)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated_pairs(make_docs(rows), bench).collect()}
    assert got == {(1000 + d, d) for d in range(6)}
    assert made[0].count() <= 0.01 * 40 * len(rows)


def test_empty_tables(make_docs, benchmark):
    assert contaminated_pairs(make_docs([]), benchmark).count() == 0
    assert contaminated_pairs(make_docs(), benchmark.limit(0)).count() == 0


def test_query(spark):
    items = [(r.item_id, words_of(r.text)) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        words = words_of(r.text)
        want |= {(r.doc_id, i) for i, w in items if alignment(w, words)[0] >= 0.5}
    assert want and {(r.doc_id, r.item_id) for r in op9_decontamination(spark, SF001).collect()} == want


def test_words_are_hashed_together():
    """Texts of a chunk are cut as words_of cuts each, and equal words only have equal hashes."""
    rng = random.Random(4)
    signs = "aAbZ09_ \n\t.,-'ßéÉİΣσςİ́­дЖ漢字٣½²\U0001f600\U00010400\0"
    texts = ["", "ΟΔΟΣ", "\n", "x", *("".join(rng.choices(signs, k=rng.randrange(60))) for _ in range(500)), ""]
    words = [(t, w) for t, text in enumerate(texts) for w in words_of(text)]
    h, of = decontam.word_hashes(texts)
    assert of.tolist() == [t for t, _ in words]
    assert len(set(zip(h.tolist(), (w for _, w in words), strict=True))) == len(set(h.tolist())) == len({w for _, w in words})
    alone = [x for t in texts for x in decontam.word_hashes([t])[0].tolist()]
    assert h.tolist() == alone


def test_chunks_and_ends_of_texts(make_docs, benchmark, monkeypatch):
    """Chunks of any size keep every row once; no n-gram reaches over the end of a text."""
    column = pa.array(["", "a b", "c" * 30, "", "d e f", ""])
    for size in (1, 5, 32, 1 << 18):
        monkeypatch.setattr(decontam, "CHUNK", size)
        assert [(top + i, t) for top, texts in decontam._chunks(column) for i, t in enumerate(texts)] == list(
            enumerate(column.to_pylist()))
    words = ITEM.split()
    halves = [(k, " ".join(words[:9] if k % 2 else words[9:])) for k in range(20)]
    rows = [*halves, (100, f"one two {ITEM}"), *halves, (101, ITEM)]
    got = {(r.doc_id, r.item_id, r.first_word, r.end_word)
           for r in contaminated_pairs(make_docs(rows).coalesce(1), benchmark, min_score=0.9).collect()}
    assert got == {(100, 1, 2, 2 + len(words)), (101, 1, 0, len(words))}
