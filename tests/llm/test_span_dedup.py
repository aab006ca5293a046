import random
from collections import defaultdict

from netlens.llm.queries import op7_span_dedup
from netlens.llm.span_dedup import sentences, span_dedup
from tests.conftest import SF001, SF01

from .conftest import LONG, rows_with_edge_cases, with_clashes


def brute(rows, within=True):
    """{(id, text): (new text, removed)} from every shortest run that is long enough; unless
    ``within``, the document of a span's first place keeps all of it."""
    rows = {(i, t or "") for i, t in rows}
    places, gone = defaultdict(list), defaultdict(set)
    for d in rows:
        keys = [d[1][a:b].lower().split() for a, b in sentences(d[1])]
        size = [0]
        for k in keys:
            size.append(size[-1] + len(k))

        def enough(a, b, size=size):
            n = size[b + 1] - size[a]
            return n >= 50 or n >= 25 and b - a >= 2
        runs = set()
        for i in range(len(keys)):
            runs.update((i, b) for b in list(range(i, min(len(keys), i + 60))) if enough(i, b)
                        and not (b > i and enough(i, b - 1)))
            runs.update((a, i) for a in range(max(0, i - 60), i + 1) if enough(a, i)
                        and not (a < i and enough(a + 1, i)))
        for a, b in runs:
            places[" ".join(w for k in keys[a:b + 1] for w in k)].append((d, a, b))
    for found in places.values():
        first = min(found, key=lambda f: (f[0][0] is not None, f[0][0] or 0, f[1]))
        for d, a, b in found:
            if (d, a) != first[:2] if within else d != first[0]:
                gone[d].update(range(a, b + 1))
    return {d: ("".join(d[1][a:b] for k, (a, b) in enumerate(sentences(d[1])) if k not in gone[d]),
                len(gone[d])) for d in rows}


def check(docs, rows, within=True):
    want = brute(rows, within)
    got = span_dedup(docs, within=within).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.text, r.n_removed) in [want[i, t or ""] for i, t in rows if i == r.doc_id]


PASSAGE = " ".join(f"shared{i}" for i in range(30)) + ". " + " ".join(f"more{i}" for i in range(25)) + "."


def test_edge_cases(make_docs):
    check(with_clashes(make_docs(), "hi", "__h", "n_removed"), [r[:2] for r in rows_with_edge_cases()])


def test_passages_of_over_fifty_words(make_docs):
    rows = [(5, f"Own start here. {PASSAGE} Own end."), (2, f"Another one! {PASSAGE} And its end."),
            (9, PASSAGE), (11, PASSAGE + "\n" + PASSAGE), (12, LONG), (13, "short. repeat."),
            (14, "short. repeat.")]
    check(make_docs(rows), rows)
    out = {r.doc_id: r.text for r in span_dedup(make_docs(rows)).collect()}
    assert out[2] == rows[1][1] and out[5] == "Own start here. Own end." and out[9] == out[11] == ""
    assert out[13] == out[14] == "short. repeat."


def test_empty_table(make_docs):
    assert span_dedup(make_docs([])).count() == 0


def test_sentences_make_up_the_text():
    for t in ("", "a", " a. b", "a.\n\nb! c?", "...", "\n", "1.5 is. x"):
        assert "".join(t[a:b] for a, b in sentences(t)) == t


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = brute(rows, within=False)
    got = {r.doc_id: (r.text, r.n_removed) for r in op7_span_dedup(spark, SF001).collect()}
    assert got == {i: v for (i, _), v in want.items()}


def test_repeats_within_a_document_stay_if_asked(make_docs):
    rows = [(1, (PASSAGE + "\n") * 3), (2, "Own words. " + PASSAGE), (3, "over and over. " * 40)]
    check(make_docs(rows), rows, within=False)
    out = {r.doc_id: r.n_removed for r in span_dedup(make_docs(rows), within=False).collect()}
    assert out[1] == out[3] == 0 and out[2] > 0


def test_passages_cut_at_any_word(spark):
    """Passages that begin and end at any word of a text, put anywhere into two hosts: 95 in 100
    of 60 words are found, and at most 1 in 100 hosts without one loses anything."""
    rng = random.Random(11)
    texts = [r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()
             if r.text and len(r.text.split()) > 150]
    texts = sorted(set(texts))
    rng.shuffle(texts)
    hosts, sources = texts[:300], texts[300:400]
    before = span_rows(spark, list(enumerate(hosts)))
    planted = list(hosts)
    for k, text in enumerate(sources):
        words = text.split(" ")
        at = rng.randrange(max(1, len(words) - 60))
        for h in (2 * k, 2 * k + 1):
            into = planted[h].split(" ")
            cut = rng.randrange(len(into))
            planted[h] = " ".join(into[:cut] + words[at:at + 60] + into[cut:])
    after = span_rows(spark, list(enumerate(planted)))
    fresh = [k for k in range(100) if not before[2 * k + 1]]
    assert len(fresh) > 70 and sum(after[2 * k + 1] > 0 for k in fresh) >= 0.95 * len(fresh)
    runs = {tuple(w[i:i + 12]) for w in map(str.split, sources) for i in range(len(w) - 11)}
    clean = [h for h in range(200, 300) if not before[h]
             and not any(tuple(w[i:i + 12]) in runs for w in [hosts[h].split()] for i in range(len(w) - 11))]
    assert len(clean) > 70
    assert sum(after[h] > 0 for h in clean) <= 0.01 * len(clean)


def span_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    return {r.doc_id: r.n_removed for r in span_dedup(docs, within=False).collect()}
