import base64
import random

import public_tokenizers
import pytest
import tiktoken

from netlens.llm.bpe import WORDS, PrefixBPE, TextBPE, bpe_decode, bpe_digest, bpe_encode
from netlens.llm.queries import VOCAB, op5_byte_bpe
from tests.conftest import SF001

from .conftest import rows_with_edge_cases, with_clashes


@pytest.fixture(scope="module")
def ranks():
    with open(VOCAB, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def coder(ranks):
    return TextBPE(ranks, public_tokenizers.PATTERN)


PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'re", "'", "e", "é", "漢字", "😀", "12", "ß", " the",
         "er", "ing", "!?", " ", "\x1c", "\x85", "é", "​", "|", "$$$"]


def test_encodes_as_the_library(coder, library):
    assert WORDS == public_tokenizers.PATTERN
    rng = random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(25)))
        ids = coder.encode(text)
        assert ids == library.encode_ordinary(text), repr(text)
        assert coder.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, " " * 2000, "ab" * 1500, "!" * 999, "the " * 3000])
def test_long_pieces(coder, library, text):
    assert coder.encode(text) == library.encode_ordinary(text)


def test_unreachable_tokens_are_never_used():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"xyz": 257, b"abc": 258}
    bpe = PrefixBPE(ranks)
    assert bpe.encode(b"xyz") == [257]  # a whole pre-token of the vocabulary
    assert bpe.encode(b"xyzx") == bpe.merged(b"xyzx") == [120, 121, 122, 120]
    assert bpe.encode(b"abcab") == [258, 256]


def test_append_and_edit_equal_a_new_encoding(coder):
    bpe, rng = coder.bpe, random.Random(3)
    old = "".join(rng.choice("aetinsr xyz") for _ in range(600)).encode()
    table = bpe.prefixes(old)
    more = old + b"ending"
    assert bpe.prefixes(more, table) == bpe.prefixes(more)
    piece, edited, done = bpe.edited(old, table, 300, 305, b"QQQ")
    assert piece == old[:300] + b"QQQ" + old[305:]
    assert edited == bpe.prefixes(piece)
    assert done < 150  # only near the edit
    assert bpe.ids(piece, edited) == bpe.merged(piece)


def test_appended_text(coder):
    for a, b in [("it'", "re"), ("it'r", "e"), ("a ", " b"), ("x\n", "\ny"), ("", "abc"), ("ab", "")]:
        assert coder.appended(coder.split.findall(a), b) == coder.split.findall(a + b)


def test_rows(make_docs, library):
    docs = with_clashes(make_docs(), "token_ids", "decoded")
    out = bpe_decode(bpe_encode(docs, VOCAB, public_tokenizers.PATTERN), VOCAB)
    assert set(out.columns) == set(docs.columns)
    for r in out.collect():
        assert r.token_ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert out.count() == len(rows_with_edge_cases())
    none = bpe_digest(bpe_decode(bpe_encode(make_docs([]), VOCAB, WORDS), VOCAB))
    assert none.count() == 0


def test_query(spark, library):
    import hashlib
    rows = {r.doc_id: r for r in op5_byte_bpe(spark, SF001).collect()}
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        assert rows[r.doc_id].n_tokens == len(ids)
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_unknown_id():
    with pytest.raises(ValueError):
        TextBPE({bytes([i]): i for i in range(256)}, WORDS).decode([999])


def test_pairs_stay_as_merging_says(coder):
    """The quick test of a pair equals merging its bytes, also for pairs of equal tokens."""
    bpe, rng = coder.bpe, random.Random(7)
    usable = sorted(bpe._usable.values())
    pairs = [(a, a) for a in usable[:400]] + [(rng.choice(usable[:800]), rng.choice(usable)) for _ in range(4000)]
    for a, b in pairs:
        assert bpe._apart(a, b) == (bpe.merged(bpe.tokens[a] + bpe.tokens[b]) == [a, b])


def test_short_pieces_share_prefixes(ranks, library):
    """Words that begin alike make the entries of the common prefix once, and forgetting does not matter."""
    bpe = PrefixBPE(ranks)
    bpe.encode(b" onntingthe")
    known = dict(bpe._last_of)
    assert known and all(b" onntingthe".startswith(p) for p in known)
    assert bpe.encode(b" onntingthexq") == library.encode_ordinary(" onntingthexq")
    assert known.items() <= bpe._last_of.items()


def test_caches_are_bounded(ranks, library, monkeypatch):
    from netlens.llm import bpe as module
    for name in ("CACHED_RUNS", "KNOWN_PAIRS", "KNOWN_PREFIXES"):
        monkeypatch.setattr(module, name, 3)
    own, rng = TextBPE(ranks, WORDS), random.Random(9)
    for _ in range(200):
        text = " ".join("".join(rng.choice("aeinorst") for _ in range(rng.randrange(1, 18))) for _ in range(8))
        assert own.encode(text) == library.encode_ordinary(text)
    assert max(len(own._known), len(own._spaced), len(own.bpe._last_of)) <= 3


def test_columns_are_made_for_parts_of_a_batch(spark):
    import pyarrow as pa
    from pyspark.sql import types as T

    from netlens.llm.common import with_column
    made = with_column(spark.range(0, 2500, 1, 1), "rows", T.LongType(),
                       lambda b: pa.array([b.num_rows] * b.num_rows, pa.int64()))
    rows = made.collect()
    assert sorted(r.id for r in rows) == list(range(2500))
    assert {r.rows for r in rows} == {1000, 500}
