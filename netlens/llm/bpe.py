"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Within one pre-token, every byte prefix has exactly one valid encoding, so the
last token of that encoding is all that must be stored per prefix.  The last token
of prefix ``i`` is the one vocabulary token ``t`` ending at ``i`` for which
``(last token of the prefix before t, t)`` is a pair that merging would leave as it
is.  The encoding is read back from the end.  As a prefix's entry depends on the
bytes before it only, appending computes the new entries and keeps the old ones;
after an edit, entries are computed until they agree with the old ones over the
length of the longest token, from where all later ones agree.

Of a short pre-token only the entries are made that reading it back comes upon.  They are
remembered by the prefix's bytes, so words that begin alike share them.

Spark deals out the documents; each task encodes its Arrow batches.  The vocabulary
is one file with a fixed number of tokens.  The driver reads it (``MAX_VOCAB_BYTES``
is checked) and broadcasts the bytes.

Defined results: null text is encoded as empty text, and empty text has no ids.
Rows are independent, so repeated rows get equal ids.  All other columns are kept;
a column that has the output's name is replaced.  An empty table gives an empty
result.  Decoding null ids gives no bytes; an id outside the vocabulary raises
ValueError.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import taken_over, with_column

MAX_VOCAB_BYTES = 64 << 20
#: Bounds on what a Python worker remembers; they bound memory, not results.
CACHED_RUNS, KNOWN_PAIRS, KNOWN_PREFIXES = 300_000, 300_000, 100_000
#: Bytes up to which a pre-token's prefixes are remembered.
SHORT = 64


def read_ranks(vocab: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in (x.split() for x in vocab.splitlines() if x)}


class PrefixBPE:
    """Encoder of single pre-tokens (bytes) over ``ranks``: token bytes -> id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._none = max(ranks.values(), default=0) + 1  # a rank behind all others
        # All usable tokens that end at each byte, found in one pass over a piece.  A token
        # that merging its own bytes does not end in never ends a prefix.
        self._ending = ahocorasick.Automaton()
        self._usable: dict[bytes, int] = {}
        self._reach: dict[bytes, int] = {}  # last three bytes -> the longest token that ends so
        self._halves: dict[int, tuple[int, int]] = {}  # the two tokens that a token's last merge joins
        for t, i in ranks.items():
            parts, halves = self._merge(t)
            if parts == [t]:
                self._ending.add_word(t.decode("latin-1"), (len(t), i))
                self._usable[t] = i
                self._reach[t[-3:]] = max(len(t), self._reach.get(t[-3:], 2))
                if halves:
                    self._halves[i] = ranks[halves[0]], ranks[halves[1]]
        if len(self._ending):
            self._ending.make_automaton()
        self._kept: dict[int, bool] = {}  # by first token * self._none + second
        self._last_of: dict[bytes, int] = {}

    def merged(self, piece: bytes) -> list[int]:
        """The definition: merge the pair of lowest rank, leftmost first, until none is left."""
        return [self.ranks[p] for p in self._merge(piece)[0]]

    def _merge(self, piece: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """The parts that merging ends in, and the two that the last merge joined."""
        parts, joined = [piece[i:i + 1] for i in range(len(piece))], None
        rank, none = self.ranks.get, self._none
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            joined = parts[i], parts[i + 1]
            parts[i:i + 2] = [joined[0] + joined[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
        return parts, joined

    def _stays(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` ends in just these two."""
        if len(self._kept) > KNOWN_PAIRS:
            self._kept.clear()
        ok = self._kept[a * self._none + b] = self._apart(a, b)
        return ok

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge ever joins bytes of ``a`` with bytes of ``b``: their merges are taken
        back, the last one first, and at each state what meets at the border must not have been
        joined before the merge that was taken back (of equal ranks the left one came first)."""
        rank, tokens, halves, none = self.ranks.get, self.tokens, self._halves.get, self._none
        before = none
        while rank(tokens[a] + tokens[b], none) >= before:
            left, right = halves(a), halves(b)
            if left and (a > b or not right):
                before, a = a, left[1]
            elif right:
                before, b = b + 1, right[0]
            else:
                return True
        return False

    def _last(self, prefix: bytes) -> int:
        """The last token of a short prefix, the longest one first tried."""
        usable, known, kept, none = self._usable.get, self._last_of.get, self._kept.get, self._none
        end = len(prefix)
        for at in range(max(0, end - self._reach.get(prefix[-3:], 2)), end):
            t = usable(prefix[at:])
            if t is None:
                continue
            if at:
                before = prefix[:at]
                if (a := known(before)) is None:
                    a = self._last(before)
                    if len(self._last_of) >= KNOWN_PREFIXES:
                        self._last_of.clear()
                    self._last_of[before] = a
                if not ((ok := kept(a * none + t)) or ok is None and self._stays(a, t)):
                    continue
            return t
        raise ValueError(f"no valid encoding of {prefix!r}")

    def _fill(self, piece: bytes, last: list[int], start: int) -> None:
        """Append the last tokens of the prefixes of ``piece`` longer than ``len(last) - 1``;
        ``start``: a byte before which no token that ends in the new part begins."""
        known, kept, none = len(last), self._kept.get, self._none
        last += [-1] * (len(piece) + 1 - known)
        for end, (size, t) in self._ending.iter(piece[start:].decode("latin-1")):
            i = end + 1 + start
            if i < known or last[i] >= 0:
                continue
            j = i - size
            if j == 0 or (ok := kept(last[j] * none + t)) or ok is None and self._stays(last[j], t):
                last[i] = t
        if min(last[known:], default=0) < 0:
            raise ValueError(f"no valid encoding of {piece!r}")

    def prefixes(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """``last[i]``: the last token of ``piece[:i]`` (``last[0]`` is unused).

        Entries given in ``last`` are kept: they must be those of a prefix of ``piece``.
        """
        last = list(last) if last else [-1]
        self._fill(piece, last, max(0, len(last) - self.longest))
        return last

    def edited(self, old: bytes, last: list[int], start: int, end: int,
               new: bytes) -> tuple[bytes, list[int], int]:
        """Replace ``old[start:end]`` by ``new``: the piece, its table, entries computed."""
        piece = old[:start] + new + old[end:]
        table, shift, same = last[:start + 1], len(new) - (end - start), 0
        while len(table) <= len(piece):
            first = len(table)
            self._fill(piece[:first + self.longest], table, max(0, first - self.longest))
            for i in range(first, len(table)):
                was = i - shift
                same = same + 1 if was > end and last[was] == table[i] else 0
                if same >= self.longest:
                    return piece, table[:i + 1] + last[was + 1:], i - start
        return piece, table, len(piece) - start

    def ids(self, piece: bytes, last: list[int]) -> list[int]:
        """Read the encoding of ``piece`` back from its prefix table."""
        out, i = [], len(piece)
        while i:
            out.append(last[i])
            i -= len(self.tokens[last[i]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)  # a whole pre-token in the vocabulary is not merged
        if whole is not None:
            return [whole]
        if len(piece) > SHORT:
            return self.ids(piece, self.prefixes(piece))
        out, known, tokens = [], self._last_of.get, self.tokens
        while piece:
            if (t := known(piece)) is None:
                t = self._last(piece)
            out.append(t)
            piece = piece[:-len(tokens[t])]
        return out[::-1]


#: The public split pattern of the vocabularies this is used with (a fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_TWO_SPACES = re.compile(r"\s\s")


class _Runs(dict):
    """Part of a text -> ids of the part with ``lead`` before it; remembers short parts."""

    def __init__(self, encode, lead: str):
        self._encode, self._lead = encode, lead

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self._encode(self._lead + part)
        if len(part) <= SHORT:
            if len(self) >= CACHED_RUNS:
                self.clear()
            self[part] = ids
        return ids


class TextBPE:
    """Encoder of texts: each match of ``pattern`` is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe, self.split = PrefixBPE(ranks), regex.compile(pattern)
        self._by_line = pattern == WORDS
        self._known, self._spaced = _Runs(self._run, ""), _Runs(self._run, " ")

    def _run(self, run: str) -> tuple[int, ...]:
        """Ids of the matches in ``run``."""
        encode = self.bpe.encode
        return tuple(chain.from_iterable([encode(p.encode()) for p in self.split.findall(run)]))

    def encode_into(self, text: str, out: array) -> None:
        known, spaced = self._known.__getitem__, self._spaced.__getitem__
        if not self._by_line or _TWO_SPACES.search(text):
            out.extend(chain.from_iterable(map(known, self.split.findall(text))))
            return
        # Where no two white spaces follow each other, no match of WORDS reaches over
        # a line end or the start of " word", so these parts can be split by themselves.
        for n, line in enumerate(text.split("\n")):
            if n:
                out.extend(known("\n"))
            first, *rest = line.split(" ")
            if first:
                out.extend(known(first))
            out.extend(chain.from_iterable(map(spaced, rest)))

    def encode(self, text: str) -> list[int]:
        self.encode_into(text, out := array("i"))
        return out.tolist()

    def decode(self, ids) -> bytes:
        return decoded(ids, self.bpe.tokens)

    def appended(self, pieces: list[str], more: str) -> list[str]:
        """Pieces of the text of ``pieces`` with ``more`` behind it.

        Only the last two can change: an apostrophe may join letters up to two on.
        """
        return pieces[:-2] + self.split.findall("".join(pieces[-2:]) + more)


@lru_cache(maxsize=2)
def _coder(vocab: bytes, pattern: str) -> TextBPE:
    return TextBPE(read_ranks(vocab), pattern)


@lru_cache(maxsize=2)
def _tokens(vocab: bytes) -> dict[int, bytes]:
    return {i: t for t, i in read_ranks(vocab).items()}


def _forget() -> None:
    _coder.cache_clear()
    _tokens.cache_clear()


def decoded(ids, tokens: dict[int, bytes]) -> bytes:
    try:
        return b"".join(map(tokens.__getitem__, ids))
    except KeyError as e:
        raise ValueError(f"id {e.args[0]} is not in the vocabulary") from None


def _vocab(df: DataFrame, path: str):
    with open(path, "rb") as f:  # on the driver; executors get the bytes
        data = f.read(MAX_VOCAB_BYTES + 1)
    if len(data) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCAB_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(data)


def bpe_encode(docs: DataFrame, vocab_path: str, pattern: str, text_col: str = "text",
               ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array of int), the ids of each whole text."""
    shared = _vocab(docs, vocab_path)

    def add(b):
        taken_over("bpe", _forget)
        coder = _coder(shared.value, pattern)
        ids, ends = array("i"), array("i", [0])
        for text in b.column(b.schema.get_field_index(text_col)):
            coder.encode_into(text.as_py() or "", ids)
            ends.append(len(ids))
        return pa.ListArray.from_arrays(pa.array(np.frombuffer(ends, np.int32)),
                                        pa.array(np.frombuffer(ids, np.int32)
                                                 if ids else np.empty(0, np.int32)))

    return with_column(docs, ids_col, T.ArrayType(T.IntegerType()), add)


def bpe_decode(encoded: DataFrame, vocab_path: str, ids_col: str = "token_ids",
               bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``bytes_col`` (binary), the bytes of the ids."""
    shared = _vocab(encoded, vocab_path)

    def add(b):
        taken_over("bpe", _forget)
        tokens = _tokens(shared.value)
        col = b.column(b.schema.get_field_index(ids_col))
        return pa.array([decoded(x.values.to_numpy(zero_copy_only=False).tolist(), tokens)
                         if x.is_valid and len(x) else b"" for x in col], pa.binary())

    return with_column(encoded, bytes_col, T.BinaryType(), add)


def bpe_digest(decoded: DataFrame, ids_col: str = "token_ids", bytes_col: str = "decoded",
               id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Counts and digests of the ids and of the bytes that they decode to."""
    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    return decoded.select(
        id_col, F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(bytes_col), 256).alias("decoded_sha256"),
        *([ids_col] if keep_ids else []))
