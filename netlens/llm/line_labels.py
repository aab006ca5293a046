"""Quality rules by line sequence labelling.

The lines of a text are a sequence; a linear-chain conditional random field gives each
one the label content or boilerplate.  A line's statistics (signs, pipes, capitals,
repeats, ends, lengths) are cut into bins; the weights of the bins and of the four
transitions between neighbours are fitted by maximum likelihood (forward-backward, full
batch, with a ridge), and the Viterbi path is taken.  A text is kept if its content lines
hold at least ``share`` of its words and it does not fail the base rules: fewer than
``min_words`` words, or more than 20 in 100 words in five-word windows that the text
holds twice or more.

Line labels are not given, documents' are: the lines of a document labelled bad start as
boilerplate, those of a good one as content.  After each fit, lines of bad documents that
the model finds to be content become content, unless that would leave a bad document
without boilerplate, and the model is fitted again (``ROUNDS`` times).

Learning reads at most ``max_per_class`` labelled documents of either label, those with
the smallest hash of their id, and of these at most ``MAX_WINDOWS`` windows of ``WINDOW``
lines, those with the smallest hash (documented bounds); only these windows' bins reach
the driver.  Scoring covers every row and whole text; nothing is shuffled.  Labels,
language, source and id are no inputs of the verdict.

Defined results: null text counts as empty; an empty text has no words, so it fails the
base rules.  Lines without a word are no part of the sequence.  Without labelled rows of
both kinds every line is content.  Very long texts are one sequence, worked on in time
and memory in proportion to their length.  Ties between labels go to content.  Repeated
rows get equal results.  Other columns are not read and may have any names; the id is
returned.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of, train_rows, train_texts

MAX_PER_CLASS, WINDOW, MAX_WINDOWS = 2000, 64, 20000
ROUNDS, STEPS, RIDGE = 2, 100, 1e-4
MIN_WORDS, MAX_REPEATED, SHARE = 10, 20, 0.5

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER, DIGITS = bytes(range(65, 91)), bytes(range(48, 58))

#: Statistic of a line -> the values at which its bins begin (the first begins below).
BINS: dict[str, tuple[float, ...]] = {
    "words": (3, 8, 20, 60),
    "word_length": (3.5, 5, 7, 10),
    "symbols": (0.02, 0.1, 0.3),
    "pipes": (0.02, 0.2),
    "bangs": (0.05, 0.3),
    "stops": (0.01, 0.05, 0.2),
    "capitals": (0.05, 0.2, 0.6),
    "digits": (0.02, 0.2),
    "different_words": (0.4, 0.6, 0.8),
    "seen_before": (0.5,),
    "ends_sentence": (0.5,),
    "first": (0.5,),
    "last": (0.5,)}
_SIZES = [len(at) + 1 for at in BINS.values()]
_OFFSETS = np.cumsum([0, *_SIZES[:-1]])
N_BINS = sum(_SIZES)


# --- statistics of texts and lines -------------------------------------------------------

class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words that lie in a run of ``window`` words which occurs twice or more."""
    n = len(words)
    if n <= window:
        return 0
    numbers = _Numbers()
    one = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    rank, size = one, 1
    while size < window:  # equal numbers stand for equal runs of ``size`` words
        step = min(size, window - size)
        pairs = rank[:len(rank) - step] * n + rank[step:]
        values, rank, times = np.unique(pairs, return_inverse=True, return_counts=True)
        size += step
        if len(values) == len(pairs):
            return 0
    twice = times[rank] > 1
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _without(line: bytes, signs: bytes) -> int:
    return len(line) - len(line.translate(None, signs))


def line_statistics(lines: list[bytes]) -> tuple[list[list[float]], list[int], int]:
    """(statistics, words) of the lines that have a word, and how many equal an earlier one."""
    rows, sizes, seen, again = [], [], set(), 0
    for line in lines:
        words = line.split()
        n = len(words)
        if not n:
            continue
        old = line in seen
        seen.add(line)
        again += old
        size = len(line) - _without(line, SPACE)
        rows.append([n, size / n, _without(line, SYMBOLS) / size, _without(line, b"|") / n,
                     _without(line, b"!?") / n, _without(line, b".,;:") / size,
                     _without(line, UPPER) / size, _without(line, DIGITS) / size,
                     len(set(words)) / n, old, words[-1][-1:] in b".!?:;\"", 0, 0])
        sizes.append(n)
    if rows:
        rows[0][-2] = rows[-1][-1] = 1
    return rows, sizes, again


def binned(rows: list[list[float]]) -> np.ndarray:
    """The bin of each statistic, numbered over all statistics: (lines, statistics)."""
    values = np.array(rows, np.float64).reshape(-1, len(BINS))
    return np.stack([np.searchsorted(np.array(at), values[:, k], side="right") + _OFFSETS[k]
                     for k, at in enumerate(BINS.values())], axis=1)


# --- the field ---------------------------------------------------------------------------

@dataclass(frozen=True)
class LineModel:
    """Scores for content over boilerplate: of the bins, and of the step from one label to
    the next (``step[a, b]``; 1 is content)."""
    bins: np.ndarray
    step: np.ndarray

    def decode(self, emission: np.ndarray) -> np.ndarray:
        """The Viterbi path over the content scores of a sequence."""
        (bb, bc), (cb, cc) = self.step.tolist()
        low, high, back = 0.0, float(emission[0]) if len(emission) else 0.0, []
        for e in emission[1:].tolist():
            low_from, high_from = high + cb >= low + bb, high + cc >= low + bc
            back.append((low_from, high_from))
            low, high = (high + cb if low_from else low + bb), (high + cc if high_from else low + bc) + e
        out = np.zeros(len(emission), bool)
        label = high >= low
        for k in range(len(emission) - 1, -1, -1):
            out[k] = label
            if k:
                label = back[k - 1][label]
        return out


def _logsum(a, b):
    top = np.maximum(a, b)
    return top + np.log(np.exp(a - top) + np.exp(b - top))


def _expected(scores, real, step):
    """Log-partition, content probabilities and pair probabilities of padded sequences
    (sequences, length): forward-backward over all sequences at once."""
    n, size = scores.shape
    forward = np.zeros((size, n, 2))
    forward[0, :, 1] = scores[:, 0]
    for t in range(1, size):
        for b in (0, 1):
            new = _logsum(forward[t - 1, :, 0] + step[0, b], forward[t - 1, :, 1] + step[1, b])
            new += scores[:, t] * b
            forward[t, :, b] = np.where(real[:, t], new, forward[t - 1, :, b])
    total = _logsum(forward[-1, :, 0], forward[-1, :, 1])
    backward = np.zeros((n, 2))
    content, pairs = np.zeros((n, size)), np.zeros((2, 2))
    for t in range(size - 1, -1, -1):
        content[:, t] = np.exp(forward[t, :, 1] + backward[:, 1] - total) * real[:, t]
        if not t:
            break
        old = backward.copy()
        for a in (0, 1):
            ways = [step[a, b] + scores[:, t] * b + old[:, b] for b in (0, 1)]
            for b in (0, 1):
                pairs[a, b] += (np.exp(forward[t - 1, :, a] + ways[b] - total) * real[:, t]).sum()
            backward[:, a] = np.where(real[:, t], _logsum(*ways), old[:, a])
    return total, content, pairs


def fit_field(sequences: list[np.ndarray], labels: list[np.ndarray], weights: np.ndarray,
              steps: int = STEPS, start: LineModel | None = None) -> LineModel:
    """Maximum likelihood with a ridge, by full-batch gradient steps of adapted size."""
    order = np.argsort([len(s) for s in sequences], kind="stable")
    blocks = []
    for part in np.array_split(order, max(1, len(order) // 512)):
        size = max(len(sequences[i]) for i in part)
        bins = np.zeros((len(part), size, len(BINS)), np.int64)
        real, truth = np.zeros((len(part), size), bool), np.zeros((len(part), size))
        for row, i in enumerate(part):
            n = len(sequences[i])
            bins[row, :n], real[row, :n], truth[row, :n] = sequences[i], True, labels[i]
        blocks.append((bins, real, truth, weights[part]))
    theta = np.zeros(N_BINS + 4) if start is None else np.concatenate([start.bins, start.step.ravel()])
    speed, last = np.full(len(theta), 0.1), np.zeros(len(theta))
    lines = sum(len(s) for s in sequences)
    for _ in range(steps):
        grad = -RIDGE * lines * theta
        for bins, real, truth, weight in blocks:
            scores = theta[bins].sum(axis=2) * real
            step = theta[N_BINS:].reshape(2, 2)
            _, content, pairs = _expected_weighted(scores, real, step, weight)
            error = (truth * real * weight[:, None] - content)
            grad[:N_BINS] += np.bincount(bins[real].ravel(), np.repeat(error[real], len(BINS)), N_BINS)
            was, now, both = truth[:, :-1], truth[:, 1:], real[:, 1:] * weight[:, None]
            grad[N_BINS:] += [((1 - was) * (1 - now) * both).sum() - pairs[0, 0],
                              ((1 - was) * now * both).sum() - pairs[0, 1],
                              (was * (1 - now) * both).sum() - pairs[1, 0],
                              (was * now * both).sum() - pairs[1, 1]]
        turned = np.sign(grad) * np.sign(last)
        speed = np.clip(np.where(turned > 0, speed * 1.2, np.where(turned < 0, speed * 0.5, speed)), 1e-6, 1)
        last = np.where(turned < 0, 0, grad)
        theta = theta + np.sign(last) * speed
    return LineModel(theta[:N_BINS], theta[N_BINS:].reshape(2, 2))


def _expected_weighted(scores, real, step, weight):
    """As ``_expected``, each sequence counted ``weight`` times."""
    total = content = None
    pairs = np.zeros((2, 2))
    for w in np.unique(weight):
        rows = np.flatnonzero(weight == w)
        of_total, of_content, of_pairs = _expected(scores[rows], real[rows], step)
        if total is None:
            total, content = np.zeros(len(scores)), np.zeros(scores.shape)
        total[rows], content[rows] = of_total, of_content * w
        pairs += of_pairs * w
    return total, content, pairs


# --- learning and scoring ----------------------------------------------------------------

def fit_line_model(docs: DataFrame, labels: DataFrame, train_fold: Column,
                   label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
                   max_per_class: int = MAX_PER_CLASS) -> LineModel | None:
    """Learn the field from the labelled documents where ``train_fold`` holds."""
    chosen = train_rows(labels, label_col, train_fold, max_per_class, id_col)
    texts = train_texts(docs, chosen, id_col, text_col).select("__y", F.col("__t").cast("binary"))

    def windows(batches):
        for b in batches:
            y, bins = [], []
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows, _, _ = line_statistics(text.split(b"\n"))
                made = binned(rows).astype(np.int16)
                for at in range(0, len(made), WINDOW):
                    y.append(label)
                    bins.append(made[at:at + WINDOW].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(bins, pa.binary())],
                                             ["y", "bins"])

    made = stored(texts.mapInArrow(windows, "y int, bins binary"), "line_windows")
    sample = (made.orderBy(F.xxhash64("bins"), "bins", "y").limit(MAX_WINDOWS)
              .toArrow())  # at most MAX_WINDOWS * WINDOW lines of a few numbers
    good = np.array([v == 1 for v in sample.column("y").to_pylist()], bool)
    if not good.any() or good.all():
        return None
    sequences = [np.frombuffer(v, np.int16).reshape(-1, len(BINS)).astype(np.int64)
                 for v in sample.column("bins").to_pylist()]
    order = sorted(range(len(good)), key=lambda i: (good[i], sequences[i].tobytes()))
    good, sequences = good[order], [sequences[i] for i in order]
    truth = [np.full(len(s), float(g)) for s, g in zip(sequences, good, strict=True)]
    weights = np.where(good, 1.0, max(1.0, good.sum() / (~good).sum()))  # both kinds weigh alike
    model = None
    for again in range(ROUNDS + 1):
        model = fit_field(sequences, truth, weights, start=model)
        if again < ROUNDS:
            for k in np.flatnonzero(~good):
                found = model.decode(model.bins[sequences[k]].sum(axis=1))
                truth[k] = np.zeros(len(found)) if found.all() else found.astype(float)
    return model


def label_lines(docs: DataFrame, model: LineModel | None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    content_lines, content_words) of every row; ``n_lines`` counts lines with a word."""
    texts = docs.select(F.col(id_col).alias("__id"), text_of(text_col).cast("binary").alias("__t"))
    kind = texts.schema["__id"].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
             "content_lines", "content_words"]
    shared = texts.sparkSession.sparkContext.broadcast(model)  # N_BINS + 4 numbers

    def run(batches):
        field = shared.value
        for b in batches:
            rows, sizes, ends, made = [], [], [], []
            for text in b.column(1).to_pylist():
                of_lines, of_sizes, again = line_statistics(text.split(b"\n"))
                rows += of_lines
                sizes += of_sizes
                ends.append(len(sizes))
                inner = len(text) - len(text.translate(None, bytes(range(128, 192))))
                made.append([sum(of_sizes), len(text) - _without(text, SPACE) - inner,
                             _without(text, SYMBOLS), again, repeated_words(text.split()), len(of_sizes)])
            counts = np.array(sizes, np.int64)
            if field is not None and rows:
                scores = field.bins[binned(rows)].sum(axis=1)
            start = 0
            for row, end in zip(made, ends, strict=True):
                if field is None:
                    content = np.ones(end - start, bool)
                elif end > start:
                    content = field.decode(scores[start:end])
                else:
                    content = np.zeros(0, bool)
                row += [int(content.sum()), int(counts[start:end][content].sum())]
                start = end
            columns = list(zip(*made, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in columns)], [id_col, *names])

    return texts.mapInArrow(run, ", ".join([f"`{id_col}` {kind}", *(f"{n} long" for n in names)]))


def line_quality(docs: DataFrame, model: LineModel | None, id_col: str = "doc_id",
                 text_col: str = "text", min_words: int = MIN_WORDS,
                 max_repeated: int = MAX_REPEATED, share: float = SHARE) -> DataFrame:
    """``label_lines`` with ``base_failed`` and ``kept``."""
    made = label_lines(docs, model, id_col, text_col)
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words")))
    return (made.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("content_words") >= share * F.col("n_words"))))
