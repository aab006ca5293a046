"""Queries of the training-data operators: ``name -> (fn(spark, sf_dir), DuckDB SQL or None)``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_digest, bpe_encode
from .collocation import collocations
from .common import table, text_of
from .decontam import contaminated_pairs
from .exact_dedup import exact_dedup
from .html_extract import extract_main_text
from .line_dedup import line_dedup
from .line_labels import fit_line_model, line_quality
from .lm_score import lm_scores
from .quality import fit_quality, score_quality
from .resample import resample
from .span_dedup import span_dedup
from .simhash import simhash_groups
from .toxicity import fit_toxicity, score_toxicity


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article text of every page, from its whole html."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def remainder(n: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def op2_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every whole text; remainder 0 is held out, remainder 1 is the part
    of the training documents on which the weights are learned."""
    return lm_scores(table(spark, sf_dir, "documents"), remainder(10) == 0, remainder(10) == 1)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; labels of remainder 0 are not learnt from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return (score_toxicity(docs, model)
            .select("doc_id", (remainder(5) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated line runs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs)


VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the bytes that they decode to, as counts and digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe_encode(docs, VOCAB, public_tokenizers.PATTERN).drop("text")
    return bpe_digest(bpe_decode(ids, VOCAB))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of whole texts; the largest doc_id of each group stays."""
    return exact_dedup(table(spark, sf_dir, "documents"),
                       carry=[F.sha2(text_of("text"), 256).alias("text_sha256")])


OP6_SQL = """
SELECT doc_id,
       max(doc_id) OVER copies AS keep_id,
       count(*) OVER copies AS group_size,
       doc_id = max(doc_id) OVER copies AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW copies AS (PARTITION BY coalesce(text, ''))
"""

def op7_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of spans that stand in an earlier document."""
    return span_dedup(table(spark, sf_dir, "documents"), within=False)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; labels of remainder 1 are not learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return (score_quality(docs, model)
            .select("doc_id", (remainder(3) == 1).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, exact or edited, with the item."""
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every whole text: 3-word shingles, at most 2 bits."""
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.withColumn("fingerprint",
                             F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best 2000 phrases of 2 to 5 words that occur 100 times or more."""
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
phrases AS (
  SELECT lang, k, phrase, count(*) AS a
  FROM (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ')
                                for i in range(1, len(w) - k + 2)]) AS phrase
        FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
alone AS (
  SELECT * FROM phrases p
  WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM phrases q
    WHERE q.lang = p.lang AND q.k > p.k AND 100 * q.a >= 100 * p.a
      AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))),
cuts AS (
  SELECT lang, phrase, a, cut,
         array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[cut + 1:k], ' ') AS tail
  FROM alone, (SELECT unnest([1, 2, 3, 4]) AS cut) WHERE cut < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, h.a AS l, t.a AS r, n,
         ((1000::HUGEINT * c.a * n) // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM cuts c JOIN phrases h ON h.lang = c.lang AND h.phrase = c.head
  JOIN phrases t ON t.lang = c.lang AND t.phrase = c.tail
  JOIN totals s ON s.lang = c.lang),
worst AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM worst
QUALIFY rank <= 2000
"""


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by how much their words are like the benchmark's."""
    return (resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_features", "weight", "score", "rank"))


OP12_SQL = """
WITH RECURSIVE steps(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM steps WHERE k = 8),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, 'corpus' AS kind FROM documents
  UNION ALL SELECT NULL, NULL, coalesce(text, ''), 'target' FROM benchmark),
words AS (
  SELECT r, doc_id, kind, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM texts),
occurrences AS (SELECT r, kind, unnest(w) AS word FROM words),
vocabulary AS (SELECT DISTINCT word FROM occurrences),
buckets AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
                               lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])),
                   4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT word, [('0x' || substr(hex(word), 2 * i - 1, 2))::BIGINT
                      for i in range(1, strlen(word) + 1)] AS bytes FROM vocabulary), crc_table),
counts AS (
  SELECT bucket, count(*) FILTER (kind = 'corpus') AS s, count(*) FILTER (kind = 'target') AS t
  FROM occurrences JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts),
weights AS (
  SELECT r, sum(gain)::BIGINT AS weight
  FROM occurrences JOIN buckets USING (word) JOIN gains USING (bucket)
  WHERE kind = 'corpus' GROUP BY r),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE kind = 'corpus'),
ranked AS (
  SELECT *, n_features >= 20 AS fit,
         row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         (10 * count(*) FILTER (n_features >= 20) OVER ()) // 100 AS quota
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= quota THEN place END AS rank
FROM ranked
"""


def op13_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every whole text and whether it is kept; labels of remainder 1 are
    not learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = fit_line_model(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return (line_quality(docs, model)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept"))


REGISTRY = {
    "op1_html_extract": (op1_html_extract, None),
    "op2_deleted_interpolation": (op2_deleted_interpolation, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_line_dedup": (op4_line_dedup, None),
    "op5_byte_bpe": (op5_byte_bpe, None),
    "op6_exact_dedup": (op6_exact_dedup, OP6_SQL),
    "op7_span_dedup": (op7_span_dedup, None),
    "op8_quality_rules": (op8_quality_rules, None),
    "op9_decontamination": (op9_decontamination, None),
    "op10_simhash": (op10_simhash, None),
    "op11_collocations": (op11_collocations, OP11_SQL),
    "op12_resample": (op12_resample, OP12_SQL),
    "op13_line_quality": (op13_line_quality, None),
}
