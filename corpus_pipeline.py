"""A corpus-cleaning pipeline: each stage is one of the numbered operators, with its
production parameters, over all that the stage before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``.  All
but the last return the columns of ``documents``.

1. toxicity: documents with a score of 0.5 or more go.
2. line_dedup: later copies of repeated line runs are cut out (and n_chars follows); all
   rows stay.
3. simhash_near_dedup: of each group of fingerprints that link at 2 bits or fewer, the
   document with the smallest id stays (rows of one id are one document).
4. decontamination: documents that hold a copy of a benchmark item go.
5. byte_bpe: token ids of what is left, with their count and digests.

Rows with a null id take part in every stage; where only null ids are in a group, they
stay.  An empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netlens.llm.bpe import bpe_decode, bpe_digest, bpe_encode
from netlens.llm.common import stored, table, text_of
from netlens.llm.decontam import contaminated_pairs
from netlens.llm.line_dedup import line_dedup
from netlens.llm.queries import VOCAB, remainder
from netlens.llm.simhash import MAX_BITS, SHINGLE, simhash_groups
from netlens.llm.toxicity import fit_toxicity, score_toxicity


def _kept(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose id and text hash are in ``gone``; adaptive execution
    measures ``gone`` and shuffles texts only if it is large."""
    gone = gone.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__gone"))
                     & (F.xxhash64(text_of("text")) == F.col("__hash")), "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return score_toxicity(docs, model, score_col="__score").filter("__score < 0.5").drop("__score")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")
                                               .cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash_groups(docs, shingle=SHINGLE, max_bits=MAX_BITS)
    return _kept(docs, groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, contaminated_pairs(docs, table(spark, sf_dir, "benchmark")))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = bpe_encode(docs.select("doc_id", "text"), VOCAB, public_tokenizers.PATTERN)
    # stored between, so that no task runs an encoding and a decoding Python worker at once
    return bpe_digest(bpe_decode(stored(ids.drop("text"), "pipeline_ids"), VOCAB), keep_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


#: Automata, fingerprints, alignment and token ids are no SQL; tests compare the stages
#: with brute force.
ORACLE_SQL = None
