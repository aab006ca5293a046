"""Small hand-made documents with the cases that every operator must stand."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

LONG = " ".join(f"word{i % 997} tail{i % 13}." for i in range(6000))
PROSE = [
    "The quick brown fox jumps over the lazy dog near the old river bank.\nA second line, with more words in it.",
    "Quite another text stands here.\nIt shares nothing with the first one, or hardly anything.",
    "Der schnelle Fuchs springt über den Hund.\nNoch eine Zeile mit Wörtern darin."]


def rows_with_edge_cases():
    texts = [*PROSE, PROSE[0], PROSE[1] + "\nAn own third line of some length.", None, "", " \n\t ",
             "one", "two words", LONG, PROSE[0], "Common line of all.\n" + PROSE[2]]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, PROSE[1], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, or the edge cases."""
    def make(pairs=None):
        rows = rows_with_edge_cases() if pairs is None else [
            (i, t, "en", "s", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(3)
    return make


def with_clashes(df, *names):
    """``df`` with further columns of the given names and of internal ones."""
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("x") for n in names})
