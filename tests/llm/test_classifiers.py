"""Toxicity and quality: folding, matching, rules, held-out accuracy, edge cases."""

from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from netlens.llm import quality
from netlens.llm.quality import RuleModel, fit_quality, holds, rules_of, score_quality, statistics
from netlens.llm.queries import REGISTRY
from netlens.llm.toxicity import ToxicityModel, evidence, fit_toxicity, fold, score_toxicity
from tests.conftest import SF01

from .conftest import with_clashes

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType()),
                       T.StructField("quality", T.IntegerType())])
# Patterns are folded, so "l" is "i".
MODEL = ToxicityModel(((" idiot", 5.0), (" scum ", 4.0)), (" idiotic pian ",), 0.25, 1.0, -3.0)


def test_folding():
    assert fold("IDIOT") == fold("1d10t") == fold("іdіоt") == fold("ídïöt") == fold("id­i​ot")
    assert fold("  a--b  ") == " a b " and fold("") == "  "


def test_evidence():
    assert evidence(MODEL, "You 1diots, all")[0] == 5.0
    assert evidence(MODEL, "scums")[0] == 0.0             # a whole word only
    assert evidence(MODEL, "an idiotic plan")[0] == 0.0   # an exception phrase
    assert evidence(MODEL, "an idiotic man, scum!") == (9.0, 4)
    assert evidence(MODEL, "") == (0, 1)
    short, long = MODEL.probability(5.0, 10), MODEL.probability(5.0, 10000)
    assert 0.5 < short and long < short                   # normalised by length


def quality_of(rows):
    return {(r.held_out, r.label, r.predicted): r["count"] for r in rows}


def held_out(spark, name, label):
    out = REGISTRY[name][0](spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    assert out.filter("score is null or score < 0 or score > 1").count() == 0
    assert out.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    n = quality_of(out.join(labels, "doc_id").groupBy("held_out", "label", "predicted").count().collect())
    right = sum(v for (h, y, p), v in n.items() if h and y == p)
    return right / sum(v for (h, _, _), v in n.items() if h)


def test_toxicity_of_held_out_rows(spark):
    assert held_out(spark, "op3_toxicity", "toxic") > 0.93


def test_toxicity_recall_by_language(spark):
    sf = str(Path(SF01).parent / "sf0.1")
    out = REGISTRY["op3_toxicity"][0](spark, sf).select("doc_id", "held_out", "predicted")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    found = {(r.lang, r.toxic): (r.right, r.n) for r in
             out.join(docs, "doc_id").join(labels, "doc_id").filter("held_out").groupBy("lang", "toxic")
             .agg(F.sum(F.expr("int(predicted = toxic)")).alias("right"), F.count("*").alias("n")).collect()}
    for lang in ("en", "fr", "de", "es"):
        right, n = found[lang, 1]
        assert right >= 0.8 * n, (lang, found)
        right, n = found[lang, 0]
        assert right >= 0.97 * n, (lang, found)


def test_density_separates():
    model = ToxicityModel(((" muck", 4.0),), (), 0.25, 1.0, -3.0, ((" muck", 2.0),))
    assert evidence(model, "muck " + "word " * 99)[0] == 4.0 and evidence(model, "muck " + "word " * 100)[0] == 0


def test_term_that_long_clean_documents_hold_once(spark):
    docs = [(i, ("muck is my word for you ox " * 5 if i % 4 == 0 else "a calm text of many words and more " * 40
                 + "muck ox"), "en", "s", 0) for i in range(80)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(80)], LABELS)
    model = fit_toxicity(docs, labels.filter("doc_id < 60"), F.lit(True))
    assert score_toxicity(docs, model).filter("(score >= 0.5) <> (doc_id % 4 = 0)").count() == 0
    short = docs.filter("doc_id % 4 = 0").withColumn("text", F.lit("ox ox ox"))
    short = docs.filter("doc_id % 4 <> 0").unionByName(short)
    model = fit_toxicity(short, labels, F.lit(True))
    assert score_toxicity(short, model).filter("(score >= 0.5) <> (doc_id % 4 = 0)").count() == 0


def test_quality_of_held_out_rows(spark):
    assert held_out(spark, "op8_quality_rules", "quality") > 0.95


def labelled(spark, n=60):
    docs = [(i, f"A calm text, number {i} of many." + (" You blork head!" if i % 3 == 0 else " Fine."),
             "en", "s", 0) for i in range(n)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(n)] + [(0, None, None), (1, 0, 1)],
                                  LABELS))


def test_learned_lexicon_and_edge_cases(spark, make_docs):
    docs, labels = labelled(spark)
    model = fit_toxicity(docs, labels, F.lit(True))
    assert any(p.startswith(" biork") or p.startswith(" head") for p, _ in model.entries)
    out = score_toxicity(with_clashes(make_docs(), "score"), model)
    assert out.count() == make_docs().count()
    assert all(0 <= r.score < 0.5 for r in out.collect())
    assert score_toxicity(docs, model).filter("(score >= 0.5) <> (doc_id % 3 = 0)").count() == 0
    assert score_toxicity(make_docs([]), model).count() == 0
    none = fit_toxicity(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in score_toxicity(docs, none).collect()} == {0.0}


def test_quality_sample_keeps_the_scan_partitions(spark, monkeypatch):
    docs, labels = labelled(spark)
    docs = spark.sparkContext.parallelize([tuple(r) for r in docs.collect()], 12).toDF(docs.schema)
    parts, write = [], quality.stored
    monkeypatch.setattr(quality, "stored", lambda df, name: parts.append(df.rdd.getNumPartitions()) or write(df, name))
    fit_quality(docs, labels.withColumn("quality", F.col("doc_id").cast("int") % 2), F.lit(True))
    assert parts[0] == 12


def test_quality_edge_cases(spark, make_docs):
    docs, labels = labelled(spark)
    one_kind = fit_quality(docs, labels, F.lit(True))
    assert one_kind.constant > 0.5
    assert fit_quality(docs, labels.limit(0), F.lit(True)).constant == 0.5
    model = RuleModel((((("__f_words", "<=", 1.0),), -2.0),), 1.0)
    out = score_quality(with_clashes(make_docs(), "score", "__f_words"), model).collect()
    assert len(out) == make_docs().count() and all(0 <= r.score <= 1 for r in out)
    assert score_quality(make_docs([]), model).count() == 0


def test_statistics_of_empty_and_null_texts(make_docs):
    df, names = statistics(make_docs([(1, None), (2, ""), (3, " \n")]), "text")
    assert all(r[n] == 0 for r in df.collect() for n in names)


def test_rules_from_tree_text(spark):
    text = ("Model\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 0.5)\n     If (feature 1 <= 2.0)\n"
            "      Predict: 0.0\n     Else (feature 1 > 2.0)\n      Predict: 1.0\n"
            "    Else (feature 0 > 0.5)\n     Predict: 1.0\n")
    rules = rules_of(text, ["a", "b"])
    assert rules == [(("a", "<=", 0.5),), (("a", "<=", 0.5), ("b", "<=", 2.0)),
                     (("a", "<=", 0.5), ("b", ">", 2.0)), (("a", ">", 0.5),)]
    assert [r[0] for r in spark.createDataFrame([(0.1, 3.0), (0.9, 3.0)], "a double, b double")
            .select(holds(rules[2])).collect()] == [True, False]
