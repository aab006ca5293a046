"""Quality by a sparse ensemble of rules.

Statistics of a text (lengths, repetition, shares of signs) are Spark columns.  Trees
are grown on them over a bounded labelled sample; every path from a root to a node is
a rule, a conjunction of thresholds.  A lasso logistic regression over the rules
keeps few of them.  The rules that are left, with their weights, are compiled into
one Spark column expression, so scoring is a scan without Python.

Learning reads at most ``max_per_class`` labelled documents of either label, those
with the smallest hash of their id (a documented bound).  The regression weighs the
classes as they are among all labelled rows of the fold.  Scoring covers every row
and whole text.  Labels, language, source and id are no inputs of a score.

Defined results: null text counts as empty; its statistics are 0 and it is scored
like any other.  Null labels are ignored; of several labels of a document the largest
holds.  With labels of one kind only, every score is that kind's smoothed share; with
none, one half.  Repeated rows get equal scores.  Only id and text are read, so
further columns cannot clash.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of, train_rows, train_texts

MAX_PER_CLASS = 8000
TREES, DEPTH, LASSO = 20, 3, 0.001
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
SIGNS = {"stops": ".?", "commas": ",;:", "shouts": "!", "bars": "|", "odd": "#$%&*<>{}[]\\^~_=+@/",
         "digits": "0123456789", "upper": UPPER}


def statistics(df: DataFrame, text_col: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns ``__f_*`` of statistics of ``text_col``, and their names."""
    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0).cast("double")

    text = F.col("__text")
    made = (df.withColumn("__text", text_of(text_col))
            .withColumns({
                "__words": F.expr(r"filter(split(__text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"),
                "__lines": F.expr(r"filter(split(__text, '\n'), l -> trim(l) <> '')"),
                "__chars": F.char_length(text)})
            .withColumns({
                "__n": F.size("__words"), "__m": F.size("__lines"),
                "__pure": F.aggregate("__words", F.lit(0), lambda a, w: a + F.char_length(w))}))
    n, m, pure = F.col("__n"), F.col("__m"), F.col("__pure")
    of = {
        "words": F.log1p(n), "lines": F.log1p(m),
        "word_length": ratio(pure, n), "line_words": ratio(n, m),
        "distinct_words": ratio(F.size(F.array_distinct("__words")), n),
        "distinct_lines": ratio(F.size(F.array_distinct("__lines")), m),
        "doubled_words": ratio(F.expr(
            "size(filter(sequence(1, greatest(__n - 1, 1)), i -> i < __n and __words[i] = __words[i - 1]))"), n),
        "open_lines": ratio(F.expr(r"size(filter(__lines, l -> not rtrim(l) rlike '[.!?:;\"]$'))"), m),
        "short_words": ratio(F.expr("size(filter(__words, w -> char_length(w) <= 3))"), n),
        "long_words": ratio(F.expr("size(filter(__words, w -> char_length(w) >= 14))"), n)}
    for name, signs in SIGNS.items():
        found = F.col("__chars") - F.char_length(F.translate(text, signs, ""))
        of[name] = ratio(found, pure)
    names = [f"__f_{k}" for k in of]
    made = made.withColumns({f"__f_{k}": v.cast("double") for k, v in of.items()})
    return made.drop("__text", "__words", "__lines", "__chars", "__n", "__m", "__pure"), names


Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold


@dataclass(frozen=True)
class RuleModel:
    """The probability of label 1: logistic of ``offset`` and the weights of the rules
    (each a tuple of conditions) that hold; ``constant`` instead, if there is one."""
    rules: tuple[tuple[tuple[Condition, ...], float], ...]
    offset: float
    constant: float | None = None

    def column(self) -> Column:
        if self.constant is not None:
            return F.lit(self.constant)
        total = F.lit(self.offset)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule: tuple[Condition, ...]) -> Column:
    out = None
    for name, op, at in rule:
        c = F.col(name) <= at if op == "<=" else F.col(name) > at
        out = c if out is None else out & c
    return out


NODE = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def rules_of(description: str, names: list[str]) -> list[tuple[Condition, ...]]:
    """The rules of all root-to-node paths in the description of a tree ensemble; of
    several thresholds in one direction the tightest."""
    rules, path = [], []
    for line in description.splitlines():
        if line.strip().startswith("Tree"):
            path = []
        if not (m := NODE.match(line)):
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (names[int(m[3])], m[4], float(m[5])))]
        tight: dict[tuple[str, str], float] = {}
        for _, (name, op, at) in path:
            was = tight.get((name, op), at)
            tight[name, op] = min(was, at) if op == "<=" else max(was, at)
        rules.append(tuple(sorted((n, op, at) for (n, op), at in tight.items())))
    return sorted(set(rules))


def fit_quality(docs: DataFrame, labels: DataFrame, train_fold: Column,
                label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
                max_per_class: int = MAX_PER_CLASS) -> RuleModel:
    """Learn the rules from the labelled rows where ``train_fold`` holds."""
    of = {0: 0, 1: 0}
    for r in (labels.filter(train_fold & F.col(label_col).isNotNull())
              .groupBy((F.col(label_col) == 1).cast("int").alias("y")).count().collect()):
        of[r.y] = r["count"]
    chosen = train_rows(labels, label_col, train_fold, max_per_class, id_col)
    stats, names = statistics(train_texts(docs, chosen, id_col, text_col), "__t")
    # Written by the scan's own tasks first; only the small table is put together.
    scanned = stored(stats.select(F.col("__y").cast("double").alias("y"), *names), "quality_scanned")
    sample = stored(scanned.coalesce(4), "quality_sample")
    n_of = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = n_of.get(1.0, 0), sum(n for y, n in n_of.items() if y != 1.0)
    if not n0 or not n1:
        return RuleModel((), 0.0, (n1 + 1) / (n0 + n1 + 2))
    sample = sample.withColumn("w", F.when(F.col("y") == 1, of[1] / n1).otherwise(of[0] / n0)
                               / ((of[0] + of[1]) / (n0 + n1)))

    forest = RandomForestClassifier(
        featuresCol="x", labelCol="y", weightCol="w", numTrees=TREES, maxDepth=DEPTH, maxBins=64,
        featureSubsetStrategy="sqrt", subsamplingRate=0.7, minInstancesPerNode=5, seed=7)
    trees = forest.fit(sample.select("y", "w", array_to_vector(F.array(*names)).alias("x")))
    rules = rules_of(trees.toDebugString, names)
    if not rules:
        return RuleModel((), 0.0, (of[1] + 1) / (of[0] + of[1] + 2))
    matrix = stored(sample.select("y", "w", F.array(*[holds(r).cast("double") for r in rules]
                                                    ).alias("x")), "quality_rules")
    lasso = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=LASSO,
                               elasticNetParam=1.0, maxIter=60, standardization=False)
    fit = lasso.fit(matrix.select("y", "w", array_to_vector("x").alias("x")))
    kept = tuple((r, float(c)) for r, c in zip(rules, fit.coefficients.toArray(), strict=True) if c)
    return RuleModel(kept, float(fit.intercept))


def score_quality(docs: DataFrame, model: RuleModel, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id_col, score) of every row."""
    stats, _ = statistics(docs.select(id_col, F.col(text_col).alias("__t")), "__t")
    return stats.select(id_col, model.column().alias("score"))
