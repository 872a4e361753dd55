"""Quality classifier: a sparse rule ensemble.

1. Statistics of each text are Spark column expressions (``STATISTICS``); nothing but the text enters them.
2. Small trees are grown on the statistics of a bounded sample of labelled documents. Every path from a root to a node
   is a rule, a conjunction of ``statistic <= cut`` and ``statistic > cut``.
3. A logistic model with an L1 (lasso) penalty weighs the rules; most weights become 0 and those rules are dropped.
4. What is left is compiled into one column expression, ``1 / (1 + exp(-(intercept + sum of weights of rules met)))``,
   which scores every whole text in the JVM in one pass.

Null and empty texts have statistics of 0 and are scored like any other. Without labels of both classes nothing can be
learned: every score is 0.5 then (1 or 0 if only one class is known). Repeated rows are scored alike, a doc_id may be null,
and extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import stage, unstage
from .samples import labelled_sample

SAMPLE_ROWS = 10_000
_WHITE = " \t\n\x0b\f\r"


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def statistics(text: Column) -> Column:
    """A struct of doubles: what the rules may look at."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_WHITE))

    def of(t):
        words = F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[ \t-\r]+"))
        return F.transform(F.array(words), lambda w: measures(t, w))[0]

    def measures(t, w):
        n = F.greatest(F.size(w), F.lit(1)).cast("double")
        chars = F.greatest(F.length(t), F.lit(1)).cast("double")
        lines = F.split(t, "\n")
        return F.struct(
            F.size(w).cast("double").alias("n_words"),
            (F.length(t) / n).alias("chars_per_word"),
            (F.size(F.array_distinct(w)) / n).alias("distinct_words"),
            (F.size(lines) / n).alias("lines_per_word"),
            F.transform(F.array(lines), lambda x: F.size(F.array_distinct(x)) / F.greatest(F.size(x), F.lit(1)))[0]
             .alias("distinct_lines"),
            (F.length(F.regexp_replace(t, "[^A-Z]+", "")) / chars).alias("capitals"),
            (F.length(F.regexp_replace(t, "[^0-9]+", "")) / chars).alias("digits"),
            (F.length(F.regexp_replace(t, r"[^#*$%&|<>{}\[\]=~^_@\\/+]+", "")) / n).alias("symbols_per_word"),
            (_count(t, "!") / n).alias("exclamations_per_word"),
            (_count(t, "|") / n).alias("bars_per_word"),
            (_count(t, ".") / n).alias("stops_per_word"),
            (_count(t, ",") / n).alias("commas_per_word"),
            (_count(t, "...") / n).alias("dots_per_word"),
        )
    return F.transform(F.array(trimmed), of)[0]


STATISTICS = ["n_words", "chars_per_word", "distinct_words", "lines_per_word", "distinct_lines", "capitals", "digits",
              "symbols_per_word", "exclamations_per_word", "bars_per_word", "stops_per_word", "commas_per_word",
              "dots_per_word"]


@dataclass(frozen=True)
class Rule:
    """A conjunction of tests (statistic, is above the cut, cut)."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self, stats: Column) -> Column:
        met = F.lit(True)
        for name, above, cut in self.tests:
            value = stats.getField(name)
            met = met & (value > F.lit(cut) if above else value <= F.lit(cut))
        return met

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if a else '<='} {c:.6g}" for n, a, c in self.tests)


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weighted: tuple[tuple[float, Rule], ...]

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for weight, rule in self.weighted:
            total = total + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(model) -> list[Rule]:
    """The distinct paths of a forest's trees. Tests of one statistic on a path are merged to the tightest cut."""
    found: dict[Rule, None] = {}

    def walk(node, tests: dict) -> None:
        if tests:
            found[Rule(tuple((n, a, c) for (n, a), c in sorted(tests.items())))] = None
        if node.subtreeDepth() == 0:
            return
        name, cut = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        low, high = tests.get((name, False), math.inf), tests.get((name, True), -math.inf)
        walk(node.leftChild(), {**tests, (name, False): min(low, cut)})
        walk(node.rightChild(), {**tests, (name, True): max(high, cut)})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def fit_rules(sample: DataFrame, trees: int = 16, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> RuleEnsemble:
    """An ensemble from a DataFrame (stats struct, label 0 or 1) of bounded size."""
    classes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(classes) < 2:
        return RuleEnsemble({0: -20.0, 1: 20.0}.get(next(iter(classes), None), 0.0), ())
    flat = sample.select(F.col("label").cast("double").alias("label"), "stats",
                         *(F.col("stats").getField(s).alias(s) for s in STATISTICS))
    data = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(flat)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="0.5", seed=seed).fit(data)
    rules = tree_rules(forest)
    met = data.select("label", array_to_vector(F.array(*(r.column(F.col("stats")).cast("double") for r in rules)))
                      .alias("rules"))
    met = stage(met.withColumn("rules", met["rules"]), "rule-sample")
    model = LogisticRegression(featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=60,
                               standardization=False).fit(met)
    unstage(met)
    weights = model.coefficients.toArray().tolist()
    return RuleEnsemble(float(model.intercept), tuple((w, r) for w, r in zip(weights, rules) if abs(w) > 1e-9))


def train_quality(documents: DataFrame, labels: DataFrame, learnable: Column, label: str = "quality",
                  sample_rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """Learn from at most ``sample_rows`` labelled documents with ``learnable`` (a condition on doc_id)."""
    chosen = labelled_sample(labels, label, learnable, sample_rows)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    sample = stage(texts.select(statistics(F.col("text")).alias("stats"), "label"), "rule-stats")
    ensemble = fit_rules(sample)
    unstage(sample)
    return ensemble


def score_quality(documents: DataFrame, ensemble: RuleEnsemble) -> DataFrame:
    """(doc_id, score) of each row: the chance of label 1."""
    stats = documents.select(F.col("doc_id").cast("long").alias("doc_id"), statistics(F.col("text")).alias("stats"))
    return stats.select("doc_id", ensemble.score(F.col("stats")).alias("score"))
