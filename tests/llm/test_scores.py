"""Toxicity, quality classifier and quality rules."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeingest.llm import quality_rules
from lakeingest.llm.quality_rules import RULES, RejectRule, measure, ordered, quality_verdicts, spread_sample
from lakeingest.llm.rule_ensemble import Rule, RuleEnsemble, score_quality, statistics, train_quality
from lakeingest.llm.samples import labelled_sample, remainder
from lakeingest.llm.toxicity import drop_toxic, fit_noisy_or, longest_that_fit, score_toxicity, train_toxicity

from .fixtures import DOCUMENTS, documents, rows, tokens

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))


def accuracy(scored, labels, label, held):
    return scored.join(labels, "doc_id").filter(held).agg(
        F.avg(((F.col("score") >= 0.5).cast("int") == F.col(label)).cast("int"))).first()[0]


def test_toxicity_on_held_out_documents(spark, tables):
    docs, labels = tables
    weights, bias = train_toxicity(docs, labels, remainder("doc_id", 5) != 0)
    scored = score_toxicity(docs, weights, bias).cache()
    # a tenth of the labels is toxic and some of them are wrong, so "never toxic" has about 0.9
    assert accuracy(scored, labels, "toxic", remainder("doc_id", 5) == 0) > 0.9
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = [r for r in scored.collect() if r.offending]
    assert found
    for r in found:
        for s in r.offending:
            part = texts[r.doc_id][s.start:s.end]
            assert part and not re.search(r"[.!?\n].*\w", part) and s.score >= 0.5
    awkward = documents(spark)
    got = {r.doc_id: r.score for r in score_toxicity(awkward, weights, bias).collect()}
    assert got[6] == got[7] == got[8] == 0.0 and all(0 <= s <= 1 for s in got.values())
    kept = drop_toxic(awkward, weights, bias)
    assert kept.columns == DOCUMENTS.names
    assert kept.count() == score_toxicity(awkward, weights, bias).filter("score < 0.5").count()
    assert score_toxicity(documents(spark, []), weights, bias).collect() == []


def test_noisy_or_learns_the_sentence():
    # word 1 is toxic; each document has two sentences of two words
    word = np.array([1, 2, 3, 4] * 40 + [2, 5, 3, 4] * 40)
    sentence = np.arange(len(word)) // 2
    doc = np.arange(len(word) // 2) // 2
    weights, bias = fit_noisy_or(word, sentence, doc, np.array([1] * 40 + [0] * 40), steps=400)
    assert bias + weights[1] + weights[2] > 0 > bias + weights[3] + weights[4]


def test_no_labels_no_toxicity(spark, tables):
    docs, labels = tables
    weights, bias = train_toxicity(docs, labels.limit(0), remainder("doc_id", 5) != 0)
    assert score_toxicity(docs.limit(5), weights, bias).filter("score > 1e-9").count() == 0


def test_toxicity_sample_is_bounded_by_rows_and_words(spark, tables):
    docs, labels = tables
    labels = labels.filter("doc_id < 300")
    weights, bias = train_toxicity(docs, labels, F.lit(True))
    # repeated rows are one document, whatever the partitions
    again, bias2 = train_toxicity(docs.union(docs).repartition(5), labels, F.lit(True))
    assert bias == bias2 and np.array_equal(weights, again)
    few, _ = train_toxicity(docs, labels, F.lit(True), sample_words=3000)
    assert (few != 0).sum() < (weights != 0).sum()
    assert train_toxicity(docs, labels, F.lit(True), sample_words=0)[1] == -40.0
    assert [longest_that_fit(x, 10) for x in ([], [11], [3, 3, 4], [3, 3, 5], [3, 4, 4], [0, 0])] == [-1, -1, 4, 3, 3, 0]


def test_labels_of_other_folds_are_never_learned(spark, tables):
    labels = tables[1]
    got = labelled_sample(labels, "quality", remainder("doc_id", 3) != 1, 10 ** 6).collect()
    assert got and all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in got)
    odd = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    assert [tuple(r) for r in labelled_sample(odd, "quality", F.lit(True), 10).collect()] == [(2, 1)]


def test_quality_on_held_out_documents(spark, tables):
    docs, labels = tables
    ensemble = train_quality(docs, labels, remainder("doc_id", 3) != 1)
    assert 0 < len(ensemble.weighted) < 80
    assert accuracy(score_quality(docs, ensemble), labels, "quality", remainder("doc_id", 3) == 1) > 0.97
    scores = [r.score for r in score_quality(documents(spark), ensemble).collect()]
    assert len(scores) == len(rows()) and all(0 <= s <= 1 for s in scores)
    assert score_quality(documents(spark, []), ensemble).collect() == []


def test_one_class_or_none(spark, tables):
    docs, labels = tables
    good = train_quality(docs, labels.filter("quality = 1"), F.lit(True))
    assert score_quality(docs.limit(3), good).filter("score > 0.99").count() == 3
    assert train_quality(docs, labels.limit(0), F.lit(True)) == RuleEnsemble(0.0, ())


def test_rules_are_columns(spark):
    text = "A b c!\nA b c!\n12 | x"
    got = spark.createDataFrame([(text,)], "t string").select(statistics(F.col("t")).alias("s")).select("s.*").first()
    assert got.n_words == 9 and got.distinct_lines == 2 / 3 and got.exclamations_per_word == 2 / 9
    ensemble = RuleEnsemble(-1.0, ((2.0, Rule((("n_words", True, 5.0), ("digits", False, 0.5)))),))
    one = spark.createDataFrame([(1, text), (2, "a"), (3, None)], "doc_id long, text string")
    assert [round(r.score, 6) for r in score_quality(one, ensemble).orderBy("doc_id").collect()] == [
        round(1 / (1 + np.exp(-1)), 6), round(1 / (1 + np.exp(1)), 6), round(1 / (1 + np.exp(1)), 6)]


def brute_counts(text):
    w = tokens(text)
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(5)}
    lines = [x for x in (text or "").split("\n") if tokens(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered))


def test_base_counts_match_brute_force(spark):
    got = quality_verdicts(documents(spark)).collect()
    want = []
    for r in rows():
        c = brute_counts(r[1])
        want.append((r[0], *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(want, key=repr)
    assert all(not (r.base_failed and r.kept) for r in got)
    kept = {r.doc_id for r in got if r.kept}
    assert {1, 3, 13, 17} <= kept and not kept & {6, 7, 23}
    assert quality_verdicts(documents(spark, [])).collect() == []


def test_the_verdict_does_not_depend_on_the_order(spark):
    docs = documents(spark)
    a = quality_verdicts(docs, RULES).collect()
    b = quality_verdicts(docs, RULES[::-1]).collect()
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)


def test_rules_are_ordered_by_rejection_per_cost(spark):
    rule = [RejectRule(n, None) for n in "abcd"]
    measured = [{"rule": r, "seconds": s, "rejection": p} for r, s, p in zip(rule, (1, 1, 4, 1), (0.1, 0.4, 0.9, 0.4))]
    assert [r.name for r in ordered(measured)] == ["b", "d", "c", "a"]
    sample = documents(spark).select("text", F.struct(F.lit(1).alias("x")).alias("counts"))
    m = measure(sample, [RejectRule("long", lambda t, c: F.length(t) > 1000)])
    assert 0 < m[0]["rejection"] < 1 and m[0]["seconds"] > 0


def test_kept_matches_rules_one_by_one(spark, tables):
    docs, labels = tables
    kept = quality_verdicts(docs).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("p"))
    share = {r.quality: r.p for r in kept.collect()}
    assert share[1] > 0.97 and share[0] < 0.5


def test_rules_are_measured_on_rows_of_the_whole_table(spark, monkeypatch):
    """Rows sorted by source: the sample holds both, rows that fail the base rule are none of it."""
    texts = [(i, "one two") for i in range(300)] + [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(300, 3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    seen = []

    def watched(sample, rules):
        seen.extend(r.doc_id for r in sample.collect())
        return measure(sample, rules)
    monkeypatch.setattr(quality_rules, "measure", watched)
    assert quality_verdicts(docs, sample_rows=100).count() == 3000
    assert len(seen) == 100 and min(seen) >= 300 and any(i < 1500 for i in seen) and any(i > 2500 for i in seen)
    assert spread_sample(docs.limit(5), 100).count() == 5 and spread_sample(docs.limit(0), 100).count() == 0
