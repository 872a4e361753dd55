"""Hard negatives, ranked search and exact de-duplication against brute force, with the awkward cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeingest.llm import exact_dedup as X
from lakeingest.llm import hard_negatives as H
from lakeingest.llm import ranked_search as R
from lakeingest.session import ship_package
from tests.llm.fixtures import documents, prose, rows

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("id", T.StringType()),
                        T.StructField("slot", T.IntegerType()), T.StructField("score", T.StringType())])


def vectors(spark, data):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in data], VECTORS).repartition(4)


def negatives_by_hand(data, positives=5, negatives=3, low=50, high=95):
    known = {}
    for i, v, label in sorted((r for r in data if None not in r and all(x is not None and math.isfinite(x) for x in r[1])),
                              key=lambda r: (r[0], r[2], r[1])):
        known.setdefault(i, (label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (label, v) in known.items():
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in known.items() if i != a and len(w) == len(v)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if known[i][0] == label][:positives]:
            hits = [i for i in order if known[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(hits[:negatives])]
    return sorted(out)


def mined(spark, data, **options):
    ship_package(spark)
    return sorted(tuple(r) for r in H.hard_negatives(vectors(spark, data), F.col("id") % 50 == 0, **options).collect())


def some_vectors(seed, n=400, d=8):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(3, d))
    data = [(i, [float(np.float32(x)) for x in centre[i % 3] + rng.normal(size=d)], int(rng.integers(0, 3))) for i in range(n)]
    data += [(i + n, data[i][1], (i % 3)) for i in range(0, 60)]            # ties
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_by_hand(spark, seed):
    data = some_vectors(seed)
    want = negatives_by_hand(data)
    assert len(want) > 50 and mined(spark, data) == want


def test_hard_negatives_in_groups_and_small_blocks(spark, monkeypatch):
    data = some_vectors(5, n=120)
    monkeypatch.setattr(H, "GROUP_BYTES", 100)
    assert mined(spark, data, positives=3, negatives=2, low=10, high=99) == negatives_by_hand(data, 3, 2, 10, 99)


def test_hard_negatives_awkward_rows(spark):
    rng = random.Random(4)
    data = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)], rng.randint(0, 1)) for i in range(-50, 90)]
    data += data[:30]                                                       # repeated rows
    data += [(None, [1.0] * 4, 1), (200, None, 1), (250, [1.0] * 4, None), (300, [1.0, None, 0.0, 0.0], 0),
             (350, [float("nan")] * 4, 0), (400, [float("inf"), 0.0, 0.0, 0.0], 0), (450, [], 0), (451, [], 0), (452, [], 1),
             (500, [1.0, 1.0], 0), (501, [1.0, 1.0], 0), (502, [0.75, 1.0], 1), (550, [0.0] * 4, 1)]
    assert mined(spark, data) == negatives_by_hand(data)
    assert mined(spark, []) == []


def test_scores_beyond_doubles_are_exact_up_to_the_limit():
    a, b = np.array([[2.0 ** 40, 1.0]]), np.array([[2.0 ** 9, 1.0], [2.0 ** 40, 0.0], [-2.0 ** 40, 0.0], [np.inf, 0.0]])
    assert H._scores(a, b).tolist() == [[2 ** 49 + 1, H.LIMIT, -H.LIMIT, H.LIMIT]]


# -- ranked search ---------------------------------------------------------------------------------------------------

def search_by_hand(docs, items, k):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    terms = [(d, re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))) for d, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = Counter(x for _, t in terms for x in set(t))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower)))
    out = []
    for i, want in wanted.items():
        hits = []
        for d, t in terms:
            tf, m = Counter(t), 50 + (50 * len(t) * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                        * ((10 ** 9 * tf[x]) // (1000 * tf[x] + 20 * m)) for x in want if tf[x])
            if score > 0:
                hits.append((-score, d is None, d or 0))
        out += [(i, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(hits)[:k])]
    return sorted(out, key=str)


ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("term", T.StringType()), T.StructField("n", T.LongType())])


def ranked(spark, docs, items, k):
    ship_package(spark)
    found = R.ranked_search(docs, spark.createDataFrame([(*r, "t", 1) for r in items], ITEMS), k=k)
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def some_items(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.randint(1, 30))) for i in range(25)]
    return items + [(100, None), (101, ""), (102, "++ -- !!"), (103, "Né ñandú 中文 🙂 absentterm"), (104, "A a A b"),
                    (0, prose(rng, 5)), (0, items[0][1]), (None, "one two")]


@pytest.mark.parametrize("k", [1, 4, 50])
def test_ranked_search_by_hand(spark, k):
    data, items = rows(), some_items(1)
    assert ranked(spark, documents(spark, data), items, k) == search_by_hand([r[:2] for r in data], items, k)


def test_ranked_search_many_documents_and_item_groups(spark, monkeypatch):
    rng = random.Random(9)
    data = [(i, prose(rng, rng.randint(0, 60)), "en", "s", 1, "n", 1, "k") for i in range(900)]
    items = some_items(2)
    want = search_by_hand([r[:2] for r in data], items, 5)
    assert ranked(spark, documents(spark, data), items, 5) == want
    monkeypatch.setattr(R, "GROUP_TERMS", 40)
    monkeypatch.setattr(R, "SEEDS", 1)
    assert ranked(spark, documents(spark, data), items, 5) == want


def test_ranked_search_empty_tables(spark):
    assert ranked(spark, documents(spark, []), some_items(1), 3) == []
    assert ranked(spark, documents(spark), [], 3) == []


def test_bounds_drop_pairs_and_lose_nothing():
    """With documents in groups of their own words, most pairs of leaves are never scored."""
    rng = np.random.default_rng(3)
    docs, per, words = 1024, 12, 256
    term = np.concatenate([rng.choice(32, per, replace=False) + 32 * (d % 8) for d in range(docs)])
    doc, impact = np.repeat(np.arange(docs), per), rng.integers(1, 1000, docs * per)
    items = {i: set((rng.choice(32, 6, replace=False) + 32 * (i % 8)).tolist()) for i in range(32)}
    weight = rng.integers(1, 50, words)
    best = R.Best(np.zeros(32), 5)
    scored = 0
    for low in range(0, docs, 256):
        at = (doc >= low) & (doc < low + 256)
        scored += R.dual_search(R.ItemTree(items, weight),
                                R.DocTree(doc[at] - low, term[at], impact[at], np.arange(low, low + 256), weight), best)
    dense = np.zeros((docs, words))
    np.add.at(dense, (doc, term), impact)
    for i, terms in items.items():
        at = sorted(terms)
        score = dense[:, at] @ weight[at]
        want = sorted((-s, d) for d, s in enumerate(score) if s > 0)[:5]
        assert list(zip(-best.found[i][0], best.found[i][1])) == want
    assert scored < 32 * docs / 3


# -- exact de-duplication --------------------------------------------------------------------------------------------

def test_exact_dedup_by_hand(spark):
    data = rows() + [(40, " one two"), (41, " one\t\x0btwo"), (42, "one two ")]
    data = [(*r, "en", "s", 1, "n", 1, "kind") if len(r) == 2 else r for r in data]
    docs = documents(spark, data).withColumn("kept", F.lit("old")).withColumn("sha", F.lit("x")).withColumn("ROW", F.lit(1))
    got = X.exact_dedup(docs)
    assert got.columns == [c for c in docs.columns if c != "kept"] + list(X.RESULT)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for r in data:
        groups.setdefault(norm(r[1]), []).append(r[0])
    want = Counter()
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(t.encode()).hexdigest()
        want.update((i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids))
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got.collect()) == want


def test_exact_dedup_hot_group_and_filter_slices(spark, monkeypatch):
    monkeypatch.setattr(X, "SLICE_BLOCKS", 1)
    monkeypatch.setattr(X, "BITS_PER_ROW", 64)
    monkeypatch.setattr(X, "HOT_ROWS", 100)
    docs = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same  text' WHEN id % 100 = 1 THEN "
                                        "concat('pair ', id div 200) ELSE concat('text ', id) END AS text")
    got = X.exact_dedup(docs).groupBy("text").agg(F.count("*").alias("n"), F.min("group_size").alias("low"),
                                                  F.max("group_size").alias("high"), F.count_if("kept").alias("kept"),
                                                  F.min("doc_id").alias("first"), F.max("keep_id").alias("keep")).collect()
    assert len(got) > 3000
    assert all(r["n"] == r["low"] == r["high"] and r["kept"] == 1 and r["first"] == r["keep"] for r in got)


def test_only_suspects_shuffle(spark):
    """Without copies nearly no row takes the shuffle."""
    docs = spark.range(20000).selectExpr("sha2(cast(id as string), 256) AS sha", "1 AS at", "id", "struct(1) AS row")
    blocks = 10
    tested = X.with_suspicion(docs, X.repeated_bits(docs, blocks), blocks)
    assert tested.where("maybe").count() < 400
    copies = docs.unionByName(docs.where("id < 50"))
    tested = X.with_suspicion(copies, X.repeated_bits(copies, blocks), blocks)
    assert tested.where("maybe AND id < 50").count() == 100


def test_exact_dedup_empty(spark):
    assert X.exact_dedup(documents(spark, [])).count() == 0
