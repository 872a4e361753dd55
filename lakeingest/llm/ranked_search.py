"""Ranked lexical search by dual trees: the best documents of every item, exactly.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z as a-z; a null text has
none. With N documents that hold a term, L terms in all, n terms in a document and df documents holding a term:

    weight of a term      w = floor(1000 * ln((2N + 2) / (2 df + 1)))
    document's length     m = 100 - b + (b * n * N) div L                        (b = 50)
    impact in a document  (1000000000 * tf) div (1000 * tf + 20 * m)

and a score is the sum of w * impact over the item's terms, in integers.

Two hierarchies hold coordinate maxima. A leaf of the item tree is a few items with similar rare terms, a leaf of a
document tree a few documents whose weightiest terms agree; a node holds, for every term, the most that any item or document
below it has. For a pair of nodes the sum of weight times greatest impact bounds all scores between them. The trees are
descended together; a pair whose bound is below the weakest k-th score of its items is dropped with all documents and items
below it. Pairs of leaves that remain are scored in full. Nothing is lost: only pairs that cannot enter a list are dropped.

On Spark: one pass over the texts stages each document's counts of the items' terms. Counts over all documents give N, L
and df. Each task builds trees over batches of its documents and searches them with the item tree, which is broadcast. A
first search of every ``SEEDS``-th document gives a lower bound of every item's k-th score, so that the search of all
documents drops most pairs from the start and tasks return only contenders. Items are taken in groups of about
``GROUP_TERMS`` (item, term) pairs, which bounds what is broadcast; documents are never collected.

Document terms are recognised by 64-bit hashes of their bytes among the items' terms (two terms of one group with the same
hash are an error; a document's other word meeting one has a chance of 1 in 10^12 for 10^7 words).

Defined cases: an item without terms, and one whose terms are in no document, has no rows; rows of one item_id are one item
with the terms of all; a null doc_id sorts after all others; repeated document rows are documents of their own; empty tables
give no rows; other columns are ignored, so their names cannot clash. Texts are read whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exchange import stage
from .textblocks import chunks, words

GROUP_TERMS = 500_000
SEEDS = 16
#: Numbers in a batch's matrix of impacts (terms x documents), and documents at most.
CELLS = 1 << 23
BATCH = 2048
LEAF, FAN = 16, 8
ITEM_LEAF, ITEM_FAN = 8, 4
NULL_ID = np.iinfo(np.int64).max

_APART = np.ones(256, dtype=bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _APART[_low:_high] = False
_TERM = "([^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()), F.lit(_TERM), 1)


def term_hashes(terms: list[str]) -> np.ndarray:
    """The hash by which each term is recognised in documents."""
    text = pa.array([" ".join(terms)], pa.string())
    out = [words(data, begin, _APART).hashes(lower=True) for _, _, data, begin in chunks(text)] if terms else []
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


# -- index: counts of the items' terms in every document ------------------------------------------------------------

INDEX = "doc_id long, n long, terms array<int>, tf array<int>"
_INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])


def _index(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, numbers = shared.value          # sorted, and the term of each
        for batch in batches:
            ids = batch.column("doc_id")
            for low, high, data, begin in chunks(batch.column("text")):
                w = words(data, begin, _APART)
                n = np.diff(w.first)
                h = w.hashes(lower=True)
                at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
                hit = np.flatnonzero(hashes[at] == h) if len(hashes) else np.zeros(0, dtype=np.int64)
                code, tf = np.unique(w.doc[hit].astype(np.int64) << 32 | numbers[at[hit]], return_counts=True)
                offsets = pa.array(np.searchsorted(code, np.arange(high - low + 1, dtype=np.int64) << 32), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    ids.slice(low, high - low), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array((code & 0xFFFFFFFF).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))], schema=_INDEX)
    return run


# -- trees -----------------------------------------------------------------------------------------------------------

class ItemTree:
    """Items with similar rare terms side by side; a node's ``terms`` are those of all items below it."""

    def __init__(self, items: dict, weight: np.ndarray):
        """``items``: number of the item -> its terms. ``weight``: w of each term."""
        self.weight = weight.astype(np.float64)
        by_weight = {i: sorted(t, key=lambda x: (-weight[x], x)) for i, t in items.items()}
        order = sorted(items, key=lambda i: (by_weight[i][:4], i))
        self.leaves = [np.array(order[i:i + ITEM_LEAF]) for i in range(0, len(order), ITEM_LEAF)]
        self.terms = [np.array(sorted({t for i in leaf for t in items[i]}), dtype=np.int64) for leaf in self.leaves]
        self.matrix = []
        for leaf, terms in zip(self.leaves, self.terms):
            m = np.zeros((len(leaf), len(terms)))
            for row, i in enumerate(leaf):
                at = np.searchsorted(terms, np.array(sorted(items[i]), dtype=np.int64))
                m[row, at] = self.weight[terms[at]]
            self.matrix.append(m)
        self.children: list[list[int]] = [[] for _ in self.leaves]
        self.below = [leaf for leaf in self.leaves]
        level = list(range(len(self.leaves)))
        while len(level) > 1:
            upper = []
            for i in range(0, len(level), ITEM_FAN):
                kids = level[i:i + ITEM_FAN]
                upper.append(len(self.children))
                self.children.append(kids)
                self.terms.append(np.unique(np.concatenate([self.terms[k] for k in kids])))
                self.below.append(np.concatenate([self.below[k] for k in kids]))
            level = upper
        self.root = len(self.children) - 1


class DocTree:
    """A batch of documents: impacts by term and document, and their maxima over leaves and over nodes above."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, ids: np.ndarray, weight: np.ndarray):
        """``doc``, ``term``, ``impact``: the entries, documents as places in ``ids``."""
        # The two weightiest terms of a document place it among its like.
        size = len(ids)
        first = np.lexsort((-(weight[term] * impact), doc))
        heads = np.searchsorted(doc[first], np.arange(size))
        count = np.bincount(doc, minlength=size)
        top = np.full((2, size), -1)
        for k in range(2):
            has = count > k
            top[k, has] = term[first[heads[has] + k]]
        place = np.empty(size, dtype=np.int64)
        order = np.lexsort((top[1], top[0]))
        place[order] = np.arange(size)
        self.ids = ids[order]
        self.present = np.unique(term)
        row = np.searchsorted(self.present, term)
        # Impacts are below 10^6: exact in single precision.
        self.impact = np.zeros((len(self.present), size), dtype=np.float32)
        self.impact[row, place[doc]] = impact
        self.levels = [self._maxima(self.impact, LEAF)]
        while self.levels[-1].shape[1] > FAN:
            self.levels.append(self._maxima(self.levels[-1], FAN))

    @staticmethod
    def _maxima(m: np.ndarray, fan: int) -> np.ndarray:
        return np.maximum.reduceat(m, np.arange(0, m.shape[1], fan), axis=1)


class Best:
    """Of every item the k best (score, doc_id) so far, and a score that its k-th best is known to reach."""

    def __init__(self, known: np.ndarray, k: int):
        self.known = known.astype(np.float64).copy()
        self.k = k
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def weakest(self, items: np.ndarray) -> float:
        return self.known[items].min()

    def add(self, item: int, score: np.ndarray, ids: np.ndarray) -> None:
        keep = np.flatnonzero((score > 0) & (score >= self.known[item]))
        if not len(keep):
            return
        score, ids = score[keep], ids[keep]
        if item in self.found:
            score = np.concatenate([self.found[item][0], score])
            ids = np.concatenate([self.found[item][1], ids])
        order = np.lexsort((ids, -score))[:self.k]
        self.found[item] = score[order], ids[order]
        if len(order) == self.k:
            self.known[item] = max(self.known[item], score[order[-1]])


def dual_search(items: ItemTree, docs: DocTree, best: Best) -> int:
    """Descend both trees together; returns the number of (item, document) pairs scored in full."""
    scored = 0
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def rows(node: int) -> tuple[np.ndarray, np.ndarray]:
        """Of an item node's terms those in the batch: their rows there, and their places in the node's list."""
        if node not in kept:
            at = np.minimum(np.searchsorted(docs.present, items.terms[node]), len(docs.present) - 1)
            held = docs.present[at] == items.terms[node]
            kept[node] = at[held], np.flatnonzero(held)
        return kept[node]

    def widen(nodes: np.ndarray, fan: int, end: int) -> np.ndarray:
        below = (nodes[:, None] * fan + np.arange(fan)).ravel()
        return below[below < end]

    def visit(node: int, level: int, nodes: np.ndarray) -> None:
        nonlocal scored
        at, _ = rows(node)
        if not len(at):
            return
        weight = items.weight[docs.present[at]]
        bound = weight @ docs.levels[level][np.ix_(at, nodes)].astype(np.float64)
        live = nodes[(bound > 0) & (bound >= best.weakest(items.below[node]))]
        if not len(live):
            return
        kids = items.children[node]
        if level:
            lower = widen(live, FAN, docs.levels[level - 1].shape[1])
            for kid in kids or [node]:
                visit(kid, level - 1, lower)
        elif kids:
            for kid in kids:
                visit(kid, 0, live)
        else:
            at, terms = rows(node)
            columns = widen(live, LEAF, len(docs.ids))
            score = items.matrix[node][:, terms] @ docs.impact[np.ix_(at, columns)].astype(np.float64)
            scored += score.size
            for row, item in enumerate(items.leaves[node]):
                best.add(int(item), score[row], docs.ids[columns])

    top = len(docs.levels) - 1
    if len(docs.present):
        visit(items.root, top, np.arange(docs.levels[top].shape[1]))
    return scored


# -- search in tasks -------------------------------------------------------------------------------------------------

HITS = "item int, doc_id long, score long"
_HITS = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, known, n_docs, n_terms, length_share = shared.value
        best = Best(known, k)
        size = int(min(BATCH, max(LEAF, CELLS // max(1, len(tree.weight)))))
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                part = batch.slice(low, size)
                lists = part.column("terms")
                count = np.asarray(lists.value_lengths()).astype(np.int64)
                term = np.asarray(lists.flatten()).astype(np.int64)
                if not len(term):
                    continue
                tf = np.asarray(part.column("tf").flatten()).astype(np.int64)
                n = np.asarray(part.column("n")).astype(np.int64)
                m = (100 - length_share) + (length_share * n * n_docs) // n_terms
                doc = np.repeat(np.arange(part.num_rows), count)
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
                ids = np.asarray(part.column("doc_id").fill_null(NULL_ID)).astype(np.int64)
                dual_search(tree, DocTree(doc, term, impact, ids, tree.weight), best)
        for item, (score, ids) in sorted(best.found.items()):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item), pa.int32()), pa.array(ids, pa.int64()),
                                              pa.array(score.astype(np.int64), pa.int64())], schema=_HITS)
    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", item_id: str = "item_id",
                  text: str = "text", length_share: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    pairs = stage(items.select(F.col(f"`{item_id}`").alias("item_id"), F.explode(_terms(F.col(f"`{text}`"))).alias("term"))
                  .distinct(), "search-item-terms")
    groups = max(1, -(-pairs.count() // GROUP_TERMS))
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = None
    for g in range(groups):
        # A hash of the item deals the pairs over the groups: about GROUP_TERMS pairs are collected at a time.
        mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).toArrow()
        names = sorted(set(mine.column("term").to_pylist()))
        number = {t: i for i, t in enumerate(names)}
        item_ids: list = list(dict.fromkeys(mine.column("item_id").to_pylist()))
        place = {x: i for i, x in enumerate(item_ids)}
        terms_of: dict[int, set[int]] = {}
        for x, t in zip(mine.column("item_id").to_pylist(), mine.column("term").to_pylist()):
            terms_of.setdefault(place[x], set()).add(number[t])
        hashes = term_hashes(names)
        order = np.argsort(hashes)
        if len(np.unique(hashes)) != len(names):
            raise ValueError("two terms of the items have the same 64-bit hash")
        lookup = spark.sparkContext.broadcast((hashes[order], order.astype(np.int64)))
        index = stage(texts.mapInArrow(_index(lookup), INDEX), "search-index")
        n_docs, n_terms = index.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        found = index.select(F.explode("terms").alias("term")).groupBy("term").count()
        df = np.zeros(len(names), dtype=np.int64)
        for r in found.toArrow().to_pylist():               # one row per term of the group
            df[r["term"]] = r["count"]
        weight = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
        if terms_of and n_docs:
            tree = ItemTree(terms_of, weight)
            index = index.where(F.size("terms") > 0)
            facts = (int(n_docs), int(n_terms), length_share)
            known = np.zeros(len(item_ids), dtype=np.int64)
            # Any documents' k-th best score is a lower bound of all documents' k-th best.
            seeds = spark.sparkContext.broadcast((tree, known, *facts))
            first = index.where(F.pmod(F.xxhash64("doc_id"), F.lit(SEEDS)) == 0).mapInArrow(_search(seeds, k), HITS)
            for r in _ranked(first, k).where(F.col("rank") == k).select("item", "score").toArrow().to_pylist():
                known[r["item"]] = r["score"]               # one row per item of the group
            shared = spark.sparkContext.broadcast((tree, known, *facts))
            best = _ranked(index.mapInArrow(_search(shared, k), HITS), k)
        else:
            best = _ranked(spark.createDataFrame([], HITS), k)
        kind = items.schema[item_id].dataType
        label = spark.createDataFrame([(i, x) for i, x in enumerate(item_ids)], f"item int, item_id {kind.simpleString()}")
        part = stage(best.join(F.broadcast(label), "item").select(      # at most GROUP_TERMS rows
            "item_id", "rank", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "score"), "search-found")
        out = part if out is None else out.unionByName(part)
    return out


ORACLE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'),
                                             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
     i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'),
                                             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
     g AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d),
     t AS (SELECT doc_id, term, len(terms) AS n, count(*) AS tf
           FROM (SELECT doc_id, terms, unnest(terms) AS term FROM d) GROUP BY doc_id, term, terms),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM t, g GROUP BY term),
     s AS (SELECT i.item_id, t.doc_id, CAST(sum(w.w * ((1000000000 * t.tf)
                  // (1000 * t.tf + 20 * (100 - 50 + ((50 * t.n * g.n_docs) // g.n_terms))))) AS BIGINT) AS score
           FROM i JOIN t USING (term) JOIN w USING (term), g GROUP BY i.item_id, t.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50"""
