"""Hard negatives by slot-decomposed selection.

For an anchor, its positives are the best rows of its label. A positive of score p admits negatives (rows of another
label) whose score is between ``low`` and ``high`` per cent of p, and wants the best few of them. These windows overlap, so
they are not searched one by one:

- the positives' upper limits cut the scores below the best positive into disjoint slots;
- one pass keeps, per anchor and slot, the best few negatives: in each task (the combiner), then over all tasks;
- slots are joined from the lowest up: a slot's list followed by the merged list below it, cut to the wanted length, holds
  the best negatives under that slot's limit. It answers the window of that positive once the lower limit is applied.

Scores are inner products of the vectors after each component x became floor(scale * x), as integers: exact in double
precision while they stay below 2^50; beyond that they count as 2^50 (or -2^50).

At scale: vectors are shuffled once (to one row per id) and then only read. Anchors are a stated query set; they are taken
in groups whose vectors fill at most ``GROUP_BYTES``, and each group is broadcast and meets all rows where they lie, in
blocks. A task returns at most a few rows per anchor, never pairs.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part, and rows whose vector
has another length than the anchor's take no part for it; of rows sharing an id the one with the smallest (label, vector)
counts; equal scores are ordered by id; an anchor without positives, and an empty table, give no rows; columns beyond the
three that are named are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exchange import stage

#: Bytes of the anchors' vectors that are broadcast at a time.
GROUP_BYTES = 64 << 20
#: Vector components below which a task is not worth a split of its own.
TASK_NUMBERS = 4 << 20
ROWS = 2048
ANCHORS = 256
LIMIT = 1 << 50
NONE = np.iinfo(np.int64).min


def usable(vectors: DataFrame, id: str, label: str, vector: str) -> DataFrame:
    """(id, label, vec): one row per id, with finite vectors only."""
    x = F.col(f"`{vector}`")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                          F.when(~bad, x).alias("vec")).where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    return rows.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")


def _numbers(vec: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of floor(scale * x)) for each length of vector in the column."""
    vec = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    length = np.asarray(vec.value_lengths())
    flat = np.asarray(vec.flatten()).astype(np.float64)
    start = np.cumsum(length) - length
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        with np.errstate(over="ignore"):
            yield at, np.floor(flat[start[at][:, None] + np.arange(n)] * scale)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` with those of ``b``."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < 2 ** 53:
        return np.clip((a @ b.T).astype(np.int64), -LIMIT, LIMIT)
    exact = np.array([[int(v) if abs(v) != np.inf else int(np.sign(v)) << 1100 for v in row] for row in a], dtype=object)
    other = np.array([[int(v) if abs(v) != np.inf else int(np.sign(v)) << 1100 for v in row] for row in b], dtype=object)
    return np.array([[max(-LIMIT, min(LIMIT, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in other] for p in exact],
                    dtype=np.int64).reshape(len(a), len(b))


def _best(score: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the k best valid scores of each row (equal scores: earlier columns), and their scores (NONE: no more)."""
    n = score.shape[1]
    # Score and column in one number: LIMIT * ROWS fits 64 bits.
    code = np.where(valid, score * n + (n - 1 - np.arange(n)), NONE)
    if n > k:
        at = np.argpartition(code, n - k, axis=1)[:, n - k:]
    else:
        at = np.broadcast_to(np.arange(n), code.shape)
    return at, np.where(np.take_along_axis(valid, at, 1), np.take_along_axis(score, at, 1), NONE)


class Anchors:
    """A group of anchors: ids, labels, number matrices by length, and the positives' limits once they are known."""

    def __init__(self, table: pa.Table, scale: int):
        self.id = np.asarray(table.column("id")).astype(np.int64)
        self.label = np.asarray(table.column("label")).astype(np.int64)
        self.by_length = {m.shape[1]: (at, m) for at, m in _numbers(table.column("vec"), scale)} if len(self.id) else {}

    def set_positives(self, table: pa.Table, positives: int, low: int, high: int) -> None:
        """Upper limits of the positives, best first, and the lowest score of use in each slot."""
        place = np.searchsorted(np.sort(self.id), np.asarray(table.column("anchor_id")).astype(np.int64))
        place = np.argsort(self.id)[place]
        score = np.full((len(self.id), positives), NONE)
        score[place, np.asarray(table.column("place")).astype(np.int64) - 1] = np.asarray(table.column("score")).astype(np.int64)
        known = score != NONE
        some = np.where(known, score, 0)
        self.upper = np.where(known, some * high // 100, NONE)
        # A slot serves its own positive and better ones, whose lower limits are not lower; below it lies the next slot.
        below = np.concatenate([self.upper[:, 1:], np.full((len(self.id), 1), NONE)], axis=1)
        self.floor = np.where(known, np.maximum(-((-some * low) // 100), below + 1), LIMIT + 1)


class Lists:
    """Per anchor and slot the best (score, id) so far."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.score = np.full((anchors, slots, k), NONE)
        self.id = np.zeros((anchors, slots, k), dtype=np.int64)

    def add(self, rows: np.ndarray, slot: int, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[2]
        score = np.concatenate([self.score[rows, slot], score], axis=1)
        ids = np.concatenate([self.id[rows, slot], ids], axis=1)
        order = np.argsort(ids, axis=1, kind="stable")
        by_score = np.argsort(-np.take_along_axis(score, order, 1).astype(np.float64), axis=1, kind="stable")
        order = np.take_along_axis(order, by_score, 1)[:, :k]
        self.score[rows, slot] = np.take_along_axis(score, order, 1)
        self.id[rows, slot] = np.take_along_axis(ids, order, 1)

    def batch(self, anchors: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
        a, slot, k = np.nonzero(self.score != NONE)
        return pa.RecordBatch.from_arrays([pa.array(anchors[a], pa.int64()), pa.array(slot.astype(np.int32), pa.int32()),
                                           pa.array(self.id[a, slot, k], pa.int64()),
                                           pa.array(self.score[a, slot, k], pa.int64())], schema=schema)


FOUND = "anchor_id long, slot int, id long, score long"
_FOUND = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def _scan(shared, scale: int, slots: int, k: int, choose):
    """A task: all its rows against all anchors of the group, in blocks; ``choose`` gives the valid pairs of a slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: Anchors = shared.value
        lists = Lists(len(group.id), slots, k)
        for batch in batches:
            ids = np.asarray(batch.column("id")).astype(np.int64)
            labels = np.asarray(batch.column("label")).astype(np.int64)
            for at, numbers in _numbers(batch.column("vec"), scale):
                if numbers.shape[1] not in group.by_length:
                    continue
                which, matrix = group.by_length[numbers.shape[1]]
                order = np.argsort(ids[at], kind="stable")
                at, numbers = at[order], numbers[order]
                for low in range(0, len(at), ROWS):
                    rows, block = at[low:low + ROWS], numbers[low:low + ROWS]
                    for first in range(0, len(which), ANCHORS):
                        a = which[first:first + ANCHORS]
                        score = _scores(matrix[first:first + ANCHORS], block)
                        for slot in range(slots):
                            valid = choose(group, a, score, ids[rows], labels[rows], slot)
                            some = np.flatnonzero(valid.any(axis=1))
                            if len(some):
                                col, best = _best(score[some], valid[some], k)
                                lists.add(a[some], slot, best, ids[rows][col])
        yield lists.batch(group.id, _FOUND)
    return run


def _same_label(group: Anchors, a, score, ids, labels, slot):
    return (group.label[a][:, None] == labels) & (group.id[a][:, None] != ids)


def _in_slot(group: Anchors, a, score, ids, labels, slot):
    return ((score <= group.upper[a, slot][:, None]) & (score >= group.floor[a, slot][:, None])
            & (group.label[a][:, None] != labels))


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best k rows of each anchor and slot over all tasks, numbered from 1 (``place``)."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, id: str = "vec_id", label: str = "label",
                   vector: str = "embedding", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    ``anchors`` is a condition on the rows of ``vectors``, written with the column ``id`` (e.g. ``F.col("id") % 50 == 0``).
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors, id, label, vector), "hard-negatives-rows")
    chosen = rows.where(anchors)
    cores = spark.sparkContext.defaultParallelism
    numbers, size = rows.agg(F.sum(F.size("vec")), F.sum(F.when(anchors, 8 * (F.size("vec") + 2)))).first()
    groups = max(1, -(-(size or 0) // GROUP_BYTES))
    if (numbers or 0) < cores * TASK_NUMBERS:
        # A table too small to be read in as many splits as there are cores: the work grows with the anchors, too.
        rows = rows.repartition(2 * cores, "id")
    out = None
    for g in range(groups):
        # At most about GROUP_BYTES: a hash deals the anchors over the groups.
        group = Anchors(chosen.where(F.pmod(F.xxhash64("id"), F.lit(groups)) == g).toArrow(), scale)
        shared = spark.sparkContext.broadcast(group)
        good = stage(_top(rows.mapInArrow(_scan(shared, scale, 1, positives, _same_label), FOUND), positives),
                     "hard-negatives-positives")
        group.set_positives(good.select("anchor_id", "place", "score").toArrow(), positives, low, high)
        limited = spark.sparkContext.broadcast(group)
        found = _top(rows.mapInArrow(_scan(limited, scale, positives, negatives, _in_slot), FOUND), negatives)
        part = stage(_windows(good, found, positives, negatives, low), "hard-negatives-found")
        shared.unpersist()
        limited.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def _windows(good: DataFrame, found: DataFrame, positives: int, negatives: int, low: int) -> DataFrame:
    """Every window's answer from the slots' lists: a few rows per anchor."""
    def listed(slot: int) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("slot") == slot, F.struct(
            (-F.col("score")).alias("down"), F.col("id"))))).alias(f"s{slot}")
    lists = found.groupBy("anchor_id").agg(*[listed(j) for j in range(positives)])
    # Descending suffix merge: a slot's scores are all above those of the slots below it.
    merged = [F.col(f"s{positives - 1}")]
    for j in range(positives - 2, -1, -1):
        merged.insert(0, F.slice(F.concat(F.col(f"s{j}"), merged[0]), 1, negatives))
    windows = lists.select("anchor_id", F.posexplode(F.array(*merged)).alias("slot", "best"))
    pairs = good.select("anchor_id", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score")).join(windows, ["anchor_id", "slot"])
    best = F.filter("best", lambda b: -b["down"] * 100 >= F.col("positive_score") * low)
    return pairs.select("anchor_id", "positive_id", "positive_score", F.posexplode(best).alias("at", "hit")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("negative_id"),
        "positive_score", (-F.col("hit.down")).alias("negative_score"))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                  CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
           FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
     p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM (SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS place
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
                   AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
WHERE place <= 3"""
