"""Approximate nearest neighbours with a forest of hash prefixes.

A tree gives each vector a long hash string and keeps the strings as a sorted array. Its symbols come from random
rotations of the unit vector: the axis nearest to the rotated vector, with its sign (``2 * dimension`` symbols). Vectors
at a small angle share long prefixes in some tree.

A query descends in every tree to its longest prefix match, then all trees ascend together, one symbol at a time. At
each level the vectors that share that many symbols in any tree become candidates, those found in more trees first,
until the budget of the first look is reached (all ties are taken, and the root, which holds every vector, is reached if
need be). Candidates are ranked by their exact cosine in double precision on the original vectors.

The first look does not end the search. The chance that two vectors share a symbol depends on their cosine alone, and
trees are independent, so the k-th cosine found tells how many trees a vector at least as near shares a prefix with: at
each prefix length, the most trees that such a vector reaches with a chance of ``1 - MISS`` or more. Of the lengths, the
one that random vectors pass least is taken, and all vectors that reach its count are ranked too. Those left out would
be missed neighbours with a chance of at most ``MISS`` each, whatever the number of vectors, blocks or partitions; where
no length tells enough, every vector of the block is ranked.

Equal vectors are stored once with their smallest ``k + 1`` ids, so any number of copies costs one entry and no result is
lost. Vectors are dealt to blocks of about ``BLOCK_VECTORS`` by hash (small tables to up to ``LEAST_BLOCKS`` of
``SMALL_BLOCK`` or more), each with a forest of its own, and queries in chunks of at most ``CHUNK_QUERIES`` visit every
block: the stated query set against all rows, in blocks. Nothing is broadcast. A task holds one block and one chunk.

Hashing needs no fitting; the chance of a shared symbol at a cosine is sampled once for each dimension. Isotropic vectors
are the hardest case, where the search ranks a share of each block that the cosine sets; vectors that cluster need far
fewer candidates.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, neither do rows without vec_id.
Vectors of different dimension are not compared. Repeated rows count once; a vec_id with several vectors is a query for
each, and never its own neighbour. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exchange import stage

TREES = 64
SYMBOLS = 3
CANDIDATES = 8192
LEAST_CANDIDATES = 128
MISS = 0.05
COSINES = 64
BLOCK_VECTORS = 1 << 16
SMALL_BLOCK = 1 << 11
LEAST_BLOCKS = 16
CHUNK_QUERIES = 1 << 14


@functools.lru_cache(maxsize=4)
def rotations(dimension: int, trees: int, symbols: int) -> np.ndarray:
    """(trees, symbols, dimension, dimension) random rotations, the same in every worker."""
    rng = np.random.default_rng([20240701, dimension])
    shape = (trees, symbols, dimension, dimension)
    return np.linalg.qr(rng.standard_normal(shape))[0].astype(np.float32)


def hash_strings(unit: np.ndarray, trees: int, symbols: int) -> np.ndarray:
    """(trees, vectors) strings as integers, first symbol in the highest digit of base ``2 * dimension``."""
    n, dimension = unit.shape
    unit = unit.astype(np.float32)
    out = np.zeros((trees, n), dtype=np.int64)
    for t, tree in enumerate(rotations(dimension, trees, symbols)):
        for rotation in tree:
            turned = unit @ rotation
            axis = np.argmax(np.abs(turned), axis=1)
            out[t] = out[t] * (2 * dimension) + 2 * axis + (turned[np.arange(n), axis] > 0)
    return out


def candidates(strings: np.ndarray, order: np.ndarray, query: np.ndarray, base: int, symbols: int, budget: int) -> np.ndarray:
    """Synchronous ascent of one query. ``strings``: sorted strings of each tree, ``order``: the vectors in that order."""
    n = strings.shape[1]
    if n <= budget:
        return np.arange(n)
    found = np.zeros(0, dtype=np.int64)
    for level in range(symbols, 0, -1):
        width = base ** (symbols - level)
        runs = []
        for tree, own, q in zip(strings, order, query):
            low = q // width * width
            i, j = np.searchsorted(tree, [low, low + width])
            if i < j:
                runs.append(own[i:j])
        if not runs:
            continue
        seen, votes = np.unique(np.concatenate(runs), return_counts=True)
        if len(seen) >= budget:
            fresh = ~np.isin(seen, found)
            votes = votes[fresh]
            missing = budget - len(found)
            least = np.partition(votes, len(votes) - missing)[len(votes) - missing]
            return np.concatenate([found, seen[fresh][votes >= least]])
        found = seen
    return np.arange(n)


@functools.lru_cache(maxsize=4)
def shared_symbol(dimension: int) -> np.ndarray:
    """Chance that vectors at cosine ``i / COSINES`` share a symbol, two standard errors below its sample."""
    rng = np.random.default_rng([20240702, dimension])
    n = max(2000, min(20000, 2_000_000 // dimension))
    if dimension == 1:
        return np.concatenate([np.zeros(1), np.ones(COSINES)])      # cosines are 1 or -1
    x, y = rng.standard_normal((2, n, dimension), dtype=np.float32)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.sqrt((y * y).sum(axis=1, keepdims=True))

    def symbol(v):
        axis = np.argmax(np.abs(v), axis=1)
        return 2 * axis + (v[np.arange(n), axis] > 0)
    own = symbol(x)
    hit = np.array([(symbol(c * x + math.sqrt(1 - c * c) * y) == own).mean() for c in np.arange(COSINES + 1) / COSINES])
    return np.maximum(hit - 2 * np.sqrt(hit * (1 - hit) / n), 0.0)


@functools.lru_cache(maxsize=4096)
def votes_of(dimension: int, trees: int, symbols: int, step: int) -> tuple[int, int]:
    """(level, votes): vectors at cosine ``step / COSINES`` or more share ``level`` symbols in ``votes`` or more trees with
    a chance of ``1 - MISS``; (0, 0) if no level tells that much."""
    def fewer(chance: float, votes: int) -> float:
        return sum(math.comb(trees, i) * chance ** i * (1 - chance) ** (trees - i) for i in range(votes))
    best = (1.0, 0, 0)
    p = float(shared_symbol(dimension)[step]) if step > 0 else 0.0
    for level in range(1, symbols + 1):
        votes = 0
        while votes < trees and fewer(p ** level, votes + 1) <= MISS:
            votes += 1
        if votes:
            best = min(best, (1 - fewer((2 * dimension) ** -level, votes), level, votes))
    return best[1], best[2]


def grown(strings: np.ndarray, order: np.ndarray, query: np.ndarray, dimension: int, symbols: int, near: np.ndarray,
          bar: float) -> np.ndarray:
    """The vectors besides ``near`` that the cosine ``bar``, the k-th of ``near``, does not rule out."""
    trees, n = strings.shape
    # vectors equal but for rounding may differ in a symbol, so a bar of 1 counts as the step before it
    level, votes = votes_of(dimension, trees, symbols, min(COSINES - 1, max(0, math.floor(bar * COSINES))))
    count = np.zeros(n, dtype=np.int64)
    if level:
        width = (2 * dimension) ** (symbols - level)
        low = query // width * width
        runs = [own[slice(*np.searchsorted(tree, [q, q + width]))] for tree, own, q in zip(strings, order, low)]
        count = np.bincount(np.concatenate(runs), minlength=n)
    count[near] = -1
    return np.flatnonzero(count >= votes)


def _distinct(kept: int):
    """Per batch: distinct valid vectors (as bytes of doubles) with their smallest ids."""
    def run(batches):
        for batch in batches:
            best: dict[bytes, list[int]] = {}
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector")):
                values = vector.values
                if values is None or not len(values) or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                if np.isfinite(x).all() and x.any():
                    best.setdefault(x.tobytes(), []).append(vec_id)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.binary()),
                 pa.array([sorted(set(v))[:kept] for v in best.values()], pa.list_(pa.int64()))], names=["vector", "ids"])
    return run


def _search(k: int, trees: int, symbols: int, budget: int):
    def unit(x):
        scale = np.abs(x).max(axis=1, keepdims=True)      # no overflow or underflow of the squares
        x = x / scale
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    def run(key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        rows = ([], [], [], [])
        stored, asked = vectors.column("vector").to_pylist(), queries.column("vector").to_pylist()
        ids, query_ids = vectors.column("ids").to_pylist(), queries.column("query_id").to_pylist()
        query_keys = queries.column("query_key").to_pylist()
        for length in set(map(len, stored)):
            own = [i for i, v in enumerate(stored) if len(v) == length]
            mine = [i for i, v in enumerate(asked) if len(v) == length]
            if not mine:
                continue
            x = unit(np.frombuffer(b"".join(stored[i] for i in own)).reshape(len(own), -1))
            q = unit(np.frombuffer(b"".join(asked[i] for i in mine)).reshape(len(mine), -1))
            base = 2 * x.shape[1]
            depth = min(symbols, int(62 / math.log2(base)))
            strings = hash_strings(x, trees, depth)
            order = np.argsort(strings, axis=1, kind="stable")
            strings = np.take_along_axis(strings, order, axis=1)
            wanted = hash_strings(q, trees, depth)
            for row, i in enumerate(mine):
                near = candidates(strings, order, wanted[:, row], base, depth, budget)
                score = x[near] @ q[row]
                if len(near) < len(x):
                    # one more than k: the query's own vector may be among them
                    bar = np.partition(score, len(near) - k - 1)[len(near) - k - 1] if len(near) > k else -1.0
                    more = grown(strings, order, wanted[:, row], x.shape[1], depth, near, float(bar))
                    near, score = np.concatenate([near, more]), np.concatenate([score, x[more] @ q[row]])
                # all that tie with the (k + 1)-th, the query's own vector included
                if len(near) > k + 1:
                    bar = np.partition(score, len(near) - k - 1)[len(near) - k - 1]
                    near, score = near[score >= bar], score[score >= bar]
                best = sorted((-float(s), v) for s, c in zip(score, near) for v in ids[own[c]] if v != query_ids[i])[:k]
                for s, v in best:
                    for column, value in zip(rows, (query_ids[i], query_keys[i], v, min(1.0, max(-1.0, -s)))):
                        column.append(value)
        return pa.table({"query_id": pa.array(rows[0], pa.int64()), "query_key": pa.array(rows[1], pa.int64()),
                         "vec_id": pa.array(rows[2], pa.int64()), "score": pa.array(rows[3], pa.float64())})
    return run


def blocks_of(n: int) -> int:
    """Blocks of a table of ``n`` distinct vectors; the session's partitions have no say."""
    return max(1, -(-n // BLOCK_VECTORS), min(LEAST_BLOCKS, n // SMALL_BLOCK))


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5, trees: int = TREES, symbols: int = SYMBOLS,
            budget: int = CANDIDATES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, nearest first, ties to smaller vec_id.

    ``budget``: vectors of the first look of a query, over all blocks.
    ``embeddings``: (vec_id, embedding); ``is_query`` is a condition on vec_id.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")).filter(
        "vec_id IS NOT NULL AND vector IS NOT NULL")
    # copies in one batch, then across batches, keep their smallest k + 1 ids: one may be the query itself
    distinct = stage(rows.mapInArrow(_distinct(k + 1), "vector binary, ids array<long>").groupBy("vector").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")), "forest-vectors")
    asked = stage(rows.filter(is_query).mapInArrow(_distinct(1 << 30), "vector binary, ids array<long>").select(
        "vector", F.explode("ids").alias("query_id")).distinct().withColumn(
        "query_key", F.xxhash64("vector")), "forest-queries")
    n, m = distinct.count(), asked.count()
    blocks = blocks_of(n)
    chunks = max(1, -(-m // CHUNK_QUERIES))
    every = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    x = distinct.select("vector", "ids", F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int").alias("block"), every)
    q = asked.select("vector", "query_id", "query_key",
                     F.pmod(F.xxhash64("query_id", "vector"), F.lit(chunks)).cast("int").alias("chunk"),
                     F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    share = max(LEAST_CANDIDATES, -(-budget // blocks))
    found = x.groupBy("block", "chunk").cogroup(q.groupBy("block", "chunk")).applyInArrow(
        _search(k, trees, symbols, share), "query_id long, query_key long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
