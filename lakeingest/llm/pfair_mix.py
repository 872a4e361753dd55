"""Mixing sources to target weights by Pfair scheduling (columns and SQL functions only for the rows).

The documents of a source are put in a fixed random order (by md5 of doc_id) and cut into blocks of ``block_rows``. A
source with ``q`` of the ``cycle`` slots (its quota) gives block ``i`` (from 0) the release time ``floor(i * cycle / q)``
and the deadline ``ceil((i + 1) * cycle / q)``. One block goes to each slot; among the released blocks the one with the
earliest deadline is taken (ties: the smaller source name). Quotas sum to ``cycle``, so every slot is used and every
deadline is met: at any slot, until a source runs out, each source has had its share to within less than one block. The
release times are needed: sorted by deadline alone, a heavy source would run ahead of many light ones.

Weights: a mapping of source names to integers, or by default the integer square root of each source's row count. By
default the quotas are the weights themselves, divided by their common divisor, and the cycle is their sum: no rounding,
so the bound holds against the given weights however long the table is. Sources that the mapping leaves out or gives 0
have one slot of a cycle of ``CYCLE`` or more slots (the other weights are multiplied to reach it). With ``cycle`` given,
quotas are the weights' shares of it by largest remainder, and zeros are raised to 1 at the cost of the largest quotas.

The schedule repeats every ``cycle`` slots and depends on the quotas alone, so the driver computes one cycle, or as much
of it as there are blocks for (slots times the log of the sources), and each block's slot follows from its number.
Any number of sources is taken; only a ``cycle`` that is given must have a slot for each (an error, never a cut).

A source that runs out leaves its later slots empty; no document is dropped, and the order of the others stays. A null
source is a source of its own, a null doc_id sorts first, and repeated rows are scheduled one by one. An empty table
gives an empty result. The row numbers of a source come from 256 md5 shards and their counts, so a source with a third of
all rows is spread over many tasks.
"""

from __future__ import annotations

import heapq
import math
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CYCLE = 1000
BLOCK_ROWS = 16
#: Slots of a schedule that the driver computes (4 bytes each); square root weights stay far below.
MAX_SLOTS = 1 << 27
#: Rows of a schedule or list of sources that are broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 1 << 17
_SHIFT = 1 << 20


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _random(doc_id: Column) -> Column:
    return F.coalesce(F.md5(doc_id.cast("string").cast("binary")), F.lit(""))


def exact_quotas(weights: dict[str, int]) -> dict[str, int]:
    """The weights without their common divisor; zeros have one slot of a cycle of at least ``CYCLE``."""
    divisor = math.gcd(*weights.values()) or 1
    zeros = sum(w == 0 for w in weights.values())
    total = sum(weights.values()) // divisor
    times = max(1, -(-(CYCLE - zeros) // total)) if zeros and total else 1
    return {k: w // divisor * times or 1 for k, w in weights.items()}


def rounded_quotas(weights: dict[str, int], cycle: int) -> dict[str, int]:
    """Shares of ``cycle`` by largest remainder over the whole cycle; zeros become 1, taken from the largest quotas."""
    total = sum(weights.values())
    if not total:
        weights, total = dict.fromkeys(weights, 1), len(weights)
    q = {k: w * cycle // total for k, w in weights.items()}
    left = cycle - sum(q.values())
    for k in sorted(q, key=lambda k: (-(weights[k] * cycle % total), k))[:left]:
        q[k] += 1
    zeros = [k for k, n in q.items() if not n]
    largest = [(-n, k) for k, n in q.items() if n]
    heapq.heapify(largest)
    for k in zeros:
        n, big = largest[0]
        q[k], q[big] = 1, -n - 1
        heapq.heapreplace(largest, (n + 1, big))
    return q


def _weights(counts: dict[str, int], weights: dict[str, int] | None) -> dict[str, int]:
    if weights is None:
        return {k: math.isqrt(n) for k, n in counts.items()}
    return {k: max(0, int(weights.get(k[1:], 0))) if k else 0 for k in counts}


def quotas(counts: DataFrame, cycle: int = CYCLE, weights: dict[str, int] | None = None) -> DataFrame:
    """(key, q): slots of each source in a cycle of the given length. ``counts``: (key, n)."""
    found = {r.key: r.n for r in counts.select("key", "n").collect()}
    return counts.sparkSession.createDataFrame(sorted(rounded_quotas(_weights(found, weights), cycle).items()),
                                               "key string, q long")


def picks(quota: list[int], cycle: int, slots: int) -> array:
    """The source (by place in ``quota``) of each of the first ``slots`` slots; quotas sum to ``cycle``."""
    ready: list[tuple[int, int]] = []           # (deadline, source) of the released blocks
    waiting = [(0, i) for i in range(len(quota))]   # (release, source) of the next blocks; sorted, so a heap
    done = [0] * len(quota)
    out = array("i")
    for t in range(slots):
        while waiting and waiting[0][0] <= t:
            _, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(done[i] + 1) * cycle // quota[i]), i))
        _, i = heapq.heappop(ready)
        out.append(i)
        done[i] += 1
        heapq.heappush(waiting, (done[i] * cycle // quota[i], i))
    return out


def _plan(spark, quota: dict[str, int], cycle: int, slots: int) -> DataFrame:
    """(key, q, turn, spot) of the first ``slots`` slots."""
    keys = sorted(quota)
    who = np.frombuffer(picks([quota[k] for k in keys], cycle, slots), dtype=np.int32)
    order = np.argsort(who, kind="stable")
    first = np.cumsum(np.bincount(who, minlength=len(keys))) - np.bincount(who, minlength=len(keys))
    own = who[order]
    table = pa.table({"who": own, "turn": np.arange(slots) - first[own], "spot": order.astype(np.int64)})
    names = spark.createDataFrame([(i, k, quota[k]) for i, k in enumerate(keys)], "who int, key string, q long")
    names = F.broadcast(names) if len(keys) <= BROADCAST_ROWS else names
    return spark.createDataFrame(table).join(names, "who").select("key", "q", "turn", "spot")


def schedule(quota: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """(key, q, turn, spot): the slot ``spot`` of one cycle in which a source has its ``turn``-th block of the cycle."""
    return _plan(quota.sparkSession, {r.key: r.q for r in quota.select("key", "q").collect()}, cycle, cycle)


def scheduled(documents: DataFrame, block_rows: int = BLOCK_ROWS, cycle: int | None = None,
              weights: dict[str, int] | None = None) -> DataFrame:
    """``documents`` with a struct column ``mix`` (in the place of one of that name): block, in_block, slot, release,
    deadline."""
    spark, columns = documents.sparkSession, [c for c in documents.columns if c.lower() != "mix"]
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), _key(F.col("source")).alias("key"),
                            _random(F.col("doc_id")).alias("random")).withColumn("shard", F.substring("random", 1, 2))
    ids = documents.select(_key(F.col("source")).alias("key"),
                           F.substring(_random(F.col("doc_id")), 1, 2).alias("shard"))
    parts = ids.groupBy("key", "shard").agg(F.count("*").alias("n"))
    counts = {r.key: r.n for r in parts.groupBy("key").agg(F.sum("n").alias("n")).collect()}
    if cycle is not None and len(counts) > cycle:
        raise ValueError(f"{len(counts)} sources; a cycle of {cycle} slots takes {cycle} at most")
    wanted = _weights(counts, weights)
    quota = exact_quotas(wanted) if cycle is None else rounded_quotas(wanted, cycle)
    cycle = sum(quota.values())
    # all blocks are placed by the deadline of the last one, and what follows a cycle repeats it
    slots = min(cycle, max((-(-(-(-n // block_rows)) * cycle // quota[k]) for k, n in counts.items()), default=0))
    if slots > MAX_SLOTS:
        raise ValueError(f"weights that need {slots} slots; give cycle to round them")
    before = F.sum("n").over(Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("key", "shard", F.coalesce(before, F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy("key", "shard").orderBy("random", "row.doc_id"))
    blocks = (rows.withColumn("number", number.cast("long") - 1).join(offsets, ["key", "shard"])
              .withColumn("number", F.col("number") + F.col("offset"))
              .withColumn("block", F.floor(F.col("number") / block_rows).cast("long")))
    known = spark.createDataFrame(sorted(quota.items()), "key string, q long")
    plan = _plan(spark, quota, cycle, slots).drop("q")
    few = len(quota) <= BROADCAST_ROWS
    placed = (blocks.join(F.broadcast(known) if few else known, "key").withColumn("turn", F.col("block") % F.col("q"))
              .join(F.broadcast(plan) if slots <= BROADCAST_ROWS else plan, ["key", "turn"]))
    return placed.select("row.*", F.struct(
        "block", (F.col("number") % block_rows).alias("in_block"),
        F.expr(f"block div q * {cycle}L + spot").alias("slot"),
        F.expr(f"block * {cycle}L div q").alias("release"),
        F.expr(f"((block + 1) * {cycle}L + q - 1) div q").alias("deadline")).alias("mix"))


def _as_rows(documents: DataFrame) -> DataFrame:
    """doc_id, source and the whole row as a struct, so that no column's name can clash with the operator's."""
    return documents.select("doc_id", "source", F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))


def in_slots(documents: DataFrame, **options) -> DataFrame:
    """All rows of ``documents`` with their slot and in_block (in the place of columns of these names), sorted by them."""
    placed = scheduled(_as_rows(documents), **options)
    return placed.select(*(F.col("row")[c].alias(c) for c in documents.columns if c not in ("slot", "in_block")),
                         "mix.slot", "mix.in_block").orderBy("slot", "in_block")


def mix_documents(documents: DataFrame, **options) -> DataFrame:
    """All rows of ``documents``, unchanged, sorted by slot and place in the block across partitions."""
    placed = scheduled(_as_rows(documents), **options)
    return placed.orderBy("mix.slot", "mix.in_block").select("row.*")


#: Weights are exact: the square roots without their common divisor, and as many slots as they sum to. The slots that have a
#: block are found source by source in release order, each taking the free slot that earliest deadline first gives it.
ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
       coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS random FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY random, doc_id) - 1 AS number FROM d),
w AS (SELECT key, greatest(CAST(floor(sqrt(count(*))) AS BIGINT), 1) AS w, count(*) AS rows FROM d GROUP BY key),
g AS (SELECT list_reduce(list(w), lambda a, b: gcd(a, b)) AS divisor FROM w),
q AS (SELECT key, w // divisor AS q, rows FROM w, g),
l AS (SELECT list(q ORDER BY key) AS qs, list(key ORDER BY key) AS ks, CAST(sum(q) AS BIGINT) AS cycle,
             CAST(least(sum(q), max((((rows + {BLOCK_ROWS - 1}) // {BLOCK_ROWS}) * total + q - 1) // q)) AS BIGINT) AS slots
      FROM q, (SELECT sum(q) AS total FROM q)),
e(t, done, p) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(qs, lambda x: CAST(0 AS BIGINT)), CAST(-1 AS BIGINT) FROM l
  UNION ALL
  SELECT t, list_transform(done, lambda x, i: x + CASE WHEN i = p THEN 1 ELSE 0 END), p FROM (
    SELECT t + 1 AS t, done, list_min(list_transform(done, lambda x, i: CASE
             WHEN (x * cycle) // qs[i] <= t + 1
             THEN ((x + 1) * cycle + qs[i] - 1) // qs[i] * {_SHIFT} + i END)) % {_SHIFT} AS p
    FROM e, l WHERE t < slots - 1) AS x),
pl AS (SELECT ks[p] AS key, t AS spot, row_number() OVER (PARTITION BY p ORDER BY t) - 1 AS turn FROM e, l WHERE t >= 0),
b AS (SELECT *, number // {BLOCK_ROWS} AS block FROM n JOIN q USING (key), (SELECT cycle FROM l))
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(number % {BLOCK_ROWS} AS BIGINT) AS in_block,
       CAST(block // q * cycle + spot AS BIGINT) AS slot, CAST(block * cycle // q AS BIGINT) AS release,
       CAST(((block + 1) * cycle + q - 1) // q AS BIGINT) AS deadline
FROM b JOIN pl ON b.key = pl.key AND b.block % b.q = pl.turn"""
