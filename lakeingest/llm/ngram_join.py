"""N-gram Jaccard self-join by T-occurrence search (DivideSkip).

Two documents link when ``100 * |A & B| >= similarity * |A | B|`` over their sets of word shingles. A document of ``n``
shingles links only with documents that share at least ``T = ceil(similarity * n / 100)`` of them, so a search for its
partners is a T-occurrence query over the inverted lists of its shingles. DivideSkip splits these lists: the short
ones (the ``n - T + 1`` rarest shingles) are merged with a heap, the remaining ``T - 1`` long ones are never merged;
each merged candidate is looked up in them by binary search, until the required overlap is out of reach.

Steps, all linear in the input:

1. Documents with the same word sequence form a class (an aggregate, so a class may hold a third of all rows).
2. Classes without enough shared shingles are set aside. Each class sends the ``n - T + l`` smallest hashes of its set
   (``l`` about ``n / 10``); partners share at least ``l(T)`` of those, so a class with fewer shared ones has no link.
   Shingles found twice inside a task are counted there, so a shingle of a third of all documents sends one entry a task.
3. For the remaining classes, document frequencies are counted exactly, the order of rarity is fixed, and the short
   lists are written. The heaviest shingles (a bounded set, ``HEAVY_KEPT``) come last in that order and are not counted.
4. Searches run in rounds. Each list names hubs; a hub is a query whose short lists are merged. Found links join the
   components; lists whose documents are all in one component are done, and hubs leave their lists. The first round has
   one hub a list, so it costs one candidate per entry, and a group of near copies ends there. What is left are lists
   across components. Where up to ``SHORT_LIST`` documents are outside a list's largest component, these are its hubs and
   the second round finishes the list; others get 8, 64, ... hubs a round. No pair that could join two components is
   skipped.
5. Documents that no list connects need no look at each other, so before each round what is left falls into groups, and
   groups of bounded work are settled by the same search over arrays, in one pass: the short lists of each document outside
   their largest component are merged, and each merged document of another component is probed in full. Small groups share a
   task. A larger one is cut into blocks of ``SETTLE_SHINGLES`` shared shingles, each searched by the documents of every
   slice of the group, so that a task has ``SETTLE_PAIRS`` places to merge at most; only a group of more than
   ``SETTLE_CUTS`` blocks or slices takes another round first. The result is the same; only rounds are saved.

Order and repeats of rows do not matter. A null text, or one without words, has no shingles and links with nothing;
with fewer words than a shingle has, the whole sequence is the one shingle. Rows without doc_id take part but name no
component. Rows that repeat a doc_id keep one result row each. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .exchange import by_kind, deal, exchange, gather, partitions, stage, unstage
from .textblocks import chunks, grams, mix64, sequence_hash, words

#: Shingles a task holds before it sends them: about 50 bytes each while they are sorted.
FLUSH_SHINGLES = 1_500_000
HEAVY_KEPT = 1 << 16
HEAVY_LOCAL = 32
POSTINGS_PER_BLOCK = 8192
SHORT_LIST = 64
#: What one task settles: 8 bytes a shared shingle, and about 2 ns a place of a merged list. A group is cut so often at most.
SETTLE_SHINGLES = 4_000_000
SETTLE_PAIRS = 400_000_000
SETTLE_CUTS = 16
#: Shared shingles of the small groups that are settled together.
SETTLE_TOGETHER = 500_000
PROBED_AT_ONCE = 64
#: Rows (24 bytes each) of the classes looked at again, and of the doc_ids that go, that are broadcast to the texts; more of them
#: are joined by shuffle.
BROADCAST_CLASSES = 1_000_000
_SEQ, _CHECK, _SHORT = 1, 2, 7

_STEP1 = pa.schema([("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()),
                    ("n", pa.int64())])
_DOCS = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("shared", pa.list_(pa.int64())),
                   ("short", pa.list_(pa.int64()))])


def needed(n, similarity: int):
    """T: the least overlap of a set of ``n`` with a partner."""
    return (n * similarity + 99) // 100


def spare(n):
    """l: shared entries that partners must have in the smallest ``n - T + l`` hashes."""
    return np.maximum(1, n // 10)


def shingle_sets(column: pa.Array, k: int):
    """Per chunk: (first row, end row, class hash, check hash, list of sorted distinct shingle arrays)."""
    for low, high, data, begin in chunks(column):
        w = words(data, begin)
        h = w.hashes(lower=True)
        first, check = sequence_hash(h, w, _SEQ), sequence_hash(h, w, _CHECK)
        g, at = grams(h, w.doc, k)
        bounds = np.searchsorted(w.doc[at], np.arange(high - low + 1))
        count = np.diff(w.first)
        short = mix64(sequence_hash(h, w, _SHORT))
        sets = [np.unique(g[bounds[i]:bounds[i + 1]]) if count[i] >= k else short[i:i + 1] if count[i] else g[:0]
                for i in range(high - low)]
        yield low, high, first, check, sets


def _flush(n_parts: int, similarity: int, held: list) -> list[pa.RecordBatch]:
    """Blocks of a run of documents: 0 documents, 1 entries, 2 counts by class, 3 frequent shingles."""
    ids = np.concatenate([x[0] for x in held])
    h1 = np.concatenate([x[1] for x in held])
    h2 = np.concatenate([x[2] for x in held])
    sets = [s for x in held for s in x[3]]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = [deal(0, h1, n_parts, [ids, h1, h2, sizes])]
    everything = np.concatenate(sets)
    if not len(everything):
        return out
    _, one = np.unique(h1, return_index=True)   # copies inside the run count once
    once = np.zeros(len(h1), dtype=bool)
    once[one] = True
    heads = np.cumsum(sizes) - sizes
    rank = np.arange(len(everything)) - np.repeat(heads, sizes)
    keep = np.repeat(once, sizes)
    values, counts = np.unique(everything[keep], return_counts=True)
    if (often := counts >= HEAVY_LOCAL).any():
        out.append(deal(3, values[often], n_parts, [values[often], counts[often].astype(np.int64)]))
    prefix = keep & (rank < np.repeat(sizes - needed(sizes, similarity) + spare(sizes), sizes))
    value, owner = everything[prefix], np.repeat(h1, sizes)[prefix]
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    first = np.append(True, value[1:] != value[:-1])
    several = np.append(~first[1:], False)          # of a first entry: others follow
    multi = several[first]
    out.append(deal(1, value[first], n_parts, [value[first], owner[first], multi.astype(np.uint8)]))
    again = ~first | several
    if again.any():
        owners, c = np.unique(owner[again], return_counts=True)
        out.append(deal(2, owners, n_parts, [owners, c.astype(np.int64)]))
    return out


def _step1(k: int, similarity: int, n_parts: int):
    def emit(batches):
        held, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id")
            null = np.int64(np.iinfo(np.int64).min)
            ids = ids.fill_null(int(null)).to_numpy(zero_copy_only=False)
            for low, high, h1, h2, sets in shingle_sets(batch.column("text"), k):
                held.append((ids[low:high], h1, h2, sets))
                size += sum(map(len, sets))
                if size >= FLUSH_SHINGLES:
                    yield from _flush(n_parts, similarity, held)
                    held, size = [], 0
        if held:
            yield from _flush(n_parts, similarity, held)

    def reduce(batches):
        blocks = by_kind(batches)
        ids, h1, h2, sizes = gather(blocks.get(0, []), ["i8", "u8", "u8", "i8"])
        yield _rows(0, h1, h2, ids, sizes)
        value, owner, multi = gather(blocks.get(1, []), ["u8", "u8", "u1"])
        if len(value):
            order = np.lexsort((owner, value))
            value, owner, multi = value[order], owner[order], multi[order].astype(bool)
            new = np.append(True, value[1:] != value[:-1])
            group = np.cumsum(new) - 1
            own = np.append(True, new[1:] | (owner[1:] != owner[:-1]))   # repeats of a class count once
            shared = (np.bincount(group, weights=own) > 1) | (np.bincount(group, weights=multi) > 0)
            # entries found twice in their own task were counted there
            counted = np.zeros(len(value), dtype=bool)
            starts = np.flatnonzero(own)
            counted[starts] = np.add.reduceat(multi.astype(np.int64), starts) > 0
            owners, c = np.unique(owner[own & ~counted & shared[group]], return_counts=True)
            yield _rows(2, owners, owners, None, c)
        yield _totals(2, blocks, ["u8", "i8"])
        yield _totals(3, blocks, ["u8", "i8"])
    return emit, reduce


def _totals(kind: int, blocks: dict, kinds: list[str]) -> pa.RecordBatch:
    key, count = gather(blocks.get(kind, []), kinds)
    keys, inverse = np.unique(key, return_inverse=True)
    return _rows(kind, keys, keys, None, np.bincount(inverse, weights=count, minlength=len(keys)).astype(np.int64))


def _rows(kind, h1, h2, ids, n) -> pa.RecordBatch:
    ids = np.zeros(len(h1), dtype=np.int64) if ids is None else ids
    ids = pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(h1), kind), pa.int32()), pa.array(h1.view(np.int64)),
                                       pa.array(h2.view(np.int64)), ids, pa.array(n, pa.int64())], schema=_STEP1)


def _step3(k: int, n_parts: int, heavy: np.ndarray):
    def emit(batches):
        for batch in batches:
            h1s = batch.column("h1").to_numpy().view(np.uint64)
            h2s = batch.column("h2").to_numpy().view(np.uint64)
            for low, high, h1, h2, sets in shingle_sets(batch.column("text"), k):
                use = np.flatnonzero((h1 == h1s[low:high]) & (h2 == h2s[low:high]))
                if not len(use):
                    continue
                sets = [sets[i] for i in use]
                nodes = h1[use]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                value, owner = np.concatenate(sets), np.repeat(nodes, sizes)
                if len(heavy):
                    hot = heavy[np.minimum(np.searchsorted(heavy, value), len(heavy) - 1)] == value
                else:
                    hot = np.zeros(len(value), dtype=bool)
                yield deal(0, mix64(nodes), n_parts, [nodes, sizes])
                if hot.any():
                    yield deal(2, mix64(owner[hot]), n_parts, [owner[hot], value[hot]])
                if not hot.all():
                    yield deal(1, value[~hot], n_parts, [value[~hot], owner[~hot]])

    def count(batches):
        """Entries of a shingle become (class, shingle, frequency), dealt by class; lone shingles end here."""
        blocks = by_kind(batches)
        for kind, kinds in ((0, ["u8", "i8"]), (2, ["u8", "u8"])):
            key, value = gather(blocks.get(kind, []), kinds)
            if len(key):
                yield deal(kind, mix64(key), n_parts, [key, value])
        value, owner = gather(blocks.get(1, []), ["u8", "u8"])
        if not len(value):
            return
        order = np.lexsort((owner, value))
        value, owner = value[order], owner[order]
        own = np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))
        value, owner = value[own], owner[own]
        _, inverse, c = np.unique(value, return_inverse=True, return_counts=True)
        c = c[inverse]
        more = c > 1
        if more.any():
            yield deal(1, mix64(owner[more]), n_parts, [owner[more], value[more], c[more].astype(np.uint32)])
    return emit, count


def _assemble(similarity: int):
    def reduce(batches):
        """(class, set size, shared shingles sorted, short lists: the rarest shared shingles)."""
        blocks = by_kind(batches)
        nodes, sizes = gather(blocks.get(0, []), ["u8", "i8"])
        nodes, one = np.unique(nodes, return_index=True)
        sizes = sizes[one]
        owner, value, count = gather(blocks.get(1, []), ["u8", "u8", "u4"])
        owner2, value2 = gather(blocks.get(2, []), ["u8", "u8"])
        owner, value = np.concatenate([owner, owner2]), np.concatenate([value, value2])
        count = np.concatenate([count.astype(np.int64), np.full(len(owner2), np.iinfo(np.int64).max)])
        order = np.lexsort((value, count, owner))
        owner, value = owner[order], value[order]
        if len(owner):
            own = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))
            owner, value = owner[own], value[own]
        low, high = np.searchsorted(owner, nodes), np.searchsorted(owner, nodes, side="right")
        out = []
        for node, n, i, j in zip(nodes, sizes, low, high):
            reach = (j - i) - int(needed(n, similarity)) + 1      # of the n - T + 1 rarest, those that are shared
            if reach > 0:
                listed = value[i:j].view(np.int64)
                out.append((node, n, np.sort(listed), listed[:reach]))
        for at in range(0, len(out), 500):
            part = out[at:at + 500]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array([p[0] for p in part], dtype=np.uint64).view(np.int64)),
                 pa.array([int(p[1]) for p in part], pa.int64()), pa.array([p[2] for p in part], pa.list_(pa.int64())),
                 pa.array([p[3] for p in part], pa.list_(pa.int64()))], schema=_DOCS)
    return reduce


def merge_short(lists: list[tuple[int, list[int]]]):
    """Heap merge of sorted posting lists (shingle, documents): each document with the shingles of the lists it is in."""
    tagged = ([(doc, shingle) for doc in docs] for shingle, docs in lists)
    for doc, hits in groupby(heapq.merge(*tagged), key=lambda x: x[0]):
        yield doc, [shingle for _, shingle in hits]


def probe_long(hits: int, lists: np.ndarray, own: np.ndarray, required: int, step: int = 64) -> int:
    """``hits`` plus the number of long lists that hold the document whose sorted shingles are ``own``.

    Lists are probed by binary search; probing ends (with a number below ``required``) once the overlap is out of reach.
    """
    for at in range(0, len(lists), step):
        if hits + len(lists) - at < required:
            break
        part = lists[at:at + step]
        place = np.searchsorted(own, part)
        hits += int((own[np.minimum(place, len(own) - 1)] == part).sum()) if len(own) else 0
    return hits


def _merge(batches):
    for batch in batches:
        queries, docs, hits = [], [], []
        for query, postings in zip(batch.column("query").to_pylist(), batch.column("postings").to_pylist()):
            lists = [(s, [x["node"] for x in own]) for s, own in groupby(postings, key=lambda x: x["s"])]
            for doc, found in merge_short(lists):
                queries.append(query)
                docs.append(doc)
                hits.append(found)
        yield pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), pa.array(docs, pa.int64()),
                                          pa.array(hits, pa.list_(pa.int64()))], names=["query", "node", "hits"])


def _probe(similarity: int):
    def run(batches):
        for batch in batches:
            q, d = batch.column("query").to_pylist(), batch.column("node").to_pylist()
            nq, nd = batch.column("query_n").to_pylist(), batch.column("n").to_pylist()
            hits, lists, shared = batch.column("hits"), batch.column("lists"), batch.column("shared")
            linked = []
            for i in range(batch.num_rows):
                # overlap o of sizes a and b is enough when (100 + s) * o >= s * (a + b)
                required = -(-similarity * (nq[i] + nd[i]) // (100 + similarity))
                # merged lists hold a document only where the shingle is among its rarest: what was not hit is probed
                merged = hits[i].values.to_numpy()
                long = np.setdiff1d(lists[i].values.to_numpy(), merged, assume_unique=True)
                if probe_long(len(merged), long, shared[i].values.to_numpy(), required) >= required:
                    linked.append((q[i], d[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in linked], pa.int64()),
                                              pa.array([x[1] for x in linked], pa.int64())], names=["a", "b"])
    return run


def search(lists: DataFrame, docs: DataFrame, hubs: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) between each hub of a list and the list's documents of other components.

    ``lists``: (s, node, n, m, c), m being the number of shared shingles; ``hubs``: (s, query, query_n, query_m, query_c,
    size, rest); ``docs``: (node, n, shared, short).
    ``rest`` is the component whose documents are no hubs of the list, where all others are: pairs of hubs are then
    taken once. Conditions are part of the join, so pairs that need no look are never rows.
    """
    load = hubs.groupBy("query").agg(F.ceil(F.sum("size") / POSTINGS_PER_BLOCK).alias("blocks"))
    h = hubs.join(load, "query").withColumnRenamed("s", "hub_s")
    wanted = (F.col("s") == F.col("hub_s")) & (F.col("c") != F.col("query_c")) & \
        (F.col("query_n") * similarity <= F.col("n") * 100) & (F.col("n") * similarity <= F.col("query_n") * 100) & \
        ((F.col("query_n") + F.col("n")) * similarity <= F.least("query_m", "m") * (100 + similarity)) & \
        (F.col("rest").isNull() | (F.col("c") == F.col("rest")) | (F.col("query") < F.col("node")))
    blocks = lists.join(h, wanted).groupBy("query", F.expr("pmod(xxhash64(node), blocks)").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("s", "node"))).alias("postings"))
    found = blocks.select("query", "postings").mapInArrow(_merge, "query long, node long, hits array<long>")
    queries = docs.select(F.col("node").alias("query"), F.col("n").alias("query_n"), F.col("shared").alias("lists"))
    pairs = found.join(docs.select("node", "n", "shared"), "node").join(queries, "query")
    return pairs.select("query", "node", "query_n", "n", "hits", "lists", "shared").mapInArrow(
        _probe(similarity), "a long, b long")


def _postings(listed: list[np.ndarray], names: np.ndarray):
    """Documents by list (each list's ascending) with the start of each list, and by document its lists and its places."""
    sizes = np.array([len(x) for x in listed], dtype=np.int64)
    which = np.searchsorted(names, np.concatenate(listed))
    owner = np.repeat(np.arange(len(listed), dtype=np.int32), sizes)
    by_list = np.argsort(which, kind="stable")
    place = np.empty(len(which), dtype=np.int64)
    place[by_list] = np.arange(len(which))
    return (owner[by_list], np.searchsorted(which[by_list], np.arange(len(names) + 1)), which, place,
            np.concatenate([[0], np.cumsum(sizes)]))


def settle(node: np.ndarray, n: np.ndarray, comp: np.ndarray, shared: list[np.ndarray], listed: list[np.ndarray],
           similarity: int, large: list[np.ndarray] | None = None, held: np.ndarray | None = None,
           asks: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the components of all these documents: (a, b), one for each time two components become one.

    ``shared`` are the sorted shared shingles of a document, ``listed`` those of the lists it is still in. Documents are
    taken by size, each against the smaller ones before it in its lists, and against all that have the list in ``large``:
    documents of one component, which are not searched for each other. Where only a part of a group is at hand, documents
    that ``asks`` marks are searched among those that ``held`` marks.
    """
    order = np.lexsort((node, n))
    node, n, comp = node[order], n[order], comp[order]
    large = [x[:0] for x in listed] if large is None else large
    shared, listed, large = [shared[i] for i in order], [listed[i] for i in order], [large[i] for i in order]
    asked = range(len(node)) if asks is None else np.flatnonzero(asks[order])
    held = None if held is None or held.all() else held[order]
    m = np.array([len(x) for x in shared], dtype=np.int64)
    ends = np.cumsum(m)
    values, flat = np.unique(np.concatenate(shared), return_inverse=True)
    own, seen = np.zeros(len(values), dtype=bool), np.zeros(len(node), dtype=bool)
    names = np.unique(np.concatenate(listed + large))
    posting, heads, which, place, starts = _postings(listed, names)
    posting2, heads2, *_ = _postings(large, names)
    _, root = np.unique(comp, return_inverse=True)          # the component of each document, as a label
    links = []
    for i in asked:
        entry = slice(starts[i], starts[i + 1])
        lists = [posting[low:high] for low, high in zip(heads[which[entry]], place[entry]) if high > low]
        lists += [posting2[low:high] for low, high in zip(heads2[which[entry]], heads2[which[entry] + 1]) if high > low]
        for x in lists:
            seen[x] = True
        found = np.flatnonzero(seen)                        # the merged short lists
        seen[found] = False
        if held is not None:
            found = found[held[found]]
        found = found[root[found] != root[i]]
        found = found[(n[found] * 100 >= n[i] * similarity) & (n[i] * 100 >= n[found] * similarity) & (
            (n[found] + n[i]) * similarity <= np.minimum(m[found], m[i]) * (100 + similarity))]
        if not len(found):
            continue
        mine = flat[ends[i] - m[i]:ends[i]]
        own[mine] = True
        step = PROBED_AT_ONCE
        while len(found):
            some, found = found[:step], found[step:]
            hit = own[np.concatenate([flat[ends[j] - m[j]:ends[j]] for j in some])]
            overlap = np.add.reduceat(hit.astype(np.int64), np.cumsum(m[some]) - m[some])
            for j in some[(100 + similarity) * overlap >= similarity * (n[some] + n[i])]:
                if root[j] != root[i]:
                    links.append((int(node[i]), int(node[j])))
                    root[root == root[j]] = root[i]
            found = found[root[found] != root[i]]
            step = min(2 * step, 16 * PROBED_AT_ONCE)
        own[mine] = False
    return links


def _settled(similarity: int):
    """Links of the units (part, i, j) of a partition, which is sorted by unit."""
    numbers, arrays = ("node", "n", "c", "held", "asks"), ("shared", "listed", "large")

    def links(rows):
        node, n, c, held, asks = (np.concatenate(x) for x in zip(*(r[0] for r in rows)))
        shared, listed, large = ([x for r in rows for x in r[1][k]] for k in range(3))
        found = settle(node, n, c, shared, listed, similarity, large, held, asks) if asks.any() else []
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                           pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    def run(batches):
        rows, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = np.stack([batch.column(k).to_numpy() for k in ("part", "i", "j")])
            cuts = [0, *(np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            flat = [batch.column(k).to_numpy(zero_copy_only=False) for k in numbers]
            parts = [(batch.column(k).flatten().to_numpy(), batch.column(k).offsets.to_numpy()) for k in arrays]
            parts = [(values, at - at[0]) for values, at in parts]
            for low, high in zip(cuts, cuts[1:]):
                if rows and tuple(unit[:, low]) != last:
                    yield links(rows)
                    rows = []
                last = tuple(unit[:, low])
                rows.append(([x[low:high] for x in flat], [
                    np.split(values[at[low]:at[high]], at[low + 1:high] - at[low]) for values, at in parts]))
        if rows:
            yield links(rows)
    return run


def settle_groups(lists: DataFrame, docs: DataFrame, similarity: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Links (a, b) of the groups of bounded work, and the lists of all others; None where there are none."""
    spark = lists.sparkSession
    n_parts = partitions(spark)
    sizes = (lists.groupBy("s", "c").agg(F.count("*").alias("k"), F.min("node").alias("least"))
             .groupBy("s").agg(F.sum("k").alias("size"), F.max(F.struct("k", "c")).alias("largest"), F.min("least").alias("least")))
    entries = lists.join(sizes, "s").select("s", "node", "n", "m", "c", "size", "least",
                                            (F.col("c") == F.col("largest.c")).alias("inside"))
    nodes = stage(entries.groupBy("node").agg(
        F.first("n").alias("n"), F.first("m").alias("m"), F.first("c").alias("c"),
        F.collect_list(F.expr("IF(inside, NULL, s)")).alias("listed"), F.collect_list(F.expr("IF(inside, s, NULL)")).alias("large"),
        F.sum(F.expr("IF(inside, 0, size)")).alias("work"), F.collect_set("least").alias("near")), "ngram-nodes")
    load = [F.sum("m").alias("shingles"), F.sum(F.expr("IF(work > 0, m, 0)")).alias("asking"), F.sum("work").alias("work")]
    total = nodes.agg(*load).first()
    if total["shingles"] <= SETTLE_TOGETHER and total["work"] <= SETTLE_PAIRS:
        grouped, bundles = nodes.withColumn("part", F.lit(0).cast("long")), 1
        groups = grouped.groupBy("part").agg(*load)
    else:
        named = components(nodes.select(F.col("node").alias("a"), F.explode("near").alias("b")))
        grouped = nodes.join(named.select("node", F.col("component").alias("part")), "node")
        groups = grouped.groupBy("part").agg(*load)
        bundles = -(-total["shingles"] // SETTLE_TOGETHER)
    blocks = F.ceil(F.col("shingles") / SETTLE_SHINGLES)
    groups = stage(groups.withColumn("blocks", blocks).withColumn("slices", F.greatest(
        F.lit(1), F.ceil(F.col("work") / F.col("blocks") / abs(SETTLE_PAIRS)), F.ceil(F.col("asking") / SETTLE_SHINGLES)))
        .withColumn("ready", (F.col("blocks") <= SETTLE_CUTS) & (F.col("asking") <= SETTLE_CUTS * SETTLE_SHINGLES)
                    & (F.col("work") <= SETTLE_PAIRS * SETTLE_CUTS * F.col("blocks"))), "ngram-groups")
    kinds = {r["ready"] for r in groups.select("ready").distinct().collect()}
    found = rest = None
    if True in kinds:
        # small groups share a unit; others get one for each slice of what asks and each block of what is searched
        small = f"shingles <= {SETTLE_TOGETHER} AND blocks = 1 AND slices = 1"
        own = grouped.drop("work").join(groups.filter("ready"), "part").select(
            F.expr(f"IF({small}, pmod(xxhash64(part), {bundles}), part)").alias("part"), "node", "n", "c", "listed", "large",
            "blocks", "slices", F.expr("pmod(xxhash64(node), blocks)").alias("own_j"),
            F.expr("pmod(xxhash64(node, 1), slices)").alias("own_i"))
        units = F.expr("""concat(
            transform(sequence(0, slices - 1), i -> struct(i AS i, own_j AS j, true AS held, i = own_i AND size(listed) > 0 AS asks)),
            transform(filter(sequence(0, blocks - 1), j -> j <> own_j AND size(listed) > 0),
                      j -> struct(own_i AS i, j AS j, false AS held, true AS asks)))""")
        rows = own.join(docs.select("node", "shared"), "node").withColumn("unit", F.explode(units)).select(
            "part", "unit.*", "node", "n", "c", "shared", "listed", "large")
        found = stage(rows.repartition(n_parts, "part", "i", "j").sortWithinPartitions("part", "i", "j")
                      .mapInArrow(_settled(similarity), "a long, b long"), "ngram-links")
    if False in kinds:
        rest = lists if found is None else stage(lists.join(
            grouped.join(groups.filter("NOT ready"), "part").select("node"), "node", "left_semi").select(lists.columns), "ngram-lists")
    unstage(nodes, groups)
    return found, rest


def _hubs(lists: DataFrame, buckets: int) -> DataFrame:
    """First round: one hub a list. Later: of a list, all documents outside its largest component where these are
    ``SHORT_LIST`` at most (the list is finished then), else the smallest of each of ``buckets`` hash buckets."""
    # the smallest document of a list links with most of them
    hub = F.min(F.struct("n", "node", "m", "c"))
    named = [F.col("hub.node").alias("query"), F.col("hub.n").alias("query_n"), F.col("hub.m").alias("query_m"),
             F.col("hub.c").alias("query_c")]
    if buckets == 1:
        least = lists.groupBy("s").agg(hub.alias("hub"), F.count("*").alias("size"))
        return least.select("s", *named, "size", F.lit(None).cast("long").alias("rest"))
    parts = lists.groupBy("s", "c").agg(F.count("*").alias("m"))
    sizes = parts.groupBy("s").agg(F.sum("m").alias("size"), F.max(F.struct("m", "c")).alias("largest"))
    few = F.col("size") - F.col("largest.m") <= SHORT_LIST
    bucket = F.when(few, F.col("node")).otherwise(F.expr(f"pmod(xxhash64(node), {buckets})"))
    return (lists.join(sizes, "s").filter(~few | (F.col("c") != F.col("largest.c")))
                 .groupBy("s", bucket.alias("bucket"))
                 .agg(hub.alias("hub"), F.first("size").alias("size"), F.first(F.when(few, F.col("largest.c"))).alias("rest"))
                 .select("s", *named, "size", "rest"))


def ngram_jaccard_classes(documents: DataFrame, k: int = 5, similarity: int = 75, with_class: bool = False) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id.

    ``with_class`` adds the hashes of the text's class (h1, h2) and of its component (part).
    """
    spark = documents.sparkSession
    n_parts = partitions(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    emit, reduce = _step1(k, similarity, n_parts)
    step1 = stage(exchange(texts, emit, reduce, "kind int, h1 long, h2 long, doc_id long, n long"), "ngram-step1")
    info = step1.filter("kind = 0").select("doc_id", "h1", "h2", "n")
    classes = info.filter("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"))
    counts = step1.filter("kind = 2").groupBy("h1").agg(F.sum("n").alias("found"))
    # l of the smallest possible partner, whose size is T
    enough = F.greatest(F.lit(1), F.floor(F.floor((F.col("n") * similarity + 99) / 100) / 10))
    left = stage(classes.join(counts, "h1").filter(F.col("found") >= enough).select(
        F.col("least").alias("doc_id"), "h1", "h2"), "ngram-left")
    heavy = (step1.filter("kind = 3").groupBy("h1").agg(F.sum("n").alias("total"))
             .orderBy(F.desc("total"), "h1").limit(HEAVY_KEPT).select("h1").toPandas()["h1"])
    heavy = np.sort(heavy.to_numpy(dtype=np.int64).view(np.uint64))

    emit, count = _step3(k, n_parts, heavy)
    few = left.count() <= BROADCAST_CLASSES
    some = texts.join(F.broadcast(left) if few else left, "doc_id").select("h1", "h2", "text")
    dealt = exchange(some, emit, count, "pid int, kind int, block binary")
    docs = stage(dealt.repartitionById(n_parts, "pid").mapInArrow(
        _assemble(similarity), "node long, n long, shared array<long>, short array<long>"), "ngram-docs")

    def several(lists: DataFrame) -> DataFrame:
        """The lists that hold documents of two components or more.

        Documents whose shared shingles are too few for even the smallest document of the list leave it before.
        """
        least = lists.groupBy("s").agg(F.min("n").alias("least"))
        able = lists.join(least, "s").filter(
            (F.col("n") + F.col("least")) * similarity <= F.col("m") * (100 + similarity)).drop("least")
        good = able.groupBy("s").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("s")
        return able.join(good, "s", "left_semi")

    lists = stage(several(docs.select(F.explode("short").alias("s"), "node", "n", F.size("shared").cast("long").alias("m"),
                                      F.col("node").alias("c"))), "ngram-lists")
    links: DataFrame | None = None
    comp: DataFrame | None = None
    buckets = 1
    while not lists.isEmpty():
        found, rest = settle_groups(lists, docs, similarity)
        parts = [] if found is None else [found]
        if rest is not None:
            if rest is not lists:
                unstage(lists)
                lists = rest
            hubs = stage(_hubs(lists, buckets), "ngram-hubs")
            parts.append(stage(search(lists, docs, hubs, similarity), "ngram-links"))
        for part in parts:
            if not part.isEmpty():
                links, comp = part if links is None else links.unionByName(part), None
        if comp is None and links is not None:
            comp = stage(components(links), "ngram-comp")
        if rest is None:
            unstage(lists, docs)
            break
        gone = hubs.select("s", F.col("query").alias("node"))
        rest = lists.join(gone, ["s", "node"], "left_anti").join(
            hubs.filter("rest IS NOT NULL").select("s").distinct(), "s", "left_anti")
        if comp is not None:
            rest = rest.drop("c").join(comp, "node", "left").select(
                "s", "node", "n", "m", F.coalesce("component", "node").alias("c"))
        fewer = stage(several(rest), "ngram-lists")
        # later rounds read only the documents that are still in a list
        remaining = stage(docs.join(fewer.select("node").distinct(), "node", "left_semi"), "ngram-docs")
        unstage(lists, hubs, docs)
        lists, docs, buckets = fewer, remaining, buckets * 8

    known = classes.select("h1", "h2", "least", F.col("h1").alias("part"))
    if comp is not None:
        own = known.join(comp.select(F.col("node").alias("h1"), "component"), "h1")
        least = own.groupBy("component").agg(F.min("least").alias("component_least"))
        merged = own.join(least, "component").select("h1", "h2", "component_least", "component")
        known = known.join(merged, ["h1", "h2"], "left").select(
            "h1", "h2", F.coalesce("component_least", "least").alias("least"), F.coalesce("component", "part").alias("part"))
    out = info.join(known, ["h1", "h2"], "left")
    more = ["h1", "h2", "part"] if with_class else []
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), *more)


def _marked(batches):
    """Rows with the class hashes of their text (null without words)."""
    for batch in batches:
        n = batch.num_rows
        first, check, some = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
        for low, high, data, begin in chunks(batch.column("text")):
            w = words(data, begin)
            h = w.hashes(lower=True)
            first[low:high], check[low:high] = sequence_hash(h, w, _SEQ), sequence_hash(h, w, _CHECK)
            some[low:high] = np.diff(w.first) > 0
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("text"),
             pa.array(first.view(np.int64), mask=~some), pa.array(check.view(np.int64), mask=~some)],
            names=["row", "doc_id", "text", "h1", "h2"])


def keep_one_of_each_group(documents: DataFrame, k: int = 5, similarity: int = 75) -> DataFrame:
    """``documents`` with one row of each group, unchanged: of linked texts one held by the group's smallest doc_id stays.

    Documents without words are no copies of each other and stay. Rows without doc_id stay. Where rows repeat a doc_id each
    is judged by its own text, so an unlinked text stays whatever else its doc_id holds; of several rows that the smallest
    doc_id holds in one group the first by text, then by the other columns, stays. Columns of any name are kept: the rows
    travel as one struct.
    """
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"),
                            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    classes = stage(ngram_jaccard_classes(rows, k, similarity, with_class=True), "ngram-classes")
    known = classes.filter("doc_id IS NOT NULL AND n_shingles > 0")
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        # Every doc_id is one row with words at most: the rows that go are named by it.
        gone = known.filter("doc_id <> component_id").select("doc_id")
        few = gone.count() <= BROADCAST_CLASSES
        return rows.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select("row.*")
    marked = stage(rows.mapInArrow(_marked, T.StructType(
        [*rows.schema.fields, T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])), "ngram-marked")
    groups = known.select("h1", "h2", "part", "component_id").distinct()
    placed = marked.join(groups, ["h1", "h2"], "left")
    free = placed.filter("doc_id IS NULL OR part IS NULL").select("row")
    held = placed.filter("doc_id = component_id AND part IS NOT NULL")
    one = held.groupBy("part").agg(F.min_by("row", F.struct("text", F.to_json("row"))).alias("row"))
    return free.unionByName(one.select("row")).select("row.*")
