"""Repeated passages across documents with a sparse suffix array over words.

A passage is a run of at least ``min_words`` words that occurs in two or more documents.

1. **Sparse suffixes.** Of each document only the suffixes at minimiser positions are kept: the position with the
   smallest hash of ``anchor`` words in every window of ``min_words - anchor + 1`` positions. The choice depends on
   content alone, so every passage holds a position that is kept in each of its copies. Suffixes are sorted by their
   first ``anchor`` words (as a hash) and neighbours are compared; those equal to none are dropped.
2. **Left and right.** A kept suffix is extended to the left by 0 to ``min_words - anchor`` words. The extended
   suffixes are sorted by their first ``min_words`` words (a hash of 128 bits, so that chance matches stay away at any
   size a cluster can hold) and neighbours are compared again: equal neighbours are passages. Overlapping matches of a document are joined, which extends them to the right without limit.

So exactly the words that lie in a run of ``min_words`` words also found in another document are reported. Each run
belongs to its smallest doc_id (role ``first``); in other documents it is ``later``.

Entries that meet inside a task are compared there and only the smallest document's go on, so a passage found in a
third of all documents sends a few entries a task, never one a document. Text is read from whole documents.

Texts shorter than ``min_words`` words, empty or null texts, and rows without doc_id hold no passage. Repeats inside one
document are none, and rows that share a doc_id count as one document (spans name the text by ``text_key``, a hash of
its words). Extra columns are ignored by the search and kept by ``drop_later_passages``. Words compare byte by byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import BLOCKS, by_kind, deal, exchange, gather, partitions, stage, unpack
from .textblocks import chunks, grams, mix64, sequence_hash, words

FLUSH_ENTRIES = 2_000_000
SECOND = np.uint64(0xD1B54A32D192ED03)      # sets the second half of a passage's key apart from the first
_SPANS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("role", pa.string()),
                    ("start_word", pa.int64()), ("end_word", pa.int64()), ("n_words", pa.int64())])


def _sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``size`` entries, by doubling."""
    done, out = 1, x
    while done * 2 <= size:
        out = pick(out[:-done], out[done:])
        done *= 2
    rest = size - done
    return pick(out[:-rest], out[rest:]) if rest else out


def minimisers(h: np.ndarray, doc: np.ndarray, anchor: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and hash of the suffixes kept: the smallest anchor hash of any window inside one text."""
    x, at = grams(h, doc, anchor)
    m = len(x) - window + 1
    if m <= 0:
        return at[:0], x[:0]
    d = doc[at]
    least = _sliding(x, window, np.minimum)
    least[d[:m] != d[window - 1:]] = 0              # windows across two texts do not count
    pad = np.zeros(window - 1, dtype=np.uint64)
    most = _sliding(np.concatenate([pad, least, pad]), window, np.maximum)
    kept = (x == most) & (most != 0)
    return at[kept], x[kept]


def _local(key, check, doc, place, text, n_parts: int) -> list[pa.RecordBatch]:
    """Compare entries that met in a task: (1) entries of the smallest document of each key go on, with a flag that
    others have it too; (2) those of other documents are settled: their key is in an earlier document. Keys are equal
    if both halves, ``key`` and ``check``, are."""
    order = np.lexsort((place, doc, check, key))
    key, check, doc, place, text = (a[order] for a in (key, check, doc, place, text))
    new = np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1]))
    group = np.cumsum(new) - 1
    least = doc[new][group]
    settled = doc != least
    several = np.bincount(group, weights=settled) > 0
    on = ~settled
    out = [deal(1, key[on], n_parts,
                [key[on], check[on], doc[on], text[on], place[on], several[group][on].astype(np.uint8)])]
    if settled.any():
        spot = mix64(doc[settled].astype(np.uint64))
        out.append(deal(2, spot, n_parts, [doc[settled], text[settled], place[settled]]))
    return out


_ENTRY, _MARK = ["u8", "u8", "i8", "u8", "u4", "u1"], ["i8", "u8", "u4"]


def _compare(n_parts: int):
    """Sort entries by key and compare neighbours: marks (document, text, place) dealt by document, kind 1 if the
    passage is in an earlier document, else 0."""
    def run(batches):
        blocks = by_kind(batches)
        key, check, doc, text, place, multi = gather(blocks.get(1, []), _ENTRY)
        if len(key):
            order = np.lexsort((place, doc, check, key))
            key, check, doc, text, place, multi = (a[order] for a in (key, check, doc, text, place, multi))
            new = np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1]))
            group = np.cumsum(new) - 1
            later = doc != doc[new][group]
            found = (np.bincount(group, weights=later) + np.bincount(group, weights=multi) > 0)[group]
            for kind, own in ((0, found & ~later), (1, found & later)):
                if own.any():
                    yield deal(kind, mix64(doc[own].astype(np.uint64)), n_parts, [doc[own], text[own], place[own]])
        for block in blocks.get(2, []):
            doc, text, place = unpack(block, _MARK)
            yield deal(1, mix64(doc.astype(np.uint64)), n_parts, [doc, text, place])
    return run


def _sorted_marks(blocks: list[bytes]):
    doc, text, place = gather(blocks, _MARK)
    order = np.lexsort((place, text, doc))
    return doc[order], text[order], place[order].astype(np.int64)


def _places(batches):
    """One row per document: its marked words."""
    blocks = by_kind(batches)
    doc, _, place = _sorted_marks(blocks.get(0, []) + blocks.get(1, []))
    if len(doc):
        docs, low = np.unique(doc, return_index=True)
        parts = np.split(place.astype(np.uint32), low[1:])
        yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array([p.tobytes() for p in parts], pa.binary())],
                                         names=["doc_id", "places"])


def _spans(min_words: int):
    """Overlapping matches of a text joined to spans."""
    def run(batches):
        blocks = by_kind(batches)
        for kind, role in ((0, "first"), (1, "later")):
            doc, text, place = _sorted_marks(blocks.get(kind, []))
            if not len(doc):
                continue
            new = np.append(True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (place[1:] - place[:-1] > min_words))
            start, last = place[new], place[np.append(np.flatnonzero(new)[1:], len(place)) - 1]
            end = last + min_words
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[new]), pa.array(text[new].view(np.int64)), pa.array([role] * len(start), pa.string()),
                 pa.array(start), pa.array(end), pa.array(end - start)], schema=_SPANS)
    return run


def _flushed(make, n_parts: int):
    """A map step over batches: ``make`` gives (key, check, doc, place, text) arrays of a chunk; entries meet in runs."""
    def emit(batches):
        held, size = [], 0
        for batch in batches:
            for arrays in make(batch):
                held.append(arrays)
                size += len(arrays[0])
                if size >= FLUSH_ENTRIES:
                    yield from _local(*(np.concatenate(a) for a in zip(*held)), n_parts)
                    held, size = [], 0
        if size:
            yield from _local(*(np.concatenate(a) for a in zip(*held)), n_parts)
    return emit


def _suffixes(anchor: int, window: int):
    def make(batch):
        ids = batch.column("doc_id").to_numpy()
        for low, high, data, begin in chunks(batch.column("text")):
            w = words(data, begin)
            at, key = minimisers(w.hashes(lower=False), w.doc, anchor, window)
            place = (at - w.first[w.doc[at]]).astype(np.uint32)
            none = np.zeros(len(at), dtype=np.uint64)       # a first look: half a key is enough
            yield key, none, ids[low:high][w.doc[at]], place, none
    return make


def _extended(min_words: int, anchor: int):
    def make(batch):
        ids = batch.column("doc_id").to_numpy()
        places = batch.column("places")
        for low, high, data, begin in chunks(batch.column("text")):
            w = words(data, begin)
            h = w.hashes(lower=False)
            text = sequence_hash(h, w, 1)
            edge = np.zeros(len(h) + 1, dtype=np.int64)
            for d in range(low, high):
                first, last = w.first[d - low], w.first[d - low + 1]
                p = np.frombuffer(places[d].as_py(), dtype=np.uint32).astype(np.int64) + first
                p = p[p < last]     # others are of another text with this doc_id
                np.add.at(edge, np.maximum(p - (min_words - anchor), first), 1)
                np.add.at(edge, p + 1, -1)
            key, at = grams(h, w.doc, min_words)
            check, _ = grams(mix64(h + SECOND), w.doc, min_words)
            use = np.cumsum(edge)[at] > 0
            key, check, at = key[use], check[use], at[use]
            d = w.doc[at]
            yield key, check, ids[low:high][d], (at - w.first[d]).astype(np.uint32), text[d]
    return make


def repeated_passages(documents: DataFrame, min_words: int = 50, anchor: int = 16) -> DataFrame:
    """(doc_id, text_key, role, start_word, end_word, n_words) of every passage, ``end_word`` excluded."""
    n = partitions(documents.sparkSession)
    texts = documents.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    suffixes = exchange(texts, _flushed(_suffixes(anchor, min_words - anchor + 1), n), _compare(n), BLOCKS)
    places = stage(suffixes.repartitionById(n, "pid").mapInArrow(_places, "doc_id long, places binary"), "suffix-places")
    extended = exchange(texts.join(places, "doc_id"), _flushed(_extended(min_words, anchor), n), _compare(n), BLOCKS)
    return stage(extended.repartitionById(n, "pid").mapInArrow(
        _spans(min_words), "doc_id long, text_key long, role string, start_word long, end_word long, n_words long"),
        "suffix-spans")


def _cut(batches):
    for batch in batches:
        spans = batch.column(batch.num_columns - 1).to_pylist()
        texts = batch.column("text").to_pylist()
        for low, high, data, begin in chunks(batch.column("text")):
            some = [i for i in range(low, high) if spans[i]]
            if not some:
                continue
            w = words(data, begin)
            keys = sequence_hash(w.hashes(lower=False), w, 1).view(np.int64)
            for i in some:
                d = i - low
                mine = sorted((s["start_word"], s["end_word"]) for s in spans[i] if s["text_key"] == keys[d])
                if not mine:
                    continue
                parts, at = [], begin[d]
                for start, end in mine:
                    parts.append(data[at:w.start[w.first[d] + start]].tobytes())
                    at = w.end[w.first[d] + end - 1]
                left = (b"".join(parts) + data[at:begin[d + 1]].tobytes()).decode()
                texts[i] = left if left.strip(" \t\n\v\f\r") else None
        place = batch.schema.get_field_index("text")
        kept = batch.set_column(place, "text", pa.array(texts, batch.schema.field("text").type))
        gone = pa.array([bool(s) and t is None for s, t in zip(spans, texts)])
        keep = pa.compute.invert(gone)
        yield kept.select(list(range(batch.num_columns - 1))).filter(keep)


def _free_name(taken: list[str]) -> str:
    name = "spans"
    while name in {c.lower() for c in taken}:
        name += "_"
    return name


def drop_later_passages(documents: DataFrame, min_words: int = 50, anchor: int = 16) -> DataFrame:
    """``documents`` without the ``later`` passages; documents of which nothing is left are dropped.

    The column n_chars, where present, follows the text. Documents without such a passage are returned unchanged.
    """
    spans = (repeated_passages(documents, min_words, anchor).filter("role = 'later'")
             .groupBy(F.col("doc_id").alias("span_doc"))
             .agg(F.collect_list(F.struct("text_key", "start_word", "end_word")).alias("spans")))
    # The row travels as one struct beside its spans, so no column's name can clash; then the spans come last.
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))
    joined = rows.join(spans, F.col("row.doc_id") == F.col("span_doc"), "left")
    out = joined.select("row.*", F.col("spans").alias(_free_name(documents.columns))).mapInArrow(_cut, documents.schema)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(documents.schema["n_chars"].dataType))
    return out
