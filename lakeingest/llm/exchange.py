"""A shuffle of packed arrays, and tables staged in the shared folder.

Operators that deal out hundreds of millions of small keys ship them as binary blocks: a map step emits rows
``(pid, kind, block)``, one block per target partition and flush, Spark deals the rows by ``pid``
(``repartitionById``), and a reduce step reads the blocks of its partition as numpy arrays. Both steps are
deterministic in their input, so a lost executor's part is recomputed to the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, new_area

BLOCKS = "pid int, kind int, block binary"
_SCHEMA = pa.schema([("pid", pa.int32()), ("kind", pa.int32()), ("block", pa.binary())])


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session; set them so that a partition's share fits a task's memory."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(arrays: list[np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(block: bytes, kinds: list[str]) -> list[np.ndarray]:
    """Arrays of the given dtypes, all of one length, from ``pack``'s bytes."""
    kinds = [np.dtype(k) for k in kinds]
    n = len(block) // sum(k.itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(block, dtype=k, count=n, offset=at))
        at += n * k.itemsize
    return out


def gather(blocks: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    """The arrays of many blocks, joined."""
    parts = [unpack(b, kinds) for b in blocks]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, dtype=k) for i, k in enumerate(kinds)]


def deal(kind: int, key: np.ndarray, n: int, arrays: list[np.ndarray]) -> pa.RecordBatch:
    """One row per target partition ``key % n`` holding its share of the arrays."""
    pid = (key % np.uint64(n)).astype(np.int32)
    order = np.argsort(pid, kind="stable")
    targets, low = np.unique(pid[order], return_index=True)
    high = np.append(low[1:], len(order))
    arrays = [a[order] for a in arrays]
    blocks = [pack([a[i:j] for a in arrays]) for i, j in zip(low, high)]
    return pa.RecordBatch.from_arrays(
        [pa.array(targets, pa.int32()), pa.array(np.full(len(targets), kind), pa.int32()), pa.array(blocks, pa.binary())],
        schema=_SCHEMA)


def by_kind(batches: Iterator[pa.RecordBatch]) -> dict[int, list[bytes]]:
    """The blocks of a partition, by kind."""
    found: dict[int, list[bytes]] = {}
    for batch in batches:
        for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block").to_pylist()):
            found.setdefault(kind, []).append(block)
    return found


def exchange(df: DataFrame, emit: Callable, reduce: Callable, schema: str) -> DataFrame:
    """``emit`` makes block rows from Arrow batches; ``reduce`` makes rows of ``schema`` from a partition's blocks."""
    n = partitions(df.sparkSession)
    return df.mapInArrow(emit, BLOCKS).repartitionById(n, "pid").mapInArrow(reduce, schema)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = new_area(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._staged_at = path
    return back


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for frame in frames:
        delete_path(frame.sparkSession, frame._staged_at)
