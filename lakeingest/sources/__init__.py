"""Sources: landing-zone files and keyed messages, both as streaming DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.provenance import with_ingestion_time
from ..spec import DatasetSpec, EngineSpec

RowsOfBatch = Callable[[DataFrame, int], "DataFrame | None"]


def read_source(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec) -> tuple[DataFrame, RowsOfBatch]:
    """One entry point by ``source.type``: the stream to start, and what makes rows of one of its micro-batches.

    Files stream as names: a batch's rows are read, with columns decided from exactly its files, when the batch runs.
    Messages stream as rows. ``_ingested_at`` is added per batch.
    """
    if ds.source_type == "files":
        from .files import read_batch, stream_of_files

        def rows(batch: DataFrame, batch_id: int) -> DataFrame | None:
            return read_batch(spark, ds, engine, batch, f"batch={batch_id}")
        stream = stream_of_files(spark, ds, engine)
    else:
        from .messages import read_messages

        def rows(batch: DataFrame, batch_id: int) -> DataFrame | None:
            return batch
        stream = read_messages(spark, ds, engine)

    def stamped(batch: DataFrame, batch_id: int) -> DataFrame | None:
        found = rows(batch, batch_id)
        return None if found is None else with_ingestion_time(found)
    return stream, stamped
