"""Bounded samples of labelled documents, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the doc_id as text (a null as the empty text), modulo ``folds``."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled_sample(labels: DataFrame, label: str, learnable: Column, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` learnable rows, picked by hash; at most ``rows`` rows, so safe to broadcast.

    Null labels, labels other than 0 and 1, and doc_ids with contradicting labels are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    one = (known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).filter(learnable)
           .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
           .filter("label = other").select("doc_id", "label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
