"""Provenance and configured columns added on the way into bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGESTED_AT = "_ingested_at"
FILE_NAME = "_ingested_filename"
FILE_PATH = "_ingested_filepath"


def with_ingestion_time(df: DataFrame) -> DataFrame:
    """``_ingested_at``: one value per micro-batch (``current_timestamp`` is fixed per batch)."""
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def with_file_lineage(df: DataFrame) -> DataFrame:
    """File name and full path of every row, from the hidden ``_metadata`` column."""
    return df.withColumns({FILE_NAME: F.col("_metadata.file_name"),
                           FILE_PATH: F.col("_metadata.file_path")})


def with_derived_columns(df: DataFrame, derived: dict[str, str] | None) -> DataFrame:
    """Apply ``name: SQL expression`` pairs in order.

    Later expressions may use earlier ones and the provenance columns, and a
    name may overwrite a source column. Catalyst collapses the projections.
    """
    for name, expression in (derived or {}).items():
        df = df.withColumn(name, F.expr(expression))
    return df


def path_part(path_col: str, pattern: str, group: int = 1):
    """A value carried by the folder names of a file path (URL-decoded), e.g. field or date."""
    return F.regexp_extract(F.url_decode(F.col(path_col)), pattern, group)
