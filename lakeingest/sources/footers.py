"""Parquet files of one micro-batch: the schema of each, from its footer, and one read over all of them.

Files are grouped by what their footers say. Each group is read with its own schema, so files that disagree about a type,
or of which only some have a column, are read side by side: every value either fits the table's column or goes to
``_rescued_data`` under its path.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nested
from .schema import RESCUE_COLUMN, literal_path

@dataclass
class FileGroup:
    """Files with equal footers and the same ``key=value`` folders above them, and their rows."""

    paths: list[str]
    rows: DataFrame

    @property
    def schema(self) -> T.StructType:
        return self.rows.schema


def _prints(batches):
    """Tasks: of each file a hash of its footer's schema; null where only Spark can open the file."""
    import pandas as pd
    import pyarrow.parquet as pq

    from ..session import task_filesystem
    for pdf in batches:
        out = []
        for path in pdf["path"]:
            try:
                filesystem, local = task_filesystem(path)
                with filesystem.open_input_file(local) as file:
                    schema = pq.ParquetFile(file).schema_arrow
                own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
                text = str(schema.remove_metadata()).encode() + own
                out.append((path, hashlib.md5(text).hexdigest()))
            except Exception:   # whatever this file system says: Spark reads the footer
                out.append((path, None))
        yield pd.DataFrame(out, columns=["path", "print"])


def _folder_keys(path: str, base: str) -> tuple[str, ...]:
    inside = path[len(base):] if path.startswith(base) else path
    return tuple(part.split("=", 1)[0] for part in inside.split("/")[:-1] if "=" in part)


def file_groups(spark: SparkSession, paths: list[str], base: str, reader_opts: dict[str, str]) -> list[FileGroup]:
    """The files by footer, in the order of their first path. Footers are read in tasks."""
    if not paths:
        return []
    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    files = spark.createDataFrame([(p,) for p in paths], "path STRING").repartition(tasks)
    prints = sorted((r["path"], r["print"]) for r in files.mapInPandas(_prints, "path STRING, print STRING").collect())
    by_kind: dict[tuple, list[str]] = {}
    for path, mark in prints:
        by_kind.setdefault((mark, _folder_keys(path, base)), []).append(path)
    out = []
    for (mark, keys), paths in by_kind.items():
        out += _read(spark, paths, base if keys else None, reader_opts, merge=mark is None)
    return out


def _read(spark: SparkSession, paths: list[str], base: str | None, reader_opts: dict[str, str], merge: bool) -> list[FileGroup]:
    keep = {k: v for k, v in reader_opts.items() if k not in ("pathGlobFilter", "recursiveFileLookup", "mergeSchema")}
    # Without key=value folders above them, files are read from wherever they lie.
    where = {"basePath": base} if base else {"recursiveFileLookup": "true"}
    reader = spark.read.options(**{**keep, **where, "mergeSchema": str(merge).lower()})
    try:
        return [FileGroup(paths, reader.parquet(*[literal_path(p) for p in paths]))]
    except PySparkException:
        # Footers that only Spark could read and that do not merge: halves, down to single files.
        if not merge or len(paths) == 1:
            raise
        half = len(paths) // 2
        return _read(spark, paths[:half], base, reader_opts, True) + _read(spark, paths[half:], base, reader_opts, True)


def joint_schema(groups: list[FileGroup]) -> T.StructType:
    """All columns of all groups, at any depth; of two types for one of them the wider number, else the first."""
    return reduce(nested.join_new, [nested.nullable(g.schema) for g in groups])


def typed_rows(group: FileGroup, columns: T.StructType) -> DataFrame:
    """The rows of a group with the table's columns, ``_rescued_data`` and file lineage."""
    have = {f.name: f.dataType for f in group.schema.fields}
    fit = [(nested.conform(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have
            else F.lit(None).cast(f.dataType)).alias(f.name) for f in columns.fields]
    lineage = [F.col("_metadata.file_name").alias("_ingested_filename"), F.col("_metadata.file_path").alias("_ingested_filepath")]
    return group.rows.select(*fit, rescued(group.schema, columns).alias(RESCUE_COLUMN), *lineage)


def rescued(have: T.StructType, columns: T.StructType):
    """``_rescued_data``: undeclared columns whole (as JSON values, if nothing else is rescued), misfits by path."""
    known = {f.name: f.dataType for f in columns.fields}
    extra = [f for f in have.fields if f.name not in known and not isinstance(f.dataType, T.NullType)]
    misfits = [s for f in have.fields if f.name in known
               and (s := nested.strays(F.col(f"`{f.name}`"), f.dataType, known[f.name], F.lit(f.name))) is not None]
    plain = F.lit(None).cast("string")
    if extra:
        some = reduce(lambda a, b: a | b, [F.col(f"`{f.name}`").isNotNull() for f in extra])
        plain = F.when(some, F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in extra])))
    if not misfits:
        return plain
    parts = [F.when(F.col(f"`{f.name}`").isNotNull(), nested.entry(F.lit(f.name), nested.text_of(F.col(f"`{f.name}`"), f.dataType)))
             .otherwise(nested.none()) for f in extra]
    whole = F.concat(*[F.coalesce(m, nested.none()) for m in misfits])
    return nested.bind(whole, lambda found: F.when(F.size(found) == 0, plain).otherwise(
        nested.entries_json(F.concat(found, *parts))))


def read_groups(groups: list[FileGroup], columns: T.StructType) -> DataFrame:
    return reduce(DataFrame.unionByName, [typed_rows(g, columns) for g in groups])
