"""Incremental landing-zone file source (CSV, JSON, Parquet, Avro, binaryFile).

Spark's file stream source keeps the list of files already processed in the query checkpoint; it gives the *names* of the
files that arrived since the last micro-batch. Each batch then decides its columns from exactly those files and reads them
once. So a file is never read with a schema made before it landed, in scheduled runs and in continuous queries alike.

Every format goes through a typed projection that keeps stray data in ``_rescued_data`` (except binaryFile, whose schema is
fixed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rescue
from ..functions.provenance import FILE_NAME, FILE_PATH, with_file_lineage
from ..spec import DatasetSpec, EngineSpec, SpecError
from .footers import read_groups
from .schema import (BINARY_FILE_SCHEMA, CORRUPT_KEY, ResolvedSchema, check_source, literal_path, resolve_schema,
                     split_options)

# Landing zones keep files for a long time; Spark's default (7 days relative to
# the newest file) would silently skip an old drop. A backlog is drained in
# bounded micro-batches: each one commits, so a failure costs one batch of work
# and the driver never plans one batch over millions of files.
# Folders are looked into at any depth, whether they are named ``key=value`` or not.
_DEFAULT_STREAM_OPTIONS = {"maxFileAge": "365000d", "maxFilesPerTrigger": "50000", "recursiveFileLookup": "true"}

# Tasks of a batch of binary files, for each core of the cluster.
TASKS_PER_CORE = 8
FILE_LINEAGE = (FILE_NAME, FILE_PATH)

# Reader options that say which files are read and when; the others say how a file is read.
_SELECTION = ("pathGlobFilter", "recursiveFileLookup", "maxFilesPerTrigger", "maxBytesPerTrigger", "maxFileAge", "latestFirst",
              "cleanSource", "sourceArchiveDir", "fileNameOnly", "maxCachedFiles")


def stream_of_files(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec) -> DataFrame:
    """The names of the new files, as a stream (``path``). No content is read.

    Binary files need no schema of their batch: their stream is the rows themselves, so a batch's files are listed once
    and their names stay off the driver.
    """
    check_source(spark, ds, engine)
    path = engine.resolve_path(ds.source["path"])
    _, reader_opts = split_options(ds.source)
    options = {**_DEFAULT_STREAM_OPTIONS, **{k: v for k, v in reader_opts.items() if k in _SELECTION}}
    if "maxBytesPerTrigger" in options and "maxFilesPerTrigger" not in reader_opts:
        options.pop("maxFilesPerTrigger")       # Spark takes one of the two
    files = spark.readStream.options(**options).format("binaryFile").schema(BINARY_FILE_SCHEMA).load(path)
    if not rows_in_stream(ds):
        return files.select("path")
    return with_file_lineage(files).select(*BINARY_FILE_SCHEMA.names, *FILE_LINEAGE)


def rows_in_stream(ds: DatasetSpec) -> bool:
    """Whether the stream has the rows of the files, not only their names: binary files, unless with options of a reader."""
    return ds.source["format"] == "binaryFile" and not set(split_options(ds.source)[1]) - set(_SELECTION)


def read_batch(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec, files: DataFrame, label: str) -> DataFrame | None:
    """The rows of one micro-batch's files with its columns, rescue column and file lineage; None without any file.

    The driver holds the names of the batch's files (at most ``maxFilesPerTrigger``), as Spark's file source does, except
    for binary files. Those come in splits of some 30 files whatever their size; a few tasks a core take them together.
    """
    if rows_in_stream(ds):
        return None if files.rdd.getNumPartitions() == 0 else files.coalesce(spark.sparkContext.defaultParallelism * TASKS_PER_CORE)
    paths = sorted(r["path"] for r in files.select("path").collect())
    if not paths:
        return None
    return read_files(spark, ds, engine, resolve_schema(spark, ds, engine, paths, label), paths)


def read_files(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec, resolved: ResolvedSchema,
               paths: list[str]) -> DataFrame:
    """DataFrame of the given files, with file lineage columns."""
    fmt = ds.source["format"]
    _, reader_opts = split_options(ds.source)
    reader_opts = {k: v for k, v in reader_opts.items() if k not in _SELECTION}
    schema = resolved.columns
    files = [literal_path(p) for p in paths]
    # Wherever the files lie: their folders give no columns here.
    reader = spark.read.option("recursiveFileLookup", "true")

    if fmt == "binaryFile":
        return with_file_lineage(reader.options(**reader_opts).format("binaryFile").load(files))

    if fmt == "json":
        lineage = ["_ingested_filename", "_ingested_filepath"]
        if str(reader_opts.get("multiLine", "false")).lower() == "true":
            # Whole-file documents: one object, or an array of objects. Each file is read
            # as one text value (as Spark's own multi-line reader does) and split into
            # the raw text of its records, which then take the same path as JSON lines.
            doc_opts = {k: v for k, v in reader_opts.items() if k == "encoding"}
            docs = reader.options(**doc_opts, wholetext="true").format("text").load(files)
            docs = with_file_lineage(docs).select(F.col("value").alias("_doc"), *lineage)
            records = F.coalesce(F.from_json(F.col("_doc"), "array<string>"), F.array(F.col("_doc")))
            lines = docs.select(F.explode(records).alias("_line"), *lineage)
        else:
            text_opts = {k: v for k, v in reader_opts.items() if k in ("lineSep", "encoding")}
            lines = reader.options(**text_opts).format("text").load(files)
            # The text source names its column `value`; datasets may have a field of that name.
            lines = with_file_lineage(lines).select(F.col("value").alias("_line"), *lineage)
        lines = lines.where(F.trim(F.col("_line")) != "")
        text_types = str(ds.source.get("json_text_types", False)).lower() == "true"
        parsed = lines.select("_line", *rescue.json_parse(F.col("_line"), schema, text_types), *lineage)
        if rescue.json_has_nested(schema):
            parsed = parsed.withColumn(rescue.NESTED, rescue.json_nested(F.col("_line"), schema, text_types))
        typed = parsed.select(*rescue.json_typed(schema, text_types), *[c for c in parsed.columns])
        return typed.select(*[F.col(f"`{f.name}`") for f in schema.fields],
                            rescue.json_rescue(F.col("_line"), schema, text_types), *lineage)

    if fmt == "csv" and resolved.header_table:
        # New files carry different header orders: read positionally and map each
        # file by its own header (a small table from the probe, joined on the path).
        width = resolved.header_width
        # One slot more than the widest header catches lines with too many fields.
        read_schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width + 1)])
        # Spark itself leaves out the first line of each file; the schema applies by position.
        opts = {**reader_opts, "header": "true", "enforceSchema": "true", "mode": "PERMISSIVE"}
        df = reader.options(**opts).schema(read_schema).csv(files)
        df = df.withColumn("_file_path", F.col("_metadata.file_path"))
        df = with_file_lineage(df)
        headers = spark.read.parquet(resolved.header_table).select(
            F.col("file_path").alias("_file_path"), F.col("header").alias(rescue.HEADER),
            rescue.header_positions(F.col("header"), schema).alias(rescue.POSITIONS))
        joined = df.join(headers, "_file_path", "left").drop("_file_path")
        return rescue.csv_by_file(schema, width)(joined)

    if fmt == "csv":
        header = resolved.header or [f.name for f in schema.fields]
        read_schema = T.StructType([T.StructField(h, T.StringType()) for h in header]
                                   + [T.StructField(CORRUPT_KEY, T.StringType())])
        opts = {"header": "true", **reader_opts,
                # Every file's header is checked against the expected order: a file
                # with another order fails the query instead of swapping values.
                "enforceSchema": "false", "columnNameOfCorruptRecord": CORRUPT_KEY, "mode": "PERMISSIVE"}
        if str(opts.get("header")).lower() != "true":
            opts.pop("enforceSchema")
        df = reader.options(**opts).schema(read_schema).csv(files)
        df = with_file_lineage(df)
        return rescue.text_columns(header, schema, CORRUPT_KEY)(df)

    if fmt == "parquet":
        return read_groups(resolved.groups, schema)

    if fmt == "avro":
        from .avro import read_avro_files
        df = read_avro_files(spark, files, reader_opts, T.StructType(schema.fields + resolved.extra.fields))
        return df.select(*rescue.extra_columns(schema, resolved.extra), "_ingested_filename", "_ingested_filepath")

    raise SpecError(f"[{ds.name}] format '{fmt}' not supported")
