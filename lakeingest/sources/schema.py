"""Schema resolution for file datasets (declared, inferred, hinted, evolving).

The columns of a micro-batch are decided from exactly the files of that batch, whenever they
landed: footers only for Parquet, a parse for JSON/CSV (optionally sampled). A batch that is
run again looks at the same files again, so a run that dies in between loses nothing.

Schema versions are small JSON files at ``{checkpoints}/schemas/{datasource}/{dataset}``,
in shared storage next to the stream checkpoint.
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nested
from ..session import list_names, path_exists, read_text, write_text
from ..spec import EVOLUTION_MODES, DatasetSpec, EngineSpec, SpecError

log = logging.getLogger(__name__)

RESCUE_COLUMN = "_rescued_data"
CORRUPT_KEY = "_corrupt_record"

# Fixed value: the schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

# Options of the landing-zone source that the engine interprets itself; every
# other key of ``source.options`` is passed to Spark's reader unchanged.
ENGINE_OPTION_KEYS = {
    "cloudFiles.schemaHints": "schema_hints",
    "cloudFiles.inferColumnTypes": "infer_column_types",
    "cloudFiles.schemaEvolutionMode": "schema_evolution_mode",
    "cloudFiles.format": None,
    "cloudFiles.schemaLocation": "schema_location",
    "cloudFiles.maxFileAge": "maxFileAge",
    "cloudFiles.maxFilesPerTrigger": "maxFilesPerTrigger",
    "cloudFiles.maxBytesPerTrigger": "maxBytesPerTrigger",
    "cloudFiles.schemaInference.samplingRatio": "schema_inference_sampling_ratio",
    # All new files are looked at: a sample could miss columns.
    "cloudFiles.schemaInference.sampleSize.numFiles": None,
}

# Settings whose only value that can be honoured here is this one: any other is refused, since ignoring it would
# read data the user excluded or name columns otherwise than asked.
FIXED_OPTIONS = {"cloudFiles.includeExistingFiles": "true", "rescuedDataColumn": "_rescued_data",
                 "cloudFiles.rescuedDataColumn": "_rescued_data"}

# Reader options that also restrict which files inference looks at.
FILE_SELECTION_OPTIONS = ("pathGlobFilter", "recursiveFileLookup")


# Characters with a meaning in Hadoop's path patterns.
_PATTERN = "\\{}[]*?,"


def literal_path(path: str) -> str:
    """A path that stands for itself alone when a reader looks for patterns in it."""
    return "".join("\\" + c if c in _PATTERN else c for c in path)


class SchemaChangeError(RuntimeError):
    """New columns arrived and the evolution mode does not accept them."""


def parse_ddl(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def split_options(source: dict[str, Any]) -> tuple[dict[str, Any], dict[str, str]]:
    """Split ``source.options`` into engine settings and Spark reader options."""
    engine_opts: dict[str, Any] = {}
    reader_opts: dict[str, str] = {}
    for key, value in (source.get("options") or {}).items():
        if key in FIXED_OPTIONS:
            if str(value).lower() != FIXED_OPTIONS[key]:
                raise SpecError(f"option {key}={value!r} is not supported; only {FIXED_OPTIONS[key]!r} is")
            continue
        if key.startswith("cloudFiles.") and key not in ENGINE_OPTION_KEYS:
            log.warning("option %s has no equivalent here and is ignored", key)
            continue
        if key in ENGINE_OPTION_KEYS:
            target = ENGINE_OPTION_KEYS[key]
            if target in ("maxFilesPerTrigger", "maxBytesPerTrigger", "maxFileAge"):
                reader_opts[target] = str(value)
            elif target:
                engine_opts[target] = value
        else:
            reader_opts[key] = str(value)
    for key in ("schema_hints", "infer_column_types", "schema_inference_sampling_ratio", "schema_location"):
        if key in source:
            engine_opts[key] = source[key]
    return engine_opts, reader_opts


def evolution_mode(source: dict[str, Any], fmt: str) -> str:
    """Explicit mode wins; a declared schema or binaryFile means ``none``; else ``addNewColumns``."""
    engine_opts, _ = split_options(source)
    explicit = source.get("schema_evolution_mode") or engine_opts.get("schema_evolution_mode")
    if explicit:
        if explicit not in EVOLUTION_MODES:
            raise SpecError(f"schema evolution mode '{explicit}' not supported; valid: {sorted(EVOLUTION_MODES)}")
        return explicit
    if source.get("schema") or fmt == "binaryFile":
        return "none"
    return "addNewColumns"


def apply_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    """Force the hinted fields to the given types; hinted fields not present are appended."""
    if not hints:
        return schema
    hinted = {f.name: f for f in parse_ddl(hints).fields}
    fields = [T.StructField(f.name, hinted.pop(f.name).dataType, True) if f.name in hinted else f
              for f in schema.fields]
    return T.StructType(fields + list(hinted.values()))


def _truthy(value: Any) -> bool:
    return str(value).strip().lower() in ("true", "1", "yes")


@dataclass
class SchemaVersion:
    version: int
    schema: T.StructType
    header: list[str] = field(default_factory=list)


class SchemaLog:
    """Versions of a dataset's schema: one small JSON file per version in shared storage.

    A version file is written only when the columns or the CSV header change,
    created without overwrite so two runs racing on the same dataset cannot
    both record the same version. The log grows with schema changes, not with runs.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def latest(self) -> SchemaVersion | None:
        names = sorted(n for n in list_names(self.spark, self.path) if n.startswith("v") and n.endswith(".json"))
        if not names:
            return None
        data = json.loads(read_text(self.spark, f"{self.path}/{names[-1]}"))
        return SchemaVersion(data["version"], T.StructType.fromJson(data["schema"]), data.get("header") or [])

    def append(self, version: SchemaVersion) -> None:
        body = json.dumps({"version": version.version, "schema": version.schema.jsonValue(),
                           "header": version.header})
        write_text(self.spark, f"{self.path}/v{version.version:06d}.json", body, overwrite=False)


@dataclass
class ResolvedSchema:
    """What the reader needs: typed columns, CSV header order, extra columns to rescue."""

    columns: T.StructType
    mode: str
    rescue: bool
    header: list[str] = field(default_factory=list)
    extra: T.StructType = field(default_factory=T.StructType)
    # CSV only: set when the new files of this run carry more than one header order.
    header_table: str = ""
    header_width: int = 0
    # Parquet only: the batch's files by footer.
    groups: list = field(default_factory=list)


def schema_log_path(engine: EngineSpec, ds: DatasetSpec) -> str:
    engine_opts, _ = split_options(ds.source)
    if engine_opts.get("schema_location"):
        return engine.resolve_path(str(engine_opts["schema_location"])).rstrip("/")
    return f"{engine.checkpoint_root}/schemas/{ds.datasource}/{ds.dataset}"


def _files_reader(spark: SparkSession, reader_opts: dict[str, str]):
    """A reader of the paths it is given: files, or folders with all below them."""
    options = {k: reader_opts[k] for k in FILE_SELECTION_OPTIONS if k in reader_opts}
    return spark.read.options(**{"recursiveFileLookup": "true", **options})


HEADER_TABLE = "headers"


def probe_csv_headers(spark: SparkSession, paths: str | list[str], reader_opts: dict[str, str],
                      target: str) -> list[list[str]]:
    """Distinct headers of the CSV files; with more than one, the per-file
    mapping ``(file_path, header)`` is written as a table at ``target``.

    Each task opens its files and reads on until the first record ends, whatever its
    length. Files it cannot open (a store only Spark reaches, a codec only Hadoop
    knows) have their first line read through Spark instead. The distinct header
    orders are metadata (a handful per dataset), not data.
    """
    sep = reader_opts.get("sep", reader_opts.get("delimiter", ","))
    quote = reader_opts.get("quote", '"')
    encoding = reader_opts.get("encoding", reader_opts.get("charset", "utf-8"))
    files = (_files_reader(spark, reader_opts).format("binaryFile").load(paths)
             .select(F.col("_metadata.file_path").alias("file_path"), "path"))

    def parsed(lines) -> list[str]:
        import csv
        row = next(csv.reader(lines, delimiter=sep, quotechar=quote), [])
        return [c.strip().lstrip("\ufeff") if i == 0 else c.strip() for i, c in enumerate(row)]

    def first_records(batches):
        import csv
        import io

        import pandas as pd

        from ..session import task_filesystem
        csv.field_size_limit(1 << 30)
        for pdf in batches:
            out = []
            for file_path, uri in zip(pdf["file_path"], pdf["path"]):
                try:
                    filesystem, local = task_filesystem(uri)
                    with filesystem.open_input_stream(local) as stream:
                        lines = io.TextIOWrapper(stream, encoding=encoding, errors="replace", newline="")
                        out.append((file_path, parsed(lines)))
                except Exception:   # whatever this file system or codec says: Spark reads the file
                    out.append((file_path, None))
            yield pd.DataFrame(out, columns=["file_path", "header"])

    headers = files.mapInPandas(first_records, "file_path STRING, header ARRAY<STRING>")
    distinct = [r["header"] for r in headers.select("header").distinct().collect()]
    if any(h is None for h in distinct):
        text_opts = {k: v for k, v in reader_opts.items() if k in ("encoding", "lineSep")}
        lines = (_files_reader(spark, reader_opts).options(**text_opts).text(paths)
                 .select(F.col("_metadata.file_path").alias("file_path"), "value",
                         F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")))
        heads = lines.filter("block = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("line"))

        def split(batches):
            import pandas as pd
            for pdf in batches:
                yield pd.DataFrame({"file_path": pdf["file_path"], "header": [parsed([x]) for x in pdf["line"]]})

        headers = heads.mapInPandas(split, "file_path STRING, header ARRAY<STRING>")
        distinct = [r["header"] for r in headers.select("header").distinct().collect()]
    distinct = [list(h) for h in distinct]
    if len(distinct) > 1:
        headers.write.mode("overwrite").parquet(target)
    return distinct


def infer_files(spark: SparkSession, fmt: str, paths: list[str], reader_opts: dict[str, str],
                engine_opts: dict[str, Any]) -> tuple[T.StructType | None, list[str]]:
    """Schema (and CSV header) of the files; (None, []) if there are none.

    JSON is parsed once more, all of it unless a sampling ratio is configured (its unknown keys are rescued line by
    line in any case).
    """
    infer_types = _truthy(engine_opts.get("infer_column_types", "false"))
    reader = _files_reader(spark, reader_opts)
    passthrough = {k: v for k, v in reader_opts.items()
                   if k not in FILE_SELECTION_OPTIONS and k not in ("maxFilesPerTrigger", "maxBytesPerTrigger")}
    try:
        if fmt == "json":
            ratio = engine_opts.get("schema_inference_sampling_ratio")
            reader = reader.options(**passthrough).option("primitivesAsString", str(not infer_types).lower())
            if ratio:
                reader = reader.option("samplingRatio", str(ratio))
            schema = reader.json(paths).schema
            schema = T.StructType([f for f in schema.fields if f.name != CORRUPT_KEY])
            return (schema if schema.fields else None), []
        if fmt == "csv":
            opts = {"header": "true", **passthrough, "inferSchema": str(infer_types).lower()}
            schema = reader.options(**opts).csv(paths).schema
            return schema, [f.name for f in schema.fields]
        if fmt == "avro":
            from .avro import infer_avro_schema
            return infer_avro_schema(spark, paths, reader_opts), []
    except AnalysisException as exc:
        # Missing directory, no files: nothing to infer from.
        log.info("no schema inferred from %d path(s): %s", len(paths), str(exc).splitlines()[0])
        return None, []
    raise SpecError(f"format '{fmt}' has no inference")


def _names(schema: T.StructType) -> set[str]:
    return {f.name for f in schema.fields}


def check_source(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec) -> None:
    """What can be refused before any file is looked at."""
    src, fmt = ds.source, ds.source["format"]
    mode = evolution_mode(src, fmt)
    if src.get("schema") and mode == "addNewColumns":
        raise SpecError(f"[{ds.name}] schema_evolution_mode 'addNewColumns' cannot be used with a declared schema")
    path = engine.resolve_path(src["path"])
    if (fmt != "binaryFile" and not src.get("schema") and not any(c in path for c in "*?[{")
            and SchemaLog(spark, schema_log_path(engine, ds)).latest() is None and not path_exists(spark, path)):
        raise SpecError(f"[{ds.name}] no schema declared or stored, and no files to infer one from at {path}")


def resolve_schema(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec, paths: list[str] | None = None,
                   label: str = "probe") -> ResolvedSchema:
    """Decide the columns for a batch of files and record a new schema version when they change.

    ``paths`` are the files of the batch (default: all of the landing folder); ``label`` names the batch. The driver holds
    the names of one batch's files, as Spark's file source does.
    """
    src = ds.source
    fmt = src["format"]
    path = engine.resolve_path(src["path"])
    mode = evolution_mode(src, fmt)
    if fmt == "binaryFile":
        return ResolvedSchema(BINARY_FILE_SCHEMA, "none", rescue=False)

    engine_opts, reader_opts = split_options(src)
    declared = parse_ddl(src["schema"]) if src.get("schema") else None
    if declared is not None and fmt == "json":
        # Every JSON key is kept (typed or rescued) line by line: nothing to look up.
        return ResolvedSchema(declared, mode, rescue=True)
    given, paths = paths, [path] if paths is None else [literal_path(p) for p in paths]

    store = SchemaLog(spark, schema_log_path(engine, ds))
    latest = store.latest()
    inferred, header, groups = None, [], []
    header_table, header_width = "", 0
    if fmt == "parquet":
        from .footers import file_groups, joint_schema
        if given is None:
            given = [r["path"] for r in _files_reader(spark, reader_opts).format("binaryFile").load(path).select("path").collect()]
        groups = file_groups(spark, given, path.rstrip("/") + "/", reader_opts)
        inferred = joint_schema(groups) if groups else None
    elif fmt == "csv" and str(reader_opts.get("header", "false")).lower() == "true":
        target = f"{schema_log_path(engine, ds)}/{HEADER_TABLE}/{label}"
        distinct = probe_csv_headers(spark, paths, reader_opts, target)
        infer_types = _truthy(engine_opts.get("infer_column_types", "false"))
        if len(distinct) > 1:
            # Several header orders in one batch: map every file by its own header.
            header_table, header_width = target, max(len(h) for h in distinct)
            names = list(dict.fromkeys(n for h in distinct for n in h))
            log.info("[%s] %d header orders among new files; mapping columns per file", ds.name, len(distinct))
            inferred, header = T.StructType([T.StructField(n, T.StringType()) for n in names]), names
        elif distinct and (declared is not None or not infer_types):
            header = distinct[0]
            inferred = T.StructType([T.StructField(n, T.StringType()) for n in header])
    if inferred is None and fmt != "parquet" and (declared is None or fmt in ("csv", "avro")):
        inferred, header = infer_files(spark, fmt, paths, reader_opts, engine_opts)
    hints = engine_opts.get("schema_hints")

    if declared is not None:
        columns = declared
    elif latest is not None:
        columns = latest.schema
    elif inferred is not None:
        columns = apply_hints(inferred, hints)
    else:
        raise SpecError(f"[{ds.name}] no schema declared or stored, and no files to infer one from at {path}")

    extra = T.StructType()
    if inferred is not None:
        hinted = apply_hints(inferred, hints) if declared is None else inferred
        added = nested.new_paths(columns, hinted)
        if added and latest is not None and declared is None:
            if mode == "addNewColumns":
                columns = nested.grow(columns, hinted)
                log.info("[%s] schema grows by %s", ds.name, added)
            elif mode == "failOnNewColumns":
                raise SchemaChangeError(f"[{ds.name}] new columns {added} and mode is failOnNewColumns")
        extra = T.StructType([f for f in inferred.fields if f.name not in _names(columns)])

    if fmt == "csv" and not header:
        header = latest.header if latest and latest.header else [f.name for f in columns.fields]

    if latest is None or latest.schema != columns or (header and latest.header != header):
        version = 0 if latest is None else latest.version + 1
        store.append(SchemaVersion(version, columns, header))
    return ResolvedSchema(columns, mode, rescue=True, header=header, extra=extra, header_table=header_table,
                          header_width=header_width, groups=groups)
