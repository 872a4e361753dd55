"""Bronze sink: append-only streaming write with a checkpoint per dataset, committed batch by batch.

Default trigger is ``availableNow`` (drain what is pending, then stop), which is
what makes a scheduled hourly run correct; ``trigger.processing_time`` starts a
continuous query instead.

A micro-batch is written to a hidden folder beside the table's data and becomes visible by one rename to
``_batch=<id>``. A batch that is run again finds its folder and adds nothing. Rows are counted by ``observe`` while they
are written: exact for any number of batches, without a second pass.

A checkpoint that was reset would start again at batch 0 and add nothing. It is refused, or
(``on_checkpoint_reset: new_generation``) reads everything again into a new generation of the table, a folder of its
own. Readers follow a pointer that moves when the generation's first drain is complete.
"""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import nested
from ..functions.provenance import with_derived_columns
from ..session import list_names, path_exists, read_text, rename_path, write_text
from ..spec import DatasetSpec, EngineSpec

log = logging.getLogger(__name__)

#: The folder of a committed batch, and the column that Spark makes of its name.
BATCH = "_batch"
# Tables of files: a batch id that is already there is not written again, the trap the guard below prevents.
FILE_SINK_FORMATS = {"parquet", "orc", "json", "csv", "text", "avro"}


class CheckpointMismatchError(RuntimeError):
    """Table and checkpoint do not belong together; starting would silently write nothing."""


def table_path(ds: DatasetSpec, engine: EngineSpec) -> str:
    if ds.sink.get("path"):
        return engine.resolve_path(ds.sink["path"])
    return f"{engine.bronze_root}/{ds.datasource}/{ds.dataset}"


def checkpoint_path(ds: DatasetSpec, engine: EngineSpec) -> str:
    """Outside the table, so either can be deleted on its own."""
    return f"{engine.checkpoint_root}/bronze/{ds.datasource}/{ds.dataset}"


def sink_format(ds: DatasetSpec, engine: EngineSpec) -> str:
    return ds.sink.get("format", engine.sink_format)


def _read_token(spark: SparkSession, path: str) -> str | None:
    text = read_text(spark, path)
    return text.strip() if text else None


def _write_token(spark: SparkSession, path: str, token: str) -> None:
    write_text(spark, path, token)


def guard_checkpoint(spark: SparkSession, table: str, checkpoint: str) -> None:
    """Refuse to start when a fresh checkpoint points at a table another checkpoint wrote.

    A token is written beside the table data and inside the checkpoint folder on
    the first run (inside, so that deleting the checkpoint deletes it too). If
    the table has a token and the checkpoint does not (or another), the
    checkpoint was reset: the file sink would restart at batch 0 and skip
    batches its log already holds, reporting success with nothing written.
    """
    table_token = _read_token(spark, f"{table}/_lakeingest_token")
    ckpt_token = _read_token(spark, f"{checkpoint}/_lakeingest_token")
    if table_token and table_token != ckpt_token:
        raise CheckpointMismatchError(
            f"table {table} was written through another checkpoint than {checkpoint}; "
            "delete or move the table as well, or restore its checkpoint")
    if table_token is None:
        token = ckpt_token or uuid.uuid4().hex
        if ckpt_token:
            log.warning("table %s is new but checkpoint %s is not: only files not seen before will be read",
                        table, checkpoint)
        _write_token(spark, f"{table}/_lakeingest_token", token)
        if not ckpt_token:
            _write_token(spark, f"{checkpoint}/_lakeingest_token", token)


GENERATION_FILE = "_lakeingest_generation"


def current_generation(spark: SparkSession, table: str) -> int:
    """The generation that readers of the table see; 0 is the first, in the table's own folder."""
    return int(read_text(spark, f"{table}/{GENERATION_FILE}") or 0)


def data_path(spark: SparkSession, table: str, generation: int | None = None) -> str:
    """The folder of a table's rows: those of its current generation, or of the given one."""
    if generation is None:
        generation = current_generation(spark, table)
    return f"{table}.generation-{generation}" if generation else table


def open_generation(spark: SparkSession, table: str, checkpoint: str, on_reset: str = "refuse") -> int:
    """The generation that a checkpoint writes.

    A checkpoint goes on with the generation that holds its token: the current one, or a later one that its first run
    has not completed. A fresh checkpoint on a written table is refused, or with ``new_generation`` gets the next unused
    folder; earlier generations stay as they are. A checkpoint of another table or of an earlier generation is refused.
    """
    current = current_generation(spark, table)
    own = _read_token(spark, f"{checkpoint}/_lakeingest_token")
    generation = current
    while (token := _read_token(spark, f"{data_path(spark, table, generation)}/_lakeingest_token")) is not None:
        if token == own:
            return generation
        generation += 1
    if generation == current or own is not None or on_reset != "new_generation":
        guard_checkpoint(spark, data_path(spark, table, current), checkpoint)
        return current
    guard_checkpoint(spark, data_path(spark, table, generation), checkpoint)
    log.warning("table %s: the checkpoint was reset; rows go to generation %d", table, generation)
    return generation


SCHEMA_FILE = "_lakeingest_schema.json"


class TypeChangeError(RuntimeError):
    """A column arrives with another type than the table has; nothing is written."""


def table_schema(spark: SparkSession, table: str) -> T.StructType | None:
    """The bronze table's schema as recorded by its sink (union over all runs), if any."""
    text = read_text(spark, f"{table}/{SCHEMA_FILE}")
    return T.StructType.fromJson(json.loads(text)) if text else None


def record_table_schema(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Keep the union of the recorded schema and this run's columns beside the table.

    Readers take the schema from here instead of merging every Parquet footer of
    the table, which at scale means millions of footers per read.
    """
    current = table_schema(spark, table)
    if current is not None:
        changed = [f"{path}: {was} -> {now}" for path, was, now in _changed_types(current, schema)]
        if changed:
            raise TypeChangeError(f"table {table} holds other types ({'; '.join(changed)}); its files could no longer be "
                                  "read together. Keep the declared types, or write to another table")
        merged = nested.grow(current, schema)
    else:
        merged = nested.nullable(schema)
    if current is None or merged != current:
        write_text(spark, f"{table}/{SCHEMA_FILE}", json.dumps(merged.jsonValue()))


def _changed_types(known: T.DataType, now: T.DataType, at: str = "") -> list[tuple[str, str, str]]:
    """Where two schemas have different types for one column or nested field; fields of one side alone are none."""
    if isinstance(known, T.StructType) and isinstance(now, T.StructType):
        theirs = {f.name: f.dataType for f in now.fields}
        return [c for f in known.fields if f.name in theirs
                for c in _changed_types(f.dataType, theirs[f.name], f"{at}.{f.name}" if at else f.name)]
    if isinstance(known, T.ArrayType) and isinstance(now, T.ArrayType):
        return _changed_types(known.elementType, now.elementType, f"{at}[]")
    if isinstance(known, T.MapType) and isinstance(now, T.MapType) and nested.same(known.keyType, now.keyType):
        return _changed_types(known.valueType, now.valueType, f"{at}[]")
    return [] if nested.same(known, now) else [(at, known.simpleString(), now.simpleString())]


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", generation: int | None = None) -> DataFrame:
    """A bronze table with the schema its sink recorded (no footer merge); ``_batch`` tells the micro-batch of a row.

    Without ``generation`` the current one is read.
    """
    if fmt not in FILE_SINK_FORMATS:
        return spark.read.format(fmt).load(path)
    path = data_path(spark, path, generation)
    schema = table_schema(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", "true").format(fmt).load(path)
    return spark.read.schema(with_batch(schema)).format(fmt).load(path)


def with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def _spread(df: DataFrame, partition_by: list[str], files_per_partition: int) -> DataFrame:
    """Bound the files per table partition with a deterministic salt.

    Hashing the whole row spreads one hot partition value over several tasks
    instead of one, and a retried task sends every row to the same place.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_partition))
    return df.repartition(*[F.col(f"`{c}`") for c in partition_by], salt)


class BronzeWriter:
    """Writes the micro-batches of one dataset; what ``foreachBatch`` calls.

    ``rows`` and ``batches`` add up what this run committed, ``error`` is the exception that stopped it, and
    ``on_commit`` is called after each committed batch.
    """

    def __init__(self, spark: SparkSession, ds: DatasetSpec, engine: EngineSpec, rows_of, on_commit=None, generation: int = 0):
        self.spark, self.ds, self.engine, self.rows_of, self.on_commit = spark, ds, engine, rows_of, on_commit
        self.generation, self.fmt = generation, sink_format(ds, engine)
        self.target = data_path(spark, table_path(ds, engine), generation)
        self.rows = self.batches = 0
        self.error: Exception | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        try:
            self._write(batch, batch_id)
        except Exception as exc:
            self.error = exc
            raise

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        final = f"{self.target}/{BATCH}={batch_id}"
        if self.fmt in FILE_SINK_FORMATS and path_exists(self.spark, final):
            log.info("[%s] batch %d is already in the table", self.ds.name, batch_id)
            return
        df = self.rows_of(batch, batch_id)
        if df is None:
            return
        sink = self.ds.sink
        df = with_derived_columns(df, sink.get("derived_partitions"))
        df = with_derived_columns(df, sink.get("derived_columns"))
        partition_by = list(sink.get("partition_by", []))
        if self.fmt in FILE_SINK_FORMATS:
            record_table_schema(self.spark, self.target, df.schema)
        if partition_by and sink.get("files_per_partition"):
            df = _spread(df, partition_by, int(sink["files_per_partition"]))
        options = {k: v for k, v in sink.get("options", {}).items() if k != "checkpointLocation"}
        counted = Observation()
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(self.fmt).options(**options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.fmt in FILE_SINK_FORMATS:
            staged = f"{self.target}/.staged/{BATCH}={batch_id}"
            writer.mode("overwrite").save(staged)
            rows = int(counted.get.get("rows") or 0)
            write_text(self.spark, f"{staged}/_lakeingest_commit.json", json.dumps({"batch": batch_id, "rows": rows}))
            rename_path(self.spark, staged, final)
        else:
            # Delta skips a version of an application id that it already has.
            (writer.option("mergeSchema", "true").option("txnAppId", self.ds.name).option("txnVersion", str(batch_id))
                   .mode("append").save(self.target))
            rows = int(counted.get.get("rows") or 0)
        self.rows += rows
        self.batches += 1
        if self.ds.continuous:
            self.publish()
        if self.on_commit is not None:
            self.on_commit(self)


    def publish(self) -> None:
        """Let readers see the generation written: once a drain is complete, or a continuous query has a batch in it."""
        table = table_path(self.ds, self.engine)
        if self.fmt in FILE_SINK_FORMATS and self.batches and self.generation > current_generation(self.spark, table):
            write_text(self.spark, f"{table}/{GENERATION_FILE}", str(self.generation))


def start_bronze_stream(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec, stream: DataFrame, rows_of,
                        on_commit=None) -> tuple[StreamingQuery, BronzeWriter]:
    """Start the append stream into the dataset's bronze table; ``rows_of`` makes rows of a micro-batch of ``stream``."""
    target = table_path(ds, engine)
    checkpoint = (ds.sink.get("options") or {}).get("checkpointLocation") or checkpoint_path(ds, engine)
    generation = 0
    if sink_format(ds, engine) in FILE_SINK_FORMATS:
        if path_exists(spark, f"{target}/_spark_metadata"):
            raise CheckpointMismatchError(f"table {target} was written by Spark's file sink, whose log hides the folders "
                                          "written here; write to another path")
        generation = open_generation(spark, target, checkpoint, ds.sink.get("on_checkpoint_reset", "refuse"))
    batches = BronzeWriter(spark, ds, engine, rows_of, on_commit, generation)
    writer = stream.writeStream.foreachBatch(batches.__call__).option("checkpointLocation", checkpoint).queryName(ds.name)
    trigger = ds.sink.get("trigger", {})
    if trigger.get("processing_time"):
        writer = writer.trigger(processingTime=trigger["processing_time"])
    else:
        writer = writer.trigger(availableNow=True)
    # Each dataset runs in its own scheduler pool (effective with spark.scheduler.mode=FAIR).
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", ds.name)
    try:
        return writer.start(), batches
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def has_committed_data(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec) -> bool:
    """Whether the bronze table holds a committed batch."""
    target = table_path(ds, engine)
    if sink_format(ds, engine) in FILE_SINK_FORMATS:
        return any(n.startswith(f"{BATCH}=") for n in list_names(spark, data_path(spark, target)))
    return path_exists(spark, target)
