"""Silver streams over bronze tables: de-duplication within a watermark and
incremental change consolidation (current state per key).

Both read a bronze table as a stream of its committed files, so each run only
processes rows bronze received since the previous run.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.silver import latest_per_key
from ..session import delete_path, list_names, make_folder, path_exists, read_text, rename_path, write_text

log = logging.getLogger(__name__)


def read_bronze_stream(spark: SparkSession, table: str, schema: T.StructType | None = None,
                       **options: str) -> DataFrame:
    """A bronze table as a stream: the files its sink committed, in commit order, of its current generation.

    The schema is the one recorded by the bronze sink; merging every Parquet
    footer is the fallback for tables written by something else.
    """
    from .sink import BATCH, data_path, table_schema, with_batch
    table = data_path(spark, table)
    schema = schema or table_schema(spark, table) or spark.read.option("mergeSchema", "true").parquet(table).drop(BATCH).schema
    return (spark.readStream.schema(with_batch(schema))
            .options(**{"maxFileAge": "365000d", "maxFilesPerTrigger": "50000", **options}).parquet(table).drop(BATCH))


# Spark's state store provider classes.
HDFS_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prefer_rocksdb_state(spark: SparkSession) -> None:
    """Use the RocksDB state store unless the session chose a provider.

    The default provider keeps every key of a partition in JVM memory; with a
    long watermark delay at scale that is billions of keys. RocksDB keeps them
    on local disk with changelog checkpoints to shared storage. A restarted
    query keeps the provider recorded in its checkpoint.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, HDFS_STATE_STORE) == HDFS_STATE_STORE:
        spark.conf.set(key, ROCKSDB_STATE_STORE)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str,
                 spread_hot_keys: bool = False) -> DataFrame:
    """Drop rows whose key was already seen within ``delay`` of event time.

    State holds one entry per key until the watermark passes its event time plus
    the delay, so the delay bounds the state. ``withWatermark`` needs a
    TIMESTAMP column: a TIMESTAMP_NTZ event time is converted first.

    One stateful operator does it. Where a single key may hold a large part of the rows, ``spread_hot_keys`` runs the
    work in two phases, at the price of a second state of the same size. First the rows are
    de-duplicated per key *and input split*: copies of one key read by different
    tasks go to different tasks, and each split's copies shrink to one row. Then
    they are de-duplicated per key, over at most one row per split. A key
    holding a third of all rows therefore never lands whole in one task. The
    split id is stable when a micro-batch is replayed, because its files and
    splits are fixed.
    """
    prefer_rocksdb_state(df.sparkSession)
    ts = F.col(f"`{event_time}`")
    if isinstance(df.schema[event_time].dataType, T.TimestampNTZType):
        ts = ts.cast("timestamp")
    marked = df.withColumn("_event_time", ts).withWatermark("_event_time", delay)
    if spread_hot_keys:
        marked = (marked.withColumn("_split", F.spark_partition_id())
                        .dropDuplicatesWithinWatermark([*keys, "_split"]).drop("_split"))
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def default_state_partitions(spark: SparkSession) -> int:
    """State partitions for a new stateful stream: the cluster's total cores."""
    return max(1, spark.sparkContext.defaultParallelism)


def start_table_stream(df: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = (),
                       name: str | None = None, processing_time: str | None = None,
                       state_partitions: int | None = None) -> StreamingQuery:
    """Append a stream to a parquet table (drain what is pending unless a processing time is given).

    ``state_partitions`` sets the partition count of a stateful query's state.
    It is fixed for the life of the checkpoint, so it is chosen here on purpose
    (applied only while the query starts) rather than inherited from whatever
    ``spark.sql.shuffle.partitions`` holds at that moment. The same
    checkpoint-reset guard as for bronze tables applies.
    """
    from .sink import guard_checkpoint
    spark = df.sparkSession
    guard_checkpoint(spark, target, checkpoint)
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    if state_partitions is None:
        return writer.start(target)
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start(target)
    finally:
        spark.conf.set(key, previous)


class KeyedState:
    """Current state per key, maintained incrementally from change records.

    Layout: rows are spread over ``buckets`` by a hash of the key. Applying a
    batch of changes (version ``v``) rewrites only the buckets the batch
    touches, into ``data/_version=<v>/_bucket=<b>``, and then writes a manifest
    ``bucket -> version`` with the bucket count; a state opened with another
    count is moved to it by the next ``apply``. Readers use the newest manifest. Applying the same
    version again (a replayed micro-batch) starts from the manifest before it
    and overwrites the same folders, so it is harmless. Deletes are kept as
    tombstones in the state (an older change arriving late cannot resurrect a
    deleted key) and hidden by ``visible``.

    The change batch is reduced to one row per key before anything else; that
    reduction aggregates partially on the map side, so a hot key is not sent
    whole to one task. A bucket holds about ``state size / buckets`` rows (keys
    are unique in the state), which sizes the write tasks.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str],
                 deleted: str | Column, buckets: int = 64, files_per_bucket: int = 8):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.order_by = list(order_by)
        self.deleted = F.expr(deleted) if isinstance(deleted, str) else deleted
        self.buckets = buckets
        self.files_per_bucket = files_per_bucket

    # -- manifest -------------------------------------------------------------
    def _manifest(self, below: int | None = None) -> tuple[int | None, dict[int, int]]:
        versions = sorted(int(n.split(".")[0]) for n in list_names(self.spark, f"{self.path}/_manifest")
                          if n.endswith(".json"))
        if below is not None:
            versions = [v for v in versions if v < below]
        if not versions:
            return None, {}
        return versions[-1], self._load(versions[-1])[0]

    def _load(self, version: int) -> tuple[dict[int, int], int | None]:
        """Bucket -> version of a manifest, and the bucket count it was written with (None: not recorded)."""
        body = json.loads(read_text(self.spark, f"{self.path}/_manifest/{version:012d}.json"))
        count = body.pop("buckets", None)
        return {int(b): int(v) for b, v in body.items()}, count

    def _read(self, manifest: dict[int, int], buckets: list[int] | None = None) -> DataFrame | None:
        chosen = sorted(manifest.items()) if buckets is None else [(b, manifest[b]) for b in buckets if b in manifest]
        paths = [f"{self.path}/data/_version={v}/_bucket={b}" for b, v in chosen]
        if not paths:
            return None
        df = self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths)
        return df.drop("_version")

    def current(self) -> DataFrame | None:
        """State including tombstones (``_is_deleted``) and the ``_bucket`` column."""
        return self._read(self._manifest()[1])

    def visible(self) -> DataFrame | None:
        cur = self.current()
        return None if cur is None else cur.where(~F.col("_is_deleted")).drop("_is_deleted", "_bucket")

    # -- apply ----------------------------------------------------------------
    def apply(self, changes: DataFrame, version: int) -> None:
        """Merge a batch of changes as state version ``version`` (monotonic, e.g. the batch id).

        The newest version may be applied again (a replayed micro-batch); an older
        one can only come from a reset checkpoint and is refused, since building
        on an older manifest would drop every bucket changed since.
        """
        newest, _ = self._manifest()
        if newest is not None and version < newest:
            from .sink import CheckpointMismatchError
            raise CheckpointMismatchError(
                f"state {self.path} is at version {newest}; version {version} comes from a reset checkpoint")
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")
        marked = changes.withColumns({"_is_deleted": F.coalesce(self.deleted, F.lit(False)), "_bucket": bucket})
        reduced = latest_per_key(marked, self.keys, self.order_by)
        # Staged as a table in the shared folder: cuts lineage and survives executor loss.
        staging = f"{self.path}/_staging/_version={version}"
        reduced.write.mode("overwrite").parquet(staging)
        staged = self.spark.read.parquet(staging)
        # One row per touched bucket: bounded by the configured bucket count.
        touched = sorted(r[0] for r in staged.select("_bucket").distinct().collect())
        if not touched:
            return
        before, manifest = self._manifest(below=version)
        count = self._load(before)[1] if before is not None else None
        previous = self._read(manifest, touched)
        if count is not None and count != self.buckets:
            # Another bucket count than the state was written with: every row moves to its new bucket.
            log.info("state %s: %d buckets become %d", self.path, count, self.buckets)
            previous = self._read(manifest).withColumn("_bucket", bucket)
            touched, manifest = list(range(self.buckets)), {}
        # Columns may have been added to the changes since earlier versions.
        merged = staged if previous is None else latest_per_key(
            previous.unionByName(staged, allowMissingColumns=True), self.keys, self.order_by)
        # A bucket is written by several tasks: by a second hash of the key.
        part = F.pmod(F.xxhash64(F.lit("part"), *[F.col(f"`{k}`") for k in self.keys]), F.lit(self.files_per_bucket))
        (merged.repartition(F.col("_bucket"), part).write.mode("overwrite").partitionBy("_bucket")
               .parquet(f"{self.path}/data/_version={version}"))
        written = {int(n.split("=", 1)[1]) for n in list_names(self.spark, f"{self.path}/data/_version={version}")
                   if n.startswith("_bucket=")}
        manifest.update({b: version for b in touched if b in written})
        write_text(self.spark, f"{self.path}/_manifest/{version:012d}.json",
                   json.dumps({"buckets": self.buckets, **{str(b): v for b, v in sorted(manifest.items())}}))
        log.info("state %s: version %d rewrote %d bucket(s)", self.path, version, len(touched))


    # -- retention ------------------------------------------------------------
    def obsolete(self, retain_manifests: int = 2) -> list[str]:
        """Folders no longer needed once the newest ``retain_manifests`` manifests are kept.

        A data folder ``_version=v/_bucket=b`` is live while one of the kept
        manifests points bucket ``b`` at version ``v``; staging folders are live
        only for the newest version (a replay of it reads them again).
        """
        versions = sorted(int(n.split(".")[0]) for n in list_names(self.spark, f"{self.path}/_manifest")
                          if n.endswith(".json"))
        kept = versions[-retain_manifests:] if retain_manifests > 0 else []
        live: set[tuple[int, int]] = set()
        for v in kept:
            live.update(self._load(v)[0].items())
        out = []
        for vdir in list_names(self.spark, f"{self.path}/data"):
            if not vdir.startswith("_version="):
                continue
            version = int(vdir.split("=", 1)[1])
            for bdir in list_names(self.spark, f"{self.path}/data/{vdir}"):
                if bdir.startswith("_bucket=") and (int(bdir.split("=", 1)[1]), version) not in live:
                    out.append(f"{self.path}/data/{vdir}/{bdir}")
        newest = versions[-1] if versions else None
        for sdir in list_names(self.spark, f"{self.path}/_staging"):
            if sdir.startswith("_version=") and int(sdir.split("=", 1)[1]) != newest:
                out.append(f"{self.path}/_staging/{sdir}")
        out += [f"{self.path}/_manifest/{v:012d}.json" for v in versions if v not in kept]
        return sorted(out)

    def vacuum(self, retain_manifests: int = 2, dry_run: bool = False) -> list[str]:
        """Delete what ``obsolete`` lists (unless ``dry_run``); returns the paths.

        Run it between micro-batches (e.g. after a drain): a reader holding an
        older manifest than the kept ones would lose its files.
        """
        paths = self.obsolete(retain_manifests)
        if not dry_run:
            for p in paths:
                delete_path(self.spark, p)
        return paths


def start_cdc_stream(changes: DataFrame, state: KeyedState, checkpoint: str,
                     processing_time: str | None = None, name: str | None = None) -> StreamingQuery:
    """Consolidate a change stream into ``state``, one state version per micro-batch."""
    def each(batch: DataFrame, batch_id: int) -> None:
        state.apply(batch, batch_id)

    writer = changes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def start_validated_stream(rows: DataFrame, rules: Sequence[tuple[str, str]], valid: str, quarantine: str, checkpoint: str,
                           processing_time: str | None = None, name: str | None = None) -> StreamingQuery:
    """One pass over a stream feeds two tables: rows that keep all ``rules``, and rows that do not (``failed_rules`` tells).

    A micro-batch is written once, split by its verdict, into a hidden folder; then each half is renamed into its table as
    ``_batch=<id>``. A batch that is run again leaves alone the halves that are already there, so neither table ever has a
    row twice. Read the tables with ``sink.read_table``.
    """
    from ..operators.silver import validate_ranges
    from .sink import BATCH, guard_checkpoint, record_table_schema
    spark = rows.sparkSession
    for table in (valid, quarantine):
        guard_checkpoint(spark, table, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        checked = validate_ranges(batch, rules)
        targets = {True: f"{valid}/{BATCH}={batch_id}", False: f"{quarantine}/{BATCH}={batch_id}"}
        missing = {ok: t for ok, t in targets.items() if not path_exists(spark, t)}
        if not missing:
            return
        record_table_schema(spark, valid, batch.schema)
        record_table_schema(spark, quarantine, checked.drop("is_valid").schema)
        staged = f"{valid}/.staged/{BATCH}={batch_id}"
        checked.write.mode("overwrite").partitionBy("is_valid").parquet(staged)
        for ok, target in missing.items():
            half = f"{staged}/is_valid={str(ok).lower()}"
            if not path_exists(spark, half):
                make_folder(spark, half)        # no such row in this batch
            rename_path(spark, half, target)

    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
