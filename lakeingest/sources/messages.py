"""Keyed-message source: Kafka, or an envelope table with the same row shape.

Spark's Kafka source yields rows ``key, value, topic, partition, offset,
timestamp``. When ``source.envelope_path`` is set, the same rows are read from
parquet files dropped in that folder (a stream of files), and topic selection
and start offsets are applied as filters. From the envelope on, both
transports share one decoding path.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decode import DECODERS, Side
from ..session import read_text, write_text
from ..spec import DatasetSpec, EngineSpec, SpecError
from ..streaming.sink import checkpoint_path

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Fixed values of Kafka's JSON offset notation.
EARLIEST, LATEST = -2, -1
DEFAULT_MAX_OFFSETS_PER_TRIGGER = 50_000_000


def topic_filter(topic: Column, subscribe: str | None, pattern: str | None) -> Column:
    """The pattern, when given, wins over the list; a pattern must match the whole topic name."""
    if pattern:
        return topic.rlike(f"^(?:{pattern})$")
    names = [t.strip() for t in (subscribe or "").split(",") if t.strip()]
    return topic.isin(names)


def _parse_offsets(spec: str) -> dict[tuple[str, int], int]:
    data = json.loads(spec)
    return {(t, int(p)): int(o) for t, parts in data.items() for p, o in parts.items()}


def _start_offsets_frame(spark: SparkSession, starts: dict[tuple[str, int], int]) -> DataFrame:
    rows = [(t, p, o) for (t, p), o in starts.items()]
    return spark.createDataFrame(rows, "topic STRING, partition INT, start_offset BIGINT")


def _resolve_latest(spark: SparkSession, envelope_path: str, selected: Column, reader_opts: dict[str, str],
                    requested: dict[tuple[str, int], int] | None) -> dict[tuple[str, int], int]:
    """Turn ``latest`` into concrete offsets: one past the newest message of each partition now.

    The result has one row per topic-partition, so it is small whatever the data size.
    """
    selection = {k: v for k, v in reader_opts.items() if k in ("recursiveFileLookup", "pathGlobFilter")}
    try:
        current = (spark.read.options(**selection).schema(ENVELOPE_SCHEMA).parquet(envelope_path).where(selected)
                   .groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next")).collect())
    except AnalysisException:
        current = []
    newest = {(r["topic"], r["partition"]): r["next"] for r in current}
    if requested is None:
        return newest
    out = {}
    for key, off in requested.items():
        out[key] = newest.get(key, 0) if off == LATEST else off
    return out


def _stored_starts(spark: SparkSession, path: str) -> str | None:
    return read_text(spark, path)


def read_envelope(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec) -> DataFrame:
    src = ds.source
    path = engine.resolve_path(src["envelope_path"])
    selected = topic_filter(F.col("topic"), src.get("subscribe"), src.get("subscribe_pattern"))
    reader_opts = {"maxFileAge": "365000d", "maxFilesPerTrigger": "50000",
                   **{k: str(v) for k, v in (src.get("options") or {}).items() if not k.startswith("kafka.")}}
    df = spark.readStream.options(**reader_opts).schema(ENVELOPE_SCHEMA).parquet(path).where(selected)

    start = src.get("starting_offsets", "earliest")
    if start == "earliest":
        return df
    # Start offsets only matter for a fresh checkpoint: they are resolved once and
    # stored inside it (a reset checkpoint resolves them again), so later runs
    # filter with the same values.
    checkpoint = (ds.sink.get("options") or {}).get("checkpointLocation") or checkpoint_path(ds, engine)
    stored_at = f"{checkpoint}/_lakeingest_start_offsets"
    resolved = _stored_starts(spark, stored_at)
    if resolved is None:
        requested = None if start == "latest" else _parse_offsets(start)
        if requested is None or LATEST in requested.values():
            starts = _resolve_latest(spark, path, selected, reader_opts, requested)
        else:
            starts = requested
        resolved = json.dumps([[t, p, o] for (t, p), o in starts.items()])
        write_text(spark, stored_at, resolved)
    starts = {(t, p): o for t, p, o in json.loads(resolved)}
    if not starts:
        return df
    # One row per topic-partition named in the offsets: bounded by configuration.
    frame = F.broadcast(_start_offsets_frame(spark, starts))
    joined = df.join(frame, ["topic", "partition"], "left")
    start_at = F.col("start_offset")
    keep = start_at.isNull() | (start_at == EARLIEST) | (F.col("offset") >= start_at)
    return joined.where(keep).drop("start_offset")


def read_kafka(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(ds, engine)).load()


def kafka_options(ds: DatasetSpec, engine: EngineSpec) -> dict[str, str]:
    """The option map of the Kafka source; checked without a broker. The dataset's own options come last."""
    if engine.kafka is None:
        raise SpecError(f"[{ds.name}] kafka source but the engine spec has no 'kafka' section")
    pattern = ds.source.get("subscribe_pattern")
    topics = {"subscribePattern": pattern} if pattern else {"subscribe": ds.source["subscribe"]}
    own = {key: str(value) for key, value in (ds.source.get("options") or {}).items()}
    return {
        **engine.kafka.spark_options(),
        **topics,
        "startingOffsets": ds.source.get("starting_offsets", "earliest"),
        # Bounded micro-batches when draining a backlog.
        "maxOffsetsPerTrigger": str(DEFAULT_MAX_OFFSETS_PER_TRIGGER),
        **own,
    }


#: Column of a message row -> column in bronze.
LINEAGE = {"topic": "_topic", "partition": "_partition", "offset": "_offset", "timestamp": "_kafka_timestamp"}


def read_messages(spark: SparkSession, ds: DatasetSpec, engine: EngineSpec) -> DataFrame:
    """Streaming messages: lineage, decoded ``key`` and ``value``, and the bytes a decoder could not keep whole.

    ``_raw_value`` (and ``_raw_key``, for structured keys) is null where the decoded side holds everything. For JSON,
    ``_rescued_value`` (``_rescued_key``) names by path what the decoded value has no place for.
    """
    rows = read_envelope(spark, ds, engine) if ds.source.get("envelope_path") else read_kafka(spark, ds, engine)
    sides = (Side.of(ds.source, "key", default="string"), Side.of(ds.source, "value"))
    columns = [F.col(theirs).alias(ours) for theirs, ours in LINEAGE.items()]
    kept = []
    for side in sides:
        decoder = DECODERS.get(side.format)
        if decoder is None:
            raise SpecError(f"[{ds.name}] message format not supported: '{side.format}'")
        raw = F.col(side.name)
        try:
            value, whole, strays = decoder(raw, side, spark=spark, engine=engine)
        except SpecError as exc:
            raise SpecError(f"[{ds.name}] {exc}") from exc
        columns.append(value.alias(side.name))
        if side.format in ("json", "avro") and ds.source.get("keep_raw", True):
            kept.append(F.when(~whole, raw).alias(f"_raw_{side.name}"))
            if strays is not None:
                kept.append(strays.alias(f"_rescued_{side.name}"))
    return rows.select(*kept, *columns)
