"""Registered message queries over an envelope built from ``events``.

Envelope rows: ``key = user_id`` as text, ``value = `` the event as JSON (or
framed Avro), ``topic = 'app.events.' || event_type``, ``partition = user_id % 4``,
``offset = event_id`` (unique and increasing within a partition, as broker
offsets are), ``timestamp = ts``.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import avro
from ..sources.subjects import write_subjects
from .ingest_queries import EVENTS_COLS, EVENTS_DDL, TS_TEXT
from .lab import Lab
from .registry import register, table

SUBJECT = "app.readings-value"
# Version 1 of the reading schema has no "value"; version 2 adds it (ids 101 and 102).
READING_V1 = {"type": "record", "name": "reading", "fields": [
    {"name": "event_id", "type": ["null", "long"]},
    {"name": "ts", "type": ["null", "string"]},
    {"name": "user_id", "type": ["null", "long"]},
    {"name": "event_type", "type": ["null", "string"]}]}
READING_V2 = {**READING_V1, "fields": READING_V1["fields"] + [{"name": "value", "type": ["null", "double"]}]}


def envelope(events: DataFrame, value: F.Column) -> DataFrame:
    return events.select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        value.alias("value"),
        F.concat(F.lit("app.events."), F.col("event_type")).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"))


def json_value(events: DataFrame) -> F.Column:
    return F.encode(F.to_json(F.struct(*EVENTS_COLS), TS_TEXT), "UTF-8")


def _json_lab(spark: SparkSession, sf_dir: str, label: str, **source) -> tuple[Lab, object]:
    lab = Lab(spark, label)
    events = table(spark, sf_dir, "events")
    envelope(events, json_value(events)).write.parquet(f"{lab.engine.landing_root}/topics/drop1")
    src = {"type": "kafka", "envelope_path": "{landing}/topics", "key_format": "string",
           "value_format": "json", "value_json_schema": EVENTS_DDL,
           "options": {"recursiveFileLookup": "true"}, **source}
    ds = lab.dataset("app_events", src, {"partition_by": ["_topic"]})
    lab.run(ds)
    return lab, ds


_ORACLE_MSG = """
SELECT CAST(user_id AS VARCHAR) AS key, event_id, ts, user_id, event_type, value, props,
       'app.events.' || event_type AS _topic, CAST(user_id % 4 AS INTEGER) AS _partition, event_id AS _offset
FROM events"""


def _flat(bronze: DataFrame) -> DataFrame:
    return bronze.select("key", *[F.col("value")[c].alias(c) for c in EVENTS_COLS], "_topic", "_partition", "_offset")


@register("decode_json_messages", _ORACLE_MSG)
def decode_json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String keys and JSON values decoded with the declared schema, from every topic there is."""
    lab, ds = _json_lab(spark, sf_dir, "msgjson", subscribe_pattern=r"app\.events\..*")
    return _flat(lab.bronze(ds))


# Of ten messages one has a field that does not fit, one an undeclared field, and one is cut short.
_PARTIAL = """CASE event_id % 10
  WHEN 0 THEN '{"event_id":' || event_id || ',"user_id":"u' || user_id || '"}'
  WHEN 1 THEN '{"event_id":' || event_id || ',"user_id":' || user_id || ',"kind":"' || event_type || '"}'
  WHEN 2 THEN '{"event_id":' || event_id || ',"user_id"'
  ELSE '{"event_id":' || event_id || ',"user_id":' || user_id || '}' END"""


@register("message_partial_failure", f"""
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS _offset,
       CASE WHEN event_id % 10 <> 2 THEN event_id END AS event_id,
       CASE WHEN event_id % 10 NOT IN (0, 2) THEN user_id END AS user_id,
       CASE WHEN event_id % 10 IN (0, 1, 2) THEN {_PARTIAL} END AS raw
FROM events""")
def message_partial_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that decode in part keep their bytes beside what could be decoded."""
    lab = Lab(spark, "msgpartial")
    events = table(spark, sf_dir, "events")
    envelope(events, F.encode(F.expr(_PARTIAL), "UTF-8")).write.parquet(f"{lab.engine.landing_root}/topics/drop1")
    src = {"type": "kafka", "envelope_path": "{landing}/topics", "subscribe_pattern": r"app\.events\..*",
           "value_format": "json", "value_json_schema": "event_id BIGINT, user_id BIGINT",
           "options": {"recursiveFileLookup": "true"}}
    ds = lab.dataset("partial", src)
    lab.run(ds)
    return lab.bronze(ds).select("key", "_offset", F.col("value.event_id").alias("event_id"),
                                 F.col("value.user_id").alias("user_id"), F.col("_raw_value").cast("string").alias("raw"))


@register("topic_pattern", _ORACLE_MSG + " WHERE event_type IN ('click', 'view')")
def topic_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern subscription (full match); it wins over ``subscribe``."""
    lab, ds = _json_lab(spark, sf_dir, "msgpattern", subscribe="app.events.error",
                        subscribe_pattern=r"app\.events\.(click|view)")
    return _flat(lab.bronze(ds))


@register("start_offsets", _ORACLE_MSG + """
WHERE NOT (event_type = 'click' AND user_id % 4 = 0 AND event_id < 5000)
  AND NOT (event_type = 'view' AND user_id % 4 = 1 AND event_id < 7000)""")
def start_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per topic-partition start offsets; partitions not named start at the earliest offset."""
    offsets = json.dumps({"app.events.click": {"0": 5000, "1": -2}, "app.events.view": {"1": 7000}})
    lab, ds = _json_lab(spark, sf_dir, "msgoffsets", subscribe_pattern=r"app\.events\..*", starting_offsets=offsets)
    return _flat(lab.bronze(ds))


def framed_avro_value(events: DataFrame) -> F.Column:
    """Framed Avro bytes: even event ids written with version 1, odd ones with version 2."""
    v1, v2 = READING_V1, READING_V2

    @F.pandas_udf("binary")
    def encode(event_id: pd.Series, ts: pd.Series, user_id: pd.Series, event_type: pd.Series,
               value: pd.Series) -> pd.Series:
        out = []
        for e, t, u, et, v in zip(event_id, ts, user_id, event_type, value):
            rec = {"event_id": int(e), "ts": t, "user_id": int(u), "event_type": et, "value": float(v)}
            schema, sid = (v1, 101) if e % 2 == 0 else (v2, 102)
            out.append(avro.frame(sid, avro.encode_record(rec, schema)))
        return pd.Series(out)

    return encode("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "user_id", "event_type", "value")


@register("decode_avro_messages", """
SELECT CAST(user_id AS VARCHAR) AS key, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE value END AS value,
       'app.events.' || event_type AS _topic, FALSE AS raw_kept
FROM events
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'app.events.broken', TRUE""")
def decode_avro_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed Avro decoded with the schema named by each message's id; older id has no ``value``.

    One truncated message is added: it decodes to nulls and its raw bytes are kept.
    """
    lab = Lab(spark, "msgavro", schema_table_path="")
    subjects = f"{lab.area}/subjects"
    lab.engine.schema_table_path = subjects
    write_subjects(spark, subjects, [(SUBJECT, 1, 101, json.dumps(READING_V1)),
                                     (SUBJECT, 2, 102, json.dumps(READING_V2))])
    events = table(spark, sf_dir, "events")
    env = envelope(events, framed_avro_value(events))
    broken = spark.range(1).select(
        F.lit(None).cast("binary").alias("key"), F.unhex(F.lit("0000")).alias("value"),
        F.lit("app.events.broken").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"))
    env.unionByName(broken).write.parquet(f"{lab.engine.landing_root}/topics/drop1")
    src = {"type": "kafka", "envelope_path": "{landing}/topics", "subscribe_pattern": r"app\.events\..*",
           "key_format": "string", "value_format": "avro", "value_subject": SUBJECT,
           "options": {"recursiveFileLookup": "true"}}
    ds = lab.dataset("readings", src, {"partition_by": ["_topic"]})
    lab.run(ds)
    b = lab.bronze(ds)
    return b.select("key", *[F.col("value")[c].alias(c) for c in ("event_id", "ts", "user_id", "event_type", "value")],
                    "_topic", F.col("_raw_value").isNotNull().alias("raw_kept"))
