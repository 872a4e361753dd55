"""Avro fallback codec: round trips and framing (no Spark)."""

import io
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeingest.sources import avro

SCHEMA = {"type": "record", "name": "r", "fields": [
    {"name": "i", "type": ["null", "long"]},
    {"name": "d", "type": ["null", "double"]},
    {"name": "s", "type": ["null", "string"]},
    {"name": "b", "type": ["null", "boolean"]},
    {"name": "raw", "type": ["null", "bytes"]},
]}

records = st.fixed_dictionaries({
    "i": st.none() | st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1),
    "d": st.none() | st.floats(allow_nan=False),
    "s": st.none() | st.text(),
    "b": st.none() | st.booleans(),
    "raw": st.none() | st.binary(max_size=64),
})


@given(records)
def test_record_round_trip(rec):
    back = avro.decode_record(avro.encode_record(rec, SCHEMA), SCHEMA)
    assert back == rec


@given(st.integers(min_value=0, max_value=2 ** 32 - 1), st.binary(max_size=100))
def test_frame_header_is_five_bytes(schema_id, payload):
    framed = avro.frame(schema_id, payload)
    assert framed[0] == 0
    assert int.from_bytes(framed[1:5], "big") == schema_id
    assert framed[5:] == payload


@settings(max_examples=30)
@given(st.lists(records, max_size=20), st.sampled_from(["null", "deflate"]))
def test_container_round_trip(recs, codec):
    schema, back = avro.container_records(avro.container_bytes(SCHEMA, recs, codec))
    assert schema == SCHEMA
    assert back == recs


def test_spark_schema_mapping():
    s = avro.spark_schema({"type": "record", "name": "x", "fields": [
        {"name": "t", "type": ["null", {"type": "long", "logicalType": "timestamp-micros"}]},
        {"name": "d", "type": {"type": "int", "logicalType": "date"}},
        {"name": "f", "type": "float"}]})
    assert [f.dataType.simpleString() for f in s.fields] == ["timestamp", "date", "float"]


def test_truncated_payload_raises():
    data = avro.encode_record({"i": 1, "d": 1.5, "s": "abc", "b": True, "raw": b"x"}, SCHEMA)
    try:
        avro.decode_record(data[:3], SCHEMA)
    except (EOFError, ValueError):
        return
    raise AssertionError("truncated record decoded")


def test_timestamp_logical_value():
    ts_schema = {"type": "record", "name": "x",
                 "fields": [{"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}}]}
    rec = avro.decode_record(avro.encode_record({"t": 1_700_000_000_000}, ts_schema), ts_schema)
    assert math.isclose(rec["t"].timestamp(), 1_700_000_000)


def test_container_is_written_and_read_block_by_block(monkeypatch):
    monkeypatch.setattr(avro, "BLOCK_BYTES", 100)
    recs = [{"i": i, "d": i / 2, "s": "x" * 30, "b": None, "raw": b"y"} for i in range(200)]
    data = avro.container_bytes(SCHEMA, recs)
    assert data.count(bytes(range(avro.SYNC_SIZE))) > 50
    stream = io.BytesIO(data)
    read = avro.iter_records(stream)
    assert next(read) == recs[0] and stream.tell() < len(data) / 4      # one block, not the file
    assert [recs[0], *read] == recs
    with pytest.raises((EOFError, ValueError)):
        list(avro.iter_records(io.BytesIO(data[:-40])))


@pytest.mark.parametrize("opens", [True, False])
def test_files_are_read_whole_where_tasks_cannot_open_them(spark, monkeypatch, opens):
    from pyspark.sql import functions as F

    from lakeingest.session import new_area
    monkeypatch.setattr(avro, "BATCH_ROWS", 7)
    rows = spark.range(50).select("id", F.concat(F.lit("v"), "id").alias("s"))
    path = f"{new_area(spark, 'avro_blocks')}/d1"
    assert avro.write_avro_files(rows.repartition(2), path) == 2
    if not opens:
        def refuse(uri):
            raise OSError(uri)
        monkeypatch.setattr(avro, "_open_path", refuse)
    schema = avro.infer_avro_schema(spark, [path], {})
    assert schema.names == ["id", "s"]
    back = avro.read_avro_files(spark, [path], {}, schema)
    assert sorted((r["id"], r["s"]) for r in back.collect()) == [(i, f"v{i}") for i in range(50)]
    assert back.select("_ingested_filename").distinct().count() == 2
