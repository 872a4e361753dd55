"""Avro support: Spark's own Avro package when it is loaded, else a small fallback.

The fallback covers what bronze datasets use: records whose fields are
primitives, ``["null", T]`` unions, and the timestamp/date logical types;
container files with the ``null`` or ``deflate`` codec. Decoding runs inside
Arrow-batched pandas functions on the executors; Spark partitions the work.
Container files are written and read block by block, so a task holds one block of
a file and one batch of its rows. Files of a store only Spark reaches come whole
through ``binaryFile``; load the Avro package for large files there.
"""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, islice
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import task_filesystem

# Fixed values of the Avro 1.x specification.
MAGIC = b"Obj\x01"
SYNC_SIZE = 16
FRAME_MAGIC = 0  # first byte of a schema-registry framed message, then a 4-byte big-endian schema id
FRAME_HEADER = 5
# Bytes of a written block before compression.
BLOCK_BYTES = 1 << 20
# Rows handed to Spark at a time.
BATCH_ROWS = 10_000


def avro_package_loaded(spark: SparkSession) -> bool:
    try:
        # AvroFileFormat ships inside spark-sql; the data source module brings these.
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.v2.avro.AvroDataSourceV2")
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
        return True
    except Exception:
        return False


# ---------------------------------------------------------------- schema mapping

def _branch(t: Any) -> tuple[Any, bool]:
    """(non-null type, nullable) of a field type."""
    if isinstance(t, list):
        others = [b for b in t if b != "null"]
        if len(others) != 1:
            raise ValueError(f"only [\"null\", T] unions are supported, got {t}")
        return others[0], "null" in t
    return t, False


def _spark_type(t: Any) -> T.DataType:
    t, _ = _branch(t)
    if isinstance(t, dict):
        logical = t.get("logicalType")
        if logical in ("timestamp-millis", "timestamp-micros"):
            return T.TimestampType()
        if logical in ("local-timestamp-millis", "local-timestamp-micros"):
            return T.TimestampNTZType()
        if logical == "date":
            return T.DateType()
        t = t["type"]
    mapping = {"int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
               "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType()}
    if t not in mapping:
        raise ValueError(f"Avro type {t!r} is not supported without Spark's Avro package")
    return mapping[t]


def spark_schema(avro_schema: str | dict) -> T.StructType:
    s = json.loads(avro_schema) if isinstance(avro_schema, str) else avro_schema
    return T.StructType([T.StructField(f["name"], _spark_type(f["type"])) for f in s["fields"]])


# ---------------------------------------------------------------- binary codec

def _read_long(buf, first: bytes = b"") -> int:
    """A varint; ``first`` is its first byte if that has been read already."""
    shift, acc = 0, 0
    while True:
        b, first = first or buf.read(1), b""
        if not b:
            raise EOFError("truncated varint")
        acc |= (b[0] & 0x7F) << shift
        if not b[0] & 0x80:
            return (acc >> 1) ^ -(acc & 1)
        shift += 7


def _write_long(out: io.BytesIO, n: int) -> None:
    n = (n << 1) ^ (n >> 63)
    while n & ~0x7F:
        out.write(bytes([(n & 0x7F) | 0x80]))
        n >>= 7
    out.write(bytes([n]))


def _take(buf: io.BytesIO, n: int) -> bytes:
    data = buf.read(n)
    if n < 0 or len(data) != n:
        raise EOFError("truncated Avro value")
    return data


def _read_value(buf: io.BytesIO, t: Any) -> Any:
    if isinstance(t, list):
        idx = _read_long(buf)
        if not 0 <= idx < len(t):
            raise ValueError(f"union branch {idx} out of range")
        return _read_value(buf, t[idx])
    if isinstance(t, dict):
        t = t["type"]
    if t == "null":
        return None
    if t in ("int", "long"):
        return _read_long(buf)
    if t == "double":
        return struct.unpack("<d", _take(buf, 8))[0]
    if t == "float":
        return struct.unpack("<f", _take(buf, 4))[0]
    if t == "boolean":
        return _take(buf, 1) == b"\x01"
    if t in ("string", "bytes"):
        raw = _take(buf, _read_long(buf))
        return raw.decode("utf-8") if t == "string" else raw
    raise ValueError(f"unsupported Avro type {t!r}")


def _write_value(out: io.BytesIO, t: Any, v: Any) -> None:
    if isinstance(t, list):
        idx = t.index("null") if v is None else next(i for i, b in enumerate(t) if b != "null")
        _write_long(out, idx)
        return _write_value(out, t[idx], v)
    if isinstance(t, dict):
        t = t["type"]
    if t == "null":
        return None
    if t in ("int", "long"):
        return _write_long(out, int(v))
    if t == "double":
        return out.write(struct.pack("<d", v))
    if t == "float":
        return out.write(struct.pack("<f", v))
    if t == "boolean":
        return out.write(b"\x01" if v else b"\x00")
    if t in ("string", "bytes"):
        raw = v.encode("utf-8") if t == "string" else bytes(v)
        _write_long(out, len(raw))
        return out.write(raw)
    raise ValueError(f"unsupported Avro type {t!r}")


def _convert(v: Any, t: Any) -> Any:
    """Avro logical values to Python values Spark accepts."""
    base, _ = _branch(t)
    if v is None or not isinstance(base, dict):
        return v
    logical = base.get("logicalType", "")
    if logical.endswith("timestamp-millis"):
        return pd.Timestamp(v, unit="ms")
    if logical.endswith("timestamp-micros"):
        return pd.Timestamp(v, unit="us")
    if logical == "date":
        return (pd.Timestamp(0) + pd.Timedelta(days=v)).date()
    return v


def decode_record(data: bytes, schema: dict) -> dict[str, Any]:
    buf = io.BytesIO(data)
    return {f["name"]: _convert(_read_value(buf, f["type"]), f["type"]) for f in schema["fields"]}


def encode_record(record: dict[str, Any], schema: dict) -> bytes:
    out = io.BytesIO()
    for f in schema["fields"]:
        _write_value(out, f["type"], record.get(f["name"]))
    return out.getvalue()


def frame(schema_id: int, payload: bytes) -> bytes:
    return bytes([FRAME_MAGIC]) + struct.pack(">I", schema_id) + payload


def _read_header(stream) -> tuple[dict, str, bytes]:
    """(writer schema, codec, sync marker) from the start of a container file."""
    if stream.read(4) != MAGIC:
        raise ValueError("not an Avro container file")
    meta: dict[str, bytes] = {}
    while True:
        n = _read_long(stream)
        if n == 0:
            break
        if n < 0:
            _read_long(stream)
            n = -n
        for _ in range(n):
            key = _take(stream, _read_long(stream)).decode()
            meta[key] = _take(stream, _read_long(stream))
    return json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null").decode(), _take(stream, SYNC_SIZE)


def iter_records(stream) -> Iterator[dict[str, Any]]:
    """Records of an open container file, one block in memory at a time."""
    schema, codec, sync = _read_header(stream)
    fields = schema["fields"]
    while first := stream.read(1):
        count = _read_long(stream, first)
        block = _take(stream, _read_long(stream))
        if codec == "deflate":
            block = zlib.decompress(block, -15)
        elif codec != "null":
            raise ValueError(f"Avro codec {codec!r} not supported without Spark's Avro package")
        bbuf = io.BytesIO(block)
        for _ in range(count):
            yield {f["name"]: _convert(_read_value(bbuf, f["type"]), f["type"]) for f in fields}
        if stream.read(SYNC_SIZE) != sync:
            raise ValueError("Avro sync marker mismatch")


def container_records(data: bytes) -> tuple[dict, list[dict[str, Any]]]:
    """(writer schema, records) of an Avro container file."""
    return _read_header(io.BytesIO(data))[0], list(iter_records(io.BytesIO(data)))


class ContainerWriter:
    """Writes records to an open stream as a container file, a block at a time."""

    def __init__(self, out, schema: dict, codec: str = "deflate"):
        self.out, self.schema, self.codec = out, schema, codec
        self.sync, self.block, self.count = bytes(range(SYNC_SIZE)), io.BytesIO(), 0
        head = io.BytesIO()
        head.write(MAGIC)
        meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
        _write_long(head, len(meta))
        for k, v in meta.items():
            _write_long(head, len(k))
            head.write(k.encode())
            _write_long(head, len(v))
            head.write(v)
        _write_long(head, 0)
        head.write(self.sync)
        out.write(head.getvalue())

    def append(self, record: dict[str, Any]) -> None:
        for f in self.schema["fields"]:
            _write_value(self.block, f["type"], record.get(f["name"]))
        self.count += 1
        if self.block.tell() >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.count:
            return
        raw, head = self.block.getvalue(), io.BytesIO()
        if self.codec == "deflate":
            comp = zlib.compressobj(6, zlib.DEFLATED, -15)
            raw = comp.compress(raw) + comp.flush()
        _write_long(head, self.count)
        _write_long(head, len(raw))
        self.out.write(head.getvalue())
        self.out.write(raw)
        self.out.write(self.sync)
        self.block, self.count = io.BytesIO(), 0


def container_bytes(schema: dict, records: list[dict[str, Any]], codec: str = "deflate") -> bytes:
    out = io.BytesIO()
    writer = ContainerWriter(out, schema, codec)
    for r in records:
        writer.append(r)
    writer.flush()
    return out.getvalue()


# ---------------------------------------------------------------- Spark side

def _avro_type_of(dtype: T.DataType) -> Any:
    if isinstance(dtype, T.TimestampType):
        return {"type": "long", "logicalType": "timestamp-micros"}
    if isinstance(dtype, T.TimestampNTZType):
        return {"type": "long", "logicalType": "local-timestamp-micros"}
    if isinstance(dtype, T.DateType):
        return {"type": "int", "logicalType": "date"}
    names = {T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double",
             T.BooleanType: "boolean", T.StringType: "string", T.BinaryType: "bytes", T.ShortType: "int",
             T.ByteType: "int"}
    for cls, name in names.items():
        if isinstance(dtype, cls):
            return name
    raise ValueError(f"{dtype} has no Avro mapping here")


def avro_schema_of(schema: T.StructType, name: str = "record") -> dict:
    return {"type": "record", "name": name,
            "fields": [{"name": f.name, "type": ["null", _avro_type_of(f.dataType)]} for f in schema.fields]}


def _to_avro_value(v: Any, dtype: T.DataType) -> Any:
    if v is None or (isinstance(v, float) and pd.isna(v)) or v is pd.NaT:
        return None
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        ts = pd.Timestamp(v)
        return ts.value // 1000
    if isinstance(dtype, T.DateType):
        return (pd.Timestamp(v) - pd.Timestamp(0)).days
    return v


def write_avro_files(df: DataFrame, path: str, codec: str = "deflate") -> int:
    """Write ``df`` as Avro container files, one per Spark partition; returns the file count.

    Without the Avro package each task writes its own file, named after its
    partition id, so a retried task overwrites its file instead of adding one.
    """
    spark = df.sparkSession
    if avro_package_loaded(spark):
        df.write.format("avro").option("compression", codec).save(path)
        return len(spark.read.format("avro").load(path).inputFiles())
    schema = avro_schema_of(df.schema)
    fields = df.schema.fields

    def to_files(batches):
        from pyspark import TaskContext
        batches = (pdf for pdf in batches if len(pdf))
        first = next(batches, None)
        if first is not None:
            filesystem, base = task_filesystem(path)
            filesystem.create_dir(base, recursive=True)
            name = f"{base}/part-{TaskContext.get().partitionId():05d}.avro"
            with filesystem.open_output_stream(name) as out:
                writer = ContainerWriter(out, schema, codec)
                for pdf in chain([first], batches):
                    for row in pdf.itertuples(index=False, name=None):
                        writer.append({f.name: _to_avro_value(row[i], f.dataType) for i, f in enumerate(fields)})
                writer.flush()
        yield pd.DataFrame({"files": [0 if first is None else 1]})

    return int(df.mapInPandas(to_files, "files INT").agg(F.sum("files")).first()[0] or 0)


def _open_path(uri: str):
    filesystem, local = task_filesystem(uri)
    return filesystem.open_input_stream(local, buffer_size=BLOCK_BYTES)


def _open_bytes(content: bytes):
    return io.BytesIO(bytes(content))


def _container_files(files: DataFrame, *columns: Column) -> tuple[DataFrame, Callable]:
    """(one row per container file, what opens its first column in a task): paths, which tasks read as streams, or
    the whole content where a task cannot open the paths (a store only Spark reaches)."""
    def unread(batches):
        for pdf in batches:
            n = 0
            for uri in pdf["path"]:
                try:
                    _open_path(uri).close()
                except Exception:   # whatever this file system says: Spark reads the files
                    n += 1
            yield pd.DataFrame({"n": [n]})

    if files.select("path").mapInPandas(unread, "n LONG").agg(F.sum("n")).first()[0]:
        return files.select("content", *columns), _open_bytes
    return files.select("path", *columns), _open_path


def infer_avro_schema(spark: SparkSession, paths: list[str], reader_opts: dict[str, str]) -> T.StructType | None:
    """Union of the writer schemas of the container files."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if avro_package_loaded(spark):
        return reader.format("avro").load(paths).schema
    files, opened = _container_files(reader.format("binaryFile").load(paths))

    def schemas(batches):
        for pdf in batches:
            out = []
            for source in pdf.iloc[:, 0]:
                with opened(source) as stream:
                    out.append(json.dumps(_read_header(stream)[0]))
            yield pd.DataFrame({"schema_json": out})

    distinct = files.mapInPandas(schemas, "schema_json STRING").distinct().collect()
    if not distinct:
        return None
    fields: dict[str, T.StructField] = {}
    for row in distinct:
        for f in spark_schema(row["schema_json"]).fields:
            fields.setdefault(f.name, f)
    return T.StructType(list(fields.values()))


def read_avro_files(spark: SparkSession, paths: list[str], reader_opts: dict[str, str], schema: T.StructType) -> DataFrame:
    """Rows of Avro container files, with file lineage columns."""
    reader = spark.read.option("recursiveFileLookup", "true")
    lineage = [F.col("_metadata.file_name").alias("_ingested_filename"), F.col("_metadata.file_path").alias("_ingested_filepath")]
    if avro_package_loaded(spark):
        return reader.options(**reader_opts).format("avro").schema(schema).load(paths).select("*", *lineage)
    files, opened = _container_files(reader.format("binaryFile").load(paths), *lineage)
    out_schema = T.StructType(schema.fields + [T.StructField("_ingested_filename", T.StringType()),
                                               T.StructField("_ingested_filepath", T.StringType())])
    names = [f.name for f in schema.fields]

    def explode(batches):
        for pdf in batches:
            for source, fname, fpath in pdf.itertuples(index=False, name=None):
                with opened(source) as stream:
                    records = iter_records(stream)
                    while rows := [[*(r.get(n) for n in names), fname, fpath] for r in islice(records, BATCH_ROWS)]:
                        yield pd.DataFrame(rows, columns=names + ["_ingested_filename", "_ingested_filepath"])

    return files.mapInPandas(explode, out_schema)


def decode_framed(col: Column, schemas_by_id: dict[int, str], reader_schema: str) -> Column:
    """Decode schema-registry framed Avro: the writer schema is chosen by the id in each header.

    Fields are matched by name onto ``reader_schema``; fields the writer did not
    have are null. Short or unframed payloads decode to null (the raw bytes are
    kept by the caller). ``schemas_by_id`` holds the registered versions of the
    subject: bounded by the number of versions, so it ships with the function.
    """
    reader = json.loads(reader_schema)
    out_type = spark_schema(reader)
    spark = SparkSession.getActiveSession()
    if spark is not None and avro_package_loaded(spark):
        from pyspark.sql.avro.functions import from_avro
        schema_id = F.conv(F.hex(F.substring(col, 2, 4)), 16, 10).cast("int")
        payload = F.substring(col, FRAME_HEADER + 1, 2147483647)
        branches = None
        for sid, s in schemas_by_id.items():
            writer_fields = {f.name for f in spark_schema(s).fields}
            decoded = from_avro(payload, s, {"mode": "PERMISSIVE"})
            aligned = F.struct(*[(decoded[f.name] if f.name in writer_fields else F.lit(None).cast(f.dataType))
                                 .alias(f.name) for f in out_type.fields])
            cond = schema_id == F.lit(sid)
            branches = F.when(cond, aligned) if branches is None else branches.when(cond, aligned)
        return branches if branches is not None else F.lit(None).cast(out_type)

    writers = {int(k): json.loads(v) for k, v in schemas_by_id.items()}
    names = [f.name for f in out_type.fields]

    @F.pandas_udf(out_type)
    def decode(values: pd.Series) -> pd.DataFrame:
        rows = []
        for v in values:
            rec = None
            if v is not None and len(v) > FRAME_HEADER and v[0] == FRAME_MAGIC:
                sid = struct.unpack(">I", bytes(v[1:FRAME_HEADER]))[0]
                writer = writers.get(sid)
                if writer is not None:
                    try:
                        rec = decode_record(bytes(v[FRAME_HEADER:]), writer)
                    except (EOFError, ValueError, struct.error, UnicodeDecodeError):
                        rec = None
            rows.append([None] * len(names) if rec is None else [rec.get(n) for n in names])
        return pd.DataFrame(rows, columns=names)

    return decode(col)
