"""Decoders of message keys and values, one per format.

A decoder gives two columns: the decoded value, and whether it holds everything the bytes held. Where it does not, the
message source keeps the bytes beside the value: malformed text, a field that does not fit its type, and fields the
declared schema does not know.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import EngineSpec, SpecError
from . import nested

# Fixed value: schema-registry framing is 1 magic byte + 4 bytes of schema id.
FRAME_HEADER = 5
_CORRUPT = "__corrupt"


class Decoded(NamedTuple):
    value: Column
    whole: Column
    # What the value has no place for, by path (JSON text; null if nothing); None for formats that cannot tell.
    strays: Column | None = None


class Side(NamedTuple):
    """What a source configures for one side of a message (``key`` or ``value``)."""

    name: str
    format: str
    json_schema: str | None
    subject: str | None

    @classmethod
    def of(cls, source: dict, side: str, default: str | None = None) -> "Side":
        return cls(side, source.get(f"{side}_format") or default, source.get(f"{side}_json_schema"),
                   source.get(f"{side}_subject"))


def strip_frame(col: Column) -> Column:
    """Payload after the 5-byte header; shorter input gives empty bytes."""
    return F.substring(col, FRAME_HEADER + 1, 2147483647)


def frame_schema_id(col: Column) -> Column:
    """Schema id of a framed message (bytes 2-5, big-endian); null when too short."""
    return F.when(F.length(col) >= FRAME_HEADER, F.conv(F.hex(F.substring(col, 2, 4)), 16, 10).cast("int"))


def _json(raw: Column, side: Side, **_) -> Decoded:
    if not side.json_schema:
        raise SpecError(f"{side.name}_format json needs {side.name}_json_schema")
    declared = T.StructType.fromDDL(side.json_schema)
    text = raw.cast("string")
    # One parse: the extra field holds the text whenever a record or one of its fields did not parse.
    parsed = F.from_json(text, T.StructType([*declared.fields, T.StructField(_CORRUPT, T.StringType())]),
                         {"columnNameOfCorruptRecord": _CORRUPT})
    known = parsed.dropFields(_CORRUPT)
    # Text that is no object has no fields to name: its bytes are kept.
    named = F.json_object_keys(text).isNotNull()
    strays = F.when(named, nested.entries_json(nested.json_strays(text, known, declared, None)))
    whole = parsed.getField(_CORRUPT).isNull() & strays.isNull()
    return Decoded(known, raw.isNull() | F.coalesce(whole, F.lit(False)), strays)


def _avro(raw: Column, side: Side, spark: SparkSession, engine: EngineSpec) -> Decoded:
    if not side.subject:
        raise SpecError(f"{side.name}_format avro needs {side.name}_subject")
    from ..sources.avro import decode_framed
    from ..sources.subjects import subject_versions
    newest, by_id = subject_versions(spark, engine, side.subject)
    value = decode_framed(raw, by_id, newest)
    fields = [value.getField(f["name"]).isNotNull() for f in _fields(newest)]
    some = fields[0] if fields else F.lit(True)
    for f in fields[1:]:
        some = some | f
    return Decoded(value, raw.isNull() | (value.isNotNull() & some))


def _fields(schema) -> list[dict]:
    import json
    return (json.loads(schema) if isinstance(schema, str) else schema)["fields"]


DECODERS: dict[str, Callable[..., Decoded]] = {
    "binary": lambda raw, side, **_: Decoded(raw, F.lit(True)),
    "string": lambda raw, side, **_: Decoded(raw.cast("string"), F.lit(True)),
    "json": _json,
    "avro": _avro,
}
