"""Typed projection plus a rescue column, from built-in expressions only.

Bronze keeps the data as it arrived: a value that does not fit its declared
type, or a field nobody declared, is kept as a JSON object in ``_rescued_data``
(null when nothing was rescued). Rows are never dropped. ANSI mode is on by
default, so every conversion here is a ``try_`` variant.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schema import CORRUPT_KEY, RESCUE_COLUMN
from . import nested

_COMPLEX = (T.StructType, T.ArrayType, T.MapType)


def typed_from_text(text: Column, dtype: T.DataType) -> Column:
    """Convert one textual value to ``dtype``; null when it does not fit."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, _COMPLEX):
        return F.from_json(text, dtype)
    if isinstance(dtype, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    return text.try_cast(dtype)


_ENTRY = "struct<key:string,value:string>"


def _entry(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))


def _present(entries: list[Column]) -> Column:
    """Non-null entries of a list of optional ``(key, value)`` structs.

    ``array_except`` with a null element drops the nulls; unlike ``filter`` it
    needs no lambda, so the projection stays inside whole-stage code generation.
    """
    if not entries:
        return F.array().cast(f"array<{_ENTRY}>")
    return F.array_except(F.array(*entries), F.array(F.lit(None).cast(_ENTRY)))


def _mismatch_entries(raw: dict[str, Column], typed: dict[str, Column]) -> Column:
    """Entries field -> original text for values that were present but did not convert."""
    return _present([F.when(_mismatch(raw[n], typed[n]), _entry(n, raw[n])) for n in raw])


def _mismatch(raw: Column, typed: Column) -> Column:
    return raw.isNotNull() & typed.isNull()


def _any(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags) if flags else F.lit(False)


def _as_json(entries: Column) -> Column:
    return F.to_json(F.map_from_entries(entries))


def parse_json_object(line: Column) -> Column:
    """The top-level object of a line as ``map<string,string>`` (nested values keep their JSON text)."""
    return F.from_json(line, "map<string,string>")


NEEDS_RESCUE = "_needs_rescue"
TYPED_PREFIX = "_typed_"
DUPLICATE_KEY = "_duplicate_keys_line"
PARSED = "_parsed"
KEYS = "_keys"
MISFIT = "_misfit"
NESTED = "_nested"


def json_has_nested(schema: T.StructType) -> bool:
    """Whether any declared field has parts of its own, and ``json_nested`` is wanted."""
    return nested.has_complex(schema)


def json_nested(line: Column, schema: T.StructType, text_types: bool = False) -> Column:
    """Entries ``a.b[2].c`` -> text for what lies inside the declared complex fields and has no place in their types.

    Expects the column of ``json_parse``. Only used for schemas with such fields; others pay nothing for it.
    """
    parsed = F.col(PARSED)

    def inside(m: Column) -> Column:
        parts = []
        for f in schema.fields:
            if isinstance(f.dataType, _COMPLEX):
                typed = typed_from_text(parsed[f.name], f.dataType) if text_types else parsed[f.name]
                parts.append(nested.json_strays(F.try_element_at(m, F.lit(f.name)), typed, f.dataType, F.lit(f.name)))
        return F.concat(*[F.coalesce(p, nested.none()) for p in parts])

    return F.coalesce(nested.bind(parse_json_object(line), inside), nested.none())


def json_parse(line: Column, schema: T.StructType, text_types: bool = False) -> list[Column]:
    """Parse step for JSON lines: the declared fields and the list of top-level keys.

    By default the fields are typed by Spark's JSON rules in one parse; a value
    that does not fit its type sets ``_corrupt_record`` (the other fields keep
    their values). With ``text_types`` every field is parsed as its raw text
    and converted afterwards (a quoted number then fits a numeric field).

    Both parses are linear in the width of the record (fields are found by a
    hashed name lookup), and the key list is compared with the declared names
    through hash sets. Looking every field up in a parsed map instead costs
    quadratic time (3k rows/s at 100 fields). ``json_object_keys`` is null for a
    line that is not a JSON object.
    """
    if text_types:
        parsed = F.from_json(line, T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    else:
        with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT_KEY, T.StringType())])
        parsed = F.from_json(line, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT_KEY})
    return [parsed.alias(PARSED), F.json_object_keys(line).alias(KEYS)]


def json_typed(schema: T.StructType, text_types: bool = False) -> list[Column]:
    """First step for JSON lines: the declared fields (see ``json_parse``) plus a flag
    telling whether the row has anything to rescue.

    Kept apart from the rescue step so this projection stays small enough for
    whole-stage code generation to be compiled by the JIT; the flag is made of
    scalar tests only: not an object, an undeclared key, a repeated key, or a
    value that did not fit its type.
    """
    parsed = F.col(PARSED)
    keys = F.col(KEYS)
    if text_types:
        raw = {f.name: parsed[f.name] for f in schema.fields}
        typed = {f.name: typed_from_text(raw[f.name], f.dataType) for f in schema.fields}
        misfit = _any([_mismatch(raw[f.name], typed[f.name]) for f in schema.fields
                       if not isinstance(f.dataType, T.StringType)])
    else:
        typed = {f.name: parsed[f.name] for f in schema.fields}
        misfit = parsed[CORRUPT_KEY].isNotNull()
    names = [f.name for f in schema.fields]
    declared = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    needs = (keys.isNull() | (F.size(F.array_except(keys, declared)) > 0)
             | (F.size(keys) > F.size(F.array_distinct(keys))) | misfit)
    if json_has_nested(schema):
        needs = needs | (F.size(NESTED) > 0)
    return ([typed[f.name].alias(f.name) for f in schema.fields]
            + [needs.alias(NEEDS_RESCUE), F.coalesce(misfit, F.lit(False)).alias(MISFIT)])


def json_rescue(line: Column, schema: T.StructType, text_types: bool = False) -> Column:
    """Second step for JSON lines: ``_rescued_data`` for the flagged rows, null otherwise.

    Unknown keys and values that did not fit are rescued with their text, those inside
    a complex field under their path. A line
    that is not a JSON object is rescued whole under ``_corrupt_record``, a line
    repeating a key whole under ``_duplicate_keys_line``. Expects the columns of
    ``json_parse``, ``json_typed`` and, for schemas with complex fields, ``json_nested``;
    the line is parsed into a map only for flagged rows.
    """
    names = [f.name for f in schema.fields]
    declared = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    keys = F.col(KEYS)
    m = parse_json_object(line)
    # Undeclared keys from the key list (hash based); only their values are looked up.
    unknown_names = F.array_except(keys, declared)
    unknown = F.map_from_arrays(unknown_names, F.transform(unknown_names, lambda k: F.try_element_at(m, k)))
    with_nested = json_has_nested(schema)
    checked = [f.name for f in schema.fields if not isinstance(f.dataType, (T.StringType, *_COMPLEX))]
    if text_types:
        raw = {n: F.col(PARSED)[n] for n in checked}
    else:
        raw = {n: F.try_element_at(m, F.lit(n)) for n in checked}
    # Values present in the line whose typed column (first step) stayed null; looked
    # up field by field only when the first step saw a misfit.
    mismatched = F.when(F.col(MISFIT), F.map_from_entries(F.filter(
        F.array(*[F.when(_mismatch(raw[n], F.col(f"`{n}`")), _entry(n, raw[n])) for n in checked]
                or [F.lit(None).cast(_ENTRY)]),
        lambda e: e.isNotNull()))).otherwise(F.create_map().cast("map<string,string>"))
    whole = F.to_json(F.create_map(F.lit(CORRUPT_KEY), line))
    # A misfit that nothing names keeps the whole line. The
    # rescue map is built once per row: this rescue projection is interpreted.
    unnamed = F.col(MISFIT) & (F.size(unknown_names) == 0) & (F.size(mismatched) == 0)
    if with_nested:
        unnamed = unnamed & (F.size(NESTED) == 0)
        found = nested.entries_json(F.concat(F.map_entries(unknown).cast(nested.ENTRIES),
                                             F.map_entries(mismatched).cast(nested.ENTRIES), F.col(NESTED)))
    else:
        found = F.to_json(F.map_concat(unknown, mismatched))
    return (F.when(~F.col(NEEDS_RESCUE), F.lit(None).cast("string"))
             .when(keys.isNull(), whole)
             .when(F.size(keys) > F.size(F.array_distinct(keys)), F.to_json(F.create_map(F.lit(DUPLICATE_KEY), line)))
             .when(unnamed, whole)
             .otherwise(found)).alias(RESCUE_COLUMN)


def text_typed(header: list[str], schema: T.StructType, corrupt: Column | None = None) -> list[Column]:
    """First step for CSV: declared columns converted from the string columns named by
    the header, plus the rescue flag. Columns are matched by name, never by position;
    declared columns absent from the header are null.
    """
    present = set(header)
    typed, flags = {}, []
    for f in schema.fields:
        if f.name in present:
            src = F.col(f"`{f.name}`")
            typed[f.name] = typed_from_text(src, f.dataType)
            if not isinstance(f.dataType, T.StringType):
                flags.append(_mismatch(src, typed[f.name]))
        else:
            typed[f.name] = F.lit(None).cast(f.dataType)
    declared = {f.name for f in schema.fields}
    flags += [F.col(f"`{h}`").isNotNull() for h in header if h not in declared]
    if corrupt is not None:
        flags.append(corrupt.isNotNull())
    return [typed[f.name].alias(f"{TYPED_PREFIX}{f.name}") for f in schema.fields] + [_any(flags).alias(NEEDS_RESCUE)]


def text_rescue(header: list[str], schema: T.StructType, corrupt: Column | None = None) -> Column:
    """Second step for CSV: ``_rescued_data`` for flagged rows: undeclared header
    columns and failed conversions with their original text, and a malformed line
    (wrong number of fields) whole under ``_corrupt_record``.
    """
    declared = {f.name: f for f in schema.fields}
    entries = []
    for h in header:
        src = F.col(f"`{h}`")
        if h not in declared:
            entries.append(F.when(src.isNotNull(), _entry(h, src)))
        elif not isinstance(declared[h].dataType, T.StringType):
            entries.append(F.when(_mismatch(src, F.col(f"`{TYPED_PREFIX}{h}`")), _entry(h, src)))
    if corrupt is not None:
        entries.append(F.when(corrupt.isNotNull(), _entry(CORRUPT_KEY, corrupt)))
    body = F.to_json(F.map_from_entries(F.filter(F.array(*(entries or [F.lit(None).cast(_ENTRY)])),
                                                 lambda e: e.isNotNull())))
    return F.when(F.col(NEEDS_RESCUE), body).alias(RESCUE_COLUMN)


def text_columns(header: list[str], schema: T.StructType, df_cols_corrupt: str | None = None):
    """Both CSV steps as a function of a DataFrame of string columns (see ``text_typed``)."""
    def apply(df):
        corrupt = F.col(f"`{df_cols_corrupt}`") if df_cols_corrupt else None
        keep = [c for c in df.columns]
        typed = df.select(*[F.col(f"`{c}`") for c in keep], *text_typed(header, schema, corrupt))
        return typed.select(*[F.col(f"`{TYPED_PREFIX}{f.name}`").alias(f.name) for f in schema.fields],
                            text_rescue(header, schema, corrupt),
                            *[F.col(f"`{c}`") for c in keep if c.startswith("_ingested_")])
    return apply


UNMAPPED_KEY = "_unmapped_values"
EXTRA_VALUES_KEY = "_extra_values"
VALUES = "_values"
HEADER = "_header"
POSITIONS = "_positions"


def header_positions(header: Column, schema: T.StructType) -> Column:
    """1-based position of each declared field in a file's header (0 when absent).

    Computed once per file in the small header table, so rows index their values
    directly instead of searching the header for every field.
    """
    return F.array(*[F.array_position(header, F.lit(f.name)).cast("int") for f in schema.fields])


def csv_by_file_typed(schema: T.StructType, width: int) -> list[Column]:
    """First step for CSV files read positionally (``_c0`` ... ``_c<width>``) next to their own header.

    ``_header`` is the file's header (from the probe); each declared field takes
    the value at its position in that header. ``width`` is the widest header,
    and one more slot catches lines with more fields than any header. The header
    lines themselves are left out by the reader.
    """
    values = F.array(*[F.col(f"_c{i}") for i in range(width + 1)])
    header = F.col(HEADER)
    typed, flags = {}, [header.isNull()]
    for i, f in enumerate(schema.fields):
        pos = F.col(POSITIONS)[i]
        raw = F.when(pos > 0, F.element_at(values, pos))
        typed[f.name] = typed_from_text(raw, f.dataType)
        if not isinstance(f.dataType, T.StringType):
            flags.append(_mismatch(raw, typed[f.name]))
    declared = F.array(*[F.lit(f.name) for f in schema.fields])
    # Undeclared header columns, or values past the header: possibly something to rescue.
    flags += [F.size(F.array_except(header, declared)) > 0, F.col(f"_c{width}").isNotNull(),
              F.size(header) < F.lit(width)]
    return ([typed[f.name].alias(f"{TYPED_PREFIX}{f.name}") for f in schema.fields]
            + [_any(flags).alias(NEEDS_RESCUE), values.alias(VALUES)])


def csv_by_file_rescue(schema: T.StructType, width: int) -> Column:
    """Second step: undeclared columns (by the file's header), failed conversions,
    values past the header, and rows of files without a probed header (all values)."""
    header, values = F.col(HEADER), F.col(VALUES)
    declared = F.array(*[F.lit(f.name) for f in schema.fields])
    by_name = F.map_from_arrays(header, F.slice(values, 1, F.size(header)))
    extras = F.map_filter(by_name, lambda k, v: ~F.array_contains(declared, k) & v.isNotNull())
    checked = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    mismatched = F.map_from_entries(F.filter(F.array(*[
        F.when(_mismatch(F.try_element_at(by_name, F.lit(n)), F.col(f"`{TYPED_PREFIX}{n}`")),
               _entry(n, F.try_element_at(by_name, F.lit(n)))) for n in checked] or [F.lit(None).cast(_ENTRY)]),
        lambda e: e.isNotNull()))
    past = F.filter(F.slice(values, F.size(header) + 1, width + 1), lambda v: v.isNotNull())
    past_map = F.when(F.size(past) > 0, F.create_map(F.lit(EXTRA_VALUES_KEY), F.to_json(past))) \
        .otherwise(F.create_map().cast("map<string,string>"))
    found = F.map_concat(extras, mismatched, past_map)
    body = F.when(header.isNull(), F.to_json(F.create_map(F.lit(UNMAPPED_KEY), F.to_json(values)))) \
        .when(F.size(found) > 0, F.to_json(found))
    return F.when(F.col(NEEDS_RESCUE), body).alias(RESCUE_COLUMN)


def csv_by_file(schema: T.StructType, width: int):
    """Both steps, as a function of the positional DataFrame joined with ``_header``."""
    def apply(df):
        lineage = [c for c in df.columns if c.startswith("_ingested_")]
        typed = df.select(*csv_by_file_typed(schema, width), HEADER, *lineage)
        return typed.select(*[F.col(f"`{TYPED_PREFIX}{f.name}`").alias(f.name) for f in schema.fields],
                            csv_by_file_rescue(schema, width), *lineage)
    return apply


def extra_columns(schema: T.StructType, extra: T.StructType) -> list[Column]:
    """Declared columns as read, plus undeclared ones packed into ``_rescued_data`` (Parquet/Avro)."""
    cols = [F.col(f"`{f.name}`") for f in schema.fields]
    if not extra.fields:
        return cols + [F.lit(None).cast("string").alias(RESCUE_COLUMN)]
    packed = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in extra.fields]))
    any_set = reduce(lambda a, b: a | b, [F.col(f"`{f.name}`").isNotNull() for f in extra.fields])
    rescued = F.when(any_set, packed)
    return cols + [rescued.alias(RESCUE_COLUMN)]
