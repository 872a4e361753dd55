"""Values against a schema, at any depth: what fits is kept typed, what does not is named by its path.

A stray is an entry ``(key, value)``: the path of a value that the schema has no place for (an undeclared field of a struct,
a value of another type) and its text. Paths read ``a.b[2].c``; map entries read ``a[key]``. The siblings of a stray keep
their values. All of it is built from DataFrame functions.

Two kinds of input meet a schema: typed columns of files with a schema of their own (``conform``, ``strays``) and JSON text
(``json_strays``). ``grow`` adds to a schema what files have in addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "struct<key:string,value:string>"
ENTRIES = f"array<{ENTRY}>"
COMPLEX = (T.StructType, T.ArrayType, T.MapType)
# From narrow to wide: a value of an earlier type fits every later one.
_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def nullable(t: T.DataType) -> T.DataType:
    """The type with every part nullable, for comparison."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(nullable(t.keyType), nullable(t.valueType), True)
    return t


def same(a: T.DataType, b: T.DataType) -> bool:
    return nullable(a) == nullable(b)


def grow(known: T.DataType, seen: T.DataType) -> T.DataType:
    """``known`` and whatever ``seen`` has besides it, at any depth. A part of another type keeps the known type."""
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        more = {f.name: f for f in seen.fields}
        fields = [T.StructField(f.name, grow(f.dataType, more.pop(f.name).dataType) if f.name in more else f.dataType, True)
                  for f in known.fields]
        return T.StructType(fields + [T.StructField(f.name, nullable(f.dataType), True) for f in more.values()])
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(grow(known.elementType, seen.elementType), True)
    if isinstance(known, T.MapType) and isinstance(seen, T.MapType):
        return T.MapType(known.keyType, grow(known.valueType, seen.valueType), True)
    return seen if isinstance(known, T.NullType) else known


def join_new(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type for a field that is new in two files at once: as ``grow``, but the wider of two numbers."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f.dataType for f in b.fields}
        mine = T.StructType([T.StructField(f.name, join_new(f.dataType, theirs.get(f.name, f.dataType)), True)
                             for f in a.fields])
        return grow(mine, b)
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    return grow(a, b)


def new_paths(known: T.DataType, seen: T.DataType, at: str = "") -> list[str]:
    """Paths of the fields that ``grow`` would add."""
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        have, out = {f.name: f.dataType for f in known.fields}, []
        for f in seen.fields:
            path = f"{at}.{f.name}" if at else f.name
            out += new_paths(have[f.name], f.dataType, path) if f.name in have else [path]
        return out
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return new_paths(known.elementType, seen.elementType, f"{at}[]")
    if isinstance(known, T.MapType) and isinstance(seen, T.MapType):
        return new_paths(known.valueType, seen.valueType, f"{at}[]")
    return []


def has_complex(schema: T.StructType) -> bool:
    return any(isinstance(f.dataType, COMPLEX) for f in schema.fields)


def text_of(value: Column, t: T.DataType) -> Column:
    if isinstance(t, COMPLEX):
        return F.to_json(value)
    if isinstance(t, T.VariantType):
        return F.to_json(value)
    return F.base64(value) if isinstance(t, T.BinaryType) else value.cast("string")


def none() -> Column:
    return F.array().cast(ENTRIES)


def entry(path: Column, text: Column) -> Column:
    return F.array(F.struct(path.alias("key"), text.alias("value"))).cast(ENTRIES)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def under(path: Column | None, name: str | Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return name if path is None else F.concat(path, F.lit("."), name)


def _inside(path: Column, key: Column) -> Column:
    return F.concat(path, F.lit("["), key.cast("string"), F.lit("]"))


# -- typed values ----------------------------------------------------------------------------------------------------

def _numbers(*types: T.DataType) -> bool:
    return all(isinstance(t, T.NumericType) for t in types)


def _leaf(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in another type; null where nothing of it would be left, or not all of it."""
    if isinstance(have, COMPLEX) or isinstance(want, COMPLEX):
        return text_of(value, have) if isinstance(want, T.StringType) else F.lit(None).cast(want)
    if isinstance(want, T.StringType):
        return text_of(value, have)
    if isinstance(have, T.StringType):
        return F.try_to_binary(value, F.lit("base64")) if isinstance(want, T.BinaryType) else value.try_cast(want)
    try:
        there = value.try_cast(want)
        back = there.try_cast(have)
    except Exception:   # no such cast
        return F.lit(None).cast(want)
    if isinstance(have, T.BinaryType) or isinstance(want, T.BinaryType) or isinstance(have, T.BooleanType) \
            or isinstance(want, T.BooleanType) or (isinstance(have, T.NumericType) != isinstance(want, T.NumericType)):
        return F.lit(None).cast(want)
    # A number that loses digits, or a time that loses its hour, does not fit.
    return F.when(back == value, there)


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of type ``have`` as ``want``: parts that fit keep their values, the others are null."""
    if same(have, want):
        return value
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        theirs = {f.name: f.dataType for f in have.fields}
        parts = [(conform(value[f.name], theirs[f.name], f.dataType) if f.name in theirs else F.lit(None).cast(f.dataType))
                 .alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and same(have.keyType, want.keyType):
        return F.transform_values(value, lambda k, v: conform(v, have.valueType, want.valueType))
    return _leaf(value, have, want)


def strays(value: Column, have: T.DataType, want: T.DataType, path: Column | None) -> Column | None:
    """Entries for what ``conform`` leaves out; None where nothing can be left out."""
    if same(have, want) or isinstance(have, T.NullType):
        return None
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        known, parts = {f.name: f.dataType for f in want.fields}, []
        for f in have.fields:
            part, at = value[f.name], under(path, f.name)
            if f.name in known:
                found = strays(part, f.dataType, known[f.name], at)
                if found is not None:
                    parts.append(found)
            elif not isinstance(f.dataType, T.NullType):
                parts.append(F.when(part.isNotNull(), entry(at, text_of(part, f.dataType))).otherwise(none()))
        return F.concat(*[F.coalesce(p, none()) for p in parts]) if parts else None
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        if strays(F.lit(None).cast(have.elementType), have.elementType, want.elementType, path) is None:
            return None
        return F.flatten(F.transform(value, lambda x, i: F.coalesce(
            strays(x, have.elementType, want.elementType, _inside(path, i)), none())))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and same(have.keyType, want.keyType):
        if strays(F.lit(None).cast(have.valueType), have.valueType, want.valueType, path) is None:
            return None
        return F.flatten(F.transform(F.map_entries(value), lambda e: F.coalesce(
            strays(e["value"], have.valueType, want.valueType, _inside(path, e["key"])), none())))
    return F.when(value.isNotNull() & _leaf(value, have, want).isNull(), entry(path, text_of(value, have))).otherwise(none())


# -- JSON text -------------------------------------------------------------------------------------------------------

def json_strays(text: Column, typed: Column, want: T.DataType, path: Column | None) -> Column:
    """Entries for what the JSON text of a value holds and its typed value (as Spark's parser made it) does not."""
    if isinstance(want, T.StructType):
        def fields(m: Column) -> Column:
            known = F.array(*[F.lit(f.name) for f in want.fields]).cast("array<string>")
            parts = [F.transform(F.filter(F.map_entries(m), lambda e: ~F.array_contains(known, e["key"]) & e["value"].isNotNull()),
                                 lambda e: F.struct(under(path, e["key"]).alias("key"), e["value"].alias("value")))]
            for f in want.fields:
                if not isinstance(f.dataType, T.StringType):
                    parts.append(json_strays(F.try_element_at(m, F.lit(f.name)), typed[f.name], f.dataType, under(path, f.name)))
            return F.concat(*[F.coalesce(p.cast(ENTRIES), none()) for p in parts])
        inner = bind(F.from_json(text, "map<string,string>"), lambda m: F.when(
            m.isNull(), entry(path if path is not None else F.lit(""), text)).otherwise(fields(m)))
    elif isinstance(want, T.ArrayType):
        if isinstance(want.elementType, T.StringType):
            inner = F.when(typed.isNull(), entry(path, text)).otherwise(none())
        else:
            inner = bind(F.from_json(text, "array<string>"), lambda a: F.when(a.isNull(), entry(path, text)).otherwise(
                F.flatten(F.transform(a, lambda x, i: F.coalesce(
                    json_strays(x, F.get(typed, i), want.elementType, _inside(path, i)), none())))))
    elif isinstance(want, T.MapType):
        inner = bind(F.from_json(text, "map<string,string>"), lambda m: F.when(m.isNull(), entry(path, text)).otherwise(
            none() if isinstance(want.valueType, T.StringType) else F.flatten(F.transform(
                F.map_entries(m), lambda e: F.coalesce(json_strays(
                    e["value"], F.try_element_at(typed, e["key"]), want.valueType, _inside(path, e["key"])), none())))))
    elif isinstance(want, T.VariantType):
        return none()
    else:
        inner = F.when(typed.isNull(), entry(path, text)).otherwise(none())
    # JSON's null is no value.
    return F.when(text.isNull() | (text == "null"), none()).otherwise(inner)


def entries_json(entries: Column) -> Column:
    """The entries as one JSON object; of a path that occurs twice the values are kept as ``path``, ``path#2`` ..."""
    def numbered(all_: Column) -> Column:
        keys = F.transform(all_, lambda e: e["key"])
        return F.transform(all_, lambda e, i: F.struct(
            F.when(F.array_position(keys, e["key"]) == i + 1, e["key"]).otherwise(
                F.concat(e["key"], F.lit("#"), (i + 1).cast("string"))).alias("key"), e["value"].alias("value")))
    return bind(entries, lambda all_: F.when(F.size(all_) > 0, F.to_json(F.map_from_entries(numbered(all_)))))
