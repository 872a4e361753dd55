"""Nested rescue, conflicting types and growth, against a walk in plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeingest.functions import nested
from lakeingest.plans.ingest_queries import files_source
from lakeingest.plans.lab import Lab
from lakeingest.session import write_text

DDL = ("id BIGINT, a STRUCT<x: BIGINT, s: STRING, in: STRUCT<y: DOUBLE>>, l ARRAY<STRUCT<k: BIGINT, t: STRING>>, "
       "n ARRAY<BIGINT>, m MAP<STRING, STRUCT<v: BIGINT>>")


def some_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind < 5:
        return rng.choice([None, rng.randint(-9, 9), "w" + str(rng.randint(0, 9)), True, 2.5])
    if kind < 7:
        return {k: some_value(rng, depth + 1) for k in rng.sample(["x", "s", "in", "y", "k", "t", "v", "q"], rng.randint(0, 3))}
    return [some_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]


def some_record(rng):
    rec = {"id": rng.randint(0, 99)}
    if rng.random() < 0.7:
        rec["a"] = {"x": rng.choice([1, 2, "bad", None]), "s": "t", "in": {"y": 1.5, "z": some_value(rng, 2)}, "q": some_value(rng, 2)}
    if rng.random() < 0.7:
        rec["l"] = [{"k": rng.choice([1, "no"]), "t": "u", "w": some_value(rng, 2)} for _ in range(rng.randint(0, 3))]
    if rng.random() < 0.5:
        rec["m"] = {k: {"v": 1, "more": some_value(rng, 3)} for k in rng.sample(["p", "r"], rng.randint(0, 2))}
    if rng.random() < 0.4:
        rec[rng.choice(["a", "l", "n", "m", "new"])] = some_value(rng)
    return rec


def lost(value, typed, dtype, path, rescued):
    """Paths of values that are neither typed nor rescued (whole or in part above them)."""
    if value is None or path in rescued or isinstance(dtype, T.StringType) and typed is not None:
        return []
    if isinstance(dtype, T.StructType) and isinstance(value, dict):
        kinds, out = {f.name: f.dataType for f in dtype.fields}, []
        for k, v in value.items():
            at = f"{path}.{k}" if path else k
            if k in kinds:
                out += lost(v, None if typed is None else typed[k], kinds[k], at, rescued)
            elif v is not None and at not in rescued:
                out.append(at)
        return out
    if isinstance(dtype, T.ArrayType) and isinstance(value, list):
        return [p for i, v in enumerate(value)
                for p in lost(v, typed[i] if typed and i < len(typed) else None, dtype.elementType, f"{path}[{i}]", rescued)]
    if isinstance(dtype, T.MapType) and isinstance(value, dict):
        return [p for k, v in value.items() for p in lost(v, (typed or {}).get(k), dtype.valueType, f"{path}[{k}]", rescued)]
    return [] if typed is not None else [path]


@pytest.mark.parametrize("text_types", [False, True])
def test_json_lines_lose_nothing_at_any_depth(spark, text_types):
    rng = random.Random(7)
    records = [some_record(rng) for _ in range(250)]
    lab = Lab(spark, f"t_nested{int(text_types)}")
    write_text(spark, f"{lab.engine.landing_root}/j/a.json", "\n".join(json.dumps({**r, "id": i}) for i, r in enumerate(records)))
    ds = lab.dataset("j", files_source("json", "j", schema=DDL, json_text_types=text_types))
    result = lab.run(ds)[0]
    assert (result.status, result.rows_ingested) == ("OK", len(records)), result.error_message
    schema, seen = T.StructType.fromDDL(DDL), 0
    for row in lab.bronze(ds).collect():
        rec = {**records[row["id"]], "id": row["id"]} if row["id"] is not None else None
        rescued = json.loads(row["_rescued_data"]) if row["_rescued_data"] else {}
        if rec is None or "_corrupt_record" in rescued:
            continue
        typed = row.asDict(recursive=True)
        assert lost(rec, typed, schema, "", rescued) == [], (rec, typed, rescued)
        seen += bool(rescued)
        if isinstance(rec.get("a"), dict) and rec["a"].get("s") == "t" and isinstance(rec["a"].get("in"), dict):
            assert typed["a"]["s"] == "t" and typed["a"]["in"]["y"] == 1.5      # the siblings stay
    assert seen > 100


def test_grow_and_new_paths(spark):
    a = T.StructType.fromDDL("a STRUCT<x: INT>, l ARRAY<STRUCT<k: INT>>, z INT")
    b = T.StructType.fromDDL("l ARRAY<STRUCT<w: INT, k: STRING>>, a STRUCT<y: STRING, x: INT>, n INT, z STRING")
    assert nested.grow(a, b) == T.StructType.fromDDL("a STRUCT<x: INT, y: STRING>, l ARRAY<STRUCT<k: INT, w: INT>>, z INT, n INT")
    assert nested.new_paths(a, b) == ["l[].w", "a.y", "n"]
    assert nested.grow(a, a) == a and nested.new_paths(a, a) == []


def _conflict(spark, lab, values):
    """Files with one column ``c`` of the given (type, values); the rows by file."""
    for i, (kind, data) in enumerate(values):
        lab.land(spark.createDataFrame([(j, v) for j, v in enumerate(data)], f"id INT, c {kind}").coalesce(1), "p", f"d{i}", "parquet")
    ds = lab.dataset("p", files_source("parquet", "p"))
    result = lab.run(ds)[0]
    assert result.status == "OK", result.error_message
    out = {}
    for r in lab.bronze(ds).collect():
        rescued = json.loads(r["_rescued_data"]) if r["_rescued_data"] else {}
        out[int(r["_ingested_filepath"].split("/p/d")[1][0]), r["id"]] = r["c"], rescued.get("c")
    return lab.bronze(ds).schema["c"].dataType.simpleString(), out


def test_types_that_disagree(spark):
    kind, got = _conflict(spark, Lab(spark, "t_conf1"), [
        ("BIGINT", [1, None]), ("STRING", ["2", "x", "", None]), ("DOUBLE", [3.0, 3.5, float("nan")]), ("INT", [4]),
        ("BOOLEAN", [True]), ("ARRAY<INT>", [[1, 2]]), ("STRUCT<q: INT>", [(5,)]), ("DATE", [None])])
    assert kind == "bigint"
    assert {k: v for k, v in got.items() if v != (None, None)} == {
        (0, 0): (1, None), (1, 0): (2, None), (1, 1): (None, "x"), (1, 2): (None, ""), (2, 0): (3, None), (2, 1): (None, "3.5"),
        (2, 2): (None, "NaN"), (3, 0): (4, None), (4, 0): (None, "true"), (5, 0): (None, "[1,2]"), (6, 0): (None, '{"q":5}')}


def test_numbers_widen_when_they_arrive_together_and_later_ones_that_fit_stay(spark):
    lab = Lab(spark, "t_conf2")
    kind, got = _conflict(spark, lab, [("INT", [1]), ("BIGINT", [2 ** 40])])
    assert kind == "bigint" and got == {(0, 0): (1, None), (1, 0): (2 ** 40, None)}
    text, got = _conflict(spark, Lab(spark, "t_conf3"), [("STRING", ["a"]), ("BIGINT", [7]), ("ARRAY<STRING>", [["b"]])])
    assert text == "string" and got == {(0, 0): ("a", None), (1, 0): ("7", None), (2, 0): ('["b"]', None)}


def test_nested_conflict_in_arrays_and_structs(spark):
    lab = Lab(spark, "t_conf4")
    one = spark.createDataFrame([(1, [{"k": 1, "t": "a"}])], "id INT, l ARRAY<STRUCT<k: INT, t: STRING>>")
    two = spark.createDataFrame([(2, [{"t": "b", "k": "9"}, {"t": "c", "k": "nine"}])], "id INT, l ARRAY<STRUCT<t: STRING, k: STRING>>")
    lab.land(one, "p", "d0", "parquet")
    lab.land(two, "p", "d1", "parquet")
    ds = lab.dataset("p", files_source("parquet", "p"))
    assert lab.run(ds)[0].status == "OK"
    rows = {r["id"]: r for r in lab.bronze(ds).collect()}
    assert [(x["k"], x["t"]) for x in rows[2]["l"]] == [(9, "b"), (None, "c")]
    assert json.loads(rows[2]["_rescued_data"]) == {"l[1].k": "nine"} and rows[1]["_rescued_data"] is None


def test_declared_nested_type_change_is_refused(spark):
    lab = Lab(spark, "t_conf5")
    df = spark.createDataFrame([(1, {"x": 1})], "id INT, a STRUCT<x: INT>")
    lab.land(df, "p", "d0", "parquet")
    assert lab.run(lab.dataset("p", files_source("parquet", "p", schema="id INT, a STRUCT<x: INT>")))[0].status == "OK"
    lab.land(df, "p", "d1", "parquet")
    res = lab.run(lab.dataset("p", files_source("parquet", "p", schema="id INT, a STRUCT<x: STRING>")))[0]
    assert res.status == "ERROR" and "a.x: int -> string" in res.error_message


def test_paths_with_pattern_characters(spark):
    lab = Lab(spark, "t_glob")
    df = spark.createDataFrame([(1,)], "id INT").coalesce(1)
    for i, folder in enumerate(("a[1]", "b{x,y}", "c d%20", "plain")):
        lab.land(df.withColumn("id", F.lit(i)), "p", folder, "parquet")
        lab.land(df.withColumn("id", F.lit(i)), "j", folder, "json")
    for fmt, name in (("parquet", "p"), ("json", "j")):
        ds = lab.dataset(name, files_source(fmt, name, schema="id INT"))
        result = lab.run(ds)[0]
        assert result.status == "OK", result.error_message
        assert sorted(r["id"] for r in lab.bronze(ds).collect()) == [0, 1, 2, 3]


def test_a_repeated_path_keeps_both_values(spark):
    schema = T.StructType.fromDDL(DDL)
    line = '{"id":1,"a":{"q":1,"q":2}}'
    parsed = F.from_json(F.col("t"), schema)
    found = spark.createDataFrame([(line,)], "t STRING").select(
        nested.entries_json(nested.json_strays(F.col("t"), parsed, schema, None)).alias("r")).first()["r"]
    assert sorted(json.loads(found).values()) == ["1", "2"]
