"""State kept as runs: equal to a plain recomputation, cheap to write, safe to replay."""

import random

import pytest
from pyspark.sql import functions as F

from lakeingest.session import _fs, list_names, new_area
from lakeingest.streaming.log_state import KeyedLog, TotalsLog, runs_to_merge
from lakeingest.streaming.sink import CheckpointMismatchError

SCHEMA = "k STRING, seq INT, op STRING, g STRING, v DECIMAL(10,2)"


def _bytes(spark, path):
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def _state(spark, label, **options):
    return KeyedLog(spark, f"{new_area(spark, label)}/state", ["k"], ["seq"], "op = 'D'", **{"buckets": 3, **options})


def test_random_batches_equal_a_recomputation(spark):
    rng = random.Random(5)
    st = _state(spark, "log1", fan=2)
    totals = TotalsLog(spark, f"{st.path}-totals", {"g": F.col("g")}, {"v": F.col("v").cast("decimal(38,2)")}, buckets=2, fan=2)
    last = {}
    for version in range(7):
        batch = [(f"k{rng.randint(0, 12)}", rng.randint(version * 3 - 4, version * 3 + 9), rng.choice("IUUD"),
                  rng.choice(["a", "b", None]), rng.randint(0, 99)) for _ in range(rng.choice([0, 6, 12]))]
        seen = {}
        batch = [r for r in batch if seen.setdefault((r[0], r[1]), r) is r and last.get(r[0], (None, None))[1] != r[1]]
        changes = spark.createDataFrame(batch, SCHEMA.replace("DECIMAL(10,2)", "INT")).withColumn("v", F.col("v").cast("decimal(10,2)"))
        for _ in range(2 if version in (3, 6) else 1):      # replays
            totals.apply(st.signed_changes(changes, version), version)
            st.apply(changes, version)
        for r in batch:
            if r[0] not in last or last[r[0]][1] < r[1]:
                last[r[0]] = r
        shown = {k: r for k, r in last.items() if r[2] != "D"}
        rows = st.visible()
        assert sorted(() if rows is None else ((r["k"], r["seq"], r["op"], r["g"], int(r["v"])) for r in rows.collect()),
                      key=str) == sorted(shown.values(), key=str)
        sums = {}
        for r in shown.values():
            n, s = sums.get(r[3], (0, 0))
            sums[r[3]] = n + 1, s + r[4]
        rows = totals.visible()
        assert {r["g"]: (r["_rows"], int(r["v"])) for r in ([] if rows is None else rows.collect())} == sums


def test_a_batch_writes_bytes_in_proportion_to_itself(spark):
    st = _state(spark, "log2", buckets=4, fan=4)
    make = lambda n, seq: spark.range(n).selectExpr(
        "concat('key', id) AS k", f"{seq} AS seq", "'U' AS op", "sha2(cast(id + " + str(seq) + " as string), 256) AS g", "CAST(1 AS DECIMAL(10,2)) AS v")
    st.apply(make(40000, 0), 0)
    base = _bytes(spark, f"{st.path}/data")
    for version in (1, 2, 3):
        before = _bytes(spark, f"{st.path}/data")
        st.apply(make(200, version), version)       # touches every bucket
        assert len(list_names(spark, f"{st.path}/data/_run={version}")) >= 4
        assert _bytes(spark, f"{st.path}/data") - before < base / 20
    assert st.visible().count() == 40000 and st.visible().where("seq = 3").count() == 200


def test_the_last_version_may_be_applied_again_and_older_ones_not(spark):
    st = _state(spark, "log3")
    one = spark.createDataFrame([("a", 1, "I", "g")], "k STRING, seq INT, op STRING, g STRING")
    two = spark.createDataFrame([("a", 2, "U", "h", 7)], "k STRING, seq INT, op STRING, g STRING, extra INT")
    st.apply(one, 0)
    st.apply(two, 4)
    st.apply(two, 4)
    assert [(r["seq"], r["g"], r["extra"]) for r in st.visible().collect()] == [(2, "h", 7)]
    with pytest.raises(CheckpointMismatchError):
        st.apply(one, 3)


def test_buckets_may_change(spark):
    st = _state(spark, "log4", buckets=3)
    st.apply(spark.createDataFrame([(f"k{i}", 1, "I", "g", None) for i in range(30)], SCHEMA), 0)
    wider = KeyedLog(spark, st.path, ["k"], ["seq"], "op = 'D'", buckets=7)
    wider.apply(spark.createDataFrame([("k3", 2, "D", "g", None)], SCHEMA), 1)
    assert wider.visible().count() == 29 and max(wider.manifest()[1]) > 2


def test_vacuum_keeps_what_the_newest_manifests_need(spark):
    st = _state(spark, "log5", buckets=2, fan=2)
    for v in range(5):
        st.apply(spark.createDataFrame([(f"k{i}", v, "U", "g", None) for i in range(10)], SCHEMA), v)
    want = sorted(map(tuple, st.visible().select("k", "seq").collect()))
    gone = st.vacuum(retain_manifests=1)
    assert gone and st.vacuum(retain_manifests=1) == []
    assert sorted(map(tuple, st.visible().select("k", "seq").collect())) == want


def test_runs_stay_few_and_rewrites_are_logarithmic():
    runs, rewritten, fan = [], 0, 4
    for i in range(400):
        runs.append((str(i), 100))
        merged = runs_to_merge(runs, fan)
        if merged:
            rows = sum(n for name, n in runs if name in merged)
            rewritten += rows
            runs = [r for r in runs if r[0] not in merged] + [(f"{i}c", rows)]
        assert sum(n for _, n in runs) == 100 * (i + 1) and len(runs) <= 3 * 6
    assert rewritten < 100 * 400 * 6


def test_a_batch_is_prepared_once_and_totals_follow_ties(spark, monkeypatch):
    from lakeingest.streaming.log_state import start_state_stream
    st = _state(spark, "log_once")
    totals = TotalsLog(spark, f"{st.path}-totals", {"g": F.col("g")}, {"v": F.col("v").cast("decimal(38,2)")}, buckets=2)
    made = []
    prepared = st.prepared
    monkeypatch.setattr(st, "prepared", lambda changes: made.append(1) or prepared(changes))
    source = f"{st.path}-changes"
    # Every key comes twice with one sequence number: the state keeps the greater row, whichever came first.
    for b, factor in enumerate((1, -1)):
        (spark.range(40).selectExpr("concat('k', id) AS k", "1 AS seq", "'U' AS op", "concat('g', id % 3) AS g",
                                    f"CAST({factor} * (id - 20) AS DECIMAL(10,2)) AS v").write.parquet(f"{source}/d{b}"))
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source)
        start_state_stream(stream, st, f"{st.path}-checkpoint", [totals]).awaitTermination()
    assert len(made) == 2
    want = {r["g"]: (r["n"], r["v"]) for r in st.visible().groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect()}
    assert {r["g"]: (r["_rows"], r["v"]) for r in totals.visible().collect()} == want
