"""Stateful silver streams: keyed state table and streaming de-duplication."""

from lakeingest.session import new_area
from lakeingest.streaming.silver import KeyedState


def _state(spark, label):
    return KeyedState(spark, f"{new_area(spark, label)}/state", ["k"], ["seq"], "op = 'D'", buckets=4)


def _visible(state):
    return sorted((r["k"], r["seq"], r["v"]) for r in state.visible().collect())


def test_changes_merge_across_versions(spark):
    st = _state(spark, "ks1")
    st.apply(spark.createDataFrame([("a", 1, "I", 1.0), ("b", 1, "I", 2.0), ("c", 1, "I", 3.0)],
                                   "k STRING, seq INT, op STRING, v DOUBLE"), 0)
    st.apply(spark.createDataFrame([("a", 2, "U", 10.0), ("b", 2, "D", None)],
                                   "k STRING, seq INT, op STRING, v DOUBLE"), 1)
    assert _visible(st) == [("a", 2, 10.0), ("c", 1, 3.0)]


def test_late_older_change_does_not_resurrect_a_delete(spark):
    st = _state(spark, "ks2")
    st.apply(spark.createDataFrame([("a", 5, "D", None)], "k STRING, seq INT, op STRING, v DOUBLE"), 0)
    st.apply(spark.createDataFrame([("a", 3, "U", 7.0)], "k STRING, seq INT, op STRING, v DOUBLE"), 1)
    assert _visible(st) == []


def test_replayed_version_is_harmless(spark):
    st = _state(spark, "ks3")
    first = spark.createDataFrame([("a", 1, "I", 1.0)], "k STRING, seq INT, op STRING, v DOUBLE")
    second = spark.createDataFrame([("a", 2, "U", 2.0), ("z", 1, "I", 9.0)], "k STRING, seq INT, op STRING, v DOUBLE")
    st.apply(first, 0)
    st.apply(second, 1)
    st.apply(second, 1)  # the same micro-batch again after a failure
    assert _visible(st) == [("a", 2, 2.0), ("z", 1, 9.0)]
    assert st.current().count() == 2


def test_untouched_buckets_keep_their_version(spark):
    st = _state(spark, "ks4")
    rows = [(f"k{i}", 1, "I", float(i)) for i in range(40)]
    st.apply(spark.createDataFrame(rows, "k STRING, seq INT, op STRING, v DOUBLE"), 0)
    st.apply(spark.createDataFrame([("k1", 2, "U", -1.0)], "k STRING, seq INT, op STRING, v DOUBLE"), 1)
    _, manifest = st._manifest()
    assert sorted(set(manifest.values())) == [0, 1]
    assert list(manifest.values()).count(1) == 1
    assert len(_visible(st)) == 40


def test_dedup_stream_with_a_hot_key(spark):
    from pyspark.sql import functions as F

    from lakeingest.streaming.silver import dedup_stream, start_table_stream
    area = new_area(spark, "hotdedup")
    hot = spark.range(20000).select(F.lit(7).cast("long").alias("k"), F.lit("x").alias("payload"),
                                    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))
    rest = spark.range(500).select((F.col("id") + 100).alias("k"), F.lit("y").alias("payload"),
                                   F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))
    hot.unionByName(rest).repartition(5).write.parquet(f"{area}/in")
    stream = spark.readStream.schema("k BIGINT, payload STRING, ts TIMESTAMP_NTZ").parquet(f"{area}/in")
    q = start_table_stream(dedup_stream(stream, ["k"], "ts", "1 day", spread_hot_keys=True), f"{area}/out", f"{area}/ck")
    q.awaitTermination()
    out = spark.read.parquet(f"{area}/out")
    assert out.count() == 501 and out.where("k = 7").count() == 1
    assert [op.operatorName for op in q.lastProgress.stateOperators].count("dedupeWithinWatermark") == 2


def test_retention_lists_only_superseded_folders(spark):
    st = _state(spark, "ks_vac")
    schema = "k STRING, seq INT, op STRING, v DOUBLE"
    st.apply(spark.createDataFrame([(f"k{i}", 1, "I", 1.0) for i in range(20)], schema), 0)
    st.apply(spark.createDataFrame([("k1", 2, "U", 2.0)], schema), 1)
    st.apply(spark.createDataFrame([("k1", 3, "U", 3.0)], schema), 2)
    _, latest = st._manifest()
    bucket_k1 = next(b for b, v in latest.items() if v == 2)
    obsolete = st.vacuum(retain_manifests=1, dry_run=True)
    # k1's bucket at versions 0 and 1 is superseded; other buckets at version 0 stay live.
    assert f"{st.path}/data/_version=0/_bucket={bucket_k1}" in obsolete
    assert f"{st.path}/data/_version=1/_bucket={bucket_k1}" in obsolete
    assert not any(f"_version=0/_bucket={b}" in p for b, v in latest.items() if v == 0 for p in obsolete)
    assert f"{st.path}/_staging/_version=2" not in obsolete and f"{st.path}/_staging/_version=0" in obsolete
    assert f"{st.path}/_manifest/{0:012d}.json" in obsolete and f"{st.path}/_manifest/{2:012d}.json" not in obsolete
    assert _visible(st)[1] == ("k1", 3, 3.0) or ("k1", 3, 3.0) in _visible(st)


def test_state_refuses_versions_from_a_reset_checkpoint(spark):
    import pytest

    from lakeingest.streaming.sink import CheckpointMismatchError
    st = _state(spark, "ks_reset")
    schema = "k STRING, seq INT, op STRING, v DOUBLE"
    st.apply(spark.createDataFrame([("a", 1, "I", 1.0)], schema), 0)
    st.apply(spark.createDataFrame([("b", 1, "I", 2.0)], schema), 1)
    with pytest.raises(CheckpointMismatchError):
        st.apply(spark.createDataFrame([("c", 1, "I", 3.0)], schema), 0)
    assert _visible(st) == [("a", 1, 1.0), ("b", 1, 2.0)]


def test_bronze_stream_uses_the_recorded_schema(spark, small_dir):
    from pyspark.sql import functions as F

    from lakeingest.plans.ingest_queries import files_source
    from lakeingest.plans.lab import Lab
    from lakeingest.streaming.silver import read_bronze_stream, start_table_stream
    from lakeingest.streaming.sink import table_path, table_schema
    lab = Lab(spark, "t_bronze_schema")
    o = spark.read.parquet(f"{small_dir}/orders.parquet")
    ds = lab.dataset("o", files_source("parquet", "o"))
    lab.land(o.limit(10), "o", "d1", "parquet")
    lab.run(ds)
    lab.land(o.limit(4).withColumn("channel", F.lit("web")), "o", "d2", "parquet")
    lab.run(ds)
    path = table_path(ds, lab.engine)
    assert "channel" in table_schema(spark, path).fieldNames()
    out = f"{lab.area}/silver"
    start_table_stream(read_bronze_stream(spark, path), out, f"{lab.area}/ck").awaitTermination()
    silver = spark.read.parquet(out)
    assert silver.count() == 14 and silver.where("channel = 'web'").count() == 4
