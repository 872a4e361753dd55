"""Silver/gold operators against brute force in plain Python on small fixtures."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from lakeingest.operators import gold, silver
from lakeingest.streaming.audit import audit_history, run_report, run_summary


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def test_latest_per_key_matches_brute_force_with_ties(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 5), rnd.randint(0, 3), rnd.choice("abc"), rnd.random()) for _ in range(300)]
    df = spark.createDataFrame(data, "k INT, seq INT, tag STRING, x DOUBLE")
    got = _rows(silver.latest_per_key(df, ["k"], ["seq"]), ["k", "seq", "tag", "x"])
    best = {}
    for row in data:
        if row[0] not in best or (row[1], row[2], row[3]) > (best[row[0]][1], best[row[0]][2], best[row[0]][3]):
            best[row[0]] = row
    assert got == sorted(best.values(), key=lambda t: tuple((v is None, v) for v in t))


def test_latest_per_key_on_a_hot_key(spark):
    # One key holds a third of the rows: still one row, the maximum.
    df = spark.range(30000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                   F.col("id").alias("seq"))
    out = silver.latest_per_key(df, ["k"], ["seq"])
    assert out.count() == 20001
    assert out.where("k = 0").first()["seq"] == 29997


def test_cdc_deletes_hide_the_key(spark):
    changes = spark.createDataFrame([
        ("o1", 1, "I", 10.0), ("o1", 2, "U", 12.0),
        ("o2", 1, "I", 5.0), ("o2", 2, "D", None),
        ("o3", 1, "I", 7.0), ("o3", 2, "D", None), ("o3", 3, "I", 8.0),
    ], "order_id STRING, seq INT, op STRING, amount DOUBLE")
    out = silver.cdc_current_state(changes, ["order_id"], ["seq"], "op = 'D'")
    assert _rows(out, ["order_id", "seq", "amount"]) == [("o1", 2, 12.0), ("o3", 3, 8.0)]


def test_validate_ranges_null_is_not_a_violation(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None), (4, 500.0)], "id INT, v DOUBLE")
    out = silver.validate_ranges(df, [("non_negative", "v >= 0"), ("below_100", "v < 100")])
    got = _rows(out, ["id", "failed_rules", "is_valid"])
    assert got == [(1, "", True), (2, "non_negative", False), (3, "", True), (4, "below_100", False)]
    valid, quarantined = silver.split_valid(out)
    assert valid.count() + quarantined.count() == 4


def test_deduplicate_keeps_one_row_per_key(spark, small_dir):
    li = spark.read.parquet(f"{small_dir}/lineitem.parquet")
    out = silver.deduplicate(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    assert out.count() == li.select("l_orderkey", "l_linenumber").distinct().count()
    assert out.columns == li.columns


def test_conform_keeps_facts_without_dimension(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "zz")], "id INT, sku STRING")
    dim = spark.createDataFrame([("a", "apple")], "sku STRING, name STRING")
    assert sorted(_rows(silver.conform(fact, [(dim, ["sku"])]), ["id", "name"])) == [(1, "apple"), (2, None)]


def test_typed_clean_keeps_raw_text(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "n/a")], "a STRING, b STRING")
    out = silver.typed_clean(df, {"a": "int", "b": "double"}, keep_raw=True)
    assert out.columns == ["a", "a_raw", "b", "b_raw"]
    assert _rows(out, ["a", "a_raw", "b", "b_raw"]) == [(1, "1", 2.5, "2.5"), (None, "x", None, "n/a")]


def test_path_columns_decode_folder_values(spark):
    df = spark.createDataFrame([("file:/l/field=NORTH%20A/2026-04-02/crop_0001.png",)], "p STRING")
    out = silver.path_columns(df, "p", {"field": (r"field=([^/]+)/", "string"),
                                        "day": (r"/(\d{4}-\d{2}-\d{2})/", "date")})
    r = out.first()
    assert r["field"] == "NORTH A" and r["day"] == dt.date(2026, 4, 2)


def test_sales_by_week_is_exact(spark):
    df = spark.createDataFrame([("web", dt.datetime(2024, 1, 3), 0.1), ("web", dt.datetime(2024, 1, 7), 0.2),
                                ("web", dt.datetime(2024, 1, 8), 1.0)], "ch STRING, ts TIMESTAMP, amt DOUBLE")
    got = _rows(gold.sales_by_channel_week(df, "ch", "ts", "amt"), ["channel", "week", "orders", "sales"])
    assert got == [("web", dt.date(2024, 1, 1), 2, 0.3), ("web", dt.date(2024, 1, 8), 1, 1.0)]


def test_delivery_time_excludes_negative_and_missing(spark):
    df = spark.createDataFrame([("s1", dt.date(2024, 1, 1), dt.date(2024, 1, 3)),
                                ("s1", dt.date(2024, 1, 5), dt.date(2024, 1, 1)),
                                ("s1", dt.date(2024, 1, 1), None)], "sup STRING, a DATE, b DATE")
    r = gold.delivery_time_by_supplier(df, "sup", "a", "b").first()
    assert (r["shipments"], r["delivered"], r["unknown"], r["mean_days"]) == (3, 1, 2, 2.0)


def test_mean_by_group_day(spark):
    df = spark.createDataFrame([("f1", dt.datetime(2024, 1, 1, 1), 10.0), ("f1", dt.datetime(2024, 1, 1, 5), 20.0),
                                ("f1", dt.datetime(2024, 1, 2), None)], "g STRING, ts TIMESTAMP, v DOUBLE")
    got = _rows(gold.mean_by_group_day(df, "g", "ts", "v"), ["grp", "day", "readings", "mean_value"])
    assert got == [("f1", dt.date(2024, 1, 1), 2, 15.0), ("f1", dt.date(2024, 1, 2), 0, None)]


def test_as_of_cut(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))],
                               "id INT, _ingested_at TIMESTAMP")
    assert [r["id"] for r in gold.as_of(df, dt.datetime(2024, 1, 1, 12)).collect()] == [1]


def test_audit_reports(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [("r1", "d", "a", "csv", "/p", t0, t0 + dt.timedelta(seconds=2.26), 10, "OK", ""),
            ("r1", "d", "b", "json", "/p", t0, t0 + dt.timedelta(seconds=1), 0, "ERROR", "Boom: x"),
            ("r1", "d", "c", "kafka", "/p", t0, t0, 0, "RUNNING", ""),
            ("r2", "d", "a", "csv", "/p", t0 + dt.timedelta(hours=1), t0 + dt.timedelta(hours=1, seconds=3), 5, "OK", "")]
    from lakeingest.streaming.catalog import AUDIT_SCHEMA
    audit = spark.createDataFrame(rows, AUDIT_SCHEMA)
    s = {r["run_id"]: r for r in run_summary(audit).collect()}
    assert (s["r1"]["ok"], s["r1"]["errors"], s["r1"]["running"], s["r1"]["rows_ok"]) == (1, 1, 1, 10)
    assert s["r1"]["failures"] == ["d.b -> Boom: x"]
    report = {r["dataset"]: r for r in run_report(audit.where("run_id = 'r1'")).collect()}
    assert report["d.a"]["seconds"] == 2.3
    hist = audit_history(audit).collect()
    assert hist[0]["run_id"] == "r2" and hist[0]["seconds"] == 3


def test_exact_sum_is_order_independent(spark):
    vals = [0.1] * 10 + [1e-3] * 7
    df = spark.createDataFrame([(v,) for v in vals], "v DOUBLE")
    a = df.repartition(1).agg(gold.exact_sum(F.col("v"))).first()[0]
    b = df.repartition(7).agg(gold.exact_sum(F.col("v"))).first()[0]
    assert a == b == float(sum(Decimal(str(v)) for v in vals))


def test_sums_do_not_round(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("v"), F.lit("a").alias("g"), F.lit(dt.datetime(2024, 1, 1)).alias("t"))
    assert gold.sales_by_channel_week(df, "g", "t", "v").first()["sales"] == 4.0
    assert gold.mean_by_group_day(df, "g", "t", "v").first()["mean_value"] == 0.004
    money = spark.createDataFrame([(Decimal("1e20"),), (Decimal("0.5"),)], "v decimal(38,2)")
    assert money.agg(gold.exact_sum(F.col("v"), None)).first()[0] == 1e20


def test_delivery_hours(spark):
    t = dt.datetime(2024, 1, 1, 23)
    rows = [("s", t, t + dt.timedelta(hours=2)), ("s", t, t + dt.timedelta(minutes=30)), ("s", t, None), ("s", t, t - dt.timedelta(hours=1))]
    df = spark.createDataFrame(rows, "s string, a timestamp, b timestamp")
    r = gold.delivery_time_by_supplier(df, "s", "a", "b", unit="hours").first()
    assert (r.shipments, r.delivered, r.unknown, r.mean_hours) == (4, 2, 2, 1.25)


def test_duplicate_dimension_keys_do_not_multiply_facts(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("x", 1), ("x", 2)], "k string, d int")
    assert sorted((r.id, r.d) for r in silver.conform(fact, [(dim, ["k"])]).collect() if r.d) == [(1, 2)]
    assert silver.conform(fact, [(dim, ["k"])]).count() == 3
