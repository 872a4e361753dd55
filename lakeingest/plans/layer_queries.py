"""Registered silver and gold queries over the given tables (standing in for bronze)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, silver
from .ingest_queries import EVENTS_COLS, EVENTS_DDL, LINEITEM_COLS, TS_TEXT, files_source
from .lab import Lab
from .registry import register, table

# Plausible ranges of the line-item readings used by range validation.
LINEITEM_RULES = [
    ("discount_range", "l_discount BETWEEN 0.0 AND 0.08"),
    ("tax_range", "l_tax BETWEEN 0.0 AND 0.06"),
    ("quantity_range", "l_quantity BETWEEN 1 AND 45"),
]


@register("cdc_current_state", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) t
WHERE rn = 1 AND event_type <> 'error'""")
def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes keyed by user, ordered by event id; an 'error' change is a delete."""
    events = table(spark, sf_dir, "events")
    return silver.cdc_current_state(events, ["user_id"], ["event_id"], "event_type = 'error'")


@register("range_validation", """
SELECT l_orderkey, l_linenumber, l_partkey,
       concat_ws(',',
         CASE WHEN NOT (l_discount BETWEEN 0.0 AND 0.08) THEN 'discount_range' END,
         CASE WHEN NOT (l_tax BETWEEN 0.0 AND 0.06) THEN 'tax_range' END,
         CASE WHEN NOT (l_quantity BETWEEN 1 AND 45) THEN 'quantity_range' END) AS failed_rules,
       (l_discount BETWEEN 0.0 AND 0.08) AND (l_tax BETWEEN 0.0 AND 0.06) AND (l_quantity BETWEEN 1 AND 45)
         AS is_valid
FROM lineitem""")
def range_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return silver.validate_ranges(lineitem, LINEITEM_RULES).select(
        "l_orderkey", "l_linenumber", "l_partkey", "failed_rules", "is_valid")


@register("quarantine_counts", """
SELECT is_valid, count(*) AS n_rows FROM (
  SELECT (l_discount BETWEEN 0.0 AND 0.08) AND (l_tax BETWEEN 0.0 AND 0.06) AND (l_quantity BETWEEN 1 AND 45)
    AS is_valid FROM lineitem) t
GROUP BY is_valid""")
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, quarantined = silver.split_valid(silver.validate_ranges(table(spark, sf_dir, "lineitem"), LINEITEM_RULES))
    return (valid.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(True).alias("is_valid"), "n_rows")
            .unionByName(quarantined.agg(F.count(F.lit(1)).alias("n_rows"))
                         .select(F.lit(False).alias("is_valid"), "n_rows")))


_LI_ORDER = ", ".join(f"{c} DESC" for c in ["l_shipdate"] + [c for c in LINEITEM_COLS
                                                            if c not in ("l_orderkey", "l_linenumber", "l_shipdate")])


@register("dedup_latest", f"""
SELECT {', '.join(LINEITEM_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_ORDER}) AS rn FROM lineitem) t
WHERE rn = 1""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, line number): the latest shipment, all columns as tie-break."""
    return silver.deduplicate(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("conform_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
       p.p_name, p.p_brand, s.s_name, n.n_name AS supplier_nation
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def conform_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items conformed with part, supplier and supplier nation on business keys."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                                   F.col("n_name").alias("supplier_nation"))
    out = silver.conform(li, [(part, ["l_partkey"]), (supplier, ["l_suppkey"]), (nation, ["s_nationkey"])])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                      "p_name", "p_brand", "s_name", "supplier_nation")


@register("latest_snapshot", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) t
WHERE rn = 1""")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest order of each customer; same-day orders resolved by the order key."""
    orders = table(spark, sf_dir, "orders")
    return silver.latest_snapshot(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@register("sales_by_channel_week", """
SELECT o_orderpriority AS channel, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
       count(*) AS orders, CAST(sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) AS sales
FROM orders GROUP BY 1, 2""")
def sales_by_channel_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sales_by_channel_week(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice")


@register("delivery_time_by_supplier", """
SELECT l_suppkey AS supplier, count(*) AS shipments, count(d) AS delivered,
       count(*) FILTER (WHERE d IS NULL) AS unknown, CAST(sum(d) AS DOUBLE) / count(d) AS mean_days
FROM (SELECT l_suppkey,
             CASE WHEN datediff('day', o_orderdate, l_shipdate) >= 0
                  THEN datediff('day', o_orderdate, l_shipdate) END AS d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
GROUP BY l_suppkey""")
def delivery_time_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from order to shipment per supplier; negative spans count as unknown."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    shipments = li.join(orders, "l_orderkey")
    return gold.delivery_time_by_supplier(shipments, "l_suppkey", "o_orderdate", "l_shipdate")


@register("mean_by_group_day", """
SELECT event_type AS grp, CAST(ts AS DATE) AS day, count(value) AS readings,
       CAST(sum(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) / count(value) AS mean_value,
       min(value) AS min_value, max(value) AS max_value
FROM events GROUP BY 1, 2""")
def mean_by_group_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.mean_by_group_day(table(spark, sf_dir, "events"), "event_type", "ts", "value")


@register("delivery_hours", """
SELECT l_suppkey AS supplier, count(*) AS shipments, count(us) AS delivered, count(*) FILTER (WHERE us IS NULL) AS unknown,
       CAST(sum(us) AS DOUBLE) / 3600000000 / count(us) AS mean_hours
FROM (SELECT l_suppkey, CASE WHEN epoch_us(shipped) >= epoch_us(o_orderdate)
                             THEN epoch_us(shipped) - epoch_us(o_orderdate) END AS us
      FROM (SELECT *, l_shipdate + to_minutes(l_linenumber * 37) AS shipped
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t) t
GROUP BY l_suppkey""")
def delivery_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from order to shipment per supplier (the time of day is made from the line number)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", F.expr("l_shipdate + make_dt_interval(0, 0, l_linenumber * 37, 0)").alias("shipped"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return gold.delivery_time_by_supplier(li.join(orders, "l_orderkey"), "l_suppkey", "o_orderdate", "shipped", unit="hours")


@register("sales_exact", """
SELECT o_orderpriority AS channel, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, count(*) AS orders,
       CAST(CAST(sum(CAST(o_orderkey AS HUGEINT) * 4) AS DECIMAL(38,6)) / 1000000 AS DOUBLE) AS sales
FROM orders GROUP BY 1, 2""")
def sales_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of a few millionths, which a sum at the scale of cents would lose."""
    small = table(spark, sf_dir, "orders").withColumn(
        "amount", (F.col("o_orderkey").cast("decimal(20,0)") * F.lit("0.000004").cast("decimal(7,6)")).cast("double"))
    return gold.sales_by_channel_week(small, "o_orderpriority", "o_orderdate", "amount")


@register("typed_clean", """
SELECT event_id, ts, user_id, event_type,
       TRY_CAST(CASE WHEN event_id % 50 = 0 THEN 'n/a' END AS DOUBLE) AS value_if_broken,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 70 = 0 THEN NULL ELSE ts END AS ts_clean,
       CASE WHEN event_id % 50 = 0 THEN 'n/a' ELSE NULL END AS value_raw_if_broken
FROM events""")
def typed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze kept as text (every 50th value and 70th time broken) typed with try_cast in silver."""
    lab = Lab(spark, "typed")
    events = table(spark, sf_dir, "events")
    text = events.select(
        "event_id", F.col("ts").alias("ts_orig"), "user_id", "event_type",
        F.when(F.col("event_id") % 50 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_id") % 70 == 0, F.lit("never"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts_text"))
    lab.land(text, "events_text", "drop1", "csv", header="true", **TS_TEXT)
    ddl = "event_id STRING, ts_orig STRING, user_id STRING, event_type STRING, value STRING, ts_text STRING"
    ds = lab.dataset("events_text", files_source("csv", "events_text", schema=ddl, options={"header": "true"}))
    lab.run(ds)
    clean = silver.typed_clean(lab.bronze(ds), {"event_id": "bigint", "ts_orig": "timestamp_ntz",
                                                "user_id": "bigint", "value": "double",
                                                "ts_text": "timestamp_ntz"}, keep_raw=True)
    return clean.select(
        "event_id", F.col("ts_orig").alias("ts"), "user_id", "event_type",
        F.when(F.col("value_raw") == "n/a", F.col("value")).alias("value_if_broken"),
        "value", F.col("ts_text").alias("ts_clean"),
        F.when(F.col("value").isNull(), F.col("value_raw")).alias("value_raw_if_broken"))


def _events_in_two_runs(spark: SparkSession, sf_dir: str, label: str, second=None):
    """Bronze events from two drops ingested by two runs; returns the lab, spec and the drops."""
    lab = Lab(spark, label)
    events = table(spark, sf_dir, "events")
    first = events.where("ts < TIMESTAMP '2024-01-16'")
    second = events.where("ts >= TIMESTAMP '2024-01-16'") if second is None else second(events)
    ds = lab.dataset("events", files_source("json", "events", schema=EVENTS_DDL),
                     {"derived_partitions": {"_ingested_date": "to_date(_ingested_at)"},
                      "partition_by": ["_ingested_date"]})
    return lab, ds, first, second


@register("cdc_incremental", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) t
WHERE rn = 1 AND event_type <> 'error'""")
def cdc_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state kept up to date run after run: bronze changes -> bucketed state table."""
    from ..streaming.silver import KeyedState, read_bronze_stream, start_cdc_stream
    from ..streaming.sink import table_path
    lab, ds, first, second = _events_in_two_runs(spark, sf_dir, "cdcinc")
    state = KeyedState(spark, f"{lab.area}/silver/user_state", ["user_id"], ["event_id"],
                       "event_type = 'error'", buckets=16)
    checkpoint = f"{lab.area}/silver/_checkpoints/user_state"
    for drop, rows in (("d1", first), ("d2", second)):
        lab.land(rows, "events", drop, "json", **TS_TEXT)
        lab.run(ds)
        changes = read_bronze_stream(spark, table_path(ds, lab.engine)).select(*EVENTS_COLS)
        start_cdc_stream(changes, state, checkpoint).awaitTermination()
    return state.visible().select(*EVENTS_COLS)


@register("cdc_rebucketed", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) t
WHERE rn = 1 AND event_type <> 'error'""")
def cdc_rebucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state is opened with another bucket count between two runs."""
    from ..streaming.silver import KeyedState, read_bronze_stream, start_cdc_stream
    from ..streaming.sink import table_path
    lab, ds, first, second = _events_in_two_runs(spark, sf_dir, "cdcbuckets")
    checkpoint = f"{lab.area}/silver/_checkpoints/user_state"
    for drop, rows, buckets in (("d1", first, 16), ("d2", second, 6)):
        state = KeyedState(spark, f"{lab.area}/silver/user_state", ["user_id"], ["event_id"], "event_type = 'error'",
                           buckets=buckets)
        lab.land(rows, "events", drop, "json", **TS_TEXT)
        lab.run(ds)
        changes = read_bronze_stream(spark, table_path(ds, lab.engine)).select(*EVENTS_COLS)
        start_cdc_stream(changes, state, checkpoint).awaitTermination()
    return state.visible().select(*EVENTS_COLS)


@register("dedup_stream", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice (the copy in a later drop): silver keeps each event once."""
    from ..streaming.silver import (dedup_stream as dedup, default_state_partitions, read_bronze_stream,
                                    start_table_stream)
    from ..streaming.sink import table_path
    lab, ds, first, second = _events_in_two_runs(spark, sf_dir, "dedup", second=lambda e: e)
    target, checkpoint = f"{lab.area}/silver/events", f"{lab.area}/silver/_checkpoints/events"
    for drop, rows in (("d1", first), ("d2", second)):
        lab.land(rows, "events", drop, "json", **TS_TEXT)
        lab.run(ds)
        bronze = read_bronze_stream(spark, table_path(ds, lab.engine)).select(*EVENTS_COLS)
        start_table_stream(dedup(bronze, ["event_id"], "ts", "365 days"), target, checkpoint,
                           state_partitions=default_state_partitions(spark)).awaitTermination()
    return spark.read.parquet(target).select(*EVENTS_COLS)
