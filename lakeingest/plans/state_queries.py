"""Registered queries over state tables kept as runs, aggregates that follow them, and the two-table validation stream."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.log_state import KeyedLog, TotalsLog, start_state_stream
from ..streaming.silver import read_bronze_stream, start_validated_stream
from ..streaming.sink import read_table, table_path
from .ingest_queries import EVENTS_COLS, EVENTS_DDL, files_source
from .lab import Lab
from .registry import register, table

BATCHES = 10


def _changes(orders: DataFrame, batch: int) -> DataFrame:
    """Changes of one delivery: inserts of a tenth of the orders, and updates and deletes of earlier ones.

    Order o is inserted by delivery o % 10; every later delivery b with (o + b) % 4 = 0 updates it (amount + b), and with
    (o + b) % 23 = 0 deletes it. Later deliveries therefore revive deleted orders, too.
    """
    first = F.col("o_orderkey") % BATCHES
    update, delete = (F.col("o_orderkey") + batch) % 4 == 0, (F.col("o_orderkey") + batch) % 23 == 0
    return (orders.where((first == batch) | ((first < batch) & (update | delete)))
            .select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
                    (F.col("o_totalprice").cast("decimal(20,2)") + batch).alias("amount"), F.lit(batch).alias("seq"),
                    F.when(first == batch, F.lit("I")).when(delete, F.lit("D")).otherwise(F.lit("U")).alias("op")))


_STATE_SQL = f"""
WITH c AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, CAST(o_totalprice AS DECIMAL(20,2)) + b AS amount, b AS seq,
         CASE WHEN o_orderkey % {BATCHES} = b THEN 'I' WHEN (o_orderkey + b) % 23 = 0 THEN 'D' ELSE 'U' END AS op
  FROM orders, range({BATCHES}) r(b)
  WHERE o_orderkey % {BATCHES} = b
     OR (o_orderkey % {BATCHES} < b AND ((o_orderkey + b) % 4 = 0 OR (o_orderkey + b) % 23 = 0))),
s AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1)
"""


def _run_state(spark: SparkSession, sf_dir: str, label: str, with_totals: bool) -> tuple[KeyedLog, TotalsLog | None]:
    """Ten deliveries, each streamed into the state as a version; the last batch is replayed."""
    from ..session import delete_path, list_names
    lab = Lab(spark, label)
    orders = table(spark, sf_dir, "orders")
    state = KeyedLog(spark, f"{lab.area}/state", ["o_orderkey"], ["seq"], "op = 'D'", buckets=8)
    totals = None
    if with_totals:
        totals = TotalsLog(spark, f"{lab.area}/totals", buckets=2, groups={
            "channel": F.col("o_orderpriority"), "week": F.date_trunc("week", F.col("o_orderdate")).cast("date")},
            measures={"sales": F.col("amount").cast("decimal(38,2)")})
    source, checkpoint = f"{lab.area}/changes", f"{lab.area}/checkpoint"
    schema = _changes(orders, 0).schema
    for b in range(BATCHES):
        _changes(orders, b).coalesce(4).write.parquet(f"{source}/d{b}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        start_state_stream(stream, state, checkpoint, [totals] if totals else []).awaitTermination()
    newest = max(int(n) for n in list_names(spark, f"{checkpoint}/commits") if n.isdigit())
    delete_path(spark, f"{checkpoint}/commits/{newest}")
    delete_path(spark, f"{checkpoint}/commits/.{newest}.crc")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
    start_state_stream(stream, state, checkpoint, [totals] if totals else []).awaitTermination()
    return state, totals


@register("cdc_log_structured", _STATE_SQL + """
SELECT o_orderkey, o_orderstatus, CAST(amount AS DOUBLE) AS amount, seq, op FROM s WHERE op <> 'D'""")
def cdc_log_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state after ten batches of inserts, updates and deletes, kept as runs, and a replay of the last batch."""
    state, _ = _run_state(spark, sf_dir, "logstate", with_totals=False)
    return state.visible().select("o_orderkey", "o_orderstatus", F.col("amount").cast("double").alias("amount"), "seq", "op")


@register("sales_incremental", _STATE_SQL + """
SELECT o_orderpriority AS channel, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, count(*) AS orders,
       CAST(sum(amount) AS DOUBLE) AS sales
FROM s WHERE op <> 'D' GROUP BY 1, 2""")
def sales_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and sales per channel and week, folded from signed changes batch by batch; never recomputed."""
    _, totals = _run_state(spark, sf_dir, "logsales", with_totals=True)
    return totals.visible().select("channel", "week", F.col("_rows").alias("orders"), F.col("sales").cast("double").alias("sales"))


@register("validated_stream", """
SELECT event_id, CASE WHEN value > 400 AND user_id % 7 = 0 THEN 'value_range,user' WHEN value > 400 THEN 'value_range'
                      WHEN user_id % 7 = 0 THEN 'user' ELSE '' END AS failed_rules,
       CASE WHEN coalesce(value > 400, FALSE) OR user_id % 7 = 0 THEN 'quarantine' ELSE 'valid' END AS in_table
FROM events""")
def validated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events into a valid and a quarantine table in one pass; the second batch dies half-way and is run again."""
    from ..session import delete_path
    lab = Lab(spark, "validated")
    events = table(spark, sf_dir, "events")
    ds = lab.dataset("events", files_source("parquet", "events", schema=EVENTS_DDL))
    valid, quarantine, checkpoint = (f"{lab.area}/silver/{n}" for n in ("valid", "quarantine", "checkpoint"))
    rules = [("value_range", f"value <= {Decimal(400)}"), ("user", "user_id % 7 <> 0")]
    for drop, part in (("d1", events.where("event_id % 2 = 0")), ("d2", events.where("event_id % 2 = 1"))):
        lab.land(part, "events", drop, "parquet")
        lab.run(ds)
        bronze = read_bronze_stream(spark, table_path(ds, lab.engine)).select(*EVENTS_COLS)
        start_validated_stream(bronze, rules, valid, quarantine, checkpoint).awaitTermination()
    for path in (f"{checkpoint}/commits/1", f"{checkpoint}/commits/.1.crc", f"{quarantine}/_batch=1"):
        delete_path(spark, path)
    bronze = read_bronze_stream(spark, table_path(ds, lab.engine)).select(*EVENTS_COLS)
    start_validated_stream(bronze, rules, valid, quarantine, checkpoint).awaitTermination()
    good = read_table(spark, valid).select("event_id", F.lit("").alias("failed_rules"), F.lit("valid").alias("in_table"))
    return good.unionByName(read_table(spark, quarantine).select("event_id", "failed_rules", F.lit("quarantine").alias("in_table")))


@register("mean_of_odd_values", """
SELECT event_type AS grp, count(*) AS readings,
       CASE event_type WHEN (SELECT min(event_type) FROM events) THEN CAST('nan' AS DOUBLE) ELSE 2e-14 END AS mean_value
FROM events GROUP BY event_type""")
def mean_of_odd_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a hundred-billionth of a unit, and a group in which some are NaN: neither vanishes from the mean."""
    from ..operators import gold
    events = table(spark, sf_dir, "events")
    first = events.agg(F.min("event_type")).first()[0]
    odd = (F.col("event_type") == F.lit(first)) & (F.col("event_id") % 2 == 0)
    rows = events.select("event_type", F.when(odd, F.lit(float("nan"))).otherwise(F.lit(2e-14)).alias("value"),
                         F.lit("2026-01-01").alias("ts"))
    means = gold.mean_by_group_day(rows, "event_type", "ts", "value")
    return means.select("grp", "readings", F.when(F.isnan("mean_value"), F.col("mean_value")).otherwise(
        F.round(F.col("mean_value") * 1e20) / 1e20).alias("mean_value"))
