"""Registered ingestion queries about what a micro-batch sees: late files, types that disagree, nested fields, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.schema import resolve_schema
from .ingest_queries import BY_DAY, ORDERS_COLS, files_source
from .lab import Lab
from .message_queries import envelope
from .registry import register, table

OLD, NEW = "o_orderdate < TIMESTAMP '1998-01-01'", "o_orderdate >= TIMESTAMP '1998-01-01'"
_CHANNEL = f"""
SELECT o_orderkey, CASE WHEN {NEW} THEN 'web' END AS channel, CAST(NULL AS VARCHAR) AS _rescued_data FROM orders"""


@register("late_file_new_column", _CHANNEL)
def late_file_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a new column land after the run has started its query (between two of its micro-batches)."""
    from ..sources import read_source
    from ..streaming.sink import start_bronze_stream
    lab = Lab(spark, "late")
    orders = table(spark, sf_dir, "orders")
    lab.land(orders.where(OLD), "orders", "d1", "parquet")
    ds = lab.dataset("orders", files_source("parquet", "orders"), BY_DAY)
    lab.run(ds)
    lab.land(orders.where(OLD).limit(0), "orders", "d2", "parquet")
    stream, rows_of = read_source(spark, ds, lab.engine)        # the run has made its preparations
    lab.land(orders.where(NEW).withColumn("channel", F.lit("web")), "orders", "d3", "parquet")
    query, _ = start_bronze_stream(spark, ds, lab.engine, stream, rows_of)
    query.awaitTermination()
    return lab.bronze(ds).select("o_orderkey", "channel", "_rescued_data")


@register("continuous_new_column", _CHANNEL)
def continuous_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column appears while a continuous query is running; the query is not restarted."""
    lab = Lab(spark, "contnew")
    orders = table(spark, sf_dir, "orders")
    lab.land(orders.where(OLD), "orders", "d1", "parquet")
    ds = lab.dataset("orders", files_source("parquet", "orders"), {**BY_DAY, "trigger": {"processing_time": "1 second"}})
    lab.run(ds)
    query = next(q for q in spark.streams.active if q.name == ds.name)
    query.processAllAvailable()
    lab.land(orders.where(NEW).withColumn("channel", F.lit("web")), "orders", "d2", "parquet")
    query.processAllAvailable()
    query.stop()
    return lab.bronze(ds).select("o_orderkey", "channel", "_rescued_data")


@register("same_time_files", _CHANNEL)
def same_time_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a later drop carry the very modification times of the files read before."""
    lab = Lab(spark, "sametime")
    orders = table(spark, sf_dir, "orders")
    ds = lab.dataset("orders", files_source("parquet", "orders"), BY_DAY)
    first = lab.land(orders.where(OLD), "orders", "d1", "parquet")
    lab.set_times(first, 1_700_000_000_000)
    lab.run(ds)
    second = lab.land(orders.where(NEW).withColumn("channel", F.lit("web")), "orders", "d2", "parquet")
    lab.set_times(second, 1_700_000_000_000)
    lab.run(ds)
    return lab.bronze(ds).select("o_orderkey", "channel", "_rescued_data")


@register("equals_in_names", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'year=2026' WHEN o_orderkey % 3 = 1 THEN '2026' ELSE 'export_q=1' END AS part,
       CASE WHEN o_orderkey % 3 = 0 THEN 2026 END AS year
FROM orders""")
def equals_in_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops in a ``key=value`` folder, in plain nested folders and in one with "=" in a file's name, side by side.

    The key of the folder is a column of its files; the others have none.
    """
    lab = Lab(spark, "equals")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    for rest, drop in ((0, "year=2026"), (1, "2026/09/01"), (2, "plain")):
        lab.land(orders.where(F.col("o_orderkey") % 3 == rest), "orders", drop, "parquet")
    lab.rename_files("orders/plain", "orders/d3", "export_q=1-")
    ds = lab.dataset("orders", files_source("parquet", "orders"))
    lab.run(ds)
    part = F.regexp_extract("_ingested_filepath", r"/orders/(?:d3/)?(year=2026|2026|export_q=1)", 1)
    return lab.bronze(ds).select("o_orderkey", part.alias("part"), "year")


@register("parquet_type_conflict", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 3 = 1 THEN 'c-' || o_custkey END AS rescued, 'OK' AS status
FROM orders""")
def parquet_type_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over files in which a column is BIGINT, INT, or text (numbers in some, other words in others)."""
    lab = Lab(spark, "conflict")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    key = F.col("o_orderkey") % 3
    lab.land(orders.where(key == 0), "orders", "d0", "parquet")
    lab.land(orders.where(key == 1).withColumn("o_custkey", F.concat(F.lit("c-"), "o_custkey")), "orders", "d1", "parquet")
    lab.land(orders.where((key == 2) & (F.col("o_custkey") % 2 == 0)).withColumn("o_custkey", F.col("o_custkey").cast("string")),
             "orders", "d2", "parquet")
    lab.land(orders.where((key == 2) & (F.col("o_custkey") % 2 != 0)).withColumn("o_custkey", F.col("o_custkey").cast("int")),
             "orders", "d3", "parquet")
    ds = lab.dataset("orders", files_source("parquet", "orders"))
    result = lab.run(ds)[0]
    return lab.bronze(ds).select("o_orderkey", "o_custkey", F.get_json_object("_rescued_data", "$.o_custkey").alias("rescued"),
                                 F.lit(result.status).alias("status"))


_CUSTOMER = "STRUCT<id: BIGINT, tags: ARRAY<STRUCT<k: STRING>>>"


def _order_struct(extra: bool) -> F.Column:
    """A customer with tags; with ``extra`` the customer has a segment, and each tag a weight, that nobody declared."""
    def tag(name: str):
        fields = [F.lit(name).alias("k")] + ([(F.col("o_orderkey") % 7).alias("w")] if extra else [])
        return F.struct(*fields)
    fields = [F.col("o_custkey").alias("id"), F.array(tag("x"), tag("y")).alias("tags")]
    return F.struct(*fields, *([F.struct(F.col("o_orderpriority").alias("name")).alias("segment")] if extra else []))


_NESTED_SQL = """
SELECT o_orderkey, o_custkey AS customer_id, 'y' AS second_tag,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 7 AS VARCHAR) END AS w0,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 7 AS VARCHAR) END AS w1,
       CASE WHEN o_orderkey % 2 = 0 THEN '{"name":"' || o_orderpriority || '"}' END AS segment,
       CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 0 END AS n_rescued
FROM orders"""


def _nested_result(rows: DataFrame, customer: str, rescued: str, keys: str = "o_orderkey", at: str = "customer") -> DataFrame:
    found = F.from_json(rescued, "map<string,string>")

    def by_path(path: str) -> F.Column:
        return F.try_element_at(found, F.lit(f"{at}{path}"))
    return rows.select(F.col(keys).alias("o_orderkey"), F.col(f"{customer}.id").alias("customer_id"),
                       F.col(f"{customer}.tags")[1]["k"].alias("second_tag"), by_path(".tags[0].w").alias("w0"),
                       by_path(".tags[1].w").alias("w1"), by_path(".segment").alias("segment"),
                       F.coalesce(F.size(F.map_keys(found)), F.lit(0)).alias("n_rescued")).withColumn(
                           "n_rescued", F.when(F.col("n_rescued") < 0, 0).otherwise(F.col("n_rescued")))


@register("rescue_json_nested", _NESTED_SQL)
def rescue_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared fields inside a declared struct and inside the elements of its array, rescued by path."""
    lab = Lab(spark, "nestedjson")
    orders = table(spark, sf_dir, "orders")
    for rest in (0, 1):
        lab.land(orders.where(F.col("o_orderkey") % 2 == rest).select("o_orderkey", _order_struct(rest == 0).alias("customer")),
                 "orders", f"d{rest}", "json")
    ds = lab.dataset("orders", files_source("json", "orders", schema=f"o_orderkey BIGINT, customer {_CUSTOMER}"))
    lab.run(ds)
    return _nested_result(lab.bronze(ds), "customer", "_rescued_data")


@register("message_nested", _NESTED_SQL)
def message_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fields inside JSON messages: named by path in ``_rescued_value``, beside the bytes."""
    lab = Lab(spark, "nestedmsg")
    orders = table(spark, sf_dir, "orders")
    body = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct("o_orderkey", _order_struct(True).alias("customer")))).otherwise(
        F.to_json(F.struct("o_orderkey", _order_struct(False).alias("customer"))))
    rows = orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("event_id"),
                         F.lit("orders").alias("event_type"), F.col("o_orderdate").alias("ts"), F.encode(body, "UTF-8").alias("body"))
    envelope(rows, F.col("body")).write.parquet(f"{lab.engine.landing_root}/topics/d1")
    ds = lab.dataset("messages", {"type": "kafka", "envelope_path": "{landing}/topics", "subscribe": "app.events.orders",
                                  "value_format": "json", "value_json_schema": f"o_orderkey BIGINT, customer {_CUSTOMER}",
                                  "options": {"recursiveFileLookup": "true"}})
    lab.run(ds)
    rows = lab.bronze(ds).where((F.col("_raw_value").isNotNull()) == (F.col("value.o_orderkey") % 2 == 0))
    return _nested_result(rows, "value.customer", "_rescued_value", "value.o_orderkey")


@register("parquet_nested_rescue", _NESTED_SQL)
def parquet_nested_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet structs with more fields than the declared ones: the rest by path, whatever file it came in."""
    lab = Lab(spark, "nestedpq")
    orders = table(spark, sf_dir, "orders")
    for rest in (0, 1):
        lab.land(orders.where(F.col("o_orderkey") % 2 == rest).select("o_orderkey", _order_struct(rest == 0).alias("customer")),
                 "orders", f"d{rest}", "parquet")
    ds = lab.dataset("orders", files_source("parquet", "orders", schema=f"o_orderkey BIGINT, customer {_CUSTOMER}"))
    lab.run(ds)
    return _nested_result(lab.bronze(ds), "customer", "_rescued_data")


@register("parquet_nested_growth", """
SELECT o_orderkey, o_custkey AS customer_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS segment_name,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 7 END AS second_weight, CAST(NULL AS VARCHAR) AS _rescued_data
FROM orders""")
def parquet_nested_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that appear inside a struct, and inside the elements of its array, grow the table's column."""
    lab = Lab(spark, "nestedgrow", register_tables=True)
    orders = table(spark, sf_dir, "orders")
    ds = lab.dataset("orders", files_source("parquet", "orders"), BY_DAY)
    for drop, rest in (("d1", 1), ("d2", 0)):
        lab.land(orders.where(F.col("o_orderkey") % 2 == rest).select("o_orderkey", _order_struct(rest == 0).alias("customer")),
                 "orders", drop, "parquet")
        lab.run(ds)
    from ..streaming.catalog import bronze_table_name
    rows = spark.table(bronze_table_name(spark, lab.engine, ds))
    return rows.select("o_orderkey", F.col("customer.id").alias("customer_id"), F.col("customer.segment.name").alias("segment_name"),
                       F.col("customer.tags")[1]["w"].alias("second_weight"), "_rescued_data")


@register("many_small_batches", """
SELECT 'r1' AS run_id, count(*) AS rows_ingested, count(*) AS bronze_rows, 12 AS batches FROM orders""")
def many_small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More micro-batches than the session keeps progress entries of: every row is counted."""
    lab = Lab(spark, "batches")
    lab.land(table(spark, sf_dir, "orders").repartition(12, "o_orderkey"), "orders", "d1", "parquet")
    ds = lab.dataset("orders", files_source("parquet", "orders", options={"maxFilesPerTrigger": "1"}))
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        lab.run(ds, run_id="r1")
    finally:
        spark.conf.set(key, before)
    from ..streaming.sink import BATCH, read_table, table_path
    rows, batches = read_table(spark, table_path(ds, lab.engine)).agg(F.count(F.lit(1)), F.countDistinct(BATCH)).first()
    return lab.audit().select("run_id", "rows_ingested", F.lit(rows).cast("long").alias("bronze_rows"),
                              F.lit(batches).cast("int").alias("batches"))


@register("continuous_audit", """
SELECT 'RUNNING' AS status, FALSE AS all_rows, TRUE AS registered
UNION ALL SELECT 'STOPPED', TRUE, TRUE""")
def continuous_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A continuous query: audited while it runs and, with all its rows, when it ends; its table is registered by then."""
    import time

    from ..streaming.catalog import bronze_table_name
    lab = Lab(spark, "contaudit", register_tables=True)
    orders = table(spark, sf_dir, "orders")
    lab.engine_landing("orders")
    ds = lab.dataset("orders", files_source("parquet", "orders"), {**BY_DAY, "trigger": {"processing_time": "1 second"}})
    lab.run(ds, run_id="r1")
    query = next(q for q in spark.streams.active if q.name == ds.name)
    lab.land(orders, "orders", "d1", "parquet")
    query.processAllAvailable()
    registered = spark.catalog.tableExists(bronze_table_name(spark, lab.engine, ds).replace("`", ""))
    query.stop()
    for _ in range(100):        # the listener is told of the end a moment later
        if lab.audit().where("status = 'STOPPED'").count():
            break
        time.sleep(0.1)
    return lab.audit().select("status", (F.col("rows_ingested") == orders.count()).alias("all_rows"),
                              F.lit(registered).alias("registered"))


@register("checkpoint_reset_generation", f"""
SELECT 0 AS generation, {', '.join(ORDERS_COLS)} FROM orders WHERE {OLD}
UNION ALL SELECT 1, {', '.join(ORDERS_COLS)} FROM orders""")
def checkpoint_reset_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint is deleted between two runs: all files are read again into a new generation, the old one stays."""
    from ..session import delete_path
    from ..streaming.sink import checkpoint_path, current_generation, read_table, table_path
    lab = Lab(spark, "generation")
    orders = table(spark, sf_dir, "orders")
    lab.land(orders.where(OLD), "orders", "d1", "parquet")
    ds = lab.dataset("orders", files_source("parquet", "orders"), {**BY_DAY, "on_checkpoint_reset": "new_generation"})
    lab.run(ds)
    delete_path(spark, checkpoint_path(ds, lab.engine))
    lab.land(orders.where(NEW), "orders", "d2", "parquet")
    lab.run(ds)
    path = table_path(ds, lab.engine)
    now = read_table(spark, path).select(F.lit(current_generation(spark, path)).alias("generation"), *ORDERS_COLS)
    first = read_table(spark, path, generation=0).select(F.lit(0).alias("generation"), *ORDERS_COLS)
    return first.unionByName(now)


@register("replayed_batch", f"""
SELECT {', '.join(ORDERS_COLS)} FROM orders""")
def replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run dies between writing a batch and committing it to its checkpoint: run again, the batch adds nothing."""
    from ..session import delete_path
    from ..streaming.sink import checkpoint_path
    lab = Lab(spark, "replay")
    lab.land(table(spark, sf_dir, "orders"), "orders", "d1", "parquet")
    ds = lab.dataset("orders", files_source("parquet", "orders"), BY_DAY)
    lab.run(ds)
    delete_path(spark, f"{checkpoint_path(ds, lab.engine)}/commits/0")
    delete_path(spark, f"{checkpoint_path(ds, lab.engine)}/commits/.0.crc")
    resolve_schema(spark, ds, lab.engine)
    lab.run(ds)
    return lab.bronze(ds).select(*ORDERS_COLS)
