"""Registered ingestion queries: land drops from the given tables, ingest, read bronze.

Each query returns bronze without run-dependent columns (ingestion time, paths),
so it can be compared with SQL over the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gold import as_of
from ..operators.silver import path_columns
from ..streaming.audit import run_summary
from .lab import Lab
from .registry import register, table

ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

# Microsecond timestamps in text drops (Spark's default text format keeps milliseconds only).
TS_TEXT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
BY_DAY = {"derived_partitions": {"_ingested_date": "to_date(_ingested_at)"}, "partition_by": ["_ingested_date"]}


def files_source(fmt: str, dataset: str, **extra) -> dict:
    return {"type": "files", "format": fmt, "path": "{landing}/" + dataset, "options": extra.pop("options", {}), **extra}


def csv_orders_source(**extra) -> dict:
    options = {"header": "true", **extra.pop("options", {})}
    return files_source("csv", "orders", schema=ORDERS_DDL, options=options, **extra)


@register("ingest_csv_declared", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(NULL AS VARCHAR) AS _rescued_data, TRUE AS from_csv
FROM orders""")
def ingest_csv_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Lab(spark, "csv")
    lab.land(table(spark, sf_dir, "orders"), "orders", "drop1", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source(), BY_DAY)
    lab.run(ds)
    return lab.bronze(ds).select(*ORDERS_COLS, "_rescued_data",
                                 F.col("_ingested_filename").endswith(".csv").alias("from_csv"))


@register("ingest_json_declared", """
SELECT event_id, ts, user_id, event_type, value, props, CAST(NULL AS VARCHAR) AS _rescued_data
FROM events""")
def ingest_json_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Lab(spark, "json")
    lab.land(table(spark, sf_dir, "events"), "events", "drop1", "json", **TS_TEXT)
    ds = lab.dataset("events", files_source("json", "events", schema=EVENTS_DDL), BY_DAY)
    lab.run(ds)
    return lab.bronze(ds).select(*EVENTS_COLS, "_rescued_data")


@register("ingest_json_inferred_hints", """
SELECT event_id, ts, user_id, event_type, value, props, CAST(NULL AS VARCHAR) AS _rescued_data
FROM events""")
def ingest_json_inferred_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Lab(spark, "jsoninf")
    lab.land(table(spark, sf_dir, "events"), "events", "drop1", "json", **TS_TEXT)
    src = files_source("json", "events", options={"cloudFiles.inferColumnTypes": "true",
                                                  "cloudFiles.schemaHints": "ts timestamp_ntz"})
    ds = lab.dataset("events", src, BY_DAY)
    lab.run(ds)
    return lab.bronze(ds).select(*EVENTS_COLS, "_rescued_data")


@register("ingest_parquet_partitioned", f"""
SELECT {', '.join(LINEITEM_COLS)}, CAST(NULL AS VARCHAR) AS _rescued_data FROM lineitem""")
def ingest_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Lab(spark, "parquet")
    lab.land(table(spark, sf_dir, "lineitem"), "lineitem", "drop1", "parquet")
    ds = lab.dataset("lineitem", files_source("parquet", "lineitem"), {"partition_by": ["l_returnflag"]})
    lab.run(ds)
    return lab.bronze(ds).select(*LINEITEM_COLS, "_rescued_data")


LANG_OF_URL = r"^https?://[^/]+/([a-z]{2})/"


@register("ingest_binary_files", f"""
SELECT page_id, regexp_extract(url, '{LANG_OF_URL}', 1) AS lang, CAST(strlen(html) AS BIGINT) AS length,
       md5(html) AS content_md5
FROM pages""")
def ingest_binary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per page under a folder per language; both carry values (path-derived columns)."""
    lab = Lab(spark, "binary")
    pages = table(spark, sf_dir, "pages")
    rel = F.format_string("lang=%s/page_%d.txt", F.regexp_extract("url", LANG_OF_URL, 1), F.col("page_id"))
    lab.land_files(pages.withColumn("rel", rel), "pages", "drop1", "rel", "html")
    # Files the glob filter must skip.
    pages.select("html").write.json(f"{lab.engine.landing_root}/pages/not_pages")
    src = files_source("binaryFile", "pages", options={"pathGlobFilter": "*.txt"})
    ds = lab.dataset("pages", src, BY_DAY)
    lab.run(ds)
    bronze = path_columns(lab.bronze(ds), "_ingested_filepath",
                          {"page_id": (r"/page_(\d+)\.txt$", "bigint"), "lang": (r"/lang=([^/]*)/", "string")})
    return bronze.select("page_id", "lang", "length", F.md5("content").alias("content_md5"))


@register("incremental_runs", """
SELECT 'r1' AS run_id, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS rows_ingested, 'OK' AS status FROM orders
UNION ALL SELECT 'r2', count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01'), 'OK' FROM orders
UNION ALL SELECT 'r3', 0, 'OK'""")
def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops and an idle run: each run reads only the files that arrived since the last one."""
    lab = Lab(spark, "incr")
    orders = table(spark, sf_dir, "orders")
    ds = lab.dataset("orders", csv_orders_source(), BY_DAY)
    lab.land(orders.where("o_orderdate < TIMESTAMP '1998-01-01'"), "orders", "drop1", "csv", header="true")
    lab.run(ds, run_id="r1")
    lab.land(orders.where("o_orderdate >= TIMESTAMP '1998-01-01'"), "orders", "drop2", "csv", header="true")
    lab.run(ds, run_id="r2")
    lab.run(ds, run_id="r3")
    return lab.audit().select("run_id", "rows_ingested", "status")


@register("derived_columns", """
SELECT event_id, CAST(ts AS DATE) AS event_day, dayofweek(ts) IN (0, 6) AS is_weekend,
       upper(event_type) AS event_type
FROM events""")
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured SQL columns, applied in order, one using another, one replacing a source column."""
    lab = Lab(spark, "derived")
    lab.land(table(spark, sf_dir, "events"), "events", "drop1", "json", **TS_TEXT)
    sink = {"derived_partitions": {"event_day": "to_date(ts)",
                                   "is_weekend": "dayofweek(event_day) IN (1, 7)",
                                   "event_type": "upper(event_type)"},
            "partition_by": ["event_day"]}
    ds = lab.dataset("events", files_source("json", "events", schema=EVENTS_DDL), sink)
    lab.run(ds)
    return lab.bronze(ds).select("event_id", "event_day", "is_weekend", "event_type")


def _three_datasets(spark: SparkSession, sf_dir: str, label: str) -> Lab:
    """Two good datasets and one whose landing folder does not exist, in one run."""
    lab = Lab(spark, label)
    lab.land(table(spark, sf_dir, "orders"), "orders", "drop1", "csv", header="true")
    lab.land(table(spark, sf_dir, "events"), "events", "drop1", "json", **TS_TEXT)
    good1 = lab.dataset("orders", csv_orders_source(), BY_DAY)
    good2 = lab.dataset("events", files_source("json", "events", schema=EVENTS_DDL))
    broken = lab.dataset("missing", files_source("json", "missing"))
    lab.run(good1, broken, good2, run_id="run1")
    return lab


@register("audit_rows", """
SELECT 'lab' AS datasource, 'orders' AS dataset, 'csv' AS source_format, count(*) AS rows_ingested,
       'OK' AS status, FALSE AS has_error FROM orders
UNION ALL SELECT 'lab', 'events', 'json', count(*), 'OK', FALSE FROM events
UNION ALL SELECT 'lab', 'missing', 'json', 0, 'ERROR', TRUE""")
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure isolation: the broken dataset is an ERROR row, the others are ingested whole."""
    lab = _three_datasets(spark, sf_dir, "audit")
    return lab.audit().select("datasource", "dataset", "source_format", "rows_ingested", "status",
                              (F.length(F.coalesce("error_message", F.lit(""))) > 0).alias("has_error"))


@register("run_summary", """
SELECT 'run1' AS run_id, 2 AS ok, 1 AS errors, 0 AS running,
       (SELECT count(*) FROM orders) + (SELECT count(*) FROM events) AS rows_ok, 1 AS n_failures""")
def run_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = _three_datasets(spark, sf_dir, "summary")
    return run_summary(lab.audit()).select("run_id", F.col("ok").cast("int").alias("ok"),
                                           F.col("errors").cast("int").alias("errors"),
                                           F.col("running").cast("int").alias("running"), "rows_ok",
                                           F.size("failures").alias("n_failures"))


def _events_json_lines(events: DataFrame, drop_value: bool = False) -> DataFrame:
    cols = [c for c in EVENTS_COLS if not (drop_value and c == "value")]
    return events.select(*cols)


@register("evolve_add_columns", """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END AS value, props
FROM events""")
def evolve_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column appears in a later drop: the schema grows, earlier rows read it as null."""
    lab = Lab(spark, "evolve")
    events = table(spark, sf_dir, "events")
    src = files_source("json", "events", options={"cloudFiles.inferColumnTypes": "true",
                                                  "cloudFiles.schemaHints": "ts timestamp_ntz"})
    ds = lab.dataset("events", src, BY_DAY)
    lab.land(_events_json_lines(events.where("ts < TIMESTAMP '2024-01-16'"), drop_value=True),
             "events", "drop1", "json", **TS_TEXT)
    lab.run(ds)
    lab.land(events.where("ts >= TIMESTAMP '2024-01-16'"), "events", "drop2", "json", **TS_TEXT)
    lab.run(ds)
    return lab.bronze(ds).select(*EVENTS_COLS)


@register("evolve_modes", """
SELECT m.mode, m.status,
       CASE WHEN m.status = 'OK' THEN (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16') ELSE 0 END
         AS rows_ingested,
       m.value_column, m.value_rescued
FROM (VALUES ('addNewColumns', 'OK', TRUE, FALSE), ('rescue', 'OK', FALSE, TRUE),
             ('failOnNewColumns', 'ERROR', FALSE, FALSE), ('none', 'OK', FALSE, TRUE))
     AS m(mode, status, value_column, value_rescued)""")
def evolve_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same new column under each evolution mode (second run of each dataset)."""
    lab = Lab(spark, "modes")
    events = table(spark, sf_dir, "events")
    modes = ["addNewColumns", "rescue", "failOnNewColumns", "none"]
    specs = {}
    for mode in modes:
        name = f"events_{mode}"
        lab.land(_events_json_lines(events.where("ts < TIMESTAMP '2024-01-16'"), drop_value=True),
                 name, "drop1", "json", **TS_TEXT)
        src = files_source("json", name, schema_evolution_mode=mode,
                           options={"cloudFiles.inferColumnTypes": "true",
                                    "cloudFiles.schemaHints": "ts timestamp_ntz"})
        specs[mode] = lab.dataset(name, src)
    lab.run(*specs.values(), run_id="first")
    for mode in modes:
        lab.land(events.where("ts >= TIMESTAMP '2024-01-16'"), f"events_{mode}", "drop2", "json", **TS_TEXT)
    results = {r.dataset: r for r in lab.run(*specs.values(), run_id="second")}
    frames = []
    for mode in modes:
        r = results[f"events_{mode}"]
        bronze = lab.bronze(specs[mode])
        has_value = "value" in bronze.columns
        rescued = bronze.agg(F.count_if(F.get_json_object("_rescued_data", "$.value").isNotNull()).alias("n"))
        frames.append(rescued.select(
            F.lit(mode).alias("mode"), F.lit(r.status).alias("status"),
            F.lit(r.rows_ingested).cast("bigint").alias("rows_ingested"),
            F.lit(has_value).alias("value_column"), (F.col("n") > 0).alias("value_rescued")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("rescue_json", """
SELECT event_id,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 50 = 0 THEN 'n/a' END AS rescued_value,
       CASE WHEN event_id % 50 = 0 THEN '{"k":' || event_id || '}' END AS rescued_extra,
       CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END AS rescued_fields
FROM events""")
def rescue_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th record carries a non-numeric value and an undeclared object: both are rescued."""
    lab = Lab(spark, "rescuejson")
    events = table(spark, sf_dir, "events")
    good = F.to_json(F.struct(*EVENTS_COLS), TS_TEXT)
    bad = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", F.lit("n/a").alias("value"), "props",
                             F.struct(F.col("event_id").alias("k")).alias("extra")), TS_TEXT)
    lines = events.select(F.when(F.col("event_id") % 50 == 0, bad).otherwise(good).alias("value"))
    lab.land(lines, "events", "drop1", "text")
    ds = lab.dataset("events", files_source("json", "events", schema=EVENTS_DDL), BY_DAY)
    lab.run(ds)
    rescued = F.from_json("_rescued_data", "map<string,string>")
    return lab.bronze(ds).select(
        "event_id", "value",
        F.get_json_object("_rescued_data", "$.value").alias("rescued_value"),
        F.get_json_object("_rescued_data", "$.extra").alias("rescued_extra"),
        # size() of NULL is -1 when ANSI mode is off: test for null first.
        F.when(rescued.isNull(), F.lit(0)).otherwise(F.size(rescued)).alias("rescued_fields"))


@register("rescue_csv", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' END AS rescued_price,
       'note-' || o_orderkey AS rescued_note,
       o_orderdate, o_orderpriority
FROM orders""")
def rescue_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header in another order than the schema, an undeclared column and broken numbers."""
    lab = Lab(spark, "rescuecsv")
    orders = table(spark, sf_dir, "orders")
    drop = orders.select(
        "o_custkey", "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderkey") % 50 == 0, F.lit("n/a"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.concat(F.lit("note-"), F.col("o_orderkey")).alias("note"), "o_orderstatus", "o_orderdate")
    lab.land(drop, "orders", "drop1", "csv", header="true", **TS_TEXT)
    ds = lab.dataset("orders", csv_orders_source(), BY_DAY)
    lab.run(ds)
    return lab.bronze(ds).select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.get_json_object("_rescued_data", "$.o_totalprice").alias("rescued_price"),
        F.get_json_object("_rescued_data", "$.note").alias("rescued_note"),
        "o_orderdate", "o_orderpriority")


@register("registered_table", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS n_with_channel
FROM orders""")
def registered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog table sees rows of later runs and a column added by them."""
    lab = Lab(spark, "registered", register_tables=True)
    orders = table(spark, sf_dir, "orders")
    src = files_source("parquet", "orders")
    ds = lab.dataset("orders", src, BY_DAY)
    lab.land(orders.where("o_orderdate < TIMESTAMP '1998-01-01'"), "orders", "drop1", "parquet")
    lab.run(ds)
    lab.land(orders.where("o_orderdate >= TIMESTAMP '1998-01-01'").withColumn("channel", F.lit("web")),
             "orders", "drop2", "parquet")
    lab.run(ds)
    from ..streaming.catalog import bronze_table_name
    name = bronze_table_name(spark, lab.engine, ds)
    return spark.table(name).agg(F.count(F.lit(1)).alias("n_rows"), F.count("channel").alias("n_with_channel"))


@register("as_of_read", f"""
SELECT {', '.join(ORDERS_COLS)} FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'""")
def as_of_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as it was after the first run, read after the second one."""
    lab = Lab(spark, "asof")
    orders = table(spark, sf_dir, "orders")
    ds = lab.dataset("orders", csv_orders_source(), BY_DAY)
    lab.land(orders.where("o_orderdate < TIMESTAMP '1998-01-01'"), "orders", "drop1", "csv", header="true")
    lab.run(ds)
    cut = lab.bronze(ds).agg(F.max("_ingested_at")).first()[0]
    lab.land(orders.where("o_orderdate >= TIMESTAMP '1998-01-01'"), "orders", "drop2", "csv", header="true")
    lab.run(ds)
    return as_of(lab.bronze(ds), cut).select(*ORDERS_COLS)


@register("continuous_query", """
SELECT 'RUNNING' AS status, count(*) AS rows_after_stop FROM orders""")
def continuous_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset with a processing-time trigger is left running and reported as RUNNING."""
    lab = Lab(spark, "continuous")
    lab.land(table(spark, sf_dir, "orders"), "orders", "drop1", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source(), {**BY_DAY, "trigger": {"processing_time": "1 second"}})
    results = lab.run(ds)
    query = next(q for q in spark.streams.active if q.name == ds.name)
    query.processAllAvailable()
    query.stop()
    n = lab.bronze(ds).agg(F.count(F.lit(1)).alias("rows_after_stop"))
    return n.select(F.lit(results[0].status).alias("status"), "rows_after_stop")


@register("ingest_avro_file", f"""
SELECT {', '.join(ORDERS_COLS)}, CAST(NULL AS VARCHAR) AS _rescued_data, TRUE AS from_avro FROM orders""")
def ingest_avro_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Avro container files (schema inside the files), partitioned by a column of the data."""
    from ..sources.avro import write_avro_files
    lab = Lab(spark, "avro")
    write_avro_files(table(spark, sf_dir, "orders").repartition(4), f"{lab.engine.landing_root}/orders/drop1")
    ds = lab.dataset("orders", files_source("avro", "orders"), {"partition_by": ["o_orderpriority"]})
    lab.run(ds)
    return lab.bronze(ds).select(*ORDERS_COLS, "_rescued_data",
                                 F.col("_ingested_filename").endswith(".avro").alias("from_avro"))


@register("rewritten_file_ignored", f"""
SELECT {', '.join(ORDERS_COLS)}, 0 AS second_run_rows FROM orders""")
def rewritten_file_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files re-delivered under names already ingested are not read again (first version kept)."""
    lab = Lab(spark, "rewrite")
    orders = table(spark, sf_dir, "orders").repartition(4, "o_orderkey")
    ds = lab.dataset("orders", csv_orders_source())
    lab.land_csv_parts(orders, "orders", "drop1")
    lab.run(ds, run_id="first")
    lab.land_csv_parts(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), "orders", "drop1")
    second = lab.run(ds, run_id="second")[0]
    return lab.bronze(ds).select(*ORDERS_COLS, F.lit(second.rows_ingested).cast("bigint").alias("second_run_rows"))


@register("failure_isolation", """
SELECT 'orders' AS dataset, count(*) AS bronze_rows FROM orders
UNION ALL SELECT 'events', count(*) FROM events""")
def failure_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset failing in the same run leaves the others ingested whole."""
    from ..streaming.sink import table_path
    lab = _three_datasets(spark, sf_dir, "isolation")
    frames = [spark.read.parquet(table_path(lab.dataset(name, {"type": "files", "format": "json", "path": "x"}),
                                            lab.engine))
              .agg(F.count(F.lit(1)).alias("bronze_rows")).select(F.lit(name).alias("dataset"), "bronze_rows")
              for name in ("orders", "events")]
    return frames[0].unionByName(frames[1])


@register("csv_mixed_headers", f"""
SELECT {', '.join(ORDERS_COLS)}, CAST(NULL AS VARCHAR) AS _rescued_data FROM orders""")
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over CSV files whose headers list the columns in different orders."""
    lab = Lab(spark, "csvmixed")
    orders = table(spark, sf_dir, "orders")
    lab.land(orders.where("o_orderdate < TIMESTAMP '1998-01-01'").select(*ORDERS_COLS),
             "orders", "drop1", "csv", header="true")
    lab.land(orders.where("o_orderdate >= TIMESTAMP '1998-01-01'").select(*reversed(ORDERS_COLS)),
             "orders", "drop2", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source(), BY_DAY)
    lab.run(ds)
    return lab.bronze(ds).select(*ORDERS_COLS, "_rescued_data")


@register("audit_history", """
SELECT 'r1' AS run_id, 'orders' AS dataset, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS rows_ingested,
       'OK' AS status, TRUE AS timed FROM orders
UNION ALL SELECT 'r2', 'orders', count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01'), 'OK', TRUE FROM orders""")
def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table read as an operations report: latest first, whole seconds per dataset."""
    from ..streaming.audit import audit_history as history
    lab = Lab(spark, "history")
    orders = table(spark, sf_dir, "orders")
    ds = lab.dataset("orders", csv_orders_source(), BY_DAY)
    lab.land(orders.where("o_orderdate < TIMESTAMP '1998-01-01'"), "orders", "drop1", "csv", header="true")
    lab.run(ds, run_id="r1")
    lab.land(orders.where("o_orderdate >= TIMESTAMP '1998-01-01'"), "orders", "drop2", "csv", header="true")
    lab.run(ds, run_id="r2")
    return history(lab.audit()).select("run_id", "dataset", "rows_ingested", "status",
                                       (F.col("seconds") >= 0).alias("timed"))


@register("run_report", """
SELECT 'lab.orders' AS dataset, 'csv' AS source_format, count(*) AS rows_ingested, 'OK' AS status, TRUE AS timed
FROM orders
UNION ALL SELECT 'lab.missing', 'json', 0, 'ERROR', TRUE""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report printed after a run: one line per dataset with duration, rows, status."""
    from ..streaming.audit import results_frame, run_report as report
    lab = Lab(spark, "report")
    lab.land(table(spark, sf_dir, "orders"), "orders", "drop1", "csv", header="true")
    results = lab.run(lab.dataset("orders", csv_orders_source()), lab.dataset("missing", files_source("json", "missing")))
    return report(results_frame(spark, results)).select(
        "dataset", "source_format", "rows_ingested", "status", (F.col("seconds") >= 0).alias("timed"))


@register("nested_dated_drops", f"""
SELECT {', '.join(ORDERS_COLS)}, 'orders/' || strftime(o_orderdate, '%Y') || '/12/31' AS folder FROM orders""")
def nested_dated_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops in year, month and day folders, read by a dataset without any option."""
    lab = Lab(spark, "nested")
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    # a handful of years, whatever the number of orders
    for y in sorted(r[0] for r in orders.select(year).distinct().collect()):
        lab.land(orders.where(year == y), "orders", f"{y}/12/31", "parquet")
    ds = lab.dataset("orders", {"type": "files", "format": "parquet", "path": "{landing}/orders"}, BY_DAY)
    lab.run(ds)
    folder = F.regexp_extract("_ingested_filepath", r"(orders/\d+/\d+/\d+)/[^/]*$", 1)
    return lab.bronze(ds).select(*ORDERS_COLS, folder.alias("folder"))


@register("parquet_columns_of_every_file", """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'web' END AS channel,
       CAST(NULL AS VARCHAR) AS _rescued_data FROM orders""")
def parquet_columns_of_every_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only the older files of a backlog have."""
    lab = Lab(spark, "allfiles")
    orders = table(spark, sf_dir, "orders")
    lab.land(orders.where("o_orderdate < TIMESTAMP '1998-01-01'").withColumn("channel", F.lit("web")), "orders", "d1", "parquet")
    lab.land(orders.where("o_orderdate >= TIMESTAMP '1998-01-01'"), "orders", "d2", "parquet")
    ds = lab.dataset("orders", files_source("parquet", "orders"), BY_DAY)
    lab.run(ds)
    return lab.bronze(ds).select("o_orderkey", "channel", "_rescued_data")


@register("rescue_after_failed_run", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN '{"channel":"web"}' END AS _rescued_data
FROM orders""")
def rescue_after_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema is frozen; a run that dies after its schema step does not lose the undeclared columns of its files."""
    from ..sources.schema import resolve_schema
    lab = Lab(spark, "deadrun")
    orders = table(spark, sf_dir, "orders")
    ds = lab.dataset("orders", files_source("parquet", "orders", schema_evolution_mode="rescue"), BY_DAY)
    lab.land(orders.where("o_orderdate < TIMESTAMP '1998-01-01'"), "orders", "d1", "parquet")
    lab.run(ds)
    lab.land(orders.where("o_orderdate >= TIMESTAMP '1998-01-01'").withColumn("channel", F.lit("web")), "orders", "d2", "parquet")
    resolve_schema(spark, ds, lab.engine)       # a run that got no further
    lab.run(ds)
    return lab.bronze(ds).select("o_orderkey", "_rescued_data")


@register("csv_mixed_headers_after_failed_run", """
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS _rescued_data FROM orders""")
def csv_mixed_headers_after_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their columns in two orders; the first run dies after its schema step."""
    from ..sources.schema import resolve_schema
    lab = Lab(spark, "deadcsv")
    orders = table(spark, sf_dir, "orders")
    ddl = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    ds = lab.dataset("orders", files_source("csv", "orders", schema=ddl, options={"header": "true"}))
    lab.land(orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus", "o_totalprice"), "orders", "d1", "csv",
             header="true")
    lab.land(orders.where("o_orderkey % 2 <> 0").select("o_totalprice", "o_orderkey", "o_orderstatus"), "orders", "d2", "csv",
             header="true")
    resolve_schema(spark, ds, lab.engine)
    lab.run(ds)
    return lab.bronze(ds).select("o_orderkey", "o_orderstatus", "o_totalprice", "_rescued_data")


@register("declared_type_change", """
SELECT 'ERROR' AS status, TRUE AS names_column, count(*) AS n_rows FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'""")
def declared_type_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column declared with another type than the table has: the run is refused and bronze stays readable."""
    lab = Lab(spark, "retyped")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    lab.land(orders.where("o_orderdate < TIMESTAMP '1998-01-01'").drop("o_orderdate"), "orders", "d1", "json")
    first = lab.dataset("orders", files_source("json", "orders", schema="o_orderkey BIGINT, o_orderstatus STRING"))
    lab.run(first)
    lab.land(orders.where("o_orderdate >= TIMESTAMP '1998-01-01'").drop("o_orderdate"), "orders", "d2", "json")
    second = lab.dataset("orders", files_source("json", "orders", schema="o_orderkey STRING, o_orderstatus STRING"))
    result = lab.run(second)[0]
    return lab.bronze(first).agg(F.count("*").alias("n_rows")).select(
        F.lit(result.status).alias("status"), F.lit("o_orderkey" in result.error_message).alias("names_column"), "n_rows")
