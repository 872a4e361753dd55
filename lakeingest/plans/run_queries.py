"""One engine run over ten datasets of every kind, as a scheduled run would do."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.avro import write_avro_files
from ..sources.subjects import write_subjects
from .ingest_queries import BY_DAY, EVENTS_DDL, LANG_OF_URL, TS_TEXT, files_source
from .lab import Lab
from .message_queries import READING_V1, READING_V2, SUBJECT, envelope, framed_avro_value, json_value
from .registry import register, table

LINEITEM_DDL = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ")


def ten_dataset_lab(spark: SparkSession, sf_dir: str, label: str = "fullrun"):
    """Landing drops for ten datasets and their specs (file formats, options and messages)."""
    lab = Lab(spark, label)
    part, orders, events = (table(spark, sf_dir, t) for t in ("part", "orders", "events"))
    lineitem, supplier, pages = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "pages"))

    lab.land(part, "catalog", "d1", "parquet")
    lab.land(orders, "snapshots", "d1", "parquet")
    lab.land(events, "changes", "d1", "json", **TS_TEXT)
    lab.land(events, "readings", "d1", "json", **TS_TEXT)
    lab.land(events, "app_events", "d1", "json", **TS_TEXT)
    lab.land(lineitem, "shipments", "d1", "csv", header="true", **TS_TEXT)
    write_avro_files(supplier.repartition(2), f"{lab.engine.landing_root}/observations/d1")
    rel = F.format_string("lang=%s/page_%d.txt", F.regexp_extract("url", LANG_OF_URL, 1), F.col("page_id"))
    lab.land_files(pages.withColumn("rel", rel), "images", "d1", "rel", "html")
    envelope(events, json_value(events)).write.parquet(f"{lab.engine.landing_root}/topics_json/d1")
    subjects = f"{lab.area}/subjects"
    write_subjects(spark, subjects, [(SUBJECT, 1, 101, json.dumps(READING_V1)),
                                     (SUBJECT, 2, 102, json.dumps(READING_V2))])
    lab.engine.schema_table_path = subjects
    envelope(events, framed_avro_value(events)).write.parquet(f"{lab.engine.landing_root}/topics_avro/d1")

    recursive = {"recursiveFileLookup": "true"}
    specs = [
        lab.dataset("catalog", files_source("parquet", "catalog", schema_evolution_mode="addNewColumns"), BY_DAY),
        lab.dataset("snapshots", files_source("parquet", "snapshots"), {"partition_by": ["o_orderpriority"]}),
        lab.dataset("changes", files_source("json", "changes", schema=EVENTS_DDL), BY_DAY),
        lab.dataset("readings", files_source("json", "readings", options={
            "cloudFiles.inferColumnTypes": "true", "cloudFiles.schemaHints": "ts timestamp_ntz, value double"}),
            {"partition_by": ["event_type"]}),
        lab.dataset("app_events", files_source("json", "app_events", options={
            "cloudFiles.schemaHints": "ts timestamp_ntz"}), BY_DAY),
        lab.dataset("shipments", files_source("csv", "shipments", schema=LINEITEM_DDL, options={"header": "true"}),
                    BY_DAY),
        lab.dataset("observations", files_source("avro", "observations"), {"partition_by": ["s_nationkey"]}),
        lab.dataset("images", files_source("binaryFile", "images", options={"pathGlobFilter": "*.txt"}), BY_DAY),
        lab.dataset("app_events_stream", {"type": "kafka", "envelope_path": "{landing}/topics_json",
                                          "subscribe_pattern": r"app\.events\..*",
                                          "value_format": "json", "value_json_schema": EVENTS_DDL,
                                          "options": recursive}, BY_DAY),
        lab.dataset("readings_stream", {"type": "kafka", "envelope_path": "{landing}/topics_avro",
                                        "subscribe_pattern": r"app\.events\..*", "value_format": "avro",
                                        "value_subject": SUBJECT, "options": recursive},
                    {"partition_by": ["_topic"]}),
    ]
    return lab, specs


@register("ingest_ten_datasets", """
SELECT 'catalog' AS dataset, 'parquet' AS source_format, count(*) AS rows_ingested, 'OK' AS status FROM part
UNION ALL SELECT 'snapshots', 'parquet', count(*), 'OK' FROM orders
UNION ALL SELECT 'changes', 'json', count(*), 'OK' FROM events
UNION ALL SELECT 'readings', 'json', count(*), 'OK' FROM events
UNION ALL SELECT 'app_events', 'json', count(*), 'OK' FROM events
UNION ALL SELECT 'shipments', 'csv', count(*), 'OK' FROM lineitem
UNION ALL SELECT 'observations', 'avro', count(*), 'OK' FROM supplier
UNION ALL SELECT 'images', 'binaryFile', count(*), 'OK' FROM pages
UNION ALL SELECT 'app_events_stream', 'kafka', count(*), 'OK' FROM events
UNION ALL SELECT 'readings_stream', 'kafka', count(*), 'OK' FROM events""")
def ingest_ten_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten datasets in one run: queries start together and overlap; one audit row each."""
    lab, specs = ten_dataset_lab(spark, sf_dir)
    lab.run(*specs, run_id="full")
    return lab.audit().select("dataset", "source_format", "rows_ingested", "status")


@register("ingest_ten_datasets_idle_rerun", """
SELECT dataset, 0 AS rows_ingested, 'OK' AS status FROM (VALUES ('catalog'), ('snapshots'), ('changes'),
  ('readings'), ('app_events'), ('shipments'), ('observations'), ('images'), ('app_events_stream'),
  ('readings_stream')) AS t(dataset)""")
def ingest_ten_datasets_idle_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run right after the first: nothing new arrived, every dataset reports 0 rows."""
    lab, specs = ten_dataset_lab(spark, sf_dir, "idlerun")
    lab.run(*specs, run_id="first")
    lab.run(*specs, run_id="second")
    return lab.audit().where("run_id = 'second'").select("dataset", "rows_ingested", "status")
