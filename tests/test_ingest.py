"""Engine behaviours on small data with a real Spark session."""

import json

import pytest
from pyspark.sql import functions as F

from lakeingest.plans.ingest_queries import EVENTS_DDL, ORDERS_DDL, TS_TEXT, csv_orders_source, files_source
from lakeingest.plans.lab import Lab
from lakeingest.session import write_text
from lakeingest.spec import EngineSpec


def orders(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/orders.parquet")


def events(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/events.parquet")


def test_idle_run_reports_zero_and_new_drop_only_new_rows(spark, small_dir):
    lab = Lab(spark, "t_incr")
    o = orders(spark, small_dir)
    ds = lab.dataset("orders", csv_orders_source())
    lab.land(o.limit(100), "orders", "d1", "csv", header="true")
    r1 = lab.run(ds)[0]
    r2 = lab.run(ds)[0]
    lab.land(o.limit(30), "orders", "d2", "csv", header="true")
    r3 = lab.run(ds)[0]
    assert (r1.rows_ingested, r2.rows_ingested, r3.rows_ingested) == (100, 0, 30)
    assert {r1.status, r2.status, r3.status} == {"OK"}
    assert lab.bronze(ds).count() == 130


def test_ingestion_time_is_one_value_per_micro_batch(spark, small_dir):
    lab = Lab(spark, "t_p1")
    o = orders(spark, small_dir)
    lab.land(o.limit(50).coalesce(1), "orders", "d1", "csv", header="true")
    lab.land(o.limit(20).coalesce(1), "orders", "d2", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source(options={"header": "true", "maxFilesPerTrigger": "1"}))
    res = lab.run(ds)[0]
    assert res.rows_ingested == 70
    per_file = (lab.bronze(ds).groupBy("_ingested_filepath")
                .agg(F.countDistinct("_ingested_at").alias("n")).collect())
    assert len(per_file) == 2 and all(r["n"] == 1 for r in per_file)
    assert lab.bronze(ds).select("_ingested_at").distinct().count() == 2


def test_rewritten_file_is_not_read_again(spark):
    lab = Lab(spark, "t_rewrite")
    path = f"{lab.engine.landing_root}/ev/drop.json"
    write_text(spark, path, '{"event_id": 1}\n{"event_id": 2}\n')
    ds = lab.dataset("ev", files_source("json", "ev", schema="event_id BIGINT"))
    assert lab.run(ds)[0].rows_ingested == 2
    write_text(spark, path, '{"event_id": 3}\n')
    assert lab.run(ds)[0].rows_ingested == 0
    assert sorted(r[0] for r in lab.bronze(ds).select("event_id").collect()) == [1, 2]


def test_json_rescue_keeps_everything(spark):
    lab = Lab(spark, "t_rescue")
    lines = "\n".join([
        '{"id": 1, "amount": 2.5, "when": "2024-01-01T10:00:00"}',
        '{"id": "bad", "amount": 3, "extra": {"k": 1}}',
        'not json at all',
        '{"id": 4, "amount": null}',
        '{"id": 5, "amount": 1.0, "amount": 2.0}',
        '',
    ])
    write_text(spark, f"{lab.engine.landing_root}/t/a.json", lines)
    ds = lab.dataset("t", files_source("json", "t", schema="id BIGINT, amount DOUBLE, `when` TIMESTAMP_NTZ"))
    assert lab.run(ds)[0].rows_ingested == 5
    got = [(r["id"], r["amount"], r["_rescued_data"]) for r in lab.bronze(ds).collect()]
    assert (1, 2.5, None) in got
    assert (4, None, None) in got  # an explicit null is not a mismatch
    rescued = [json.loads(r[2]) for r in got if r[2]]
    assert {"id": "bad", "extra": '{"k":1}'} in rescued
    assert {"_corrupt_record": "not json at all"} in rescued
    assert {"_duplicate_keys_line": '{"id": 5, "amount": 1.0, "amount": 2.0}'} in rescued


def test_csv_matches_columns_by_header_name(spark):
    lab = Lab(spark, "t_csvname")
    write_text(spark, f"{lab.engine.landing_root}/c/a.csv", "b,a,extra\n2,1,x\nz,3,\n")
    ds = lab.dataset("c", files_source("csv", "c", schema="a INT, b INT", options={"header": "true"}))
    assert lab.run(ds)[0].rows_ingested == 2
    got = sorted((r["a"], r["b"], r["_rescued_data"]) for r in lab.bronze(ds).collect())
    assert got == [(1, 2, '{"extra":"x"}'), (3, None, '{"b":"z"}')]


def test_csv_header_order_may_change_between_runs(spark):
    lab = Lab(spark, "t_csvhdr")
    write_text(spark, f"{lab.engine.landing_root}/c/d1/a.csv", "a,b\n1,2\n")
    ds = lab.dataset("c", files_source("csv", "c", schema="a INT, b INT", options={"header": "true"}))
    assert lab.run(ds)[0].rows_ingested == 1
    write_text(spark, f"{lab.engine.landing_root}/c/d2/b.csv", "b,a\n5,6\n")
    assert lab.run(ds)[0].rows_ingested == 1
    assert sorted((r["a"], r["b"]) for r in lab.bronze(ds).collect()) == [(1, 2), (6, 5)]


def test_csv_mixed_header_orders_in_one_run_are_mapped_per_file(spark):
    lab = Lab(spark, "t_csvmix")
    write_text(spark, f"{lab.engine.landing_root}/c/d1/a.csv", "a,b\n1,2\n3,x\n")
    write_text(spark, f"{lab.engine.landing_root}/c/d1/b.csv", "b,a,note\n5,6,hello\n7,8,\n")
    write_text(spark, f"{lab.engine.landing_root}/c/d1/c.csv", "a\n9\n")
    ds = lab.dataset("c", files_source("csv", "c", schema="a INT, b INT", options={"header": "true"}))
    res = lab.run(ds)[0]
    assert res.status == "OK" and res.rows_ingested == 5
    got = sorted(((r["a"], r["b"], r["_rescued_data"]) for r in lab.bronze(ds).collect()), key=lambda t: t[0])
    assert got == [(1, 2, None), (3, None, '{"b":"x"}'), (6, 5, '{"note":"hello"}'), (8, 7, None), (9, None, None)]


def test_missing_landing_folder_is_a_per_dataset_error(spark, small_dir):
    lab = Lab(spark, "t_missing")
    lab.land(orders(spark, small_dir).limit(10), "orders", "d1", "csv", header="true")
    good = lab.dataset("orders", csv_orders_source())
    inferred = lab.dataset("nothing", files_source("json", "nothing"))
    declared = lab.dataset("nothing_declared", files_source("json", "nothing_declared", schema="a INT"))
    res = {r.dataset: r for r in lab.run(good, inferred, declared)}
    assert res["orders"].status == "OK" and res["orders"].rows_ingested == 10
    assert res["nothing"].status == "ERROR" and "no files" in res["nothing"].error_message
    assert res["nothing_declared"].status == "ERROR" and "PATH_NOT_FOUND" in res["nothing_declared"].error_message
    assert len(res["nothing"].error_message) <= 1000


def test_checkpoint_reset_is_refused(spark, small_dir):
    lab = Lab(spark, "t_reset")
    table = f"{lab.area}/shared_table"
    lab.land(orders(spark, small_dir).limit(10), "orders", "d1", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source(), {"path": table})
    assert lab.run(ds)[0].rows_ingested == 10
    # Same table, another lakehouse root: a fresh checkpoint.
    other = EngineSpec.from_dict({**lab.engine.__dict__, "kafka": None,
                                  "landing_root": lab.engine.landing_root,
                                  "lakehouse_root": f"{lab.area}/other_lakehouse", "catalog": "spark_catalog",
                                  "audit_path": f"{lab.area}/other_audit"})
    from lakeingest.streaming.runner import run_ingestion
    res = run_ingestion(spark, other, [ds])[0]
    assert res.status == "ERROR" and "CheckpointMismatchError" in res.error_message
    assert lab.bronze(ds).count() == 10


def test_fail_on_new_columns_names_them(spark, small_dir):
    lab = Lab(spark, "t_failnew")
    e = events(spark, small_dir)
    src = files_source("json", "ev", schema_evolution_mode="failOnNewColumns")
    ds = lab.dataset("ev", src)
    lab.land(e.select("event_id", "user_id"), "ev", "d1", "json")
    assert lab.run(ds)[0].status == "OK"
    lab.land(e.select("event_id", "user_id", "event_type"), "ev", "d2", "json")
    res = lab.run(ds)[0]
    assert res.status == "ERROR" and "event_type" in res.error_message


def test_declared_schema_rejects_add_new_columns(spark, small_dir):
    lab = Lab(spark, "t_declared_add")
    lab.land(events(spark, small_dir).limit(5), "ev", "d1", "json", **TS_TEXT)
    ds = lab.dataset("ev", files_source("json", "ev", schema=EVENTS_DDL, schema_evolution_mode="addNewColumns"))
    res = lab.run(ds)[0]
    assert res.status == "ERROR" and "addNewColumns" in res.error_message


def test_parquet_column_added_then_missing(spark, small_dir):
    lab = Lab(spark, "t_pq")
    o = orders(spark, small_dir)
    ds = lab.dataset("o", files_source("parquet", "o"))
    lab.land(o.limit(10).drop("o_orderpriority"), "o", "d1", "parquet")
    lab.run(ds)
    lab.land(o.limit(5), "o", "d2", "parquet")
    lab.run(ds)
    lab.land(o.limit(3).drop("o_custkey"), "o", "d3", "parquet")
    lab.run(ds)
    b = lab.bronze(ds)
    assert "o_orderpriority" in b.columns
    assert b.count() == 18
    assert b.where("o_custkey IS NULL").count() == 3
    assert b.where("o_orderpriority IS NULL").count() == 10


def test_sink_options_override_checkpoint(spark, small_dir):
    lab = Lab(spark, "t_k4")
    lab.land(orders(spark, small_dir).limit(7), "orders", "d1", "csv", header="true")
    ckpt = f"{lab.area}/custom_checkpoint"
    ds = lab.dataset("orders", csv_orders_source(), {"options": {"checkpointLocation": ckpt}})
    assert lab.run(ds)[0].rows_ingested == 7
    from lakeingest.session import path_exists
    assert path_exists(spark, f"{ckpt}/offsets")


def test_latest_start_offsets_skip_existing_messages(spark, small_dir):
    from lakeingest.plans.message_queries import envelope, json_value
    lab = Lab(spark, "t_latest")
    e = events(spark, small_dir)
    first, second = e.where("event_id < 500"), e.where("event_id >= 500")
    envelope(first, json_value(first)).write.parquet(f"{lab.engine.landing_root}/topics/d1")
    src = {"type": "kafka", "envelope_path": "{landing}/topics", "subscribe_pattern": r"app\.events\..*",
           "value_format": "json", "value_json_schema": EVENTS_DDL, "starting_offsets": "latest",
           "options": {"recursiveFileLookup": "true"}}
    ds = lab.dataset("msgs", src)
    assert lab.run(ds)[0].rows_ingested == 0
    envelope(second, json_value(second)).write.parquet(f"{lab.engine.landing_root}/topics/d2")
    assert lab.run(ds)[0].rows_ingested == second.count()


def test_malformed_json_message_keeps_raw_bytes(spark):
    from lakeingest.sources.messages import ENVELOPE_SCHEMA
    lab = Lab(spark, "t_badmsg")
    rows = [(b"k1", b'{"a": 1}', "t", 0, 0, None), (None, b"{broken", "t", 0, 1, None), (b"k3", None, "t", 0, 2, None)]
    spark.createDataFrame(rows, ENVELOPE_SCHEMA).write.parquet(f"{lab.engine.landing_root}/topics/d1")
    src = {"type": "kafka", "envelope_path": "{landing}/topics", "subscribe": "t", "value_format": "json",
           "value_json_schema": "a INT", "options": {"recursiveFileLookup": "true"}}
    ds = lab.dataset("msgs", src)
    assert lab.run(ds)[0].rows_ingested == 3
    got = {r["_offset"]: r for r in lab.bronze(ds).collect()}
    assert got[0]["key"] == "k1" and got[0]["value"]["a"] == 1 and got[0]["_raw_value"] is None
    assert got[1]["key"] is None and bytes(got[1]["_raw_value"]) == b"{broken"
    assert got[2]["value"] is None and got[2]["_raw_value"] is None


def test_strip_frame_on_short_input(spark):
    from lakeingest.functions.decode import frame_schema_id, strip_frame
    df = spark.createDataFrame([(bytes([0, 0, 0, 0, 7, 1, 2]),), (b"\x00\x01",), (None,)], "v BINARY")
    got = df.select(strip_frame(F.col("v")).alias("p"), frame_schema_id(F.col("v")).alias("id")).collect()
    assert bytes(got[0]["p"]) == b"\x01\x02" and got[0]["id"] == 7
    assert bytes(got[1]["p"]) == b"" and got[1]["id"] is None
    assert got[2]["p"] is None


def test_audit_and_catalog_bootstrap(spark, small_dir):
    lab = Lab(spark, "t_audit")
    lab.land(orders(spark, small_dir).limit(4), "orders", "d1", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source())
    res = lab.run(ds)
    assert len(res[0].run_id) == 12 and all(c in "0123456789abcdef" for c in res[0].run_id)
    audit = lab.audit().collect()
    assert len(audit) == 1 and audit[0]["rows_ingested"] == 4 and audit[0]["status"] == "OK"
    assert audit[0]["finished_at"] >= audit[0]["started_at"]
    names = {r.namespace for r in spark.sql("SHOW SCHEMAS").collect()}
    assert lab.engine.ops_schema in names and lab.engine.bronze_schema in names


def test_files_per_partition_spreads_without_losing_rows(spark, small_dir):
    lab = Lab(spark, "t_spread")
    o = orders(spark, small_dir)
    lab.land(o, "orders", "d1", "csv", header="true")
    sink = {"partition_by": ["o_orderstatus"], "files_per_partition": 3}
    ds = lab.dataset("orders", csv_orders_source(), sink)
    assert lab.run(ds)[0].rows_ingested == o.count()
    b = lab.bronze(ds)
    assert b.count() == o.count()
    files = (b.withColumn("f", F.col("_metadata.file_path")).groupBy("o_orderstatus")
             .agg(F.countDistinct("f").alias("n")).collect())
    assert all(r["n"] <= 3 for r in files)


@pytest.mark.parametrize("n_files", [1, 4])
def test_splitting_a_drop_never_changes_bronze(spark, small_dir, n_files):
    lab = Lab(spark, f"t_split{n_files}")
    e = events(spark, small_dir)
    lab.land(e.repartition(n_files), "ev", "d1", "json", **TS_TEXT)
    ds = lab.dataset("ev", files_source("json", "ev", schema=EVENTS_DDL))
    lab.run(ds)
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    assert lab.bronze(ds).select(*cols).exceptAll(e.select(*cols)).count() == 0
    assert lab.bronze(ds).count() == e.count()


def test_source_options_override_engine_defaults(spark):
    from lakeingest.sources.schema import split_options
    engine_opts, reader_opts = split_options({"options": {"cloudFiles.schemaHints": "a int", "maxFileAge": "7d",
                                                          "cloudFiles.maxFilesPerTrigger": 3,
                                                          "cloudFiles.useNotifications": "true"}})
    assert engine_opts == {"schema_hints": "a int"}
    assert reader_opts == {"maxFileAge": "7d", "maxFilesPerTrigger": "3"}
    from lakeingest.sources.files import _DEFAULT_STREAM_OPTIONS
    assert {**_DEFAULT_STREAM_OPTIONS, **reader_opts}["maxFileAge"] == "7d"


def test_json_sink_format(spark, small_dir):
    lab = Lab(spark, "t_k3")
    lab.land(orders(spark, small_dir).limit(12), "orders", "d1", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source(), {"format": "json"})
    assert lab.run(ds)[0].rows_ingested == 12
    from lakeingest.streaming.sink import table_path
    assert spark.read.json(table_path(ds, lab.engine)).count() == 12


def test_csv_empty_fields_are_null(spark):
    lab = Lab(spark, "t_c6")
    write_text(spark, f"{lab.engine.landing_root}/s/a.csv",
               "id,delivered_ts,hours,status\n1,2024-01-02T10:00:00,5.5,DELIVERED\n2,,,IN_TRANSIT\n")
    ds = lab.dataset("s", files_source("csv", "s", options={"header": "true"},
                                       schema="id INT, delivered_ts TIMESTAMP_NTZ, hours DOUBLE, status STRING"))
    lab.run(ds)
    got = {r["id"]: r for r in lab.bronze(ds).collect()}
    assert got[2]["delivered_ts"] is None and got[2]["hours"] is None and got[2]["_rescued_data"] is None
    assert got[1]["hours"] == 5.5


def test_glob_filter_and_recursion_select_files(spark):
    lab = Lab(spark, "t_s8")
    write_text(spark, f"{lab.engine.landing_root}/img/f1/2024-01-01/a.png", "png-a")
    write_text(spark, f"{lab.engine.landing_root}/img/f2/2024-01-02/b.png", "png-bb")
    write_text(spark, f"{lab.engine.landing_root}/img/f2/notes.txt", "not an image")
    ds = lab.dataset("img", files_source("binaryFile", "img", options={"pathGlobFilter": "*.png"}))
    assert lab.run(ds)[0].rows_ingested == 2
    from lakeingest.operators.silver import path_columns
    out = path_columns(lab.bronze(ds), "path", {"field": (r"/img/([^/]+)/", "string"),
                                                 "day": (r"/(\d{4}-\d{2}-\d{2})/", "date")})
    assert sorted((r["field"], str(r["day"]), r["length"]) for r in out.collect()) == [
        ("f1", "2024-01-01", 5), ("f2", "2024-01-02", 6)]


def test_header_probe_skips_files_without_a_readable_line(spark):
    from lakeingest.sources.schema import probe_csv_headers
    lab = Lab(spark, "t_probe")
    write_text(spark, f"{lab.engine.landing_root}/c/a.csv", "a,b\n1,2\n")
    write_text(spark, f"{lab.engine.landing_root}/c/b.csv.bz2", "not really bz2")
    assert probe_csv_headers(spark, f"{lab.engine.landing_root}/c", {}, f"{lab.area}/h") == [["a", "b"]]
    assert probe_csv_headers(spark, f"{lab.engine.landing_root}/c", {"pathGlobFilter": "*.csv"},
                             f"{lab.area}/h2") == [["a", "b"]]


def test_missing_connectors_are_per_dataset_errors(spark, small_dir, tmp_path):
    props = tmp_path / "client.properties"
    props.write_text("bootstrap.servers=localhost:9092\n", encoding="utf-8")
    lab = Lab(spark, "t_conn", kafka={"client_properties_path": str(props)})
    lab.land(orders(spark, small_dir).limit(5), "orders", "d1", "csv", header="true")
    good = lab.dataset("orders", csv_orders_source())
    to_delta = lab.dataset("orders_delta", csv_orders_source(), {"format": "delta"})
    from_kafka = lab.dataset("msgs", {"type": "kafka", "subscribe": "t", "value_format": "string"})
    res = {r.dataset: r for r in lab.run(good, to_delta, from_kafka)}
    assert res["orders"].status == "OK" and res["orders"].rows_ingested == 5
    assert res["orders_delta"].status == "ERROR" and "delta" in res["orders_delta"].error_message.lower()
    assert res["msgs"].status == "ERROR" and "kafka" in res["msgs"].error_message.lower()


def test_inference_looks_at_every_new_file(spark, small_dir):
    lab = Lab(spark, "t_infer_all")
    e = events(spark, small_dir)
    lab.land(e.select("event_id", F.lit(1).alias("x")).limit(10).coalesce(1), "ev", "d1", "parquet")
    lab.land(e.select("event_id", "event_type").limit(10).coalesce(1), "ev", "d2", "parquet")
    src = files_source("parquet", "ev", options={"cloudFiles.schemaInference.sampleSize.numFiles": "1"})
    ds = lab.dataset("ev", src)
    assert lab.run(ds)[0].rows_ingested == 20
    b = lab.bronze(ds)
    assert b.where("x = 1").count() == 10 and b.where("event_type IS NOT NULL").count() == 10


def test_headers_of_any_length(spark):
    lab = Lab(spark, "t_wide")
    names = [f"column_number_{i:05d}" for i in range(6000)]
    path = f"{lab.engine.landing_root}/wide/d1"
    spark.createDataFrame([(",".join(names) + "\n" + ",".join(str(i) for i in range(6000)),)], "value string").coalesce(1).write.text(path)
    ds = lab.dataset("wide", files_source("csv", "wide", options={"header": "true"}))
    from lakeingest.sources.schema import resolve_schema
    resolved = resolve_schema(spark, ds, lab.engine)
    assert resolved.columns.names == names


def test_a_data_line_like_the_header_is_kept(spark):
    lab = Lab(spark, "t_echo")
    for drop, text in (("d1", "a,b\n1,2\na,b"), ("d2", "b,a\n4,3")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{lab.engine.landing_root}/echo/{drop}")
    ds = lab.dataset("echo", files_source("csv", "echo", schema="a STRING, b STRING", options={"header": "true"}))
    assert lab.run(ds)[0].status == "OK"
    assert sorted((r.a, r.b) for r in lab.bronze(ds).collect()) == [("1", "2"), ("3", "4"), ("a", "b")]


@pytest.mark.parametrize("codec", ["gzip", "bzip2"])
def test_compressed_csv_with_mixed_headers(spark, codec):
    lab = Lab(spark, f"t_{codec}")
    for drop, text in (("d1", "a,b\n1,2"), ("d2", "b,a\n4,3")):
        (spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("compression", codec)
              .text(f"{lab.engine.landing_root}/z/{drop}"))
    ds = lab.dataset("z", files_source("csv", "z", schema="a INT, b INT", options={"header": "true"}))
    assert lab.run(ds)[0].status == "OK"
    assert sorted((r.a, r.b) for r in lab.bronze(ds).collect()) == [(1, 2), (3, 4)]


def test_options_that_would_be_ignored_are_refused(spark, small_dir):
    lab = Lab(spark, "t_opts")
    lab.land(orders(spark, small_dir).limit(5), "orders", "d1", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source(options={"cloudFiles.includeExistingFiles": "false"}))
    res = lab.run(ds)[0]
    assert res.status == "ERROR" and "includeExistingFiles" in res.error_message


def test_registration_never_touches_another_table(spark, small_dir):
    from lakeingest.streaming.catalog import TableConflictError, bootstrap, bronze_table_name, register_table
    lab = Lab(spark, "t_conflict")
    lab.land(orders(spark, small_dir).limit(5), "orders", "d1", "csv", header="true")
    ds = lab.dataset("orders", csv_orders_source(), {"partition_by": ["o_orderstatus"]})
    bootstrap(spark, lab.engine)
    name = bronze_table_name(spark, lab.engine, ds)
    spark.range(7).write.saveAsTable(name)
    lab.run(ds)
    with pytest.raises(TableConflictError):
        register_table(spark, lab.engine, ds)
    assert spark.table(name).count() == 7
    spark.sql(f"DROP TABLE {name}")
    assert register_table(spark, lab.engine, ds) == register_table(spark, lab.engine, ds) == name
    assert spark.table(name).count() == 5
    assert "mergeSchema" not in str(spark.sql(f"SHOW CREATE TABLE {name}").first()[0])


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_schema_evolution_in_any_session_time_zone(spark, small_dir, zone):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        lab = Lab(spark, "t_zone")
        e = events(spark, small_dir)
        ds = lab.dataset("ev", files_source("json", "ev"))
        lab.land(e.select("event_id", "user_id").limit(10), "ev", "d1", "json")
        assert lab.run(ds)[0].rows_ingested == 10
        lab.land(e.select("event_id", "user_id", "event_type").limit(7), "ev", "d2", "json")
        assert lab.run(ds)[0].rows_ingested == 7
        b = lab.bronze(ds)
        assert "event_type" in b.columns and b.where("event_type IS NOT NULL").count() == 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_multiline_json_documents_are_rescued_like_lines(spark):
    lab = Lab(spark, "t_multiline")
    root = f"{lab.engine.landing_root}/docs"
    write_text(spark, f"{root}/array.json", '[\n  {"id": 1, "v": 1.5},\n  {"id": 2, "v": "bad",\n   "extra": {"k": [1, 2]}},\n'
                                           '  {"id": 3}\n]\n')
    write_text(spark, f"{root}/object.json", '{\n  "id": 4,\n  "v": 4.5\n}\n')
    write_text(spark, f"{root}/broken.json", '{"id": 5, "v": \n')
    ds = lab.dataset("docs", files_source("json", "docs", schema="id BIGINT, v DOUBLE", options={"multiLine": "true"}))
    assert lab.run(ds)[0].rows_ingested == 5
    got = {r["id"]: r for r in lab.bronze(ds).collect()}
    assert got[1]["v"] == 1.5 and got[1]["_rescued_data"] is None
    assert json.loads(got[2]["_rescued_data"]) == {"v": "bad", "extra": '{"k":[1,2]}'}
    assert got[3]["v"] is None and got[4]["v"] == 4.5
    broken = json.loads(got[None]["_rescued_data"])
    assert broken["_corrupt_record"].startswith('{"id": 5')


def test_key_and_value_decoders_are_independent(spark):
    from lakeingest.sources.messages import ENVELOPE_SCHEMA
    lab = Lab(spark, "t_d6")
    rows = [(b'{"region": "north", "id": 7}', b"\x00\x01raw", "t", 0, 0, None),
            (None, b"plain text", "t", 1, 1, None)]
    spark.createDataFrame(rows, ENVELOPE_SCHEMA).write.parquet(f"{lab.engine.landing_root}/topics/d1")
    base = {"type": "kafka", "envelope_path": "{landing}/topics", "subscribe": "t",
            "options": {"recursiveFileLookup": "true"}}
    json_key = lab.dataset("json_key", {**base, "key_format": "json", "key_json_schema": "region STRING, id INT",
                                        "value_format": "binary"})
    binary_key = lab.dataset("binary_key", {**base, "key_format": "binary", "value_format": "string"})
    res = {r.dataset: r for r in lab.run(json_key, binary_key)}
    assert res["json_key"].rows_ingested == 2 and res["binary_key"].rows_ingested == 2
    a = {r["_offset"]: r for r in lab.bronze(json_key).collect()}
    assert (a[0]["key"]["region"], a[0]["key"]["id"]) == ("north", 7) and bytes(a[0]["value"]) == b"\x00\x01raw"
    assert a[1]["key"] is None and bytes(a[1]["value"]) == b"plain text"
    b = {r["_offset"]: r for r in lab.bronze(binary_key).collect()}
    assert bytes(b[0]["key"]) == b'{"region": "north", "id": 7}' and b[1]["value"] == "plain text"
    assert "_raw_value" not in lab.bronze(binary_key).columns


def test_custom_checkpoint_location_is_guarded_too(spark, small_dir):
    lab = Lab(spark, "t_guard_custom")
    table = f"{lab.area}/table"
    lab.land(orders(spark, small_dir).limit(6), "orders", "d1", "csv", header="true")
    first = lab.dataset("orders", csv_orders_source(), {"path": table, "options": {"checkpointLocation": f"{lab.area}/ck1"}})
    assert lab.run(first)[0].rows_ingested == 6
    second = lab.dataset("orders", csv_orders_source(), {"path": table, "options": {"checkpointLocation": f"{lab.area}/ck2"}})
    res = lab.run(second)[0]
    assert res.status == "ERROR" and "CheckpointMismatchError" in res.error_message
    from lakeingest.session import path_exists
    assert path_exists(spark, f"{lab.area}/ck1/_lakeingest_token")


@pytest.mark.parametrize("text_types", [False, True])
def test_quoted_numbers_follow_the_typing_mode(spark, text_types):
    strict = not text_types
    lab = Lab(spark, f"t_strict{int(strict)}")
    write_text(spark, f"{lab.engine.landing_root}/q/a.json", '{"id": "123", "n": 1}\n{"id": 5, "n": 2}\n')
    ds = lab.dataset("q", files_source("json", "q", schema="id BIGINT, n INT", json_text_types=text_types))
    lab.run(ds)
    got = {r["n"]: (r["id"], r["_rescued_data"]) for r in lab.bronze(ds).collect()}
    assert got[2] == (5, None)
    assert got[1] == ((None, '{"id":"123"}') if strict else (123, None))


def test_schema_log_grows_with_schema_changes_not_runs(spark, small_dir):
    from lakeingest.session import list_names
    from lakeingest.sources.schema import schema_log_path
    lab = Lab(spark, "t_schemalog")
    e = events(spark, small_dir)
    ds = lab.dataset("ev", files_source("json", "ev"))
    for i in range(3):
        lab.land(e.select("event_id", "user_id").limit(5), "ev", f"d{i}", "json")
        assert lab.run(ds)[0].rows_ingested == 5
    versions = [n for n in list_names(spark, schema_log_path(lab.engine, ds)) if n.startswith("v")]
    assert len(versions) == 1
    lab.land(e.select("event_id", "user_id", "event_type").limit(5), "ev", "d9", "json")
    assert lab.run(ds)[0].rows_ingested == 5
    assert len([n for n in list_names(spark, schema_log_path(lab.engine, ds)) if n.startswith("v")]) == 2
    assert lab.bronze(ds).where("event_type IS NOT NULL").count() == 5


def test_csv_parts_are_written_batch_by_batch(spark, monkeypatch):
    from lakeingest.plans import lab as lab_module

    class CountedWrites:
        """A local file system that keeps beside a file how often it was written to."""

        def create_dir(self, path, recursive=True):
            import os
            os.makedirs(path, exist_ok=True)

        def open_output_stream(self, path):
            import contextlib

            @contextlib.contextmanager
            def opened():
                with open(path, "wb") as out:
                    class Counted:
                        writes = 0

                        def write(self, data):
                            self.writes += 1
                            return out.write(data)
                    counted = Counted()
                    yield counted
                with open(f"{path}.writes", "w") as note:
                    note.write(str(counted.writes))
            return opened()

    lab = Lab(spark, "t_csvparts")
    monkeypatch.setattr(lab_module, "task_filesystem", lambda base: (CountedWrites(), "/" + base[len("file:"):].lstrip("/")))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "10")
    try:
        assert lab.land_csv_parts(spark.range(35).selectExpr("id", "concat('a,', id) AS t").coalesce(1), "x", "d1") == 35
    finally:
        spark.conf.set(batch, before)
    folder = f"{lab.engine.landing_root}/x/d1"
    assert spark.read.text(f"{folder}/*.writes").first()[0] == "4"
    back = spark.read.csv(f"{folder}/part-00000.csv", header=True, schema="id BIGINT, t STRING")
    assert sorted((r["id"], r["t"]) for r in back.collect()) == [(i, f"a,{i}") for i in range(35)]


def test_binary_batches_list_their_files_once(spark, monkeypatch):
    from lakeingest.session import prepare
    from lakeingest.sources import files
    lab = Lab(spark, "t_binonce")
    rows = spark.createDataFrame([(f"lang=en/p {i}[x].txt", f"text {i}") for i in range(70)], "rel STRING, body STRING")
    lab.land_files(rows, "pages", "d1", "rel", "body")
    ds = lab.dataset("pages", files_source("binaryFile", "pages", options={"pathGlobFilter": "*.txt"}))

    def again(*_):
        raise AssertionError("files listed a second time")
    monkeypatch.setattr(files, "read_files", again)
    result = lab.run(ds)[0]
    assert (result.status, result.rows_ingested) == ("OK", 70)
    bronze = lab.bronze(ds)
    assert bronze.columns == ["path", "modificationTime", "length", "content", "_ingested_filename", "_ingested_filepath",
                              "_ingested_at"]
    theirs = (spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(f"{lab.engine.landing_root}/pages")
              .select("*", "_metadata.file_name", "_metadata.file_path"))
    assert sorted(map(tuple, bronze.drop("_ingested_at").collect())) == sorted(map(tuple, theirs.collect()))
    assert bronze.select("content").distinct().count() == 70
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(listing)
    spark.conf.unset(listing)
    try:
        prepare(spark)
        assert int(spark.conf.get(listing)) <= 8 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set(listing, before)
