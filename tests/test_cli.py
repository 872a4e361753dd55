"""The launcher: validates all files, runs the selected datasets, reports."""

import json

from lakeingest.__main__ import main
from lakeingest.session import new_area


def test_launcher_runs_selected_datasets(spark, small_dir, tmp_path, capsys):
    area = new_area(spark, "cli")
    spark.read.parquet(f"{small_dir}/orders.parquet").write.option("header", "true").csv(f"{area}/landing/orders/d1")
    (tmp_path / "engine.json").write_text(json.dumps({
        "catalog": "spark_catalog", "landing_root": f"{area}/landing", "lakehouse_root": f"{area}/lakehouse",
        "register_tables": False, "audit_path": "{lakehouse}/ops/audit", "ops_schema": "ops_cli"}))
    datasets = tmp_path / "datasets"
    datasets.mkdir()
    src = {"type": "files", "format": "csv", "path": "{landing}/orders", "options": {"header": "true",
           "recursiveFileLookup": "true"}, "schema": "o_orderkey BIGINT, o_custkey BIGINT"}
    (datasets / "01.json").write_text(json.dumps({"datasource": "shop", "dataset": "orders", "source": src, "sink": {}}))
    (datasets / "02.json").write_text(json.dumps({"datasource": "shop", "dataset": "other", "source": src, "sink": {}}))
    code = main(["--engine", str(tmp_path / "engine.json"), "--datasets", str(datasets), "--only", " shop.orders ,"])
    assert code == 0
    out = capsys.readouterr().out
    assert "shop.orders" in out and "shop.other" not in out
    audit = spark.read.parquet(f"{area}/lakehouse/ops/audit").collect()
    assert [(r["dataset"], r["rows_ingested"]) for r in audit] == [("orders", 1500)]
