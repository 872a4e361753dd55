"""A landing zone + lakehouse in the shared scratch folder, fed from existing tables.

Used by the registered queries, the tests and the benchmark: drops are written
from the driver's tables *with Spark* (so their size grows with the tables),
the engine ingests them, and the bronze tables are read back.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import (list_names, make_folder, new_area, rename_path, set_file_time, ship_package,
                       task_filesystem)
from ..spec import DatasetSpec, EngineSpec
from ..streaming.catalog import audit_table_name
from ..streaming.runner import run_ingestion


class Lab:
    def __init__(self, spark: SparkSession, label: str, **engine_extra: Any):
        self.spark = spark
        ship_package(spark)
        self.area = new_area(spark, label)
        tag = uuid.uuid4().hex[:8]
        self.engine = EngineSpec.from_dict({
            "catalog": "spark_catalog",
            "landing_root": f"{self.area}/landing",
            "lakehouse_root": f"{self.area}/lakehouse",
            "bronze_schema": f"bronze_{label}_{tag}",
            "ops_schema": f"ops_{label}_{tag}",
            "audit_path": f"{self.area}/lakehouse/ops/ingestion_audit",
            "register_tables": False,
            **engine_extra,
        })

    def land(self, df: DataFrame, dataset: str, drop: str, fmt: str, **options: str) -> str:
        """Write ``df`` as one drop (a sub-folder) of a dataset's landing folder."""
        path = f"{self.engine.landing_root}/{dataset}/{drop}"
        df.write.format(fmt).options(**options).save(path)
        return path

    def land_files(self, df: DataFrame, dataset: str, drop: str, relpath: str, content: str) -> int:
        """Write one file per row: ``content`` (binary or text) at ``{landing}/{dataset}/{drop}/{relpath}``.

        Each task writes its own rows with deterministic names, so a retried task
        overwrites its files instead of adding copies. Returns the number of files.
        """
        base = f"{self.engine.landing_root}/{dataset}/{drop}"

        def write(batches):
            import pandas as pd
            filesystem, root = task_filesystem(base)
            n = 0
            for pdf in batches:
                for rel, body in zip(pdf["_rel"], pdf["_body"]):
                    target = f"{root}/{rel}"
                    filesystem.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    with filesystem.open_output_stream(target) as out:
                        out.write(body if isinstance(body, (bytes, bytearray)) else str(body).encode("utf-8"))
                    n += 1
            yield pd.DataFrame({"n": [n]})

        rows = df.select(F.col(relpath).alias("_rel"), F.col(content).alias("_body"))
        return int(rows.mapInPandas(write, "n LONG").agg(F.sum("n")).first()[0] or 0)

    def engine_landing(self, dataset: str) -> str:
        """The landing folder of a dataset, created empty if it does not exist."""
        path = f"{self.engine.landing_root}/{dataset}"
        make_folder(self.spark, path)
        return path

    def set_times(self, folder: str, millis: int) -> None:
        """Give all files of a drop the same modification time."""
        for name in list_names(self.spark, folder):
            set_file_time(self.spark, f"{folder}/{name}", millis)

    def rename_files(self, folder: str, target: str, prefix: str) -> None:
        """Move the data files of a drop to another folder, with a prefix to their names."""
        root = self.engine.landing_root
        make_folder(self.spark, f"{root}/{target}")
        for name in list_names(self.spark, f"{root}/{folder}"):
            if name[0] not in "._":
                rename_path(self.spark, f"{root}/{folder}/{name}", f"{root}/{target}/{prefix}{name}")

    def land_csv_parts(self, df: DataFrame, dataset: str, drop: str) -> int:
        """Write ``df`` as CSV files named after their partition (``part-00000.csv`` ...).

        Writing again with the same partitioning rewrites the same file names;
        that is how a source re-delivers a file under an existing name.
        """
        base = f"{self.engine.landing_root}/{dataset}/{drop}"

        def write(batches):
            import pandas as pd
            from pyspark import TaskContext
            batches = (pdf for pdf in batches if len(pdf))
            n, pdf = 0, next(batches, None)
            if pdf is not None:
                filesystem, root = task_filesystem(base)
                filesystem.create_dir(root, recursive=True)
                with filesystem.open_output_stream(f"{root}/part-{TaskContext.get().partitionId():05d}.csv") as out:
                    while pdf is not None:
                        out.write(pdf.to_csv(None, index=False, header=n == 0).encode("utf-8"))
                        n, pdf = n + len(pdf), next(batches, None)
            yield pd.DataFrame({"n": [n]})

        return int(df.mapInPandas(write, "n LONG").agg(F.sum("n")).first()[0] or 0)

    def dataset(self, name: str, source: dict[str, Any], sink: dict[str, Any] | None = None,
                datasource: str = "lab") -> DatasetSpec:
        return DatasetSpec.from_dict({"datasource": datasource, "dataset": name, "source": source,
                                      "sink": sink or {}}, f"{name}.json")

    def run(self, *datasets: DatasetSpec, run_id: str | None = None):
        return run_ingestion(self.spark, self.engine, list(datasets), run_id=run_id)

    def bronze(self, ds: DatasetSpec) -> DataFrame:
        """The bronze table, read with the schema its sink recorded (no footer merge)."""
        from ..streaming.sink import BATCH, read_table, sink_format, table_path
        return read_table(self.spark, table_path(ds, self.engine), sink_format(ds, self.engine)).drop(BATCH)

    def audit(self) -> DataFrame:
        return self.spark.read.table(audit_table_name(self.spark, self.engine))
