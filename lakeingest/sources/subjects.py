"""Message schemas by subject: a small table of registered versions.

Rows are ``subject, version, id, schema_json``. The latest version of a
subject is the reader schema; every version is available by id, so a message
is decoded with the schema it was written with. The table holds schema
versions only (bounded by how often a subject changes), so reading it to the
driver is cheap.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..spec import EngineSpec, SpecError

SUBJECTS_SCHEMA = "subject STRING, version INT, id INT, schema_json STRING"


def subject_versions(spark: SparkSession, engine: EngineSpec, subject: str) -> tuple[str, dict[int, str]]:
    """(latest schema, {id: schema}) of a subject."""
    if not engine.schema_table_path:
        # No HTTP client here: the registry content is exported to a table.
        raise SpecError(f"no schema table configured (engine 'schema_table_path') for subject '{subject}'")
    path = engine.resolve_path(engine.schema_table_path)
    try:
        df = spark.read.schema(SUBJECTS_SCHEMA).parquet(path).where(F.col("subject") == subject)
        rows = df.select("version", "id", "schema_json").collect()
    except AnalysisException as exc:
        raise SpecError(f"schema table {path} unreadable: {exc}") from exc
    if not rows:
        raise SpecError(f"subject '{subject}' not found in {path}")
    latest = max(rows, key=lambda r: r["version"])["schema_json"]
    return latest, {r["id"]: r["schema_json"] for r in rows}


def write_subjects(spark: SparkSession, path: str, rows: list[tuple[str, int, int, str]]) -> None:
    spark.createDataFrame(rows, SUBJECTS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
