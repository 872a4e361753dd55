"""Catalog side of a run: schemas, external bronze tables, the audit table."""

from __future__ import annotations

import logging
import re

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..functions import nested
from ..spec import DatasetSpec, EngineSpec
from .sink import BATCH, FILE_SINK_FORMATS, data_path, sink_format, table_path, table_schema, with_batch

log = logging.getLogger(__name__)

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("datasource", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("source_format", T.StringType()),
    T.StructField("sink_path", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("rows_ingested", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


def _catalog_known(spark: SparkSession, catalog: str) -> bool:
    return bool(catalog) and (catalog == "spark_catalog"
                              or spark.conf.get(f"spark.sql.catalog.{catalog}", None) is not None)


def qualified(spark: SparkSession, engine: EngineSpec, schema: str, table: str | None = None) -> str:
    """``catalog.schema[.table]`` when the catalog is configured in the session, else ``schema[.table]``."""
    parts = [engine.catalog] if _catalog_known(spark, engine.catalog) else []
    parts.append(schema)
    if table:
        parts.append(table)
    return ".".join(f"`{p}`" for p in parts)


def bronze_table_name(spark: SparkSession, engine: EngineSpec, ds: DatasetSpec) -> str:
    return qualified(spark, engine, engine.bronze_schema, f"{ds.datasource}_{ds.dataset}")


def audit_table_name(spark: SparkSession, engine: EngineSpec) -> str:
    return qualified(spark, engine, engine.ops_schema, engine.audit_table)


_BOOTSTRAPPED: set[tuple[str, str, str, str]] = set()


def bootstrap(spark: SparkSession, engine: EngineSpec, force: bool = False) -> None:
    """Create the bronze and ops schemas and the audit table when absent (once per application)."""
    key = (spark.sparkContext.applicationId, engine.bronze_schema, engine.ops_schema, audit_table_name(spark, engine))
    if key in _BOOTSTRAPPED and not force:
        return
    for schema in (engine.bronze_schema, engine.ops_schema):
        location = f"{engine.lakehouse_root}/_catalog/{schema}.db"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {qualified(spark, engine, schema)} LOCATION '{location}'")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in AUDIT_SCHEMA.fields)
    location = f" LOCATION '{engine.resolve_path(engine.audit_path)}'" if engine.audit_path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {audit_table_name(spark, engine)} ({ddl}) USING parquet{location}")
    _BOOTSTRAPPED.add(key)


class TableConflictError(RuntimeError):
    """The catalog name belongs to another table; it is left alone."""


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """The detailed information rows of DESCRIBE TABLE EXTENDED."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"]}


def _plain(uri: str) -> str:
    return re.sub(r"^file:/+", "/", uri or "").rstrip("/")


def _earlier_generation(location: str, home: str, current: str) -> bool:
    """Whether a location holds another generation of the table at ``home`` than its current one."""
    return location != current and re.fullmatch(re.escape(home) + r"(\.generation-\d+)?", location) is not None


def register_table(spark: SparkSession, engine: EngineSpec, ds: DatasetSpec) -> str:
    """Declare the bronze table as an external table over its path.

    The schema is the one the sink recorded beside the table, so no file is opened. An existing table of that name must
    be at the same location: then its missing columns are added. One at an earlier generation of the same table is declared
    anew at the current one. Any other table (a managed one, or one of another
    dataset whose names join to the same text) is never touched.
    """
    name = bronze_table_name(spark, engine, ds)
    fmt, home = sink_format(ds, engine), table_path(ds, engine)
    path = data_path(spark, home) if fmt in FILE_SINK_FORMATS else home
    schema = table_schema(spark, path)
    create = f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'"
    if schema:
        schema = with_batch(schema)
        parts = ", ".join(f"`{p}`" for p in [BATCH, *ds.sink.get("partition_by", [])])
        columns = ", ".join(_column(f) for f in schema.fields)
        create = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} PARTITIONED BY ({parts}) LOCATION '{path}'"
    if not spark.catalog.tableExists(name.replace("`", "")):
        spark.sql(create)
    else:
        found = _described(spark, name)
        if _earlier_generation(_plain(found.get("Location", "")), _plain(home), _plain(path)):
            spark.sql(f"DROP TABLE {name}")     # the declaration of an external table; its files stay
            spark.sql(create)
            found = _described(spark, name)
        if found.get("Type", "").upper() == "MANAGED" or _plain(found.get("Location", "")) != _plain(path):
            raise TableConflictError(f"{name} is another table (at {found.get('Location')}); it is left as it is")
        known = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
        new = [f for f in (schema.fields if schema else []) if f.name.lower() not in known]
        grown = [f for f in (schema.fields if schema else [])
                 if f.name.lower() in known and not nested.same(known[f.name.lower()], f.dataType)]
        if grown:
            # A field was added inside a column: the declaration of an external table is made anew, its files stay.
            spark.sql(f"DROP TABLE {name}")
            spark.sql(create)
        elif new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(_column(f) for f in new)})")
    if _described(spark, name).get("Partition Provider") == "Catalog":
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
    log.info("[%s] registered as %s", ds.name, name)
    return name


def _column(field) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}"
