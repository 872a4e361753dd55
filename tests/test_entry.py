"""Driver contract: smoke entry, registry consistency, every query against its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as entry
from lakeingest.plans.registry import QUERIES, load_all
from scripts.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["o_orderstatus", "orders", "total_price", "rescued"]
    assert sum(r["orders"] for r in rows) == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert all(r["rescued"] == 0 for r in rows)


load_all()
CORE = sorted([*QUERIES, "flagship_orders_by_status"])


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(entry.queries())
    assert set(CORE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]
