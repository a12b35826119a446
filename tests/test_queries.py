"""Every registered query against its SQL check on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from farelake.registry import QUERIES
from oracles import collect
from tools.check import TABLES, cell

SQL = collect()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_a_check():
    assert set(QUERIES) == set(collect())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(os.environ.get("SKIP_QUERIES") == "1", reason="left out on request")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    rel = con.sql(SQL[name])
    assert sorted(rel.columns) == columns
    want = rel.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(tuple(cell(v) for v in r) for r in rows) == sorted(tuple(cell(v) for v in r) for r in want)
