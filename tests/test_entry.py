"""Every registered genomics query with SQL has a like-named entry and gives what it gives."""

import duckdb
import pytest

import __spark_entry__ as entry
from readloom.jobs import queries as jobs

SF = "/root/testdata/sf0.001"


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "lineitem", "orders", "part", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(jobs.SQL))
def test_matches_sql(spark, con, name):
    """Values are equal to the last bit."""
    got = entry.queries()[name](spark, SF)
    columns = ", ".join(f'"{c}"' for c in sorted(got.columns))
    want = con.sql(f"SELECT {columns} FROM ({entry.oracle_sql()[name]}) x").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*sorted(got.columns)).collect()))) == sorted(map(repr, want))
