"""Every registered query against its SQL, on the smallest tables."""

import warnings
from pathlib import Path

import __spark_entry__ as registry
import pytest

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_each_query_has_sql():
    assert registry.own_queries().keys() <= registry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(registry.own_queries()))
def test_query_agrees_with_sql(spark, tables, name):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = registry.own_queries()[name](spark, str(DATA))
        columns = sorted(df.columns)
        got = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    cursor = tables.execute(registry.oracle_sql()[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    rows = cursor.fetchall()
    assert got == sorted(repr(tuple(row[found.index(c)] for c in columns)) for row in rows)
    assert got


def test_flagship(spark):
    assert registry.entry(spark).count() > 0
