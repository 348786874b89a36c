"""Every query of the subpackage that SQL can express, against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from tuneprep.llm import queries

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    cursor = con.execute(queries.ORACLES[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    rows = cursor.fetchall()
    assert got == sorted(repr(tuple(row[found.index(c)] for c in columns)) for row in rows)
    assert got
