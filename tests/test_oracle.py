"""Every registered query with an oracle matches DuckDB on sf0.001 (same compare as tools/oracle_check)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from codeindex.session import TABLES
from tools.oracle_check import digest

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns
        return
    cur = con.execute(ORACLE[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert digest(df.columns, rows)[:3] == digest(ocols, orows)[:3]
