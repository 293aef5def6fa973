"""Every catalogue query with a SQL twin agrees with DuckDB on the derived
panel (sf0.001 here; the driver repeats this at sf0.01)."""

import pytest

from conftest import SF_SMALL
from oracle_harness import compare, duck

import __spark_entry__ as entry

SQL = entry.oracle_sql()
KEYS = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[key])
    dcols = [c[0] for c in cur.description]
    problems = compare(srows, df.columns, cur.fetchall(), dcols)
    assert not problems, problems


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
