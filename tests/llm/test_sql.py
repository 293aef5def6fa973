"""Queries against their SQL."""

import sys

import pytest
from llm_cases import SF_SMALL  # noqa: F401

import __spark_entry__ as entry
from shopcast.llm.queries import QUERIES, SQL

sys.path.insert(0, __file__.rsplit("/", 2)[0])
from oracle_harness import compare, duck  # noqa: E402


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(entry.oracle_sql()[key])
    columns = [c[0] for c in cur.description]
    rows = cur.fetchall()
    assert not compare([tuple(r) for r in df.collect()], df.columns, rows, columns) and len(rows) == 200
