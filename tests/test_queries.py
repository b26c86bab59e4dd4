"""Every registered query against its DuckDB SQL on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, digest  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["greeter", "count"] and len(rows) > 0


def test_every_query_has_sql():
    """Of the topic-log queries; training-data queries that SQL can't express
    are tested by brute force in tests/llm."""
    from tidelog.plans.oracle import ORACLE_SQL
    from tidelog.plans.queries import QUERIES, ROWS_ONLY
    assert set(QUERIES) - ROWS_ONLY == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_rows_only_queries_run(spark):
    from tidelog.plans.queries import ROWS_ONLY
    for name in ROWS_ONLY:
        df = E.queries()[name](spark, SF_SMALL)
        rows = df.collect()
        assert len(rows) > 0
        if "id" in df.columns:
            assert len({r.id for r in rows}) == len(rows)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    sc, sh, _ = digest(df.columns, srows)
    dc, dh, _ = digest(dcols, drows)
    assert sc == dc
    assert len(srows) == len(drows)
    assert sh == dh
