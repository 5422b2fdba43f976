"""Every registered query against its DuckDB oracle on the smallest provided tables.

Same check as the driver's gate: column names, row count, order-insensitive value hash.
Streaming queries are marked ``slow`` (each runs several micro-batches); run them with
``pytest -m slow``.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", [pytest.param(n, marks=pytest.mark.slow) if n.endswith("_stream")
                                  else n for n in NAMES])
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    cols = [c[0] for c in cur.description]
    expected = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expected)
    assert digest(df.columns, rows)[0] == digest(cols, expected)[0]


def test_only_queries_that_sql_cannot_express_have_no_oracle():
    """Those are held against brute force in tests of their own."""
    from tributary.plans.queries import QUERIES
    from tributary.streaming.jobs import STREAM_QUERIES
    assert set(SQL) >= QUERIES.keys() | STREAM_QUERIES.keys() and set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["stt", "edt"]
