"""Every registered query against its DuckDB oracle on the smallest data set
(the driver repeats this at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from strata.queries import QUERIES  # noqa: E402

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


def test_every_key_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, small_dir, con, key):
    df = E.queries()[key](spark, small_dir)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert rows_of(df.columns, s_rows) == rows_of(o_cols, o_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["category", "revenue", "orders", "pct_revenue"]


def test_oracle_needs_no_spark_session():
    """The oracle SQL is plain text: building it must not touch Spark."""
    import subprocess
    code = ("import __spark_entry__ as E; from pyspark import SparkContext; "
            "o = E.oracle_sql(); assert SparkContext._active_spark_context is None; print(len(o))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.strip().splitlines()[-1]) >= len(QUERIES)
