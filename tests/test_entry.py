"""The driver contract: entry() runs, every query runs on the smallest
tables, and every oracle agrees with its Spark query."""

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, norm  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "tp", "support", "predicted", "precision", "recall", "f1"]
    assert len(rows) >= 1


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_against_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    cur = duck.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    d_rows = [tuple(norm(r[i]) for i in idx) for r in cur.fetchall()]
    assert Counter(s_rows) == Counter(d_rows)
