"""Registered queries against the DuckDB oracle on the smallest driver scale."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as entry
from commitlake import registry

SF = "/root/testdata/sf0.001"
NAMES = [name for name in entry.oracle_sql() if name in registry.QUERIES]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            if isinstance(v, float):
                v = round(v, 9)
            elif isinstance(v, (dt.date, dt.datetime)):
                v = v.isoformat()
            vals.append(v)
        out.append(repr(tuple(vals)))
    return sorted(out)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events", "part"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(orows, ocols)


def test_registry_is_complete():
    assert set(registry.QUERIES) <= set(entry.oracle_sql()) and set(registry.QUERIES) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "committer_id" in df.columns
