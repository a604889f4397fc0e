"""The document queries that SQL can express, against DuckDB on the smallest driver scale."""

import duckdb
import pytest

from commitlake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    got = [tuple(r) for r in found.select(*columns).collect()]
    rounded = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert rounded(got) == rounded(want)
