import uuid

import pytest

from commitlake.operators.quality import (
    Check, assert_passes, not_null, observe_nulls, quality_report, relationships, unique,
)
from commitlake.session import shared_dir


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "k int, v string")
    assert [tuple(r) for r in unique(df, "k").collect()] == [(1, 2)]
    nn = {r["column_name"]: r["failures"] for r in not_null(df, ["k", "v"]).collect()}
    assert nn == {"k": 1, "v": 1}
    parent = spark.createDataFrame([(1,)], "id int")
    assert sorted(r["k"] for r in relationships(df, "k", parent, "id").collect()) == [2]


def test_report_and_severity(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    parent = spark.createDataFrame([(2,)], "id int")
    checks = [Check("t", "unique", "k"), Check("t", "not_null", "v", severity="warn"),
              Check("t", "relationships", "k", severity="warn", parent="p", field="id")]
    report = quality_report({"t": df, "p": parent}, checks)
    got = {(r["check_name"], r["column_name"]): (r["severity"], r["failures"]) for r in report.collect()}
    assert got == {("unique", "k"): ("error", 1), ("not_null", "v"): ("warn", 1),
                   ("relationships", "k"): ("warn", 2)}
    with pytest.raises(AssertionError):
        assert_passes(report)
    warn_only = quality_report({"t": df, "p": parent}, checks[1:])
    assert len(assert_passes(warn_only)) == 2


@pytest.mark.parametrize("rows", [[(1, "a"), (1, None), (None, None)] * 40, []])
def test_nulls_observed_while_writing_need_no_pass(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string")
    checks = [Check("t", "not_null", "v", severity="warn"), Check("t", "not_null", "k"), Check("t", "unique", "k"),
              Check("u", "not_null", "v")]
    assert observe_nulls(df, "other", checks) == (df, None)
    counting, seen = observe_nulls(df.repartition(3), "t", checks)
    path = shared_dir(spark, "tests", f"observed-{uuid.uuid4().hex}")
    counting.write.parquet(path)
    tables = {"t": spark.read.schema(df.schema).parquet(path), "u": df}
    report = quality_report(tables, checks, {"t": seen, "u": None})
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, quality_report(tables, checks).collect()))
    nulls = quality_report(tables, checks[:2], {"t": seen})
    assert "Scan" not in nulls._jdf.queryExecution().executedPlan().toString().replace("Scan ExistingRDD", "")
