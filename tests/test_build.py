import os
import uuid

import pytest
from pyspark.sql import functions as F

from commitlake.operators.quality import MART_CHECKS, Check, assert_passes
from commitlake.plans import docs
from commitlake.plans.build import build_all
from commitlake.session import shared_dir
from commitlake.sources import fixtures as fx
from commitlake.sources.sinks import apply_comments, publish

SF = "/root/testdata/sf0.001"


def test_publish_and_comments(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    path = shared_dir(spark, "tests", "warehouse", name)
    out = publish(spark.createDataFrame([(1, "a")], "k int, v string"), name, path, "test_marts")
    apply_comments(spark, f"test_marts.{name}", "a table", {"k": "the key", "missing": "ignored"})
    desc = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE test_marts.{name}").collect()}
    assert desc["k"] == "the key" and out.count() == 1
    publish(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), name, path, "test_marts")
    assert spark.table(f"test_marts.{name}").count() == 2
    publish(spark.createDataFrame([(1.5,)], "other double"), name, path, "test_marts")      # other columns: made anew
    assert spark.table(f"test_marts.{name}").columns == ["other"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_build_publishes_after_the_gate_and_not_before(spark):
    raw = {name: make(spark, SF) for name, make in fx.RAW_STREAMS.items()}
    root = shared_dir(spark, "tests", f"published-{uuid.uuid4().hex}")
    database = f"built_{uuid.uuid4().hex[:8]}"
    passing = [x for x in MART_CHECKS if (x.table, x.column) != ("commits", "git_author_email")]
    warned = Check("commits", "not_null", "git_author_email", severity="warn")       # the fixture nulls some e-mails
    res = build_all(spark, raw, root, fx.as_of_lit(), publish_to=database, checks=[*passing, warned])
    assert [(r.table_name, r.column_name) for r in res.warnings] == [("commits", "git_author_email")]
    counts = {}
    for name in docs.TABLES:
        table = spark.table(f"{database}.{name}")
        counts[name] = table.count()
        assert counts[name] == res.marts[name].count() > 0
        described = spark.sql(f"DESCRIBE TABLE {database}.{name}").where("col_name NOT LIKE '#%'")
        assert described.where("comment IS NULL OR comment = ''").count() == 0
    before = {n: spark.sql(f"DESCRIBE EXTENDED {database}.{n}").where("col_name = 'Location'").first()[1] for n in docs.TABLES}
    with pytest.raises(AssertionError, match="git_author_email"):
        build_all(spark, raw, root, fx.as_of_lit(), publish_to=database, full_refresh=True)
    for name in docs.TABLES:
        assert spark.sql(f"DESCRIBE EXTENDED {database}.{name}").where("col_name = 'Location'").first()[1] == before[name]
        assert spark.table(f"{database}.{name}").count() == counts[name], "a failed check leaves the published tables"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_build_all_gates_on_error_checks(spark):
    raw = {name: make(spark, SF) for name, make in fx.RAW_STREAMS.items()}
    root = shared_dir(spark, "tests", f"build-{uuid.uuid4().hex}")
    res = build_all(spark, raw, root, fx.as_of_lit(), fail_on_error=False)
    failing = {(r["table_name"], r["column_name"]) for r in res.report.where(F.col("failures") > 0).collect()}
    assert failing == {("commits", "git_author_email")}      # the fixture nulls some author e-mails
    with pytest.raises(AssertionError, match="git_author_email"):
        assert_passes(res.report)                             # what build_all runs before publishing


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_build_from_landed_paths(spark):
    from commitlake.plans.build import build_from_paths
    from commitlake.sources.envelope import write_raw
    root = shared_dir(spark, "tests", f"landed-{uuid.uuid4().hex}")
    paths = {}
    for name, make in fx.RAW_STREAMS.items():
        paths[name] = f"{root}/raw/{name}"
        write_raw(make(spark, SF), paths[name])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    res = build_from_paths(spark, paths, f"{root}/build", as_of=fx.as_of_lit(), fail_on_error=False)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    assert res.marts["commits"].count() == res.staging["commits"].count() > 0
