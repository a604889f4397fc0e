"""Operators checked against brute-force Python on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from commitlake.operators import (
    VersionedTable, global_rank, incremental_run, keep_latest, latest_by, left_join_dim, mode_by, rank_by_value, upsert, watermark_filter,
)
from commitlake.session import shared_dir


def test_keep_latest_orders_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 3, 3), ("b", None, 4), (None, 1, 5)],
                               "k string, ts int, id int")
    got = {r["k"]: r["id"] for r in keep_latest(df, ["k"], [F.col("ts").desc()]).collect()}
    assert got == {"a": 2, "b": 4, None: 5}


def test_mode_by_null_bucket_wins_ties(spark):
    df = spark.createDataFrame([(1, None), (1, 3), (2, 4), (2, 4), (2, 1), (3, 7), (3, 2)], "k int, v int")
    got = {r["k"]: r["m"] for r in mode_by(df, "k", "v", out="m").collect()}
    assert got == {1: None, 2: 4, 3: 2}
    got = {r["k"]: r["m"] for r in mode_by(df, "k", "v", out="m", null_bucket=False).collect()}
    assert got == {1: 3, 2: 4, 3: 2}


def test_latest_by_keeps_rows_with_null_order(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (2, 5, "p"), (2, None, "q")],
                               "k int, ts int, v string")
    got = {r["k"]: r["v"] for r in latest_by(df, "k", ["ts", "v"], ["v"]).collect()}
    assert got == {1: "y", 2: "p"}


def test_global_rank_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 20)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, score long").repartition(5)
    ranked = global_rank(df, [F.col("score").desc(), F.col("id").asc()], "rk")
    got = {r["id"]: r["rk"] for r in ranked.collect()}
    expected = {row[0]: i + 1 for i, row in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == expected


def test_upsert_replaces_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    got = sorted((r["k"] or -1, r["v"]) for r in upsert(target, batch, ["k"]).collect())
    assert got == [(-1, "n"), (1, "a"), (2, "B"), (3, "C")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got_shuffle = sorted((r["k"] or -1, r["v"]) for r in upsert(target, batch, ["k"]).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got_shuffle == got


def test_watermark_filter_semantics(spark):
    src = spark.createDataFrame([(1,), (5,), (7,)], "w int")
    tgt = spark.createDataFrame([(5,)], "w int")
    empty = spark.createDataFrame([], "w int")
    assert sorted(r[0] for r in watermark_filter(src, tgt, "w").collect()) == [7]      # equal value skipped
    assert watermark_filter(src, empty, "w").count() == 0                             # empty target loads nothing
    assert watermark_filter(src, empty, "w", empty_target="load_all").count() == 3
    assert watermark_filter(src, None, "w").count() == 3                              # first run


def test_timestamp_watermark_is_pushed_to_scan(spark):
    path = shared_dir(spark, "tests", "wm-scan")
    spark.sql("SELECT id, timestamp_seconds(id * 3600) AS t FROM range(100)").write.mode("overwrite").parquet(path)
    src = spark.read.parquet(path)
    tgt = spark.sql("SELECT timestamp_seconds(50 * 3600) AS t")
    out = watermark_filter(src, tgt, "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), GreaterThan(t," in plan
    assert out.count() == 49


def test_incremental_run_versions(spark):
    table = VersionedTable(spark, shared_dir(spark, "tests", f"vt-{random.random()}"))
    src1 = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, w int")
    src2 = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "B", 2), (3, "c", 2)], "k int, v string, w int")
    model = lambda df: df
    incremental_run(src1, model, table, ["k"], "w")
    out = incremental_run(src2, model, table, ["k"], "w")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]
    assert table.versions() == [1, 2]
    full = incremental_run(src1, model, table, ["k"], "w", full_refresh=True)
    assert full.count() == 2 and table.versions() == [1, 2, 3]


def test_versioned_table_skips_folders_without_a_commit(spark):
    root = shared_dir(spark, "tests", f"vt-crash-{random.random()}")
    table = VersionedTable(spark, root)
    table.write(spark.createDataFrame([(1,)], "k int"))
    spark.createDataFrame([(9,)], "k int").write.parquet(f"{root}/v=000002")    # a job lost before its commit
    assert table.versions() == [1] and table.read().first()["k"] == 1
    out = table.write(spark.createDataFrame([(2,)], "k int"))
    assert table.versions() == [1, 3] and out.first()["k"] == 2


def test_merge_rewrites_only_files_with_a_key_of_the_batch(spark):
    table = VersionedTable(spark, shared_dir(spark, "tests", f"vt-merge-{random.random()}"), ["t", "k"], ["t"])
    rows = spark.range(4000).selectExpr("id AS k", "id AS t", "repeat('x', 40) AS v").repartition(7)
    advisory = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table.write(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", advisory)
    before = set(table.files())
    assert len(before) > 4 and table.high_watermark("t") == 3999
    batch = spark.createDataFrame([(3990, 5000, "new"), (4100, 5001, "new")], "k long, t long, v string")
    out = table.merge(batch, ["k"])
    after = set(table.files())
    assert len(before - after) == 1 and len(before & after) == len(before) - 1, "the other files are still the same"
    assert out.count() == 4001 and table.high_watermark("t") == 5001
    assert {r.k for r in out.where("v = 'new'").collect()} == {3990, 4100}
    table.vacuum()
    assert table.versions() == [2] and table.read().count() == 4001
    assert table.folder().endswith("v=000003") and table.read().count() == 4001


def test_merge_with_an_order_keeps_the_better_row(spark):
    table = VersionedTable(spark, shared_dir(spark, "tests", f"vt-order-{random.random()}"))
    table.write(spark.createDataFrame([(1, 5, "old"), (2, 5, "old")], "k int, t int, v string"))
    out = table.merge(spark.createDataFrame([(1, 4, "late"), (2, 6, "new"), (3, 1, "new")], "k int, t int, v string"),
                      ["k"], [F.col("t").desc()])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 5, "old"), (2, 6, "new"), (3, 1, "new")]


def test_event_time_filter_skips_files(spark):
    """A table clustered by time: a filter on recent times reads few of its rows."""
    table = VersionedTable(spark, shared_dir(spark, "tests", f"vt-prune-{random.random()}"), ["t", "k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = table.write(spark.range(8000).selectExpr("(id * 7919) % 8000 AS k", "timestamp_seconds(id * 60) AS t").repartition(5))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = [r.high - r.low for r in out.groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.unix_seconds("t")).alias("low"), F.max(F.unix_seconds("t")).alias("high")).collect()]
    assert len(spans) > 4 and sum(spans) <= 8000 * 60, "files do not overlap in time"
    recent = out.where(F.col("t") > F.timestamp_seconds(F.lit(7900 * 60)))
    assert recent.select(F.input_file_name()).distinct().count() <= 2


def test_left_join_dim_keeps_null_keys(spark):
    fact = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (9, "d")], "k int, v string")
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    got = sorted(((r.k, r.v, r.name) for r in left_join_dim(fact, dim, "k").collect()), key=str)
    assert got == sorted([(1, "a", "one"), (None, "b", None), (None, "c", None), (9, "d", None)], key=str)


def test_tune_shuffle_partitions_only_raises(spark):
    from commitlake.session import tune_shuffle_partitions
    path = shared_dir(spark, "tests", f"size-{random.random()}")
    spark.range(20000).selectExpr("id", "repeat('x', 50) AS pad").write.parquet(path)
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert tune_shuffle_partitions(spark, [path], target_bytes=10**9) == before
    raised = tune_shuffle_partitions(spark, [path], target_bytes=1024)
    assert raised > before
    spark.conf.set("spark.sql.shuffle.partitions", str(before))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)


def test_remove_scratch(spark):
    from commitlake.session import remove_scratch
    path = shared_dir(spark, "tests", "to-remove")
    spark.range(3).write.mode("overwrite").parquet(path)
    remove_scratch(spark, "tests", "to-remove")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def test_global_rank_empty_input(spark):
    df = spark.createDataFrame([], "id long, score long")
    assert global_rank(df, [F.col("score").desc(), F.col("id")], "rk").count() == 0


@pytest.mark.parametrize("lane_rows", [1_000_000, 300, 7])
def test_rank_by_value_matches_brute_force(spark, lane_rows):
    """A third of all rows share one value; NULL, negative and far apart values, clashing column names."""
    rows = [(i * 7919 % 3001, 0 if i % 3 == 0 else (None if i % 11 == 0 else (-5, 2**39, 2**21, i % 40, -2**33)[i % 5]), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, score long, n int").repartition(5)
    got = {r.id: r.rk for r in rank_by_value(df, "score", "id", "rk", lane_rows).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(want)}


def test_rank_by_value_lanes_spread_one_value(spark):
    df = spark.range(20_000).select("id", F.lit(3).alias("score"))
    ranked = rank_by_value(df, "score", "id", "rk", 1_000)
    assert ranked.where(F.col("rk") != F.col("id") + 1).count() == 0
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "_lane" in plan
    assert rank_by_value(df.limit(0), "score", "id", "rk").count() == 0
    every_null = df.select("id", F.lit(None).cast("long").alias("score"))
    assert rank_by_value(every_null, "score", "id", "rk", 900).where(F.col("rk") != F.col("id") + 1).count() == 0
