import random
import uuid

import pytest
from pyspark.sql import functions as F

from commitlake.operators import PartitionedTable, incremental_run
from commitlake.operators import partitioned
from commitlake.session import shared_dir

SCHEMA = "k long, t timestamp, w long, v string"


def new_table(spark, grain="month"):
    return PartitionedTable(spark, shared_dir(spark, "tests", f"month-{uuid.uuid4().hex}"), "t", grain, ["w"])


def rows_of(frame):
    return sorted(((r.k is None, r.k or 0), str(r.t), r.w, r.v) for r in frame.collect())


def files_of(table):
    return {r[0]: r[1] for r in table.read().select(F.input_file_name().alias("f"), F.col("_metadata.file_size").alias("n")).distinct().collect()}


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "k long, day int, w long, v string").select(
        "k", F.timestamp_seconds(F.col("day") * 86400 + 1_700_000_000).alias("t"), "w", "v")


@pytest.mark.parametrize("broadcast", [1 << 25, 0])
def test_random_batches_equal_one_big_upsert(spark, monkeypatch, broadcast):
    monkeypatch.setattr(partitioned, "BROADCAST_BYTES", broadcast)
    rng = random.Random(broadcast)
    table, kept = new_table(spark), {}
    for w in range(5):
        batch = {rng.randrange(60): (None if rng.random() < 0.1 else rng.randrange(300), w, f"v{w}") for _ in range(40)}
        frame = frame_of(spark, [(k, *x) for k, x in batch.items()])
        table.merge(frame, ["k"]) if w else table.write(frame)
        kept |= batch
        assert rows_of(table.read()) == rows_of(frame_of(spark, [(k, *x) for k, x in kept.items()]))
        assert table.high_watermark("w") == w and set(table.read().columns) == {"k", "t", "w", "v"}


def test_a_recent_batch_rewrites_few_bytes(spark):
    """A tenth of all rows, all recent: under a quarter of the bytes is written anew, the other files stay as they are."""
    table = new_table(spark)
    table.write(frame_of(spark, [(i, i // 10, 0, f"text {i} " * 20) for i in range(7200)]))
    before = files_of(table)
    table.merge(frame_of(spark, [(i, i // 10, 1, "new " * 20) for i in range(6840, 7560)]), ["k"])
    after = files_of(table)
    written = sum(n for f, n in after.items() if f not in before)
    assert written < 0.25 * sum(after.values()) and len(set(before) & set(after)) > 15
    assert table.read().count() == 7560
    recent = table.since(F.timestamp_seconds(F.lit(740 * 86400 + 1_700_000_000)))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and recent.count() == 160


def test_a_period_whose_rows_have_all_moved_is_removed(spark):
    table = new_table(spark)
    table.write(frame_of(spark, [(1, 0, 0, "a"), (2, 100, 0, "b"), (3, None, 0, "c")]))
    table.merge(frame_of(spark, [(1, 100, 1, "moved"), (3, 100, 1, "dated")]), ["k"])
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "moved"), (2, "b"), (3, "dated")]
    assert len(table.periods()) == 1
    assert table.merge(table.read().limit(0), ["k"]).count() == 3


def test_order_keeps_the_better_row_in_its_period(spark):
    table = new_table(spark, "day")
    table.write(frame_of(spark, [(1, 0, 5, "old"), (2, 0, 5, "old")]))
    out = table.merge(frame_of(spark, [(1, 9, 4, "late"), (2, 9, 6, "new")]), ["k"], [F.col("w").desc()])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "old"), (2, "new")]
    out = table.merge(frame_of(spark, [(1, 9, 7, "newer")]), ["k"], [F.col("w").desc()])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "newer"), (2, "new")] and len(table.periods()) == 1


def test_a_lost_merge_is_repeated(spark, monkeypatch):
    """The watermark moves last: a run that is lost after it has replaced a period loads the same rows again."""
    table = new_table(spark)
    first, both = [(1, 0, 1, "a"), (2, 40, 1, "b")], [(1, 0, 1, "a"), (2, 40, 1, "b"), (1, 0, 2, "A"), (2, 40, 2, "B"), (3, 80, 2, "C")]
    model = lambda df: df
    incremental_run(frame_of(spark, first), model, table, ["k"], "w")
    with monkeypatch.context() as m:
        m.setattr(table, "_leave_state", lambda _: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental_run(frame_of(spark, both), model, table, ["k"], "w")
    out = incremental_run(frame_of(spark, both), model, table, ["k"], "w")
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "A"), (2, "B"), (3, "C")]


def test_a_clashing_column_is_refused(spark):
    with pytest.raises(ValueError, match="period"):
        new_table(spark).write(frame_of(spark, [(1, 0, 0, "a")]).withColumn("period", F.lit(1)))


@pytest.mark.parametrize("broadcast", [1 << 25, 300, 0])
def test_random_batches_in_rounds_equal_one_big_upsert(spark, monkeypatch, broadcast):
    """Every round a few periods, some of them emptied, with NULL and repeated keys in the old rows."""
    monkeypatch.setattr(partitioned, "ROUND_BYTES", 0)
    monkeypatch.setattr(partitioned, "BROADCAST_BYTES", broadcast)
    rng = random.Random(broadcast + 1)
    table = new_table(spark)
    kept = [(rng.choice([None, *range(30)]), rng.choice([None, *range(0, 300, 50)]), 0, f"old {i}") for i in range(60)]
    table.write(frame_of(spark, kept))
    for w in (1, 2):
        batch = [(k, rng.choice([None, 20, 200, 400]), w, f"v{w}") for k in [None, *rng.sample(range(35), 20)]]
        table.merge(frame_of(spark, batch), ["k"])
        keys = {k for k, *_ in batch if k is not None}
        kept = [r for r in kept if r[0] not in keys] + batch
        assert rows_of(table.read()) == rows_of(frame_of(spark, kept))
        assert table.high_watermark("w") == w
        held = table.read().select(F.date_format("t", "'m'yyyy-MM")).distinct().collect()
        assert set(table.periods()) == {r[0] or partitioned.NO_TIME for r in held}


def test_many_keys_leave_old_rows_in_place(spark, monkeypatch):
    """A batch with too many keys to broadcast at once: the rounds do, and no old row is exchanged."""
    monkeypatch.setattr(partitioned, "BROADCAST_BYTES", 10_000)
    table = new_table(spark)
    table.write(frame_of(spark, [(i, i // 10, 0, f"text {i}") for i in range(7200)]))
    puts, put = [], table._put
    monkeypatch.setattr(table, "_put", lambda rows, mode: puts.append(rows._jdf.queryExecution().executedPlan().toString()) or put(rows, mode))
    table.merge(frame_of(spark, [(i, i // 10, 1, "new") for i in range(0, 7200, 2)]), ["k"])
    assert 1 < len(puts) <= partitioned.ROUNDS + 1
    assert all("BroadcastHashJoin" in p and "SortMergeJoin" not in p and p.count("REBALANCE") == 1 for p in puts)
    assert table.read().count() == 7200 and table.read().where("v = 'new'").count() == 3600


def test_a_merge_lost_between_rounds_is_repeated(spark, monkeypatch):
    monkeypatch.setattr(partitioned, "ROUND_BYTES", 0)
    table = new_table(spark)
    first, both = [(1, 0, 1, "a"), (2, 40, 1, "b")], [(1, 0, 1, "a"), (2, 40, 1, "b"), (1, 40, 2, "A"), (2, 0, 2, "B"), (3, 80, 2, "C")]
    incremental_run(frame_of(spark, first), lambda df: df, table, ["k"], "w")
    put, calls = table._put, []
    with monkeypatch.context() as m:
        m.setattr(table, "_put", lambda *x: put(*x) if not calls.append(1) and len(calls) < 2 else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental_run(frame_of(spark, both), lambda df: df, table, ["k"], "w")
    assert table.high_watermark("w") == 1
    out = incremental_run(frame_of(spark, both), lambda df: df, table, ["k"], "w")
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "A"), (2, "B"), (3, "C")] and table.high_watermark("w") == 2
