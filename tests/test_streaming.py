import json
import uuid
from datetime import datetime, timezone
from pathlib import Path

from commitlake.operators import VersionedTable
from commitlake.plans import stg_commits
from commitlake.plans.staging import latest_first
from commitlake.session import shared_dir
from commitlake.sources.schemas import ENVELOPE
from commitlake.streaming import stream_upsert


def _batch(spark, rows, day, first=0):
    t = datetime(2024, 2, day, tzinfo=timezone.utc)
    data = [(json.dumps({"sha": sha, "commit_timestamp": "2024-01-05T00:00:00Z", "commit": {"message": msg}}),
             t, t, t, None, i, 1) for i, (sha, msg) in enumerate(rows, first)]
    return spark.createDataFrame(data, ENVELOPE)


def test_available_now_stream_upserts_each_new_file(spark):
    run = uuid.uuid4().hex
    landing = shared_dir(spark, "tests", f"landing-{run}")
    table = VersionedTable(spark, shared_dir(spark, "tests", f"stream-table-{run}"))
    checkpoint = shared_dir(spark, "tests", f"stream-ckpt-{run}")
    _batch(spark, [("a", "fix: one"), ("b", "feat: two")], 1).write.parquet(f"{landing}/batch=1")
    out = stream_upsert(spark, landing, stg_commits, table, ["sha"], checkpoint, latest_first("commits"))
    assert sorted(r["sha"] for r in out.collect()) == ["a", "b"]
    # same extraction time as the first batch: a watermark load would skip it, the file stream does not
    _batch(spark, [("b", "docs: changed"), ("c", "test: new")], 1, 10).write.parquet(f"{landing}/batch=2")
    out = stream_upsert(spark, landing, stg_commits, table, ["sha"], checkpoint, latest_first("commits"))
    got = {r["sha"]: r["commit_message"] for r in out.collect()}
    assert got == {"a": "fix: one", "b": "docs: changed", "c": "test: new"}
    versions = table.versions()
    stream_upsert(spark, landing, stg_commits, table, ["sha"], checkpoint, latest_first("commits"))   # nothing new: no new version
    assert table.versions() == versions


def _extracted(spark, sha, message, day, seq):
    t = datetime(2024, 1, day, tzinfo=timezone.utc)
    data = json.dumps({"sha": sha, "commit_timestamp": "2024-01-05T00:00:00Z", "commit": {"message": message}})
    return spark.createDataFrame([(data, t, t, t, None, seq, 1)], ENVELOPE)


def test_an_older_version_that_lands_later_does_not_win(spark):
    run = uuid.uuid4().hex
    landing = shared_dir(spark, "tests", f"landing-{run}")
    table = VersionedTable(spark, shared_dir(spark, "tests", f"stream-table-{run}"))
    checkpoint = shared_dir(spark, "tests", f"stream-ckpt-{run}")
    for i, (message, day) in enumerate([("new", 2), ("old", 1), ("newest", 3)]):
        _extracted(spark, "a", message, day, i).write.parquet(f"{landing}/batch={i}")
        out = stream_upsert(spark, landing, stg_commits, table, ["sha"], checkpoint, latest_first("commits"))
        full = stg_commits(spark.read.schema(ENVELOPE).parquet(landing))
        assert [r.commit_message for r in out.collect()] == [r.commit_message for r in full.collect()]


def test_the_first_batch_is_written_once(spark):
    run = uuid.uuid4().hex
    landing = shared_dir(spark, "tests", f"landing-{run}")
    table = VersionedTable(spark, shared_dir(spark, "tests", f"stream-table-{run}"))
    batches = Path(shared_dir(spark, "batches").removeprefix("file:"))
    before = set(batches.glob("*"))
    _batch(spark, [("a", "fix: one"), ("b", "feat: two")], 1).write.parquet(f"{landing}/batch=1")
    out = stream_upsert(spark, landing, stg_commits, table, ["sha"], shared_dir(spark, "tests", f"ckpt-{run}"),
                        latest_first("commits"))
    assert sorted(r["sha"] for r in out.collect()) == ["a", "b"]
    assert set(batches.glob("*")) == before
