"""The maintained committers mart against a full rebuild, through batches that move commits between cells."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from commitlake.plans.committer_state import MaintainedCommitters
from commitlake.plans.committers import committers
from commitlake.session import shared_dir

SCHEMA = """sha string, commit_timestamp timestamp, github_author_id long, repo string, commit_type string,
    is_verified boolean, is_merge_commit boolean, pull_request_number long, git_author_email string,
    github_author_is_site_admin boolean, github_author_login string, github_author_avatar_url string,
    github_author_profile_url string, github_author_type string, git_author_name string, _sdc_extracted_at timestamp"""
START = 1_690_000_000                     # 2023-07-22
AS_OF = "2024-02-01 09:30:00"


def as_of(text=AS_OF):
    return F.lit(text).cast("timestamp")


def commits(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA.replace("commit_timestamp timestamp", "commit_timestamp long")
                                  .replace("_sdc_extracted_at timestamp", "_sdc_extracted_at long"))
    ts = F.timestamp_seconds("commit_timestamp")
    return frame.withColumn("commit_timestamp", ts).withColumn("_sdc_extracted_at", F.timestamp_seconds("_sdc_extracted_at")).select(
        "*", F.to_date("commit_timestamp").alias("commit_date"), F.hour("commit_timestamp").cast("long").alias("commit_hour"))


def random_row(rng, sha, batch):
    author = rng.choice([None, 1, 1, 1, 2, 3, 4])
    time = None if rng.random() < 0.1 else START + rng.randrange(0, 200 * 86400)
    return (f"s{sha:03}", time, author, rng.choice(["r1", "r2", None]), rng.choice(["fix", "feature", "style", "other"]),
            rng.choice([True, False, None]), rng.choice([True, False]), rng.choice([None, 1, 2, 3]),
            rng.choice([None, "a@x.io", "b@x.io"]), rng.choice([None, True, False]), f"login{rng.randrange(3)}", None,
            None, "User", f"name{rng.randrange(3)}", 1_700_000_000 + batch)


def random_batches(seed, n=3, size=40):
    rng = random.Random(seed)
    return [[random_row(rng, sha, b) for sha in sorted(rng.sample(range(90), size))] for b in range(n)]


def new_state(spark):
    return MaintainedCommitters(spark, shared_dir(spark, "tests", f"state-{uuid.uuid4().hex}"))


def rows_of(mart):
    return sorted(map(str, (r.asDict() for r in mart.collect())))


def rebuilt(spark, batches, moment):
    kept = {r[0]: r for rows in batches for r in rows}
    return rows_of(committers(commits(spark, list(kept.values())), moment, moment))


def test_random_batches_equal_a_rebuild(spark):
    state, batches = new_state(spark), random_batches(1)
    state.write(commits(spark, batches[0]))
    for i, text in ((1, AS_OF), (2, "2023-11-20 00:00:00")):
        state.merge(commits(spark, batches[i]), ["sha"])
        moment = as_of(text)
        assert rows_of(state.mart(moment, moment)) == rebuilt(spark, batches[:i + 1], moment)


def test_only_touched_cells_are_counted_again(spark):
    state = new_state(spark)
    rng = random.Random(3)
    rows = [(f"s{i:03}", START + i * 86400, 1 + i % 3, *random_row(rng, 0, 0)[3:]) for i in range(150)]
    state.write(commits(spark, rows))
    files = lambda: {r[0] for r in state.days.read().select(F.input_file_name()).distinct().collect()}
    before = files()
    moved = [(*rows[0][:1], rows[0][1] + 60, 9, *rows[0][3:])]       # a new author, the same day
    state.merge(commits(spark, moved), ["sha"])
    assert len(before - files()) == 1                              # one month of six
    days = {(r.github_author_id, r.day) for r in state.days.read().collect()}
    assert (9, "2023-07-22") in days and (1, "2023-07-22") not in days and len(days) == 150
    assert rows_of(state.mart(as_of(), as_of())) == rebuilt(spark, [rows, moved], as_of())


@pytest.mark.parametrize("step", ["commits", "values"])
def test_a_lost_run_is_finished_by_the_next(spark, monkeypatch, step):
    state, batches = new_state(spark), random_batches(7, 3, 20)
    state.write(commits(spark, batches[0]))
    with monkeypatch.context() as m:
        m.setattr(getattr(state, step), "merge" if step == "commits" else "replace", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.merge(commits(spark, batches[1]), ["sha"])
    if step == "commits":                                          # nothing has changed yet: the batch comes again
        state.merge(commits(spark, batches[1]), ["sha"])
    state.merge(commits(spark, batches[2]), ["sha"])
    assert rows_of(state.mart(as_of(), as_of())) == rebuilt(spark, batches, as_of())


def test_empty_tables(spark):
    state = new_state(spark)
    state.write(commits(spark, []))
    assert state.mart(as_of(), as_of()).collect() == []
    state.merge(commits(spark, []), ["sha"])
    rows = random_batches(5, 1, 10)[0]
    state.merge(commits(spark, rows), ["sha"])
    assert rows_of(state.mart(as_of(), as_of())) == rebuilt(spark, [rows], as_of())


def test_cutoff_days_are_read_by_month(spark):
    state = new_state(spark)
    state.write(commits(spark, random_batches(11)[0]))
    plan = state.commits.at([as_of()])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "m2024-02" in plan
