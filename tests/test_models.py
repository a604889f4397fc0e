"""Models on hand-written raw records, including the source quirks that are kept on purpose."""

import uuid

from pyspark.sql import functions as F

from commitlake.operators import VersionedTable, incremental_run, unique
from commitlake.plans import committers, stg_branches, stg_commits, stg_pull_request_commits, stg_repositories
from commitlake.plans.committers import committer_stats
from commitlake.session import shared_dir


def as_of():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def commit(sha, ts, author=7, email="a@x.io", committer_email=None, msg="feat(api): x (#3)", repo="r1"):
    return {"sha": sha, "commit_timestamp": ts, "org": "o", "repo": repo, "repo_id": "12",
            "commit": {"message": msg, "author": {"name": "A", "email": email, "date": ts},
                       "committer": {"email": committer_email or email},
                       "verification": {"verified": True}},
            "author": None if author is None else {"id": author, "login": f"l{author}", "site_admin": False}}


def repo(rid, org="o", name="r", full_name="o/r", updated="2024-01-01T00:00:00Z", slug="r"):
    return {"id": rid, "name": name, "full_name": full_name, "org": org, "repo": slug, "updated_at": updated,
            "owner": {"login": org, "site_admin": None}}


def test_stg_commits_dedupe_and_derived(spark, envelope):
    raw = envelope([
        (commit("s1", "2024-01-10T10:00:00Z", msg="fix: old"), "2024-02-01T00:00:00Z"),
        (commit("s1", "2024-01-10T10:00:00Z", msg="fix: new (#9)"), "2024-02-02T00:00:00Z"),
        (commit("s2", None, email=None), "2024-02-01T00:00:00Z"),
        (commit(None, "2024-01-10T10:00:00Z"), "2024-02-01T00:00:00Z"),
        ('{"sha": "s3", "commit": "not an object", "repo_id": "1.5"}', "2024-02-01T00:00:00Z"),
    ])
    rows = {r["sha"]: r for r in stg_commits(raw).collect()}
    assert set(rows) == {"s1", "s2", "s3"}
    assert rows["s1"]["commit_message"] == "fix: new (#9)" and rows["s1"]["pull_request_number"] == 9
    assert rows["s1"]["commit_type"] == "other" and rows["s1"]["repo_id"] == 12
    assert rows["s1"]["commit_day_of_week"] == 4 and rows["s1"]["commit_hour"] == 10
    assert rows["s2"]["commit_date"] is None and rows["s2"]["is_merge_commit"] is False
    assert rows["s3"]["commit_message"] is None and rows["s3"]["repo_id"] is None


def test_stg_repositories_latest_without_org_is_dropped(spark, envelope):
    raw = envelope([
        (repo(1), "2024-02-01T00:00:00Z"),
        (repo(1, org=None, updated="2024-01-02T00:00:00Z"), "2024-02-02T00:00:00Z"),
        (repo(2, full_name=None), "2024-02-01T00:00:00Z"),
        (repo(3, name=None), "2024-02-01T00:00:00Z"),
    ])
    rows = {r["repo_id"]: r for r in stg_repositories(raw, as_of()).collect()}
    assert set(rows) == {2, 3}
    assert rows[2]["repo_sk"] == "2:o"                      # full_name missing → org alone
    assert rows[3]["repo"] == "r" and rows[3]["full_repo_name"] == "o/r"   # falls back to the slug
    assert rows[2]["owner_is_site_admin"] is False


def test_incremental_rename_keeps_two_rows(spark, envelope):
    table = VersionedTable(spark, shared_dir(spark, "tests", f"repos-{uuid.uuid4().hex}"))
    model = lambda raw: stg_repositories(raw, as_of())
    b1 = envelope([(repo(1), "2024-02-01T00:00:00Z")])
    both = envelope([(repo(1), "2024-02-01T00:00:00Z"),
                     (repo(1, full_name="o/renamed", updated="2024-01-05T00:00:00Z"), "2024-02-02T00:00:00Z")])
    incremental_run(b1, model, table, ["repo_sk"], "_sdc_extracted_at")
    out = incremental_run(both, model, table, ["repo_sk"], "_sdc_extracted_at")
    assert sorted(r["repo_sk"] for r in out.collect()) == ["1:o/r", "1:o/renamed"]
    assert unique(out, "repo_id").count() == 1               # the declared unique(repo_id) test fails


def test_incremental_empty_target_loads_nothing(spark, envelope):
    table = VersionedTable(spark, shared_dir(spark, "tests", f"empty-{uuid.uuid4().hex}"))
    raw = envelope([(commit("s1", "2024-01-10T10:00:00Z"), "2024-02-01T00:00:00Z")])
    incremental_run(raw.where(F.lit(False)), stg_commits, table, ["sha"], "_sdc_extracted_at")
    assert incremental_run(raw, stg_commits, table, ["sha"], "_sdc_extracted_at").count() == 0
    again = incremental_run(raw, stg_commits, table, ["sha"], "_sdc_extracted_at", empty_target="load_all")
    assert again.count() == 1


def test_branches_and_pr_commits_keys(spark, envelope):
    braw = envelope([
        ({"org": "o", "repo": "r", "repo_id": 5, "name": "main", "protected": "TRUE",
          "commit": {"sha": "h1"}}, "2024-02-01T00:00:00Z"),
        ({"org": "o", "repo": "r", "repo_id": 5, "name": "main", "protected": False,
          "commit": {"sha": "h2"}}, "2024-02-02T00:00:00Z"),
        ({"org": "o", "repo": None, "repo_id": 5, "name": "dev"}, "2024-02-02T00:00:00Z"),
    ])
    rows = stg_branches(braw, as_of()).collect()
    assert len(rows) == 1 and rows[0]["branch_sk"] == "o/r:5:main" and rows[0]["commit_sha"] == "h2"
    praw = envelope([({"org": "o", "repo": "r", "repo_id": 5, "pull_number": 3, "sha": "s",
                       "commit": {"message": "docs:x", "author": {"date": "2024-01-07T01:00:00Z"}}},
                      "2024-02-01T00:00:00Z"),
                     ({"org": "o", "repo": "r", "repo_id": 5, "sha": "t"}, "2024-02-01T00:00:00Z")])
    rows = stg_pull_request_commits(praw, as_of()).collect()
    assert len(rows) == 1
    assert rows[0]["pull_request_commit_sk"] == "o/r:5:pr:3:s" and rows[0]["commit_day_of_week"] == 1


def test_committers_null_times_and_hour_ties(spark, envelope):
    raw = envelope([
        (commit("a1", None, author=1), "2024-02-01T00:00:00Z"),
        (commit("a2", None, author=1), "2024-02-01T00:00:00Z"),
        (commit("b1", "2024-01-30T03:00:00Z", author=2), "2024-02-01T00:00:00Z"),
        (commit("b2", None, author=2), "2024-02-01T00:00:00Z"),
        (commit("b3", "2024-01-29T05:00:00Z", author=2, email="b@x.io"), "2024-02-01T00:00:00Z"),
        (commit("c1", "2024-01-29T05:00:00Z", author=None), "2024-02-01T00:00:00Z"),
    ])
    rows = {r["committer_id"]: r for r in committers(stg_commits(raw), as_of(), as_of()).collect()}
    assert set(rows) == {1, 2}
    a, b = rows[1], rows[2]
    assert a["days_active_span"] is None and a["avg_commits_per_day_in_span"] is None
    assert a["active_days"] == 0 and a["commits_per_active_day"] is None
    assert a["avg_commits_per_active_day"] == 2.0 and a["most_active_hour"] is None
    assert a["activity_status"] == "Inactive"
    assert b["most_active_hour"] is None                     # three buckets of one: NULL sorts first
    assert b["most_active_day_of_week"] is None
    assert b["committer_email"] == "a@x.io"                  # 2 vs 1
    assert b["days_active_span"] == 0 and b["avg_commits_per_day_in_span"] == 3.0
    assert b["commits_last_30_days"] == 2 and b["active_days_last_30"] == 2
    assert b["rank_by_total_commits"] == 1 and a["rank_by_total_commits"] == 2
    assert b["feature_commits_pct"] == 100.0 and b["unique_prs"] == 1


def test_committer_stats_shuffle_budget(spark, envelope):
    raw = envelope([(commit("x", "2024-01-30T03:00:00Z"), "2024-02-01T00:00:00Z")])
    path = shared_dir(spark, "tests", f"stg-{uuid.uuid4().hex}")
    stg_commits(raw).write.parquet(path)
    plan = committer_stats(spark.read.parquet(path), as_of())._jdf.queryExecution().executedPlan().toString()
    # day rollup, author rollup, value rollup (+ author), latest time, profile: six hash exchanges at most
    assert plan.count("Exchange hashpartitioning") <= 6
    assert "SinglePartition" not in plan


def test_parse_order_does_not_change_results(spark):
    from commitlake.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    for build, raw in [(stg_commits, fx.raw_commits(spark, sf)),
                       (lambda r, **k: stg_repositories(r, as_of(), **k), fx.raw_repositories(spark, sf))]:
        a, b = build(raw, dedupe_first=True), build(raw, dedupe_first=False)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_staging_dedupe_limits_rows_before_the_shuffle(spark, envelope):
    raw = envelope([(commit("s1", "2024-01-10T10:00:00Z"), "2024-02-01T00:00:00Z")])
    for df in (stg_commits(raw), stg_repositories(envelope([(repo(1), "2024-02-01T00:00:00Z")]), as_of())):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        before_shuffle = plan.split("Exchange hashpartitioning")[1]
        assert "WindowGroupLimit" in before_shuffle      # partial limit runs map-side: one row per key per task
