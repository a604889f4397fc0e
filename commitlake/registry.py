"""Registered queries: every model and operator, runnable over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
fixture streams. Timestamps are rendered as UTC text (``comparable``) so the
results can be compared value-for-value with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.functions import (
    json_query, json_value, parse_rfc3339, safe_bool, safe_int,
)
from commitlake.functions.text import commit_type
from commitlake.operators.dedupe import keep_latest
from commitlake.operators.incremental import VersionedTable, incremental_run, stored, upsert, watermark_filter
from commitlake.operators.partitioned import PartitionedTable
from commitlake.operators.joins import left_join_dim
from commitlake.operators.modes import mode_by
from commitlake.operators.quality import MART_CHECKS, not_null, observe_nulls, quality_report, relationships, unique
from commitlake.operators.rank import rank_by_value
from commitlake.plans import committers as committers_plan
from commitlake.plans.committer_state import MaintainedCommitters
from commitlake.plans.committers import (
    AUTHOR, author_days, author_profile, author_totals, author_values, authored, committer_stats,
)
from commitlake.plans.marts import branches_mart, commits_mart, pull_request_commits_mart, repositories_mart
from commitlake.plans.staging import (
    latest_first, stg_branches, stg_commits, stg_pull_request_commits, stg_repositories,
)
from commitlake.session import configure, shared_dir
from commitlake.sources import fixtures as fx
from commitlake.sources.envelope import (
    Landing, parse_payload, raw_view, read_jsonl, read_raw, select_streams, write_jsonl,
)
from commitlake.sources.schemas import COMMIT_FIELDS, REPOSITORY_FIELDS, SDC_COLUMNS, STREAM_FIELDS
from commitlake.sources.typed import TypedLanding, flatten

c = F.col
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def comparable(df: DataFrame) -> DataFrame:
    """Render timestamp columns as UTC text for value comparison (other types unchanged)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(c(f.name), TS_TEXT).alias(f.name))
        else:
            cols.append(c(f.name))
    return df.select(*cols)


def _as_of():
    return fx.as_of_lit()


# ---- model builders over the fixture streams --------------------------------------------------

def s_commits(spark, sf, versions=(0, 1)):
    return stg_commits(fx.raw_commits(spark, sf, versions))


def s_pr(spark, sf, versions=(0, 1)):
    return stg_pull_request_commits(fx.raw_pull_request_commits(spark, sf, versions), _as_of())


def s_branches(spark, sf, versions=(0, 1)):
    return stg_branches(fx.raw_branches(spark, sf, versions), _as_of())


def s_repos(spark, sf, versions=(0, 1)):
    return stg_repositories(fx.raw_repositories(spark, sf, versions), _as_of())


def stored_commits(spark, sf):
    """Staging commits written once, for queries that read them several times."""
    return stored(s_commits(spark, sf), spark, "stg_commits")


def m_committers(spark, sf):
    return committers_plan(stored_commits(spark, sf), _as_of(), _as_of())


def m_stats(spark, sf):
    return committer_stats(stored_commits(spark, sf), _as_of())


def m_commits(spark, sf):
    return commits_mart(s_commits(spark, sf), _as_of())


def _stats_cols(*cols):
    return lambda spark, sf: m_stats(spark, sf).select("committer_id", *cols)


# ---- queries ------------------------------------------------------------------------------------

def q_commits_by_type(spark, sf):
    return m_commits(spark, sf).groupBy("commit_type").agg(F.count(F.lit(1)).alias("commit_count"))


def q_top_committers(spark, sf):
    top = m_committers(spark, sf).orderBy(c("total_commits").desc(), c("committer_id").asc()).limit(10)
    return top.select("committer_id", "github_login", "total_commits", "rank_by_total_commits")


def q_email_mode(spark, sf):
    m = author_values(authored(s_commits(spark, sf)))
    return m.where(c("git_author_email").isNotNull()).select(
        c(AUTHOR).alias("committer_id"), c("git_author_email").alias("committer_email"))


def _work_pattern(spark, sf, column):
    m = author_totals(author_days(authored(s_commits(spark, sf)), _as_of()), _as_of())
    return m.select(c(AUTHOR).alias("committer_id"), column)


def q_hour_mode(spark, sf):
    return _work_pattern(spark, sf, "most_active_hour")


def q_dow_mode(spark, sf):
    return _work_pattern(spark, sf, "most_active_day_of_week")


def q_mode_by(spark, sf):
    """The general mode operator: the most frequent commit type of each author."""
    m = mode_by(authored(s_commits(spark, sf)), AUTHOR, "commit_type", out="usual_type")
    return m.withColumnRenamed(AUTHOR, "committer_id")


def q_profile_latest(spark, sf):
    return author_profile(authored(stored_commits(spark, sf))).withColumnRenamed(AUTHOR, "committer_id")


def q_group_count(spark, sf):
    return (authored(s_commits(spark, sf)).groupBy(AUTHOR, "commit_hour")
            .agg(F.count(F.lit(1)).alias("commit_hour_count")))


def _ranked(by: str, name: str):
    def run(spark, sf):
        stats = stored(m_stats(spark, sf).select("committer_id", by), spark, "rank-input")
        return rank_by_value(stats, by, "committer_id", name)
    return run


def q_left_join_dim(spark, sf):
    stg = stored_commits(spark, sf)
    commits = commits_mart(stg, _as_of()).select("sha", "github_author_id")
    dim = committer_stats(stg, _as_of()).select(
        c("committer_id").alias("github_author_id"), "github_login", "activity_status")
    return left_join_dim(commits, dim, "github_author_id")


def q_dedupe_commits(spark, sf):
    narrow = parse_payload(fx.raw_commits(spark, sf), [f for f in COMMIT_FIELDS if f[0] in ("sha", "commit_timestamp")],
                           keep=SDC_COLUMNS)
    latest = keep_latest(narrow.where(c("sha").isNotNull()), ["sha"],
                         [c("commit_timestamp").desc(), c("_sdc_extracted_at").desc()])
    return latest.select("sha", "commit_timestamp", "_sdc_extracted_at", "_sdc_sequence")


def q_dedupe_branches(spark, sf):
    return s_branches(spark, sf).select("branch_sk", "is_protected", "commit_sha", "_sdc_extracted_at")


def q_dedupe_repositories(spark, sf):
    return s_repos(spark, sf).select("repo_id", "description", "stargazers_count", "updated_at", "_sdc_extracted_at")


def q_dedupe_pr_commits(spark, sf):
    return s_pr(spark, sf).select("pull_request_commit_sk", "commit_message", "_sdc_extracted_at")


def _flatten(stream: str, builder):
    def run(spark, sf):
        typed = parse_payload(builder(spark, sf), STREAM_FIELDS[stream], keep=["_sdc_extracted_at", "_sdc_sequence"])
        return typed
    return run


def q_envelope_project(spark, sf):
    return fx.raw_commits(spark, sf).select(*SDC_COLUMNS)


def q_land_envelope(spark, sf):
    path = shared_dir(spark, "landing", "commits", f"run-{_run_id()}")
    fx.raw_commits(spark, sf).write.parquet(path)
    back = read_raw(spark, path)
    return parse_payload(back, [f for f in COMMIT_FIELDS if f[0] in ("sha", "commit_timestamp", "commit_message")],
                         keep=["_sdc_extracted_at", "_sdc_sequence"])


def q_jsonl_roundtrip(spark, sf):
    path = shared_dir(spark, "landing", "branches-jsonl", f"run-{_run_id()}")
    write_jsonl(fx.raw_branches(spark, sf), path)
    back = read_jsonl(spark, path)
    return parse_payload(back, STREAM_FIELDS["branches"], keep=["_sdc_extracted_at", "_sdc_sequence"])


def q_raw_view(spark, sf):
    raw_view(spark, fx.raw_repositories(spark, sf), "repositories", "raw_repositories_typed")
    return spark.sql("SELECT repo_id, full_name, is_private, updated_at, _sdc_extracted_at "
                     "FROM raw_repositories_typed")


def q_stream_select(spark, sf):
    catalog = {name: build(spark, sf) for name, build in fx.RAW_STREAMS.items()}
    chosen = select_streams(catalog, ["commits.*", "branches.*"])
    parts = [df.groupBy().agg(F.count(F.lit(1)).alias("n_records")).select(F.lit(name).alias("stream"), "n_records")
             for name, df in chosen.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_property_select(spark, sf):
    """Property-level selection: only matching payload properties are left, the others read as NULL."""
    chosen = select_streams({"commits": fx.raw_commits(spark, sf)}, ["commits.sha", "commits.commit*"])
    return parse_payload(chosen["commits"], COMMIT_FIELDS, keep=["_sdc_sequence"]).select(
        "_sdc_sequence", "sha", "commit_message", "github_author_login")


def q_json_value(spark, sf):
    raw = fx.raw_commits(spark, sf)
    return raw.select(
        "_sdc_sequence",
        json_value("data", "$.sha").alias("sha"),
        json_value("data", "$.commit.message").alias("commit_message"),
        json_value("data", "$.commit").alias("commit_object"),
        json_value("data", "$.author.login").alias("author_login"),
    )


def q_json_query(spark, sf):
    raw = fx.raw_commits(spark, sf)
    tree = json_query("data", "$.commit.tree")
    return raw.select("_sdc_sequence", F.get_json_object(tree, "$.sha").alias("tree_sha"),
                      json_query("data", "$.commit.tree.sha").alias("tree_sha_json"))


def q_safe_int(spark, sf):
    raw = fx.raw_commits(spark, sf)
    return raw.select("_sdc_sequence",
                      safe_int(json_value("data", "$.repo_id")).alias("repo_id"),
                      safe_int(json_value("data", "$.commit.message")).alias("message_as_int"),
                      safe_int(json_value("data", "$.commit.comment_count")).alias("comment_count"))


def q_safe_bool(spark, sf):
    raw = fx.raw_commits(spark, sf)
    return raw.select("_sdc_sequence",
                      safe_bool(json_value("data", "$.commit.verification.verified")).alias("is_verified"),
                      safe_bool(json_value("data", "$.author.site_admin")).alias("is_site_admin"),
                      safe_bool(json_value("data", "$.commit.comment_count")).alias("count_as_bool"))


def q_parse_rfc3339(spark, sf):
    raw = fx.raw_commits(spark, sf)
    return raw.select("_sdc_sequence",
                      parse_rfc3339(json_value("data", "$.commit_timestamp")).alias("commit_timestamp"),
                      parse_rfc3339(json_value("data", "$.commit.verification.verified_at")).alias("verified_at"),
                      parse_rfc3339(json_value("data", "$.sha")).alias("sha_as_ts"))


def q_coalesce(spark, sf):
    return s_repos(spark, sf).select("repo_id", "repo", "owner_is_site_admin", "repo_sk")


def q_full_repo_name(spark, sf):
    return m_commits(spark, sf).select("sha", "full_repo_name")


def q_commit_type_lenient(spark, sf):
    return s_commits(spark, sf).select("sha", commit_type(c("commit_message"), lenient=True).alias("commit_type"))


def q_commit_type(spark, sf):
    return s_commits(spark, sf).select("sha", "commit_message", "commit_type")


def q_pr_number(spark, sf):
    return s_commits(spark, sf).select("sha", "pull_request_number")


def q_date_dims(spark, sf):
    return s_commits(spark, sf).select("sha", "commit_date", "commit_week", "commit_month", "commit_quarter",
                                       "commit_year", "commit_day_of_week", "commit_hour")


def q_merge_flag(spark, sf):
    return s_commits(spark, sf).select("sha", "git_author_email", "git_committer_email", "is_merge_commit")


def q_repo_sk(spark, sf):
    return s_repos(spark, sf).select("repo_id", "repo_sk")


def q_branch_sk(spark, sf):
    return s_branches(spark, sf).select("branch_sk", "full_repo_name")


def q_pr_commit_sk(spark, sf):
    return s_pr(spark, sf).select("pull_request_commit_sk", "sha", "full_repo_name")


def q_predicates(spark, sf):
    s = s_commits(spark, sf)
    keep = ((c("commit_hour").between(9, 17) & c("commit_day_of_week").isin(2, 3, 4, 5, 6))
            | (c("commit_type").isin("fix", "feature") & ~c("is_merge_commit"))
            | (c("git_author_email").isNull() & (c("repo_id") >= 105) & (c("repo_id") < 108)))
    return s.where(keep).select("sha", "commit_type", "commit_hour")


def q_watermark_filter(spark, sf):
    target = s_commits(spark, sf, versions=(0,))
    fresh = watermark_filter(fx.raw_commits(spark, sf), target, "_sdc_extracted_at")
    return parse_payload(fresh, [f for f in COMMIT_FIELDS if f[0] in ("sha", "commit_message")],
                         keep=["_sdc_extracted_at"])


EARLIER_BUILD_CUTOFF = "2023-07-01 00:00:00"   # the commits mart was first built when only older commits existed


def q_watermark_event_time(spark, sf):
    """Rows of staging newer (by commit time) than the commits mart of an earlier build."""
    stg = s_commits(spark, sf)
    earlier_mart = commits_mart(stg.where(c("commit_timestamp") < F.lit(EARLIER_BUILD_CUTOFF).cast("timestamp")),
                                _as_of())
    return watermark_filter(stg, earlier_mart, "commit_timestamp").select("sha", "commit_timestamp")


def q_incremental_two_batches(spark, sf):
    """Branches staging loaded in two extraction batches (watermark + upsert by branch_sk)."""
    table = VersionedTable(spark, shared_dir(spark, "tables", f"stg_branches-{_run_id()}"))
    model = lambda raw: stg_branches(raw, _as_of())
    for versions in [(0,), (0, 1)]:
        out = incremental_run(fx.raw_branches(spark, sf, versions), model, table, ["branch_sk"], "_sdc_extracted_at")
    return out.select("branch_sk", "is_protected", "commit_sha", "_sdc_extracted_at")


def q_upsert(spark, sf):
    target = s_commits(spark, sf, versions=(0,))
    batch = s_commits(spark, sf, versions=(1,))
    return upsert(target, batch, ["sha"]).select("sha", "commit_message", "_sdc_extracted_at")


def _run_id():
    import uuid
    return uuid.uuid4().hex


def q_incremental_commits(spark, sf):
    table = VersionedTable(spark, shared_dir(spark, "tables", f"stg_commits-{_run_id()}"))
    for versions in [(0,), (0, 1)]:
        out = incremental_run(fx.raw_commits(spark, sf, versions), stg_commits, table, ["sha"], "_sdc_extracted_at")
    return out.select("sha", "commit_message", "_sdc_extracted_at")


def q_incremental_by_month(spark, sf):
    """The same two runs into folders by month: the second rewrites the months of its rows by partition overwrite."""
    table = PartitionedTable(spark, shared_dir(spark, "tables", f"stg_commits_month-{_run_id()}"), "commit_timestamp", "month",
                             ["_sdc_extracted_at"])
    for versions in [(0,), (0, 1)]:
        out = incremental_run(fx.raw_commits(spark, sf, versions), stg_commits, table, ["sha"], "_sdc_extracted_at")
    return out.select("sha", "commit_message", "_sdc_extracted_at")


def q_incremental_landed(spark, sf):
    """Two extractions landed in folders by date; the second run reads the folders from the watermark's day on."""
    run = _run_id()
    landing = Landing(spark, shared_dir(spark, "landing", f"commits-dated-{run}"))
    table = PartitionedTable(spark, shared_dir(spark, "tables", f"stg_commits_landed-{run}"), "commit_timestamp", "month",
                             ["_sdc_extracted_at"])
    for version in (0, 1):
        landing.append(fx.raw_commits(spark, sf, (version,)))
        out = incremental_run(landing, stg_commits, table, ["sha"], "_sdc_extracted_at")
    return out.select("sha", "commit_message", "_sdc_extracted_at")


def _typed(stream: str, builder, spark, sf) -> DataFrame:
    """A stream landed with VARIANT payloads, read back."""
    landing = TypedLanding(spark, shared_dir(spark, "landing", f"typed-{stream}-{_run_id()}"), stream)
    landing.append(builder(spark, sf))
    return landing.read()


def _typed_flatten(stream: str, builder):
    def run(spark, sf):
        return flatten(_typed(stream, builder, spark, sf), STREAM_FIELDS[stream], ["_sdc_extracted_at", "_sdc_sequence"])
    return run


def q_typed_columns(spark, sf):
    """Five of the 35 payload fields of repositories: the scan reads no other."""
    chosen = [f for f in REPOSITORY_FIELDS
              if f[0] in ("repo_id", "full_name", "primary_language", "stargazers_count", "pushed_at")]
    return flatten(_typed("repositories", fx.raw_repositories, spark, sf), chosen, ["_sdc_sequence"])


def q_stg_commits_typed(spark, sf):
    """Commits staging, its two extractions landed with VARIANT payloads and merged by an incremental run each."""
    run = _run_id()
    landing = TypedLanding(spark, shared_dir(spark, "landing", f"typed-commits-{run}"), "commits")
    table = PartitionedTable(spark, shared_dir(spark, "tables", f"stg_commits_typed-{run}"), "commit_timestamp", "month",
                             ["_sdc_extracted_at"])
    for version in (0, 1):
        landing.append(fx.raw_commits(spark, sf, (version,)))
        out = incremental_run(landing, stg_commits, table, ["sha"], "_sdc_extracted_at")
    return out


def q_committers_maintained(spark, sf):
    """The committers mart from stored day rows: a build and a batch that counts only the cells it touches again."""
    state = MaintainedCommitters(spark, shared_dir(spark, "tables", f"committers-{_run_id()}"))
    for versions in [(0,), (0, 1)]:
        incremental_run(fx.raw_commits(spark, sf, versions), stg_commits, state, ["sha"], "_sdc_extracted_at")
    return state.mart(_as_of(), _as_of())


def q_incremental_repositories(spark, sf):
    table = VersionedTable(spark, shared_dir(spark, "tables", f"stg_repositories-{_run_id()}"))
    model = lambda raw: stg_repositories(raw, _as_of())
    for versions in [(0,), (0, 1)]:
        out = incremental_run(fx.raw_repositories(spark, sf, versions), model, table, ["repo_sk"],
                              "_sdc_extracted_at")
    return out.select("repo_id", "repo_sk", "description", "stargazers_count", "_sdc_extracted_at")


def q_incremental_commits_mart(spark, sf):
    """Two runs of the commits mart: the second loads only commits newer (event time) than the target."""
    table = VersionedTable(spark, shared_dir(spark, "tables", f"commits-{_run_id()}"))
    model = lambda stg: commits_mart(stg, _as_of())
    for versions in [(0,), (0, 1)]:
        out = incremental_run(s_commits(spark, sf, versions), model, table, ["sha"], "commit_timestamp")
    return out.select("sha", "commit_message", "commit_timestamp")


def q_stream_incremental_commits(spark, sf):
    """Land two extraction batches as files; an availableNow stream upserts each into staging."""
    from commitlake.streaming import stream_upsert
    run = _run_id()
    landing = shared_dir(spark, "landing", f"commits-stream-{run}")
    table = VersionedTable(spark, shared_dir(spark, "tables", f"stg_commits_stream-{run}"))
    checkpoint = shared_dir(spark, "streams", f"stg_commits-{run}")
    for batch, versions in [(1, (0,)), (2, (1,))]:
        fx.raw_commits(spark, sf, versions).write.parquet(f"{landing}/batch={batch}")
        out = stream_upsert(spark, landing, stg_commits, table, ["sha"], checkpoint, latest_first("commits"))
    return out.select("sha", "commit_message", "_sdc_extracted_at")


def q_stream_out_of_order(spark, sf):
    """The later extraction lands first: the stream's table still equals a full build of both."""
    from commitlake.streaming import stream_upsert
    run = _run_id()
    landing = shared_dir(spark, "landing", f"commits-late-{run}")
    table = VersionedTable(spark, shared_dir(spark, "tables", f"stg_commits_late-{run}"))
    checkpoint = shared_dir(spark, "streams", f"late-{run}")
    for batch, versions in [(1, (1,)), (2, (0,))]:
        fx.raw_commits(spark, sf, versions).write.parquet(f"{landing}/batch={batch}")
        out = stream_upsert(spark, landing, stg_commits, table, ["sha"], checkpoint, latest_first("commits"))
    return out.select("sha", "commit_message", "_sdc_extracted_at")


def q_published_branches(spark, sf):
    """Full-refresh publication into the catalog, read back by name."""
    from commitlake.sources.sinks import apply_comments, publish
    name = f"branches_{_run_id()[:12]}"
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    out = publish(branches_mart(s_branches(spark, sf), _as_of()), name, f"{warehouse}/published/{name}", "marts")
    apply_comments(spark, f"marts.{name}", "Latest known state of each branch.", {"branch_sk": "Branch key."})
    return out.select("branch_sk", "is_main_branch", "is_protected")


def q_mart_docs(spark, sf):
    """The columns of every published mart and whether the catalog holds a comment for them."""
    from commitlake.plans.build import publish_marts
    run = _run_id()
    stg = stored_commits(spark, sf)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    database = f"docs_{run[:12]}"
    tables = {name: VersionedTable(spark, f"{warehouse}/published/{database}/{name}")
              for name in ("branches", "commits", "committers", "pull_request_commits", "repositories")}
    marts = {**_marts(spark, sf, stg), "committers": committers_plan(stg, _as_of(), _as_of())}
    for name, df in marts.items():
        tables[name].write(df)
    publish_marts(spark, tables, database)
    out = None
    for name in sorted(tables):
        described = spark.sql(f"DESCRIBE TABLE {database}.{name}").select(
            F.lit(name).alias("table_name"), c("col_name").alias("column_name"),
            (F.length(F.coalesce("comment", F.lit(""))) > 10).alias("described"))
        out = described if out is None else out.unionByName(described)
    return out


def q_view_commits_by_type(spark, sf):
    """View materialisation of the commits mart, queried with SQL."""
    from commitlake.sources.sinks import publish_view
    publish_view(m_commits(spark, sf), "commits_mart_view")
    return spark.sql("SELECT commit_type, commit_date, count(*) AS commit_count FROM commits_mart_view "
                     "GROUP BY commit_type, commit_date")


def _marts(spark, sf, stg=None):
    stg = stg if stg is not None else s_commits(spark, sf)
    return {
        "branches": branches_mart(s_branches(spark, sf), _as_of()),
        "commits": commits_mart(stg, _as_of()),
        "committers": committer_stats(stg, _as_of()),
        "pull_request_commits": pull_request_commits_mart(s_pr(spark, sf), _as_of()),
        "repositories": repositories_mart(s_repos(spark, sf), _as_of()),
    }


def q_test_unique(spark, sf):
    return unique(s_commits(spark, sf), "github_author_id")


def q_test_not_null(spark, sf):
    return not_null(m_commits(spark, sf), ["sha", "commit_timestamp", "git_author_email", "github_author_id"])


def q_test_relationships(spark, sf):
    orphans = relationships(s_branches(spark, sf), "commit_sha", s_commits(spark, sf).select("sha"), "sha")
    return orphans.select("branch_sk", "commit_sha")


def q_test_report(spark, sf):
    """The declared suite over the marts, materialised first as in a real build (one write per mart)."""
    run = _run_id()
    stg = VersionedTable(spark, shared_dir(spark, "tables", f"report-{run}", "stg_commits")).write(s_commits(spark, sf))
    marts = {name: VersionedTable(spark, shared_dir(spark, "tables", f"report-{run}", name)).write(df)
             for name, df in _marts(spark, sf, stg).items()}
    return quality_report(marts, MART_CHECKS)


def q_test_report_observed(spark, sf):
    """The declared suite, the NULLs of all five marts counted while they are written."""
    run = _run_id()
    stg = VersionedTable(spark, shared_dir(spark, "tables", f"observed-{run}", "stg_commits")).write(s_commits(spark, sf))
    marts, observed = {}, {}
    for name, df in _marts(spark, sf, stg).items():
        df, observed[name] = observe_nulls(df, name, MART_CHECKS)
        marts[name] = VersionedTable(spark, shared_dir(spark, "tables", f"observed-{run}", name)).write(df)
    return quality_report(marts, MART_CHECKS, observed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # models
    "stg_commits": s_commits,
    "stg_pull_request_commits": s_pr,
    "stg_branches": s_branches,
    "stg_repositories": s_repos,
    "commits": m_commits,
    "pull_request_commits": lambda spark, sf: pull_request_commits_mart(s_pr(spark, sf), _as_of()),
    "branches": lambda spark, sf: branches_mart(s_branches(spark, sf), _as_of()),
    "repositories": lambda spark, sf: repositories_mart(s_repos(spark, sf), _as_of()),
    "committers": m_committers,
    # analyst queries
    "commits_by_type": q_commits_by_type,
    "top_committers": q_top_committers,
    # committers parts
    "email_mode": q_email_mode,
    "mode_by": q_mode_by,
    "profile_latest": q_profile_latest,
    "hour_mode": q_hour_mode,
    "dow_mode": q_dow_mode,
    "group_count": q_group_count,
    "rank_total": _ranked("total_commits", "rank_by_total_commits"),
    "rank_recent": _ranked("commits_last_90_days", "rank_by_recent_activity"),
    "base_stats": _stats_cols("total_commits", "first_commit_at", "last_commit_at", "is_site_admin"),
    "distinct_counts": _stats_cols("repos_contributed_to", "active_days", "unique_prs"),
    "type_breakdown": _stats_cols("fix_commits", "feature_commits", "docs_commits", "refactor_commits",
                                  "test_commits", "chore_commits", "performance_commits", "other_commits"),
    "flag_counts": _stats_cols("verified_commits", "unverified_commits", "merge_commits", "pr_commits"),
    "recency_counts": _stats_cols("commits_last_30_days", "commits_last_90_days", "commits_last_180_days",
                                  "commits_last_365_days"),
    "recency_days": _stats_cols("active_days_last_30", "active_days_last_90", "active_days_last_365"),
    "time_patterns": _stats_cols("weekend_commits", "weekday_commits", "business_hours_commits",
                                 "off_hours_commits"),
    "contribution_intensity": _stats_cols("avg_commits_per_active_day", "max_commits_in_day"),
    "activity_status": _stats_cols("activity_status"),
    "day_span": _stats_cols("days_active_span", "days_since_last_commit"),
    "pct": _stats_cols("fix_commits_pct", "feature_commits_pct", "docs_commits_pct", "refactor_commits_pct",
                       "verification_rate_pct", "merge_commit_pct", "commits_per_active_day",
                       "avg_commits_per_day_in_span"),
    "left_join_dim": q_left_join_dim,
    # dedupe (keep-latest) per stream
    "dedupe_commits": q_dedupe_commits,
    "dedupe_branches": q_dedupe_branches,
    "dedupe_repositories": q_dedupe_repositories,
    "dedupe_pr_commits": q_dedupe_pr_commits,
    # sources, envelope and payload flatten
    "envelope_project": q_envelope_project,
    "flatten_commits": _flatten("commits", fx.raw_commits),
    "flatten_pr_commits": _flatten("pull_request_commits", fx.raw_pull_request_commits),
    "flatten_branches": _flatten("branches", fx.raw_branches),
    "flatten_repositories": _flatten("repositories", fx.raw_repositories),
    "typed_commits": _typed_flatten("commits", fx.raw_commits),
    "typed_pr_commits": _typed_flatten("pull_request_commits", fx.raw_pull_request_commits),
    "typed_branches": _typed_flatten("branches", fx.raw_branches),
    "typed_repositories": _typed_flatten("repositories", fx.raw_repositories),
    "typed_columns": q_typed_columns,
    "land_envelope": q_land_envelope,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "raw_view": q_raw_view,
    "stream_select": q_stream_select,
    "property_select": q_property_select,
    # scalar functions and keys
    "json_value": q_json_value,
    "json_query": q_json_query,
    "safe_int": q_safe_int,
    "safe_bool": q_safe_bool,
    "parse_rfc3339": q_parse_rfc3339,
    "coalesce": q_coalesce,
    "full_repo_name": q_full_repo_name,
    "commit_type": q_commit_type,
    "commit_type_lenient": q_commit_type_lenient,
    "pr_number": q_pr_number,
    "date_dims": q_date_dims,
    "merge_flag": q_merge_flag,
    "repo_sk": q_repo_sk,
    "branch_sk": q_branch_sk,
    "pr_commit_sk": q_pr_commit_sk,
    "predicates": q_predicates,
    # incremental
    "watermark_filter": q_watermark_filter,
    "watermark_event_time": q_watermark_event_time,
    "upsert": q_upsert,
    "incremental_commits": q_incremental_commits,
    "incremental_by_month": q_incremental_by_month,
    "incremental_landed": q_incremental_landed,
    "stg_commits_typed": q_stg_commits_typed,
    "committers_maintained": q_committers_maintained,
    "incremental_repositories": q_incremental_repositories,
    "incremental_two_batches": q_incremental_two_batches,
    "incremental_commits_mart": q_incremental_commits_mart,
    "stream_incremental_commits": q_stream_incremental_commits,
    "stream_out_of_order": q_stream_out_of_order,
    # sinks
    "published_branches": q_published_branches,
    "mart_docs": q_mart_docs,
    "view_commits_by_type": q_view_commits_by_type,
    # data quality
    "test_unique": q_test_unique,
    "test_not_null": q_test_not_null,
    "test_relationships": q_test_relationships,
    "test_report": q_test_report,
    "test_report_observed": q_test_report_observed,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return comparable(QUERIES[name](spark, sf_dir))
