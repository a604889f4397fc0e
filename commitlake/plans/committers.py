"""Per-contributor profile mart (the flagship model).

The source model reads its commit input eight times (e-mail mode, profile,
base stats, recency, time patterns, hour mode, day-of-week mode, daily
intensity) and joins the pieces. Here the same outputs come from three
rollups of the staging table that combine map-side:

1. ``author_days``   GROUP BY (author, commit_date): counters, first/last
                     time, a 25-bucket hour histogram. Per-commit work ends here.
2. ``author_totals`` GROUP BY author over the day rows: totals, recency,
                     active days, daily average/maximum, weekday/weekend,
                     hour and day-of-week modes (NULL bucket included).
3. ``author_values`` distinct repositories, distinct pull requests and the
                     e-mail mode from one (author, kind, value) rollup.
4. ``author_profile`` attributes of the latest commit (latest time per author, then arg-max among its rows).

Every step pre-aggregates before its shuffle, so an author holding a third
of all commits sends one row per map task, never its whole group. The
per-author results share the author hash partitioning and are joined
without re-shuffling the large side. Ranks use ``global_rank`` over two
columns (no single-partition sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.functions.dates import days_between, since
from commitlake.functions.metrics import greatest_strict, pct, rate
from commitlake.functions.text import COMMIT_TYPES
from commitlake.operators.incremental import stored
from commitlake.operators.modes import latest_by
from commitlake.operators.rank import rank_by_value

c = F.col
AUTHOR = "github_author_id"
RECENCY_DAYS = [30, 90, 180, 365]
ACTIVE_DAY_WINDOWS = [30, 90, 365]
# The commit classes with their own counter (style, ci, build have none).
COUNTED_TYPES = ["fix", "feature", "docs", "refactor", "test", "chore", "performance", "other"]
TYPE_COLUMN = {"performance": "performance_commits"}
BUSINESS_HOURS = (9, 17)          # inclusive, UTC
WEEKEND_DAYS = (1, 7)             # Sunday, Saturday (1 = Sunday)
# Activity classes by the first non-empty recency window, most recent first.
ACTIVITY_LEVELS = [(30, "Very Active"), (90, "Active"), (180, "Moderately Active"), (365, "Less Active")]
INACTIVE = "Inactive"
HOURS = list(range(24))
DAYS = list(range(1, 8))

assert set(COUNTED_TYPES) <= {t for _, t in COMMIT_TYPES} | {"other"}


def authored(stg_commits: DataFrame) -> DataFrame:
    """Commits with a known GitHub author (the mart's input)."""
    return stg_commits.where(c(AUTHOR).isNotNull())


def _type_col(t: str) -> str:
    return TYPE_COLUMN.get(t, f"{t}_commits")


def author_days(commits: DataFrame, as_of: Column) -> DataFrame:
    """Day rollup: one row per (author, commit_date); a NULL date is its own row."""
    ts, hour = c("commit_timestamp"), c("commit_hour")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.min(ts).alias("day_first"),
        F.max(ts).alias("day_last"),
        *[F.count_if(c("commit_type") == t).alias(_type_col(t)) for t in COUNTED_TYPES],
        F.count_if(F.coalesce(c("is_verified"), F.lit(False))).alias("verified_commits"),
        F.count_if(F.coalesce(c("is_merge_commit"), F.lit(False))).alias("merge_commits"),
        F.count_if(c("pull_request_number").isNotNull()).alias("pr_commits"),
        *[F.count_if(ts >= since(as_of, d)).alias(f"commits_last_{d}_days") for d in RECENCY_DAYS],
        F.max(F.coalesce(c("github_author_is_site_admin"), F.lit(False))).alias("is_site_admin"),
        F.count_if(hour.between(*BUSINESS_HOURS)).alias("business_hours_commits"),
        F.count_if((hour < BUSINESS_HOURS[0]) | (hour > BUSINESS_HOURS[1])).alias("off_hours_commits"),
        F.count_if(hour.isNull()).alias("h_null"),
        *[F.count_if(hour == h).alias(f"h_{h}") for h in HOURS],
    ]
    return commits.groupBy(AUTHOR, "commit_date").agg(*aggs)


def _mode_of(buckets: list[tuple[Column, Column]]) -> Column:
    """Bucket label with the highest count; ties go to the earliest bucket in ``buckets``.

    ``buckets`` is ordered as the source's tie-break: the NULL bucket first, then ascending.
    """
    best = F.greatest(*[F.struct(n.alias("n"), F.lit(-i).alias("r"), label.alias("v"))
                        for i, (n, label) in enumerate(buckets)])
    return best.getField("v")


def author_totals(days: DataFrame, as_of: Column) -> DataFrame:
    """Author rollup of the day rows (all fixed-width hash aggregates)."""
    d, n = c("commit_date"), c("n")
    dow = F.dayofweek(d)
    summed = [_type_col(t) for t in COUNTED_TYPES] + [
        "verified_commits", "merge_commits", "pr_commits", "business_hours_commits", "off_hours_commits",
        *[f"commits_last_{x}_days" for x in RECENCY_DAYS], "h_null", *[f"h_{h}" for h in HOURS]]
    aggs = [
        F.sum(n).alias("total_commits"),
        F.min("day_first").alias("first_commit_at"),
        F.max("day_last").alias("last_commit_at"),
        F.max("is_site_admin").alias("is_site_admin"),
        *[F.sum(x).alias(x) for x in summed],
        F.count(d).alias("active_days"),
        *[F.count_if(d.isNotNull() & (c("day_last") >= since(as_of, x))).alias(f"active_days_last_{x}")
          for x in ACTIVE_DAY_WINDOWS],
        F.avg(n).alias("avg_commits_per_active_day"),
        F.max(n).alias("max_commits_in_day"),
        F.sum(F.when(dow.isin(*WEEKEND_DAYS), n).otherwise(0)).alias("weekend_commits"),
        F.sum(F.when(dow.between(2, 6), n).otherwise(0)).alias("weekday_commits"),
        F.sum(F.when(d.isNull(), n).otherwise(0)).alias("dow_null"),
        *[F.sum(F.when(dow == x, n).otherwise(0)).alias(f"dow_{x}") for x in DAYS],
    ]
    t = days.groupBy(AUTHOR).agg(*aggs)
    hour_buckets = [(c("h_null"), F.lit(None).cast("bigint"))] + [(c(f"h_{h}"), F.lit(h).cast("bigint"))
                                                                  for h in HOURS]
    dow_buckets = [(c("dow_null"), F.lit(None).cast("bigint"))] + [(c(f"dow_{x}"), F.lit(x).cast("bigint"))
                                                                   for x in DAYS]
    drop = ["h_null", *[f"h_{h}" for h in HOURS], "dow_null", *[f"dow_{x}" for x in DAYS]]
    return t.select("*", _mode_of(hour_buckets).alias("most_active_hour"),
                    _mode_of(dow_buckets).alias("most_active_day_of_week")).drop(*drop)


def value_counts(commits: DataFrame, keys: list[str]) -> DataFrame:
    """Commits per repository, pull request and e-mail address of each ``keys`` (NULL values are not counted)."""
    pairs = F.explode(F.array(
        F.struct(F.lit("repo").alias("kind"), c("repo").alias("value")),
        F.struct(F.lit("pr").alias("kind"), c("pull_request_number").cast("string").alias("value")),
        F.struct(F.lit("email").alias("kind"), c("git_author_email").alias("value")),
    )).alias("kv")
    return (commits.select(*keys, pairs).select(*keys, "kv.kind", "kv.value")
            .where(c("value").isNotNull())
            .groupBy(*keys, "kind", "value").agg(F.count(F.lit(1)).alias("n")))


def author_values(commits: DataFrame) -> DataFrame:
    """Distinct repos, distinct pull requests and e-mail mode from one rollup.

    Each commit contributes three (kind, value) pairs; counting per
    (author, kind, value) collapses duplicates map-side, then one author-level
    pass counts distinct values and picks the most used e-mail (ties: smallest).
    """
    return values_of(value_counts(commits, [AUTHOR]))


def values_of(counted: DataFrame) -> DataFrame:
    """One row per author from its (author, kind, value) counts."""
    email = c("kind") == "email"
    return counted.groupBy(AUTHOR).agg(
        F.count_if(c("kind") == "repo").alias("repos_contributed_to"),
        F.count_if(c("kind") == "pr").alias("unique_prs"),
        F.min(F.when(email, F.struct((-c("n")).alias("neg"), c("value").alias("v")))).getField("v")
        .alias("git_author_email"),
    )


PROFILE = ["github_author_login", "github_author_avatar_url", "github_author_profile_url",
           "github_author_type", "git_author_name"]


def author_profile(commits: DataFrame) -> DataFrame:
    """Profile attributes of each author's latest commit (NULL times last; ties: greatest sha)."""
    return latest_by(commits, AUTHOR, ["commit_timestamp", "sha"], PROFILE)


# The columns of the mart, in the order of its contract.
FINAL_COLUMNS = [
    "committer_id", "github_login", "committer_name", "committer_email", "avatar_url", "profile_url",
    "account_type", "is_site_admin", "total_commits", "repos_contributed_to", "active_days",
    "days_active_span", "first_commit_at", "last_commit_at",
    *[_type_col(t) for t in COUNTED_TYPES],
    "verified_commits", "unverified_commits", "merge_commits", "pr_commits", "unique_prs",
    *[f"commits_last_{d}_days" for d in RECENCY_DAYS], *[f"active_days_last_{d}" for d in ACTIVE_DAY_WINDOWS],
    "weekend_commits", "weekday_commits", "business_hours_commits", "off_hours_commits", "most_active_hour",
    "most_active_day_of_week", "avg_commits_per_active_day", "max_commits_in_day", "days_since_last_commit",
    "activity_status", "fix_commits_pct", "feature_commits_pct", "docs_commits_pct", "refactor_commits_pct",
    "verification_rate_pct", "merge_commit_pct", "commits_per_active_day", "avg_commits_per_day_in_span",
]


def activity_status(*recent_counts: Column) -> Column:
    """Class of the first recency window (30, 90, 180, 365 days) holding any commit."""
    out = None
    for count, (_, label) in zip(recent_counts, ACTIVITY_LEVELS):
        out = F.when(count > 0, label) if out is None else out.when(count > 0, label)
    return out.otherwise(INACTIVE)


# The columns of staging that the mart reads.
INPUT_COLUMNS = [AUTHOR, "sha", "repo", "commit_timestamp", "commit_date", "commit_hour", "commit_type", "is_verified",
                 "is_merge_commit", "pull_request_number", "git_author_email", "github_author_is_site_admin", *PROFILE]


def committer_stats(stg_commits: DataFrame, as_of: Column) -> DataFrame:
    """All committer columns except the two global ranks."""
    commits = authored(stg_commits).select(*INPUT_COLUMNS)
    return stats_from(author_totals(author_days(commits, as_of), as_of), author_values(commits),
                      author_profile(commits), as_of)


def stats_from(totals: DataFrame, values: DataFrame, profile: DataFrame, as_of: Column) -> DataFrame:
    """The committer columns from the three rollups by author."""
    base = totals.join(values, AUTHOR, "left").join(profile, AUTHOR, "left")
    total = c("total_commits")
    span = days_between(c("first_commit_at"), c("last_commit_at"))
    return base.select(
        c(AUTHOR).alias("committer_id"),
        c("github_author_login").alias("github_login"),
        c("git_author_name").alias("committer_name"),
        c("git_author_email").alias("committer_email"),
        c("github_author_avatar_url").alias("avatar_url"),
        c("github_author_profile_url").alias("profile_url"),
        c("github_author_type").alias("account_type"),
        "is_site_admin", "total_commits",
        F.coalesce(c("repos_contributed_to"), F.lit(0)).alias("repos_contributed_to"),
        "active_days", span.alias("days_active_span"), "first_commit_at", "last_commit_at",
        *[_type_col(t) for t in COUNTED_TYPES],
        "verified_commits", (total - c("verified_commits")).alias("unverified_commits"),
        "merge_commits", "pr_commits", F.coalesce(c("unique_prs"), F.lit(0)).alias("unique_prs"),
        *[f"commits_last_{d}_days" for d in RECENCY_DAYS], *[f"active_days_last_{d}" for d in ACTIVE_DAY_WINDOWS],
        "weekend_commits", "weekday_commits", "business_hours_commits", "off_hours_commits",
        "most_active_hour", "most_active_day_of_week", "avg_commits_per_active_day", "max_commits_in_day",
        days_between(c("last_commit_at"), as_of).alias("days_since_last_commit"),
        activity_status(*[c(f"commits_last_{d}_days") for d in RECENCY_DAYS]).alias("activity_status"),
        pct(c("fix_commits"), total).alias("fix_commits_pct"),
        pct(c("feature_commits"), total).alias("feature_commits_pct"),
        pct(c("docs_commits"), total).alias("docs_commits_pct"),
        pct(c("refactor_commits"), total).alias("refactor_commits_pct"),
        pct(c("verified_commits"), total).alias("verification_rate_pct"),
        pct(c("merge_commits"), total).alias("merge_commit_pct"),
        rate(total, c("active_days")).alias("commits_per_active_day"),
        rate(total, greatest_strict(span, 1)).alias("avg_commits_per_day_in_span"),
    )


def committers(stg_commits: DataFrame, as_of: Column | None = None, built_at: Column | None = None,
               sort: bool = True) -> DataFrame:
    """The committers mart: ``committer_stats`` plus both global ranks.

    Ranks break ties by ``committer_id`` (the source leaves ties arbitrary).
    """
    as_of = as_of if as_of is not None else F.current_timestamp()
    return ranked_committers(committer_stats(stg_commits, as_of), built_at, sort)


def ranked_committers(stats: DataFrame, built_at: Column | None = None, sort: bool = True) -> DataFrame:
    """The mart from its columns without ranks."""
    stats = stored(stats, stats.sparkSession, "committer-stats")     # read several times below
    ranks = [rank_by_value(stats.select("committer_id", by), by, "committer_id", name).drop(by)
             for by, name in (("commits_last_90_days", "rank_by_recent_activity"),
                              ("total_commits", "rank_by_total_commits"))]
    ranked = stats.join(ranks[0], "committer_id").join(ranks[1], "committer_id")
    built = (built_at if built_at is not None else F.current_timestamp()).alias("dbt_updated_at")
    out = ranked.select(*FINAL_COLUMNS, "rank_by_total_commits", "rank_by_recent_activity", built)
    # Written in rank order (a distributed range sort over one row per author).
    return out.orderBy("rank_by_total_commits") if sort else out
