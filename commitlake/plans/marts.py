"""Marts over the staging tables (projections; commits also loads incrementally)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.functions.text import full_repo_name

c = F.col

# The columns of each mart, in the order of its contract.
REPOSITORY_COLUMNS = [
    "repo_sk", "repo_id", "node_id", "org", "repo", "full_name", "full_repo_name", "repo_github_url",
    "git_url", "ssh_url", "clone_url", "homepage_url", "is_private", "is_fork", "is_archived", "is_disabled",
    "description", "visibility", "primary_language", "default_branch", "repo_size_kb", "stargazers_count",
    "watchers_count", "forks_count", "open_issues_count", "subscribers_count", "network_count", "created_at",
    "updated_at", "pushed_at", "owner_login", "owner_id", "owner_type", "owner_github_url", "owner_avatar_url",
    "owner_is_site_admin", "_sdc_extracted_at",
]

COMMIT_COLUMNS = [
    "sha", "org", "repo", "repo_id", "node_id", "commit_api_url", "commit_github_url", "commit_timestamp",
    "commit_message", "pull_request_number", "commit_type", "git_author_name", "git_author_email",
    "git_author_timestamp", "git_committer_name", "git_committer_email", "git_committer_timestamp",
    "is_merge_commit", "is_verified", "verification_reason", "tree_sha", "tree_url",
    "github_author_id", "github_author_login", "github_author_avatar_url", "github_author_profile_url",
    "github_author_type", "github_author_is_site_admin", "github_committer_id", "github_committer_login",
    "github_committer_avatar_url", "github_committer_profile_url", "github_committer_type",
    "github_committer_is_site_admin", "commit_date", "commit_week", "commit_month", "commit_quarter",
    "commit_year", "commit_day_of_week", "commit_hour",
]

PR_COMMIT_COLUMNS = [
    "pull_request_commit_sk", "org", "repo", "repo_id", "full_repo_name", "pull_request_number", "sha",
    "node_id", "commit_api_url", "commit_github_url", "comments_api_url", "commit_message", "comment_count",
    "commit_type", "is_merge_commit", "git_author_name", "git_author_email", "git_author_timestamp",
    "git_committer_name", "git_committer_email", "git_committer_timestamp", "tree_sha", "tree_url",
    "is_verified", "verification_reason", "verified_at", "github_author_id", "github_author_login",
    "github_author_avatar_url", "github_author_profile_url", "github_author_type",
    "github_author_is_site_admin", "github_committer_id", "github_committer_login",
    "github_committer_avatar_url", "github_committer_profile_url", "github_committer_type",
    "github_committer_is_site_admin", "commit_date", "commit_week", "commit_month", "commit_quarter",
    "commit_year", "commit_day_of_week", "commit_hour", "_sdc_extracted_at",
]

BRANCH_COLUMNS = ["branch_sk", "org", "repo", "repo_id", "full_repo_name", "branch_name", "is_protected",
                  "commit_sha", "commit_api_url", "_sdc_extracted_at"]


def _built(built_at: Column | None) -> Column:
    return (built_at if built_at is not None else F.current_timestamp()).alias("dbt_updated_at")


def repositories_mart(stg: DataFrame, built_at: Column | None = None) -> DataFrame:
    return stg.select(*REPOSITORY_COLUMNS, _built(built_at))


def branches_mart(stg: DataFrame, built_at: Column | None = None) -> DataFrame:
    return stg.select(*BRANCH_COLUMNS, (c("branch_name") == "main").alias("is_main_branch"), _built(built_at))


def commits_mart(stg: DataFrame, built_at: Column | None = None) -> DataFrame:
    """Commit facts; loaded incrementally on ``commit_timestamp`` (see ``build.build_all``)."""
    return stg.select(*COMMIT_COLUMNS, full_repo_name(c("org"), c("repo")).alias("full_repo_name"),
                      _built(built_at))


def pull_request_commits_mart(stg: DataFrame, built_at: Column | None = None) -> DataFrame:
    return stg.select(*PR_COMMIT_COLUMNS, _built(built_at))
