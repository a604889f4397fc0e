"""DuckDB oracle SQL.

Typed columns are recomputed straight from the driver tables (``events``,
``part``) with the fixture rules, not through the JSON envelope, and the
models are written as plain set-based DuckDB SQL. Every
timestamp output is rendered as ``YYYY-MM-DD HH:MM:SS.ffffff`` text (the
Spark side does the same), so session time zones cannot make equal values
differ. Integer outputs are cast to BIGINT (DuckDB widens counts to HUGEINT).
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
X0 = "TIMESTAMP '2024-02-01 00:00:00'"   # first extraction batch
API = "https://api.github.com/repos/"
WEB = "https://github.com/"
AVATAR = "https://avatars.githubusercontent.com/u/"


def ts(col: str, alias: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f') AS {alias or col.split('.')[-1]}"


def _commit_rows(sha_prefix: str, pr: bool, versions: str) -> str:
    """Typed commit rows, one per (event, version). ``versions``: 'latest' | 'all' | '0' | '1'."""
    if versions == "latest":
        ver = "SELECT *, CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS v FROM events"
    elif versions == "all":
        ver = ("SELECT *, 0 AS v FROM events UNION ALL "
               "SELECT *, 1 AS v FROM events WHERE event_id % 10 = 0")
    elif versions == "0":
        ver = "SELECT *, 0 AS v FROM events"
    else:
        ver = "SELECT *, 1 AS v FROM events WHERE event_id % 10 = 0"
    msg = """CASE e % 13
          WHEN 0 THEN 'feat(api): item #' || e
          WHEN 1 THEN 'feat:add ' || e
          WHEN 2 THEN 'feat: spaced'
          WHEN 3 THEN 'fix(core): bug (#' || (e % 50) || ')'
          WHEN 4 THEN 'docs:readme'
          WHEN 5 THEN 'refactor(db): x'
          WHEN 6 THEN 'test:unit'
          WHEN 7 THEN 'chore(deps): bump'
          WHEN 8 THEN 'perf(io): fast'
          WHEN 9 THEN 'style:fmt'
          WHEN 10 THEN 'ci(gh): run'
          WHEN 11 THEN '[build] jar'
        END || CASE WHEN v = 1 THEN ' v1' ELSE '' END"""
    return f"""
    SELECT *,
      {X0} + to_hours(CAST(e % 5 AS INTEGER)) + to_days(CAST(v AS INTEGER)) AS _sdc_extracted_at
    FROM (
      SELECT
        e, u, v,
        'org' || ((e // 6) % 2) AS org,
        'repo' || (e % 6) AS repo,
        CAST(100 + e % 12 AS BIGINT) AS repo_id,
        '{'C_' if not pr else 'PRC_'}' || e AS node_id,
        md5('{sha_prefix}' || e) AS sha,
        ts - to_days(CAST((u * 37) % 500 AS INTEGER)) AS ct,
        {msg} AS commit_message,
        CAST(e % 3 AS BIGINT) AS comment_count,
        'user ' || u || '-' || (e % 2) AS git_author_name,
        CASE WHEN e % 19 <> 0 THEN 'u' || u || '_' || (e % 3) || '@x.io' END AS git_author_email,
        md5('t' || e) AS tree_sha,
        CASE WHEN e % 23 <> 0 THEN e % 3 = 0 END AS is_verified,
        e % 4 = 0 AS web_flow,
        e % 17 <> 0 AS has_author,
        CAST(e % 50 AS BIGINT) AS pull_number
      FROM (SELECT event_id AS e, user_id AS u, ts, v FROM ({ver}) AS vv) AS x
    ) AS y"""


def typed_commits(sha_prefix: str = "c", pr: bool = False, versions: str = "latest") -> str:
    """All typed columns of (pull-request) commits as the staging model computes them."""
    rows = _commit_rows(sha_prefix, pr, versions)
    return f"""
    SELECT
      org, repo, repo_id, node_id, sha,
      '{API}' || org || '/' || repo || '/commits/' || sha AS commit_api_url,
      '{WEB}' || org || '/' || repo || '/commit/' || sha AS commit_github_url,
      {'pull_number AS pull_request_number_payload,' if pr else ''}
      {"'" + API + "' || org || '/' || repo || '/commits/' || sha || '/comments' AS comments_api_url," if pr else ''}
      ct AS commit_timestamp,
      commit_message, comment_count,
      git_author_name, git_author_email, ct AS git_author_timestamp,
      CASE WHEN web_flow THEN 'GitHub' ELSE git_author_name END AS git_committer_name,
      CASE WHEN web_flow THEN 'noreply@host.io' ELSE git_author_email END AS git_committer_email,
      ct + to_minutes(CAST(e % 7 AS INTEGER)) AS git_committer_timestamp,
      tree_sha, '{API}' || org || '/' || repo || '/git/trees/' || tree_sha AS tree_url,
      is_verified,
      CASE WHEN is_verified THEN 'valid' WHEN NOT is_verified THEN 'unsigned' END AS verification_reason,
      CASE WHEN is_verified THEN ct + INTERVAL 2 MINUTE END AS verified_at,
      CASE WHEN has_author THEN u END AS github_author_id,
      CASE WHEN has_author THEN 'user' || u END AS github_author_login,
      CASE WHEN has_author THEN '{AVATAR}' || u END AS github_author_avatar_url,
      CASE WHEN has_author THEN '{WEB}user' || u END AS github_author_profile_url,
      CASE WHEN has_author THEN CASE WHEN u % 50 = 0 THEN 'Bot' ELSE 'User' END END AS github_author_type,
      CASE WHEN has_author THEN u % 40 = 0 END AS github_author_is_site_admin,
      CASE WHEN web_flow THEN 19864447 WHEN has_author THEN u END AS github_committer_id,
      CASE WHEN web_flow THEN 'web-flow' WHEN has_author THEN 'user' || u END AS github_committer_login,
      CASE WHEN web_flow THEN '{AVATAR}19864447' WHEN has_author THEN '{AVATAR}' || u END
        AS github_committer_avatar_url,
      CASE WHEN web_flow THEN '{WEB}web-flow' WHEN has_author THEN '{WEB}user' || u END
        AS github_committer_profile_url,
      CASE WHEN web_flow THEN 'User' WHEN has_author THEN CASE WHEN u % 50 = 0 THEN 'Bot' ELSE 'User' END END
        AS github_committer_type,
      CASE WHEN web_flow THEN FALSE WHEN has_author THEN u % 40 = 0 END AS github_committer_is_site_admin,
      _sdc_extracted_at,
      _sdc_extracted_at + INTERVAL 1 MINUTE AS _sdc_received_at,
      _sdc_extracted_at + INTERVAL 2 MINUTE AS _sdc_batched_at,
      CAST(NULL AS TIMESTAMP) AS _sdc_deleted_at,
      CAST(e * 10 + v AS BIGINT) AS _sdc_sequence,
      CAST(1 AS BIGINT) AS _sdc_table_version
    FROM ({rows}) AS r"""


def commit_type_sql(msg: str, lenient: bool = False) -> str:
    """The classifier with the source's own regex (DuckDB uses the same RE2 dialect); the lenient form also takes
    an optional scope and ``!`` before a colon, whatever follows it."""
    # Prefix → class in first-match order; the pattern is prefix, '(' or ':', word boundary.
    pairs = [("feat", "feature"), ("fix", "fix"), ("docs", "docs"), ("refactor", "refactor"),
             ("test", "test"), ("chore", "chore"), ("perf", "performance"), ("style", "style"),
             ("ci", "ci"), ("build", "build")]
    ending = "((\\(|:)\\b|(\\([^)]*\\))?!?:)" if lenient else "(\\(|:)\\b"
    whens = "\n".join(
        f"        WHEN regexp_matches(lower({msg}), '^{p}{ending}') THEN '{t}'" for p, t in pairs)
    return f"CASE\n{whens}\n        ELSE 'other' END"


def derived(ts_col: str, pr_from_message: bool = True) -> str:
    parts = []
    if pr_from_message:
        parts.append("TRY_CAST(NULLIF(regexp_extract(commit_message, '#([0-9]+)', 1), '') AS BIGINT)"
                     " AS pull_request_number")
    parts += [
        f"CAST({ts_col} AS DATE) AS commit_date",
        f"CAST(date_trunc('week', CAST({ts_col} AS DATE)) AS DATE) AS commit_week",
        f"CAST(date_trunc('month', CAST({ts_col} AS DATE)) AS DATE) AS commit_month",
        f"CAST(date_trunc('quarter', CAST({ts_col} AS DATE)) AS DATE) AS commit_quarter",
        f"CAST(date_trunc('year', CAST({ts_col} AS DATE)) AS DATE) AS commit_year",
        f"CAST(dayofweek({ts_col}) + 1 AS BIGINT) AS commit_day_of_week",
        f"CAST(hour({ts_col}) AS BIGINT) AS commit_hour",
        "(git_author_email IS NOT NULL AND git_committer_email IS NOT NULL "
        "AND git_author_email != git_committer_email) AS is_merge_commit",
        f"{commit_type_sql('commit_message')} AS commit_type",
    ]
    return ",\n      ".join(parts)


BODY = """commit_message, comment_count, git_author_name, git_author_email, git_author_timestamp,
      git_committer_name, git_committer_email, git_committer_timestamp, tree_sha, tree_url, is_verified,
      verification_reason, verified_at, github_author_id, github_author_login, github_author_avatar_url,
      github_author_profile_url, github_author_type, github_author_is_site_admin, github_committer_id,
      github_committer_login, github_committer_avatar_url, github_committer_profile_url, github_committer_type,
      github_committer_is_site_admin"""
SDC = "_sdc_extracted_at, _sdc_received_at, _sdc_batched_at, _sdc_deleted_at, _sdc_sequence, _sdc_table_version"


def stg_commits(versions: str = "latest") -> str:
    return f"""
    SELECT org, repo, repo_id, node_id, sha, commit_api_url, commit_github_url, commit_timestamp,
      {BODY}, {SDC},
      {derived('commit_timestamp')}
    FROM ({typed_commits('c', False, versions)}) AS t"""


def stg_pr_commits(versions: str = "latest") -> str:
    return f"""
    SELECT org, repo, repo_id, pull_request_number_payload AS pull_request_number, sha, node_id,
      commit_api_url, commit_github_url, comments_api_url,
      {BODY}, {SDC},
      coalesce(org, '') || '/' || coalesce(repo, '') || ':' || coalesce(CAST(repo_id AS VARCHAR), '')
        || ':pr:' || coalesce(CAST(pull_request_number_payload AS VARCHAR), '') || ':' || coalesce(sha, '')
        AS pull_request_commit_sk,
      org || '/' || repo AS full_repo_name,
      {derived('git_author_timestamp', pr_from_message=False)},
      {AS_OF} AS dbt_updated_at
    FROM ({typed_commits('p', True, versions)}) AS t"""


def typed_branches(versions: str = "latest") -> str:
    if versions == "latest":
        ver = "SELECT *, CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS v FROM part"
    elif versions == "all":
        ver = "SELECT *, 0 AS v FROM part UNION ALL SELECT *, 1 AS v FROM part WHERE p_partkey % 10 = 0"
    else:
        ver = f"SELECT *, {versions} AS v FROM part" + (" WHERE p_partkey % 10 = 0" if versions == "1" else "")
    return f"""
    SELECT org, repo, repo_id, branch_name, is_protected, commit_sha,
      '{API}' || org || '/' || repo || '/commits/' || commit_sha AS commit_api_url,
      {X0} + to_hours(CAST(p % 5 AS INTEGER)) + to_days(CAST(v AS INTEGER)) AS _sdc_extracted_at,
      {X0} + to_hours(CAST(p % 5 AS INTEGER)) + to_days(CAST(v AS INTEGER)) AS _sdc_received_at,
      {X0} + to_hours(CAST(p % 5 AS INTEGER)) + to_days(CAST(v AS INTEGER)) AS _sdc_batched_at,
      CAST(NULL AS TIMESTAMP) AS _sdc_deleted_at,
      CAST(p * 10 + v AS BIGINT) AS _sdc_sequence,
      CAST(1 AS BIGINT) AS _sdc_table_version
    FROM (
      SELECT p_partkey AS p, v,
        'org' || (p_partkey % 2) AS org,
        'repo' || (p_partkey % 6) AS repo,
        CAST(100 + p_partkey % 12 AS BIGINT) AS repo_id,
        CASE WHEN p_partkey < 12 THEN 'main' ELSE 'b' || p_partkey END AS branch_name,
        CASE WHEN v = 1 THEN NOT (p_size > 25) ELSE p_size > 25 END AS is_protected,
        md5(CASE WHEN v = 1 THEN 'c' || p_partkey || 'v1' ELSE 'c' || p_partkey END) AS commit_sha
      FROM ({ver}) AS vv
    ) AS b"""


def stg_branches(versions: str = "latest") -> str:
    return f"""
    SELECT org, repo, repo_id, branch_name, is_protected, commit_sha, commit_api_url, {SDC},
      coalesce(org, '') || '/' || coalesce(repo, '') || ':' || coalesce(CAST(repo_id AS VARCHAR), '')
        || ':' || coalesce(branch_name, '') AS branch_sk,
      org || '/' || repo AS full_repo_name,
      {AS_OF} AS dbt_updated_at
    FROM ({typed_branches(versions)}) AS t"""


def typed_repositories(versions: str = "latest") -> str:
    if versions == "latest":
        ver = "SELECT *, CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS v FROM part"
    elif versions == "all":
        ver = "SELECT *, 0 AS v FROM part UNION ALL SELECT *, 1 AS v FROM part WHERE p_partkey % 10 = 0"
    else:
        ver = f"SELECT *, {versions} AS v FROM part" + (" WHERE p_partkey % 10 = 0" if versions == "1" else "")
    return f"""
    SELECT *,
      {X0} + to_hours(CAST(repo_id % 5 AS INTEGER)) + to_days(CAST(v AS INTEGER)) AS _sdc_extracted_at,
      {X0} + to_hours(CAST(repo_id % 5 AS INTEGER)) + to_days(CAST(v AS INTEGER)) AS _sdc_received_at,
      {X0} + to_hours(CAST(repo_id % 5 AS INTEGER)) + to_days(CAST(v AS INTEGER)) AS _sdc_batched_at,
      CAST(NULL AS TIMESTAMP) AS _sdc_deleted_at,
      CAST(repo_id * 10 + v AS BIGINT) AS _sdc_sequence,
      CAST(1 AS BIGINT) AS _sdc_table_version
    FROM (
      SELECT
        v,
        p_partkey AS repo_id,
        'R_' || p_partkey AS node_id,
        CASE WHEN p_partkey % 13 <> 0 THEN 'repo' || p_partkey END AS name,
        CASE WHEN p_partkey % 9 <> 0 THEN 'org' || (p_partkey % 2) || '/repo' || p_partkey END AS full_name,
        CASE WHEN NOT (v = 1 AND p_partkey % 30 = 0) THEN 'org' || (p_partkey % 2) END AS org,
        'repo' || p_partkey AS repo_slug,
        '{WEB}org' || (p_partkey % 2) || '/repo' || p_partkey AS repo_github_url,
        'git://github.com/org' || (p_partkey % 2) || '/repo' || p_partkey || '.git' AS git_url,
        'git@github.com:org' || (p_partkey % 2) || '/repo' || p_partkey || '.git' AS ssh_url,
        '{WEB}org' || (p_partkey % 2) || '/repo' || p_partkey || '.git' AS clone_url,
        CASE WHEN p_partkey % 3 <> 0 THEN 'https://example.org/' || p_partkey END AS homepage_url,
        p_partkey % 4 = 0 AS is_private,
        p_partkey % 7 = 0 AS is_fork,
        p_partkey % 11 = 0 AS is_archived,
        FALSE AS is_disabled,
        CASE WHEN v = 1 THEN p_name || ' (updated)' ELSE p_name END AS description,
        CASE WHEN p_partkey % 4 = 0 THEN 'private' ELSE 'public' END AS visibility,
        p_brand AS primary_language,
        'main' AS default_branch,
        CAST(p_size AS BIGINT) AS repo_size_kb,
        CAST(p_partkey % 100 + v AS BIGINT) AS stargazers_count,
        CAST(p_partkey % 100 + v AS BIGINT) AS watchers_count,
        CAST(p_partkey % 17 AS BIGINT) AS forks_count,
        CAST(p_partkey % 5 AS BIGINT) AS open_issues_count,
        CAST(p_partkey % 23 AS BIGINT) AS subscribers_count,
        CAST(p_partkey % 17 AS BIGINT) AS network_count,
        CAST(DATE '2023-01-01' + CAST(p_partkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at,
        CAST(DATE '2024-01-01' + CAST(p_partkey % 28 + v AS INTEGER) AS TIMESTAMP) AS updated_at,
        CAST(DATE '2024-01-01' + CAST(p_partkey % 28 + v AS INTEGER) AS TIMESTAMP) - INTERVAL 1 HOUR AS pushed_at,
        'org' || (p_partkey % 2) AS owner_login,
        CAST(1000 + p_partkey % 2 AS BIGINT) AS owner_id,
        'Organization' AS owner_type,
        '{WEB}org' || (p_partkey % 2) AS owner_github_url,
        '{AVATAR}' || (1000 + p_partkey % 2) AS owner_avatar_url,
        FALSE AS owner_is_site_admin
      FROM ({ver}) AS vv
    ) AS r"""


REPO_FINAL = """repo_id, node_id, org, full_name, repo_github_url, git_url, ssh_url, clone_url, homepage_url,
      is_private, is_fork, is_archived, is_disabled, description, visibility, primary_language, default_branch,
      repo_size_kb, stargazers_count, watchers_count, forks_count, open_issues_count, subscribers_count,
      network_count, created_at, updated_at, pushed_at, owner_login, owner_id, owner_type, owner_github_url,
      owner_avatar_url"""


def stg_repositories_from(deduped: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT {REPO_FINAL}, {SDC},
        coalesce(CAST(repo_id AS VARCHAR), '') || ':' || coalesce(full_name, coalesce(org, '')) AS repo_sk,
        coalesce(name, repo_slug) AS repo,
        coalesce(owner_is_site_admin, FALSE) AS owner_is_site_admin,
        org || '/' || coalesce(name, repo_slug) AS full_repo_name,
        {AS_OF} AS dbt_updated_at
      FROM ({deduped}) AS d
    ) AS f
    WHERE repo_id IS NOT NULL AND org IS NOT NULL AND coalesce(repo, '') != ''"""


def stg_repositories(versions: str = "latest") -> str:
    return stg_repositories_from(typed_repositories(versions))


def _cut(days: int) -> str:
    return f"({AS_OF} - INTERVAL {days} DAY)"


def _unix(col: str) -> str:
    """Whole seconds since epoch, floored (exact integer arithmetic)."""
    return f"((epoch_us({col}) - (((epoch_us({col}) % 1000000) + 1000000) % 1000000)) // 1000000)"


def _round2(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def _pct(n: str, d: str) -> str:
    return _round2(f"100.0::DOUBLE * (CAST({n} AS DOUBLE) / NULLIF({d}, 0))")


# Weekend days (1 = Sunday), business hours (UTC), commit classes with a counter, activity classes.
WEEKEND_DAYS = "(1, 7)"
BUSINESS_HOURS = "9 AND 17"
COUNTED_KINDS = ["fix", "feature", "docs", "refactor", "test", "chore", "performance", "other"]
RECENCY_DAYS = [30, 90, 180, 365]
ACTIVE_DAY_WINDOWS = [30, 90, 365]
ACTIVITY = [(30, "Very Active"), (90, "Active"), (180, "Moderately Active"), (365, "Less Active")]


def committers_cte(stg: str) -> str:
    """The committers mart as DuckDB SQL.

    ``counted`` counts the commits of each author once per value of six columns (grouping sets); ``of_values`` reads
    every distinct count, day figure and most frequent value off these counts. A row belongs to the column whose
    ``grouping`` is 0, so a NULL value is a counted value like any other.
    """
    kinds = COUNTED_KINDS

    def total(condition: str, name: str) -> str:
        return f"CAST(coalesce(sum(n) FILTER ({condition}), 0) AS BIGINT) AS {name}"

    per_kind = ",\n        ".join(
        f"CAST(count(*) FILTER (commit_type = '{k}') AS BIGINT) AS {k}_commits" for k in kinds)
    recency = ",\n        ".join(
        f"CAST(count(*) FILTER (commit_timestamp >= {_cut(d)}) AS BIGINT) AS commits_last_{d}_days" for d in RECENCY_DAYS)
    recent_days = ",\n        ".join(
        f"CAST(count(commit_date) FILTER (of_date AND latest >= {_cut(d)}) AS BIGINT) AS active_days_last_{d}"
        for d in ACTIVE_DAY_WINDOWS)
    status = " ".join(f"WHEN commits_last_{d}_days > 0 THEN '{label}'" for d, label in ACTIVITY)
    values = ["git_author_email", "commit_hour", "commit_day_of_week", "commit_date", "repo", "pull_request_number"]
    flags = ["of_email", "of_hour", "of_dow", "of_date", "of_repo", "of_pr"]
    sets = ", ".join(f"(github_author_id, {v})" for v in values)
    is_of = ", ".join(f"grouping({v}) = 0 AS {f}" for v, f in zip(values, flags))
    return f"""
    authored AS (SELECT * FROM ({stg}) AS s WHERE github_author_id IS NOT NULL),
    whole AS (
      SELECT github_author_id AS committer_id,
        CAST(count(*) AS BIGINT) AS total_commits,
        bool_or(coalesce(github_author_is_site_admin, FALSE)) AS is_site_admin,
        min(commit_timestamp) AS first_commit_at, max(commit_timestamp) AS last_commit_at,
        {per_kind},
        CAST(count(*) FILTER (coalesce(is_verified, FALSE)) AS BIGINT) AS verified_commits,
        CAST(count(*) FILTER (coalesce(is_merge_commit, FALSE)) AS BIGINT) AS merge_commits,
        CAST(count(pull_request_number) AS BIGINT) AS pr_commits,
        {recency},
        arg_max({{'github_login': github_author_login, 'committer_name': git_author_name,
                  'avatar_url': github_author_avatar_url, 'profile_url': github_author_profile_url,
                  'account_type': github_author_type}},
                row(coalesce(commit_timestamp, TIMESTAMP '0001-01-01'), sha)) AS profile
      FROM authored GROUP BY github_author_id),
    counted AS (
      SELECT github_author_id, {", ".join(values)}, {is_of}, count(*) AS n, max(commit_timestamp) AS latest
      FROM authored GROUP BY GROUPING SETS ({sets})),
    of_values AS (
      SELECT github_author_id AS committer_id,
        arg_min(git_author_email, row(-n, git_author_email)) FILTER (of_email AND git_author_email IS NOT NULL)
          AS committer_email,
        nullif(arg_min(coalesce(commit_hour, -1), row(-n, coalesce(commit_hour, -1))) FILTER (of_hour), -1)
          AS most_active_hour,
        nullif(arg_min(coalesce(commit_day_of_week, -1), row(-n, coalesce(commit_day_of_week, -1))) FILTER (of_dow), -1)
          AS most_active_day_of_week,
        CAST(count(repo) FILTER (of_repo) AS BIGINT) AS repos_contributed_to,
        CAST(count(pull_request_number) FILTER (of_pr) AS BIGINT) AS unique_prs,
        CAST(count(commit_date) FILTER (of_date) AS BIGINT) AS active_days,
        {recent_days},
        avg(n) FILTER (of_date) AS avg_commits_per_active_day,
        CAST(max(n) FILTER (of_date) AS BIGINT) AS max_commits_in_day,
        {total(f"of_dow AND commit_day_of_week IN {WEEKEND_DAYS}", "weekend_commits")},
        {total(f"of_dow AND commit_day_of_week NOT IN {WEEKEND_DAYS}", "weekday_commits")},
        {total(f"of_hour AND commit_hour BETWEEN {BUSINESS_HOURS}", "business_hours_commits")},
        {total(f"of_hour AND commit_hour NOT BETWEEN {BUSINESS_HOURS}", "off_hours_commits")}
      FROM counted GROUP BY github_author_id),
    joined AS (
      SELECT whole.* EXCLUDE (profile), unnest(profile), of_values.* EXCLUDE (committer_id),
        CAST(({_unix('last_commit_at')} - {_unix('first_commit_at')}) // 86400 AS BIGINT) AS days_active_span
      FROM whole JOIN of_values USING (committer_id)),
    committers AS (
      SELECT committer_id, github_login, committer_name, committer_email, avatar_url, profile_url, account_type,
        is_site_admin, total_commits, repos_contributed_to, active_days, days_active_span, first_commit_at,
        last_commit_at, {", ".join(k + "_commits" for k in kinds)},
        verified_commits, total_commits - verified_commits AS unverified_commits, merge_commits, pr_commits,
        unique_prs, commits_last_30_days, commits_last_90_days, commits_last_180_days, commits_last_365_days,
        active_days_last_30, active_days_last_90, active_days_last_365, weekend_commits, weekday_commits,
        business_hours_commits, off_hours_commits, most_active_hour, most_active_day_of_week,
        avg_commits_per_active_day, max_commits_in_day,
        CAST(({_unix(AS_OF)} - {_unix('last_commit_at')}) // 86400 AS BIGINT) AS days_since_last_commit,
        CASE {status} ELSE 'Inactive' END AS activity_status,
        {_pct('fix_commits', 'total_commits')} AS fix_commits_pct,
        {_pct('feature_commits', 'total_commits')} AS feature_commits_pct,
        {_pct('docs_commits', 'total_commits')} AS docs_commits_pct,
        {_pct('refactor_commits', 'total_commits')} AS refactor_commits_pct,
        {_pct('verified_commits', 'total_commits')} AS verification_rate_pct,
        {_pct('merge_commits', 'total_commits')} AS merge_commit_pct,
        {_round2('total_commits / NULLIF(CAST(active_days AS DOUBLE), 0)')} AS commits_per_active_day,
        {_round2('total_commits / NULLIF(CAST(CASE WHEN days_active_span < 1 THEN 1 ELSE days_active_span END AS DOUBLE), 0)')}
          AS avg_commits_per_day_in_span,
        CAST(row_number() OVER (ORDER BY total_commits DESC, committer_id) AS BIGINT) AS rank_by_total_commits,
        CAST(row_number() OVER (ORDER BY commits_last_90_days DESC, committer_id) AS BIGINT)
          AS rank_by_recent_activity,
        {AS_OF} AS dbt_updated_at
      FROM joined)"""


# ---- registry ---------------------------------------------------------------------------------------

def project(src: str, cols: str, where: str = "") -> str:
    """SELECT ``cols`` FROM ``src``; a column written ``@name`` is a timestamp rendered as text."""
    out = []
    for col in [x.strip() for x in cols.split(",") if x.strip()]:
        out.append(ts(col[1:]) if col.startswith("@") else col)
    return f"SELECT {', '.join(out)} FROM ({src}) AS q {where}"


TS_BODY = ("@git_author_timestamp, @git_committer_timestamp, @verified_at, "
           "@_sdc_extracted_at, @_sdc_received_at, @_sdc_batched_at, @_sdc_deleted_at")
BODY_PLAIN = ("commit_message, comment_count, git_author_name, git_author_email, git_committer_name, "
              "git_committer_email, tree_sha, tree_url, is_verified, verification_reason, github_author_id, "
              "github_author_login, github_author_avatar_url, github_author_profile_url, github_author_type, "
              "github_author_is_site_admin, github_committer_id, github_committer_login, "
              "github_committer_avatar_url, github_committer_profile_url, github_committer_type, "
              "github_committer_is_site_admin")
DIMS = "commit_date, commit_week, commit_month, commit_quarter, commit_year, commit_day_of_week, commit_hour"

STG_COMMITS_COLS = (f"org, repo, repo_id, node_id, sha, commit_api_url, commit_github_url, @commit_timestamp, "
                    f"{BODY_PLAIN}, {TS_BODY}, _sdc_sequence, _sdc_table_version, pull_request_number, {DIMS}, "
                    "is_merge_commit, commit_type")
STG_PR_COLS = (f"org, repo, repo_id, pull_request_number, sha, node_id, commit_api_url, commit_github_url, "
               f"comments_api_url, {BODY_PLAIN}, {TS_BODY}, _sdc_sequence, _sdc_table_version, "
               f"pull_request_commit_sk, full_repo_name, {DIMS}, is_merge_commit, commit_type, @dbt_updated_at")
STG_BRANCH_COLS = ("org, repo, repo_id, branch_name, is_protected, commit_sha, commit_api_url, @_sdc_extracted_at, "
                   "@_sdc_received_at, @_sdc_batched_at, @_sdc_deleted_at, _sdc_sequence, _sdc_table_version, "
                   "branch_sk, full_repo_name, @dbt_updated_at")
REPO_COLS_TS = ("repo_id, node_id, org, full_name, repo_github_url, git_url, ssh_url, clone_url, homepage_url, "
                "is_private, is_fork, is_archived, is_disabled, description, visibility, primary_language, "
                "default_branch, repo_size_kb, stargazers_count, watchers_count, forks_count, open_issues_count, "
                "subscribers_count, network_count, @created_at, @updated_at, @pushed_at, owner_login, owner_id, "
                "owner_type, owner_github_url, owner_avatar_url")
STG_REPO_COLS = (f"{REPO_COLS_TS}, @_sdc_extracted_at, @_sdc_received_at, @_sdc_batched_at, @_sdc_deleted_at, "
                 "_sdc_sequence, _sdc_table_version, repo_sk, repo, owner_is_site_admin, full_repo_name, "
                 "@dbt_updated_at")

MART_REPO_COLS = ("repo_sk, repo_id, node_id, org, repo, full_name, full_repo_name, repo_github_url, git_url, "
                  "ssh_url, clone_url, homepage_url, is_private, is_fork, is_archived, is_disabled, description, "
                  "visibility, primary_language, default_branch, repo_size_kb, stargazers_count, watchers_count, "
                  "forks_count, open_issues_count, subscribers_count, network_count, @created_at, @updated_at, "
                  "@pushed_at, owner_login, owner_id, owner_type, owner_github_url, owner_avatar_url, "
                  "owner_is_site_admin, @_sdc_extracted_at, @dbt_updated_at")
MART_BRANCH_COLS = ("branch_sk, org, repo, repo_id, full_repo_name, branch_name, is_protected, commit_sha, "
                    "commit_api_url, @_sdc_extracted_at, (branch_name = 'main') AS is_main_branch, @dbt_updated_at")
MART_COMMIT_COLS = ("sha, org, repo, repo_id, node_id, commit_api_url, commit_github_url, @commit_timestamp, "
                    "commit_message, pull_request_number, commit_type, git_author_name, git_author_email, "
                    "@git_author_timestamp, git_committer_name, git_committer_email, @git_committer_timestamp, "
                    "is_merge_commit, is_verified, verification_reason, tree_sha, tree_url, github_author_id, "
                    "github_author_login, github_author_avatar_url, github_author_profile_url, github_author_type, "
                    "github_author_is_site_admin, github_committer_id, github_committer_login, "
                    "github_committer_avatar_url, github_committer_profile_url, github_committer_type, "
                    f"github_committer_is_site_admin, {DIMS}, org || '/' || repo AS full_repo_name, "
                    f"{ts(AS_OF, 'dbt_updated_at')}")
MART_PR_COLS = ("pull_request_commit_sk, org, repo, repo_id, full_repo_name, pull_request_number, sha, node_id, "
                "commit_api_url, commit_github_url, comments_api_url, commit_message, comment_count, commit_type, "
                "is_merge_commit, git_author_name, git_author_email, @git_author_timestamp, git_committer_name, "
                "git_committer_email, @git_committer_timestamp, tree_sha, tree_url, is_verified, "
                "verification_reason, @verified_at, github_author_id, github_author_login, github_author_avatar_url, "
                "github_author_profile_url, github_author_type, github_author_is_site_admin, github_committer_id, "
                "github_committer_login, github_committer_avatar_url, github_committer_profile_url, "
                f"github_committer_type, github_committer_is_site_admin, {DIMS}, @_sdc_extracted_at, "
                "@dbt_updated_at")

COMMITTER_COLS = (
    "committer_id, github_login, committer_name, committer_email, avatar_url, profile_url, account_type, "
    "is_site_admin, total_commits, repos_contributed_to, active_days, days_active_span, @first_commit_at, "
    "@last_commit_at, fix_commits, feature_commits, docs_commits, refactor_commits, test_commits, chore_commits, "
    "performance_commits, other_commits, verified_commits, unverified_commits, merge_commits, pr_commits, "
    "unique_prs, commits_last_30_days, commits_last_90_days, commits_last_180_days, commits_last_365_days, "
    "active_days_last_30, active_days_last_90, active_days_last_365, weekend_commits, weekday_commits, "
    "business_hours_commits, off_hours_commits, most_active_hour, most_active_day_of_week, "
    "avg_commits_per_active_day, max_commits_in_day, days_since_last_commit, activity_status, fix_commits_pct, "
    "feature_commits_pct, docs_commits_pct, refactor_commits_pct, verification_rate_pct, merge_commit_pct, "
    "commits_per_active_day, avg_commits_per_day_in_span, rank_by_total_commits, rank_by_recent_activity, "
    "@dbt_updated_at")

STG_C = stg_commits()
COMMITTERS = f"WITH {committers_cte(STG_C)} SELECT * FROM committers"


def _committers(cols: str) -> str:
    return project(COMMITTERS, "committer_id, " + cols)


def _raw_commits(versions: str = "all") -> str:
    return stg_commits(versions)


ORACLE_SQL: dict[str, str] = {
    "stg_commits": project(STG_C, STG_COMMITS_COLS),
    "stg_pull_request_commits": project(stg_pr_commits(), STG_PR_COLS),
    "stg_branches": project(stg_branches(), STG_BRANCH_COLS),
    "stg_repositories": project(stg_repositories(), STG_REPO_COLS),
    "commits": project(STG_C, MART_COMMIT_COLS),
    "pull_request_commits": project(stg_pr_commits(), MART_PR_COLS),
    "branches": project(stg_branches(), MART_BRANCH_COLS),
    "repositories": project(stg_repositories(), MART_REPO_COLS),
    "committers": project(COMMITTERS, COMMITTER_COLS),
    "commits_by_type": f"SELECT commit_type, CAST(count(*) AS BIGINT) AS commit_count FROM ({STG_C}) AS s "
                       "GROUP BY commit_type",
    "top_committers": f"SELECT committer_id, github_login, total_commits, rank_by_total_commits FROM ({COMMITTERS}) "
                      "AS m ORDER BY total_commits DESC, committer_id ASC LIMIT 10",
    "mode_by": f"""SELECT committer_id, arg_min(commit_type, row(-n, commit_type)) AS usual_type
        FROM (SELECT github_author_id AS committer_id, commit_type, count(*) AS n FROM ({STG_C}) AS s
              WHERE github_author_id IS NOT NULL GROUP BY ALL) AS counted GROUP BY committer_id""",
    "email_mode": _committers("committer_email") + " WHERE committer_email IS NOT NULL",
    "profile_latest": f"""SELECT committer_id, github_login AS github_author_login, avatar_url AS github_author_avatar_url,
        profile_url AS github_author_profile_url, account_type AS github_author_type, committer_name AS git_author_name
        FROM ({COMMITTERS}) AS m""",
    "hour_mode": _committers("most_active_hour"),
    "dow_mode": _committers("most_active_day_of_week"),
    "group_count": f"""SELECT github_author_id, commit_hour, CAST(count(*) AS BIGINT) AS commit_hour_count
        FROM ({STG_C}) AS s WHERE github_author_id IS NOT NULL GROUP BY github_author_id, commit_hour""",
    "rank_total": _committers("total_commits, rank_by_total_commits"),
    "rank_recent": _committers("commits_last_90_days, rank_by_recent_activity"),
    "base_stats": _committers("total_commits, @first_commit_at, @last_commit_at, is_site_admin"),
    "distinct_counts": _committers("repos_contributed_to, active_days, unique_prs"),
    "type_breakdown": _committers("fix_commits, feature_commits, docs_commits, refactor_commits, test_commits, "
                                  "chore_commits, performance_commits, other_commits"),
    "flag_counts": _committers("verified_commits, unverified_commits, merge_commits, pr_commits"),
    "recency_counts": _committers("commits_last_30_days, commits_last_90_days, commits_last_180_days, "
                                  "commits_last_365_days"),
    "recency_days": _committers("active_days_last_30, active_days_last_90, active_days_last_365"),
    "time_patterns": _committers("weekend_commits, weekday_commits, business_hours_commits, off_hours_commits"),
    "contribution_intensity": _committers("avg_commits_per_active_day, max_commits_in_day"),
    "activity_status": _committers("activity_status"),
    "day_span": _committers("days_active_span, days_since_last_commit"),
    "pct": _committers("fix_commits_pct, feature_commits_pct, docs_commits_pct, refactor_commits_pct, "
                       "verification_rate_pct, merge_commit_pct, commits_per_active_day, avg_commits_per_day_in_span"),
    "left_join_dim": f"""SELECT s.sha, s.github_author_id, m.github_login, m.activity_status
        FROM ({STG_C}) AS s LEFT JOIN ({COMMITTERS}) AS m ON s.github_author_id = m.committer_id""",
    "dedupe_commits": project(STG_C, "sha, @commit_timestamp, @_sdc_extracted_at, _sdc_sequence"),
    "dedupe_branches": project(stg_branches(), "branch_sk, is_protected, commit_sha, @_sdc_extracted_at"),
    "dedupe_repositories": project(stg_repositories(), "repo_id, description, stargazers_count, @updated_at, "
                                                       "@_sdc_extracted_at"),
    "dedupe_pr_commits": project(stg_pr_commits(), "pull_request_commit_sk, commit_message, @_sdc_extracted_at"),
    "envelope_project": project(typed_commits("c", False, "all"), "@_sdc_extracted_at, @_sdc_received_at, "
                                "@_sdc_batched_at, @_sdc_deleted_at, _sdc_sequence, _sdc_table_version"),
    "flatten_commits": project(typed_commits("c", False, "all"),
                               "@_sdc_extracted_at, _sdc_sequence, sha, @commit_timestamp, org, repo, repo_id, "
                               f"node_id, commit_api_url, commit_github_url, {BODY_PLAIN}, @git_author_timestamp, "
                               "@git_committer_timestamp, @verified_at"),
    "flatten_pr_commits": project(typed_commits("p", True, "all"),
                                  "@_sdc_extracted_at, _sdc_sequence, org, repo, repo_id, "
                                  "pull_request_number_payload AS pull_request_number, sha, node_id, commit_api_url, "
                                  f"commit_github_url, comments_api_url, {BODY_PLAIN}, @git_author_timestamp, "
                                  "@git_committer_timestamp, @verified_at"),
    "flatten_branches": project(typed_branches("all"), "@_sdc_extracted_at, _sdc_sequence, org, repo, repo_id, "
                                "branch_name, is_protected, commit_sha, commit_api_url"),
    "flatten_repositories": project(typed_repositories("all"),
                                    "@_sdc_extracted_at, _sdc_sequence, repo_id, node_id, name AS repo, full_name, "
                                    "org, repo_slug, repo_github_url, git_url, ssh_url, clone_url, homepage_url, "
                                    "is_private, is_fork, is_archived, is_disabled, description, visibility, "
                                    "primary_language, default_branch, repo_size_kb, stargazers_count, "
                                    "watchers_count, forks_count, open_issues_count, subscribers_count, "
                                    "network_count, @created_at, @updated_at, @pushed_at, owner_login, owner_id, "
                                    "owner_type, owner_github_url, owner_avatar_url, owner_is_site_admin"),
    "land_envelope": project(_raw_commits("all"), "@_sdc_extracted_at, _sdc_sequence, sha, @commit_timestamp, "
                             "commit_message"),
    "jsonl_roundtrip": project(typed_branches("all"), "@_sdc_extracted_at, _sdc_sequence, org, repo, repo_id, "
                               "branch_name, is_protected, commit_sha, commit_api_url"),
    "raw_view": project(typed_repositories("all"), "repo_id, full_name, is_private, @updated_at, "
                        "@_sdc_extracted_at"),
    "stream_select": f"""SELECT 'commits' AS stream, CAST(count(*) AS BIGINT) AS n_records FROM ({typed_commits('c', False, 'all')}) AS a
        UNION ALL SELECT 'branches' AS stream, CAST(count(*) AS BIGINT) AS n_records FROM ({typed_branches('all')}) AS b""",
    "property_select": project(typed_commits("c", False, "all"), "_sdc_sequence, sha, commit_message, "
                               "CAST(NULL AS VARCHAR) AS github_author_login"),
    "json_value": project(typed_commits("c", False, "all"), "_sdc_sequence, sha, commit_message, "
                          "CAST(NULL AS VARCHAR) AS commit_object, github_author_login AS author_login"),
    "json_query": project(typed_commits("c", False, "all"), "_sdc_sequence, tree_sha, "
                          "'\"' || tree_sha || '\"' AS tree_sha_json"),
    "safe_int": project(typed_commits("c", False, "all"), "_sdc_sequence, repo_id, "
                        "CAST(NULL AS BIGINT) AS message_as_int, comment_count"),
    "safe_bool": project(typed_commits("c", False, "all"), "_sdc_sequence, is_verified, "
                         "github_author_is_site_admin AS is_site_admin, CAST(NULL AS BOOLEAN) AS count_as_bool"),
    "parse_rfc3339": project(typed_commits("c", False, "all"), "_sdc_sequence, @commit_timestamp, @verified_at, "
                             "CAST(NULL AS VARCHAR) AS sha_as_ts"),
    "coalesce": project(stg_repositories(), "repo_id, repo, owner_is_site_admin, repo_sk"),
    "full_repo_name": project(STG_C, "sha, org || '/' || repo AS full_repo_name"),
    "commit_type": project(STG_C, "sha, commit_message, commit_type"),
    "commit_type_lenient": project(STG_C, f"sha, {commit_type_sql('commit_message', lenient=True)} AS commit_type"),
    "pr_number": project(STG_C, "sha, pull_request_number"),
    "date_dims": project(STG_C, f"sha, {DIMS}"),
    "merge_flag": project(STG_C, "sha, git_author_email, git_committer_email, is_merge_commit"),
    "repo_sk": project(stg_repositories(), "repo_id, repo_sk"),
    "branch_sk": project(stg_branches(), "branch_sk, full_repo_name"),
    "pr_commit_sk": project(stg_pr_commits(), "pull_request_commit_sk, sha, full_repo_name"),
    "predicates": project(STG_C, "sha, commit_type, commit_hour",
                          "WHERE (commit_hour BETWEEN 9 AND 17 AND commit_day_of_week IN (2, 3, 4, 5, 6)) "
                          "OR (commit_type IN ('fix', 'feature') AND NOT is_merge_commit) "
                          "OR (git_author_email IS NULL AND repo_id >= 105 AND repo_id < 108)"),
    "watermark_filter": project(typed_commits("c", False, "1"), "@_sdc_extracted_at, sha, commit_message"),
    "upsert": project(STG_C, "sha, commit_message, @_sdc_extracted_at"),
    "watermark_event_time": project(STG_C, "sha, @commit_timestamp",
                                    f"WHERE commit_timestamp > (SELECT max(commit_timestamp) FROM ({STG_C}) AS e "
                                    "WHERE commit_timestamp < TIMESTAMP '2023-07-01 00:00:00')"),
    "incremental_two_batches": project(stg_branches(), "branch_sk, is_protected, commit_sha, @_sdc_extracted_at"),
    "incremental_commits": project(STG_C, "sha, commit_message, @_sdc_extracted_at"),
    "incremental_by_month": project(STG_C, "sha, commit_message, @_sdc_extracted_at"),
    "typed_columns": project(typed_repositories("all"), "_sdc_sequence, repo_id, full_name, primary_language, "
                             "stargazers_count, @pushed_at"),
    "stg_commits_typed": project(STG_C, STG_COMMITS_COLS),
    "incremental_landed": project(STG_C, "sha, commit_message, @_sdc_extracted_at"),
    "committers_maintained": project(COMMITTERS, COMMITTER_COLS),
    "incremental_repositories": f"""
        WITH full0 AS ({stg_repositories('0')}), batch1 AS ({stg_repositories('1')})
        SELECT repo_id, repo_sk, description, stargazers_count, {ts('_sdc_extracted_at')} FROM (
          SELECT * FROM full0 WHERE repo_sk NOT IN (SELECT repo_sk FROM batch1)
          UNION ALL SELECT * FROM batch1) AS u""",
    "incremental_commits_mart": project(stg_commits("0"), "sha, commit_message, @commit_timestamp"),
    "stream_out_of_order": project(STG_C, "sha, commit_message, @_sdc_extracted_at"),
    "stream_incremental_commits": project(STG_C, "sha, commit_message, @_sdc_extracted_at"),
    "published_branches": project(stg_branches(), "branch_sk, (branch_name = 'main') AS is_main_branch, is_protected"),
    "view_commits_by_type": f"""SELECT commit_type, commit_date, CAST(count(*) AS BIGINT) AS commit_count
        FROM ({STG_C}) AS s GROUP BY commit_type, commit_date""",
    "test_unique": f"""SELECT github_author_id, CAST(count(*) AS BIGINT) AS n_records FROM ({STG_C}) AS s
        WHERE github_author_id IS NOT NULL GROUP BY github_author_id HAVING count(*) > 1""",
    "test_not_null": f"""SELECT column_name, CAST(failures AS BIGINT) AS failures FROM (
        SELECT 'sha' AS column_name, count(*) FILTER (WHERE sha IS NULL) AS failures FROM ({STG_C}) AS a
        UNION ALL SELECT 'commit_timestamp', count(*) FILTER (WHERE commit_timestamp IS NULL) FROM ({STG_C}) AS b
        UNION ALL SELECT 'git_author_email', count(*) FILTER (WHERE git_author_email IS NULL) FROM ({STG_C}) AS c
        UNION ALL SELECT 'github_author_id', count(*) FILTER (WHERE github_author_id IS NULL) FROM ({STG_C}) AS d
        ) AS u""",
    "test_relationships": f"""SELECT b.branch_sk, b.commit_sha FROM ({stg_branches()}) AS b
        WHERE b.commit_sha IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({STG_C}) AS s WHERE s.sha = b.commit_sha)""",
}


def _report_sql() -> str:
    tables = {
        "branches": stg_branches(), "commits": STG_C, "committers": COMMITTERS,
        "pull_request_commits": stg_pr_commits(), "repositories": stg_repositories(),
    }
    # The assertion suite declared on the marts (table, check, column, severity).
    suite = [("branches", "unique", "branch_sk", "error")]
    suite += [("branches", "not_null", x, "error") for x in
              ["branch_sk", "org", "repo", "repo_id", "branch_name", "commit_sha"]]
    suite += [("commits", "unique", "sha", "error")]
    suite += [("commits", "not_null", x, "error") for x in ["sha", "commit_timestamp", "git_author_email"]]
    suite += [("commits", "relationships", "github_author_id", "warn")]
    suite += [("committers", "unique", "committer_id", "error")]
    suite += [("committers", "not_null", x, "error") for x in
              ["committer_id", "total_commits", "first_commit_at", "last_commit_at"]]
    suite += [("pull_request_commits", "unique", "pull_request_commit_sk", "error")]
    suite += [("pull_request_commits", "not_null", x, "error") for x in
              ["pull_request_commit_sk", "org", "repo", "repo_id", "pull_request_number", "sha"]]
    suite += [("repositories", "unique", x, "error") for x in ["repo_sk", "repo_id"]]
    suite += [("repositories", "not_null", x, "error") for x in ["repo_sk", "repo_id", "org", "repo"]]
    parts = []
    for table, check, col, sev in suite:
        src = tables[table]
        if check == "unique":
            n = (f"(SELECT count(*) FROM (SELECT {col} FROM ({src}) AS t WHERE {col} IS NOT NULL "
                 f"GROUP BY {col} HAVING count(*) > 1) AS d)")
        elif check == "not_null":
            n = f"(SELECT count(*) FROM ({src}) AS t WHERE {col} IS NULL)"
        else:
            n = (f"(SELECT count(*) FROM ({src}) AS t WHERE {col} IS NOT NULL AND {col} NOT IN "
                 f"(SELECT committer_id FROM ({COMMITTERS}) AS p WHERE committer_id IS NOT NULL))")
        parts.append(f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{col}' AS column_name, "
                     f"'{sev}' AS severity, CAST({n} AS BIGINT) AS failures")
    return "\n UNION ALL ".join(parts)


ORACLE_SQL["test_report"] = _report_sql()


def _docs_sql() -> str:
    """The contract's columns of the five marts, each described."""
    columns = {"branches": MART_BRANCH_COLS, "commits": MART_COMMIT_COLS, "committers": COMMITTER_COLS,
               "pull_request_commits": MART_PR_COLS, "repositories": MART_REPO_COLS}
    rows = [f"('{t}', '{x.strip().removeprefix('@').rsplit(' ')[-1]}', TRUE)"
            for t, cols in columns.items() for x in re.split(r",(?![^(]*\))", cols)]     # commas outside brackets
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS d(table_name, column_name, described)"


ORACLE_SQL["mart_docs"] = _docs_sql()

# The same rows from VARIANT payloads as from JSON text.
ORACLE_SQL |= {f"typed_{x}": ORACLE_SQL[f"flatten_{x}"] for x in ("commits", "pr_commits", "branches", "repositories")}
ORACLE_SQL["test_report_observed"] = ORACLE_SQL["test_report"]
