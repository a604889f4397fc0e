"""Raw envelope and payload field maps for the four source streams.

Each stream lands as a fixed envelope (``data`` JSON text + ``_sdc_*``
bookkeeping). The payload maps below say which JSON path feeds which typed
column and how it is cast:  s = string, i = bigint (safe), b = boolean
(safe, only true/false), t = RFC 3339 timestamp (safe).

Fixed values: the JSON paths and output column names must equal the source
semantics exactly; they are listed in payload order.
"""

from __future__ import annotations

from pyspark.sql import types as T

ENVELOPE = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("_sdc_extracted_at", T.TimestampType()),
    T.StructField("_sdc_received_at", T.TimestampType()),
    T.StructField("_sdc_batched_at", T.TimestampType()),
    T.StructField("_sdc_deleted_at", T.TimestampType()),
    T.StructField("_sdc_sequence", T.LongType()),
    T.StructField("_sdc_table_version", T.LongType()),
])

SDC_COLUMNS = [f.name for f in ENVELOPE.fields if f.name != "data"]

# --- fixed values: (output column, JSON path, cast) -------------------------
REPOSITORY_FIELDS = [
    ("repo_id", "id", "i"),
    ("node_id", "node_id", "s"),
    ("repo", "name", "s"),
    ("full_name", "full_name", "s"),
    ("org", "org", "s"),
    ("repo_slug", "repo", "s"),
    ("repo_github_url", "html_url", "s"),
    ("git_url", "git_url", "s"),
    ("ssh_url", "ssh_url", "s"),
    ("clone_url", "clone_url", "s"),
    ("homepage_url", "homepage", "s"),
    ("is_private", "private", "b"),
    ("is_fork", "fork", "b"),
    ("is_archived", "archived", "b"),
    ("is_disabled", "disabled", "b"),
    ("description", "description", "s"),
    ("visibility", "visibility", "s"),
    ("primary_language", "language", "s"),
    ("default_branch", "default_branch", "s"),
    ("repo_size_kb", "size", "i"),
    ("stargazers_count", "stargazers_count", "i"),
    ("watchers_count", "watchers_count", "i"),
    ("forks_count", "forks_count", "i"),
    ("open_issues_count", "open_issues_count", "i"),
    ("subscribers_count", "subscribers_count", "i"),
    ("network_count", "network_count", "i"),
    ("created_at", "created_at", "t"),
    ("updated_at", "updated_at", "t"),
    ("pushed_at", "pushed_at", "t"),
    ("owner_login", "owner.login", "s"),
    ("owner_id", "owner.id", "i"),
    ("owner_type", "owner.type", "s"),
    ("owner_github_url", "owner.html_url", "s"),
    ("owner_avatar_url", "owner.avatar_url", "s"),
    ("owner_is_site_admin", "owner.site_admin", "b"),
]

BRANCH_FIELDS = [
    ("org", "org", "s"),
    ("repo", "repo", "s"),
    ("repo_id", "repo_id", "i"),
    ("branch_name", "name", "s"),
    ("is_protected", "protected", "b"),
    ("commit_sha", "commit.sha", "s"),
    ("commit_api_url", "commit.url", "s"),
]

# commit body shared by commits and pull-request commits
COMMIT_BODY_FIELDS = [
    ("commit_message", "commit.message", "s"),
    ("comment_count", "commit.comment_count", "i"),
    ("git_author_name", "commit.author.name", "s"),
    ("git_author_email", "commit.author.email", "s"),
    ("git_author_timestamp", "commit.author.date", "t"),
    ("git_committer_name", "commit.committer.name", "s"),
    ("git_committer_email", "commit.committer.email", "s"),
    ("git_committer_timestamp", "commit.committer.date", "t"),
    ("tree_sha", "commit.tree.sha", "s"),
    ("tree_url", "commit.tree.url", "s"),
    ("is_verified", "commit.verification.verified", "b"),
    ("verification_reason", "commit.verification.reason", "s"),
    ("verified_at", "commit.verification.verified_at", "t"),
    ("github_author_id", "author.id", "i"),
    ("github_author_login", "author.login", "s"),
    ("github_author_avatar_url", "author.avatar_url", "s"),
    ("github_author_profile_url", "author.html_url", "s"),
    ("github_author_type", "author.type", "s"),
    ("github_author_is_site_admin", "author.site_admin", "b"),
    ("github_committer_id", "committer.id", "i"),
    ("github_committer_login", "committer.login", "s"),
    ("github_committer_avatar_url", "committer.avatar_url", "s"),
    ("github_committer_profile_url", "committer.html_url", "s"),
    ("github_committer_type", "committer.type", "s"),
    ("github_committer_is_site_admin", "committer.site_admin", "b"),
]

COMMIT_FIELDS = [
    ("sha", "sha", "s"),
    ("commit_timestamp", "commit_timestamp", "t"),
    ("org", "org", "s"),
    ("repo", "repo", "s"),
    ("repo_id", "repo_id", "i"),
    ("node_id", "node_id", "s"),
    ("commit_api_url", "url", "s"),
    ("commit_github_url", "html_url", "s"),
] + COMMIT_BODY_FIELDS

PR_COMMIT_FIELDS = [
    ("org", "org", "s"),
    ("repo", "repo", "s"),
    ("repo_id", "repo_id", "i"),
    ("pull_request_number", "pull_number", "i"),
    ("sha", "sha", "s"),
    ("node_id", "node_id", "s"),
    ("commit_api_url", "url", "s"),
    ("commit_github_url", "html_url", "s"),
    ("comments_api_url", "comments_url", "s"),
] + COMMIT_BODY_FIELDS
# --- end fixed values -------------------------------------------------------

STREAM_FIELDS = {
    "repositories": REPOSITORY_FIELDS,
    "branches": BRANCH_FIELDS,
    "commits": COMMIT_FIELDS,
    "pull_request_commits": PR_COMMIT_FIELDS,
}


def payload_schema(fields, leaf: T.DataType = T.StringType()) -> T.StructType:
    """Nested ``StructType`` holding exactly the JSON paths in ``fields``.

    Leaves are all ``leaf`` (string, or variant for strict scalar checks);
    casting happens afterwards so quoted numbers still parse.
    """
    tree: dict = {}
    for _, path, _ in fields:
        node = tree
        *parents, name = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node.setdefault(name, None)

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(k, leaf if v is None else build(v)) for k, v in node.items()
        ])

    return build(tree)
