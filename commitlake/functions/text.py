"""Message classifiers, PR references and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conventional-commit prefixes and the class each maps to, in
# first-match order. A prefix counts when followed by '(' or ':' and then an
# ASCII word character (a word boundary in the source regex dialect), so
# 'feat: x' and 'feat!: x' are 'other' while 'feat(api): x' and 'feat:x' match.
COMMIT_TYPES = [
    ("feat", "feature"),
    ("fix", "fix"),
    ("docs", "docs"),
    ("refactor", "refactor"),
    ("test", "test"),
    ("chore", "chore"),
    ("perf", "performance"),
    ("style", "style"),
    ("ci", "ci"),
    ("build", "build"),
]
OTHER = "other"
PR_REFERENCE = "#([0-9]+)"


def commit_type(message: Column, lenient: bool = False) -> Column:
    """Classify a commit message.

    ``lenient=True`` also takes the usual form of conventional commits, in which white space follows the colon and
    ``!`` may stand before it (``feat: x``, ``fix(api)!: y``); the default leaves these in ``other`` like the source.

    The anchored prefixes are mutually exclusive, so one alternation regex
    (one scan of the message) is equivalent to the first-match CASE chain.
    """
    alternation = "|".join(prefix for prefix, _ in COMMIT_TYPES)
    ending = r"(?:[(:][0-9a-z_]|(?:\([^)]*\))?!?:)" if lenient else "[(:][0-9a-z_]"
    prefix = F.regexp_extract(F.lower(message), f"^({alternation}){ending}", 1)
    mapping = F.create_map(*[F.lit(x) for pair in COMMIT_TYPES for x in pair])
    return F.coalesce(mapping[prefix], F.lit(OTHER))


def pr_number(message: Column) -> Column:
    """First ``#<digits>`` reference as bigint, NULL when absent or out of range."""
    # a failing try_cast throws and catches inside, which most messages ('' without a reference) need not pay
    return F.nullif(F.regexp_extract(message, PR_REFERENCE, 1), F.lit("")).try_cast("bigint")


def is_merge_commit(author_email: Column, committer_email: Column) -> Column:
    """Author and committer e-mails both known and different; never NULL."""
    return (author_email.isNotNull() & committer_email.isNotNull()
            & (author_email != committer_email))


def _txt(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def full_repo_name(org: Column, repo: Column) -> Column:
    """``org/repo``; NULL when either part is NULL."""
    return F.concat(org, F.lit("/"), repo)


def repo_sk(repo_id: Column, full_name: Column, org: Column) -> Column:
    """``<repo_id>:<full_name>``.

    Keeps the source behaviour that a missing ``full_name`` yields the org
    alone (the source's COALESCE stops at ``COALESCE(org, '')``, never NULL).
    """
    return F.concat(_txt(repo_id), F.lit(":"), F.coalesce(full_name, _txt(org)))


def branch_sk(org: Column, repo: Column, repo_id: Column, branch: Column) -> Column:
    return F.concat(_txt(org), F.lit("/"), _txt(repo), F.lit(":"), _txt(repo_id),
                    F.lit(":"), _txt(branch))


def pr_commit_sk(org: Column, repo: Column, repo_id: Column, number: Column, sha: Column) -> Column:
    return F.concat(_txt(org), F.lit("/"), _txt(repo), F.lit(":"), _txt(repo_id),
                    F.lit(":pr:"), _txt(number), F.lit(":"), _txt(sha))
