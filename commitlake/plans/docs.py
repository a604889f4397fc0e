"""Table and column descriptions that are persisted with the published marts."""

from __future__ import annotations

TABLES = {
    "committers": "One row per GitHub author: volume, recency, working pattern and rates.",
    "commits": "One row per commit with author, committer, class and date dimensions.",
    "repositories": "Latest known state of each repository.",
    "branches": "Latest known state of each branch.",
    "pull_request_commits": "Commits that belong to pull requests.",
}

COLUMNS = {
    # keys and places
    "repo_sk": "Repository key: repository id and full name.",
    "branch_sk": "Branch key: organisation, repository, repository id and branch name.",
    "pull_request_commit_sk": "Key of a commit within a pull request of a repository.",
    "sha": "Hash of the commit.",
    "org": "Organisation that owns the repository.",
    "repo": "Short name of the repository.",
    "repo_id": "Number of the repository on the platform.",
    "node_id": "Global node identifier of the record on the platform.",
    "full_name": "Organisation and repository name as the platform gives them.",
    "full_repo_name": "Organisation and repository name joined by a slash.",
    "repo_github_url": "Web page of the repository.",
    "git_url": "Address for the git protocol.",
    "ssh_url": "Address for git over SSH.",
    "clone_url": "Address for git over HTTPS.",
    "homepage_url": "Home page that the repository names.",
    "commit_api_url": "Address of the commit in the platform's API.",
    "commit_github_url": "Web page of the commit.",
    "comments_api_url": "Address of the commit's comments in the platform's API.",
    # repositories
    "is_private": "Whether the repository is private.",
    "is_fork": "Whether the repository is a fork of another one.",
    "is_archived": "Whether the repository is read-only for good.",
    "is_disabled": "Whether the platform has disabled the repository.",
    "description": "Description that the repository gives of itself.",
    "visibility": "Who can see the repository: public, private or internal.",
    "primary_language": "Programming language most of the code is in.",
    "default_branch": "Branch that new work starts from.",
    "repo_size_kb": "Size of the repository in kilobytes.",
    "stargazers_count": "Users who have starred the repository.",
    "watchers_count": "Users who watch the repository.",
    "forks_count": "Forks made of the repository.",
    "open_issues_count": "Issues and pull requests that are open.",
    "subscribers_count": "Users subscribed to notifications.",
    "network_count": "Repositories in the network of forks.",
    "created_at": "Time at which the repository was created.",
    "updated_at": "Time of the last change to the repository's record.",
    "pushed_at": "Time of the last push.",
    # branches
    "branch_name": "Name of the branch.",
    "is_protected": "Whether rules protect the branch.",
    "commit_sha": "Hash of the commit at the head of the branch.",
    "is_main_branch": "Whether the branch is called main.",
    # commits
    "commit_timestamp": "Time of the commit as the platform lists it (UTC).",
    "commit_message": "Full message of the commit.",
    "comment_count": "Comments on the commit.",
    "pull_request_number": "Pull request: named by the message, or the one the commit belongs to.",
    "commit_type": "Class of the message by its conventional prefix; other where there is none.",
    "is_merge_commit": "Whether author and committer e-mail are known and differ.",
    "is_verified": "Whether the platform could verify the signature.",
    "verification_reason": "Why the signature was or was not verified.",
    "verified_at": "Time at which the signature was verified.",
    "tree_sha": "Hash of the tree that the commit records.",
    "tree_url": "Address of that tree in the platform's API.",
    "commit_date": "Day of the commit (UTC).",
    "commit_week": "First day of the commit's week, which starts on Sunday.",
    "commit_month": "First day of the commit's month.",
    "commit_quarter": "First day of the commit's quarter.",
    "commit_year": "Year of the commit.",
    "commit_day_of_week": "Day of the week of the commit; Sunday is 1.",
    "commit_hour": "Hour of the commit (UTC), 0 to 23.",
    # committers
    "committer_id": "User id of the author.",
    "github_login": "Login of the author at the latest commit.",
    "committer_name": "Git name of the author at the latest commit.",
    "committer_email": "E-mail the author has used in most commits.",
    "avatar_url": "Picture of the author.",
    "profile_url": "Profile page of the author.",
    "account_type": "Kind of account: user, bot or organisation.",
    "is_site_admin": "Whether any commit shows the author as site administrator.",
    "total_commits": "Commits of the author.",
    "repos_contributed_to": "Different repository names among them.",
    "active_days": "Different days with a commit.",
    "days_active_span": "Whole days between first and last commit.",
    "first_commit_at": "Time of the first commit.",
    "last_commit_at": "Time of the last commit.",
    "verified_commits": "Commits with a verified signature.",
    "unverified_commits": "Commits without a verified signature.",
    "merge_commits": "Commits whose author and committer differ.",
    "pr_commits": "Commits whose message names a pull request.",
    "unique_prs": "Different pull requests among them.",
    "weekend_commits": "Commits on Saturdays and Sundays.",
    "weekday_commits": "Commits from Monday to Friday.",
    "business_hours_commits": "Commits from 9 to 17 h UTC.",
    "off_hours_commits": "Commits at other hours.",
    "most_active_hour": "Hour with the most commits.",
    "most_active_day_of_week": "Day of the week with the most commits; Sunday is 1.",
    "avg_commits_per_active_day": "Mean of the commits per day over days with a commit.",
    "max_commits_in_day": "Most commits on one day.",
    "days_since_last_commit": "Whole days since the last commit.",
    "activity_status": "Class by the shortest of the windows of 30, 90, 180 and 365 days with a commit.",
    "verification_rate_pct": "Verified commits per hundred.",
    "merge_commit_pct": "Merge commits per hundred.",
    "commits_per_active_day": "Commits divided by active days.",
    "avg_commits_per_day_in_span": "Commits divided by the days of the active span, at least one.",
    "rank_by_total_commits": "Place by commits; equal counts in the order of the user id.",
    "rank_by_recent_activity": "Place by commits of the last 90 days; equal counts in the order of the user id.",
    # record keeping
    "_sdc_extracted_at": "Time at which the record was extracted.",
    "dbt_updated_at": "Time at which the row was built.",
}

_PERSON = {"name": "Name", "email": "E-mail", "timestamp": "Time"}
_ACCOUNT = {"id": "User id", "login": "Login", "avatar_url": "Picture", "profile_url": "Profile page",
            "type": "Kind of account", "is_site_admin": "Site administrator flag"}


def describe(column: str) -> str | None:
    """The description of a mart column; families of columns follow from their names."""
    if column in COLUMNS:
        return COLUMNS[column]
    for role in ("author", "committer"):
        if (part := column.removeprefix(f"git_{role}_")) in _PERSON:
            return f"{_PERSON[part]} of the {role} that git records."
        if (part := column.removeprefix(f"github_{role}_")) in _ACCOUNT:
            return f"{_ACCOUNT[part]} of the {role}'s account on the platform."
    if (part := column.removeprefix("owner_")) in {"login", "id", "type", "github_url", "avatar_url", "is_site_admin"}:
        return f"Owner of the repository: {part.replace('_', ' ')}."
    if column.startswith("commits_last_"):
        return f"Commits of the last {column.split('_')[2]} days."
    if column.startswith("active_days_last_"):
        return f"Days with a commit among the last {column.rsplit('_', 1)[1]}."
    if column.endswith("_commits_pct"):
        return f"Commits of class {column.removesuffix('_commits_pct')} per hundred."
    if column.endswith("_commits"):
        return f"Commits of class {column.removesuffix('_commits')}."
    return None
