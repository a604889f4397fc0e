"""The nine models: four staging tables and five marts."""

from commitlake.plans.committers import committers  # noqa: F401
from commitlake.plans.marts import (  # noqa: F401
    branches_mart, commits_mart, pull_request_commits_mart, repositories_mart,
)
from commitlake.plans.staging import (  # noqa: F401
    stg_branches, stg_commits, stg_pull_request_commits, stg_repositories,
)
