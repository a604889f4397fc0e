"""Column-level functions (all JVM-side built-ins, usable inside whole-stage codegen)."""

from commitlake.functions.casts import parse_rfc3339, safe_bool, safe_int  # noqa: F401
from commitlake.functions.dates import date_dims, days_between, since  # noqa: F401
from commitlake.functions.jsonpath import json_query, json_value, scalar_leaf  # noqa: F401
from commitlake.functions.metrics import greatest_strict, pct, rate  # noqa: F401
from commitlake.functions.text import (  # noqa: F401
    branch_sk, commit_type, full_repo_name, is_merge_commit, pr_commit_sk, pr_number, repo_sk,
)
