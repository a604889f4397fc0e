"""Plan shape of the staging models over landed parquet."""

import re

import pytest

from commitlake.plans import stg_branches, stg_commits, stg_pull_request_commits, stg_repositories
from commitlake.sources.envelope import read_raw, write_raw

MODELS = {"commits": (stg_commits, 1), "pull_request_commits": (stg_pull_request_commits, 1),
          "branches": (stg_branches, 2), "repositories": (stg_repositories, 2)}


@pytest.mark.parametrize("stream", MODELS)
def test_one_from_json_per_parse_and_none_in_a_filter(spark, envelope, tmp_path, stream):
    write_raw(envelope([({"sha": "a", "org": "o"}, "2024-01-01T00:00:00Z")]), str(tmp_path / stream))
    model, parses = MODELS[stream]
    plan = model(read_raw(spark, str(tmp_path / stream)))._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.split("\n") if re.search(r"from_json\((?!.*CASE)", line)]
    assert plan.count(" AS _p#") == parses == len([x for x in lines if " AS _p#" in x])
    assert not [x for x in plan.split("\n") if re.match(r"[ :+-]*Filter", x) and "from_json" in x]


@pytest.mark.parametrize("stream", MODELS)
def test_typed_columns_are_made_in_projections(spark, envelope, tmp_path, stream):
    """Spark interprets what stands inside a generator: nothing but columns does."""
    write_raw(envelope([({"sha": "a", "org": "o"}, "2024-01-01T00:00:00Z")]), str(tmp_path / stream))
    plan = MODELS[stream][0](read_raw(spark, str(tmp_path / stream)))._jdf.queryExecution().optimizedPlan().toString()
    generators = [x for x in plan.split("\n") if re.match(r"[ :+-]*Generate", x)]
    assert generators and not [x for x in generators if re.search(r"CASE|from_json|try_cast|gettimestamp", x)]
