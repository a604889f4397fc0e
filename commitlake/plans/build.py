"""Whole-project build: raw streams → staging (incremental) → marts → checks → publication.

Staging tables and the commits mart are versioned parquet tables that load
incrementally; the other marts are rebuilt in full. The quality suite runs
before anything is published; a failing ``error`` check stops publication,
``warn`` checks are reported.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.operators.incremental import VersionedTable, incremental_run, stored
from commitlake.operators.partitioned import PartitionedTable
from commitlake.operators.quality import MART_CHECKS, Check, assert_passes, observe_nulls, quality_report
from commitlake.plans import docs
from commitlake.plans.committers import committers
from commitlake.plans.marts import branches_mart, commits_mart, pull_request_commits_mart, repositories_mart
from commitlake.plans.staging import stg_branches, stg_commits, stg_pull_request_commits, stg_repositories
from commitlake.session import tune_shuffle_partitions
from commitlake.sources.envelope import Landing, open_raw
from commitlake.sources.sinks import apply_comments, point_table_at

STAGING_KEYS = {
    "repositories": ["repo_sk"],
    "branches": ["branch_sk"],
    "commits": ["sha"],
    "pull_request_commits": ["pull_request_commit_sk"],
}

STAGING_TIME = {"commits": "commit_timestamp"}

# Range-partitioned by time, so that event-time filters skip files and a merge of recent commits touches few of them.
CLUSTER_BY = {"commits": ["commit_timestamp", "sha"]}


def staging_table(spark: SparkSession, path: str, name: str) -> PartitionedTable | VersionedTable:
    """Commits lie in folders by month, as a batch holds recent ones; the other streams have no event time of a row."""
    if name in STAGING_TIME:
        return PartitionedTable(spark, path, STAGING_TIME[name], "month", ["_sdc_extracted_at"])
    return VersionedTable(spark, path, watermarks=["_sdc_extracted_at"])


@dataclass
class BuildResult:
    staging: dict[str, DataFrame] = field(default_factory=dict)
    marts: dict[str, DataFrame] = field(default_factory=dict)
    report: DataFrame | None = None
    warnings: list = field(default_factory=list)


def build_from_paths(spark: SparkSession, raw_paths: dict[str, str], root: str, **kwargs) -> BuildResult:
    """``build_all`` over landed raw folders, with shuffle partitions sized from their bytes."""
    tune_shuffle_partitions(spark, list(raw_paths.values()))
    return build_all(spark, {name: open_raw(spark, path) for name, path in raw_paths.items()}, root, **kwargs)


def publish_marts(spark: SparkSession, tables: dict[str, VersionedTable], database: str) -> None:
    """Switch the catalog tables of ``database`` to the newest versions of the marts and persist their descriptions."""
    for name, table in tables.items():
        published = point_table_at(spark, f"{database}.{name}", table.folder())
        described = {c: text for c in published.columns if (text := docs.describe(c))}
        apply_comments(spark, f"{database}.{name}", docs.TABLES[name], described)


def build_all(spark: SparkSession, raw: dict[str, DataFrame | Landing], root: str, as_of: Column | None = None,
              full_refresh: bool = False, publish_to: str | None = None, fail_on_error: bool = True,
              empty_target: str = "load_nothing", checks: list[Check] | None = None) -> BuildResult:
    """Build every model from the raw streams under ``root``, a folder of the warehouse, and run ``checks`` (default:
    the declared suite). When no error check fails and ``publish_to`` names a database, its tables are switched to the
    new versions; otherwise they stay as they are. ``empty_target="load_all"`` lets a table that was first built from
    an empty extract load everything in the next run.
    """
    as_of = as_of if as_of is not None else F.current_timestamp()
    models = {
        "repositories": lambda r: stg_repositories(r, as_of),
        "branches": lambda r: stg_branches(r, as_of),
        "commits": stg_commits,
        "pull_request_commits": lambda r: stg_pull_request_commits(r, as_of),
    }
    out = BuildResult()
    for name, model in models.items():
        table = staging_table(spark, f"{root}/stg/{name}", name)
        out.staging[name] = incremental_run(raw[name], model, table, STAGING_KEYS[name], "_sdc_extracted_at",
                                            full_refresh=full_refresh, empty_target=empty_target)
    tables = {name: VersionedTable(spark, f"{root}/marts/{name}") for name in docs.TABLES if name != "commits"}
    tables["commits"] = VersionedTable(spark, f"{root}/marts/commits", CLUSTER_BY["commits"], ["commit_timestamp"])
    out.marts["commits"] = incremental_run(out.staging["commits"], lambda s: commits_mart(s, as_of), tables["commits"],
                                           ["sha"], "commit_timestamp", full_refresh=full_refresh,
                                           empty_target=empty_target)
    full = {
        "committers": committers(out.staging["commits"], as_of, as_of),
        "repositories": repositories_mart(out.staging["repositories"], as_of),
        "branches": branches_mart(out.staging["branches"], as_of),
        "pull_request_commits": pull_request_commits_mart(out.staging["pull_request_commits"], as_of),
    }
    checks = MART_CHECKS if checks is None else checks
    observed = {}
    for name, df in full.items():
        df, observed[name] = observe_nulls(df, name, checks)
        out.marts[name] = tables[name].write(df)
    out.report = stored(quality_report(out.marts, checks, observed), spark, "report")
    if not fail_on_error:
        return out
    out.warnings = assert_passes(out.report)
    if publish_to:
        publish_marts(spark, tables, publish_to)
    return out
