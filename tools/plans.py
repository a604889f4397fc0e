"""Summarise the physical plans of every model: exchanges, aggregate kinds, window limits, scan pushdown.

Usage: python tools/plans.py [sf_dir] > PLANS.md   (lands the raw streams into a scratch folder first)
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from commitlake.operators.incremental import upsert, watermark_filter  # noqa: E402
from commitlake.operators.quality import MART_CHECKS, quality_report  # noqa: E402
from commitlake.plans import (  # noqa: E402
    branches_mart, commits_mart, pull_request_commits_mart, repositories_mart, stg_branches, stg_commits,
    stg_pull_request_commits, stg_repositories,
)
from commitlake.plans.committers import committer_stats  # noqa: E402
from commitlake.session import build_session  # noqa: E402
from commitlake.sources import fixtures as fx  # noqa: E402
from commitlake.sources.envelope import read_raw  # noqa: E402

PATTERNS = {
    "hash exchanges": r"Exchange hashpartitioning",
    "range exchanges": r"Exchange rangepartitioning",
    "single-partition exchanges": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "HashAggregate": r"HashAggregate\(",
    "SortAggregate": r"SortAggregate\(",
    "WindowGroupLimit": r"WindowGroupLimit",
}


def summary(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    pushed = re.findall(r"PushedFilters: \[([^\]\n]*)\]", plan)
    out["pushed filters"] = "; ".join(sorted({p for p in pushed if p})) or "-"
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    root = tempfile.mkdtemp(prefix="commitlake-plans-")
    as_of = fx.as_of_lit()
    raw, stg = {}, {}
    for name, make in fx.RAW_STREAMS.items():
        make(spark, sf).write.parquet(f"{root}/raw/{name}")
        raw[name] = read_raw(spark, f"{root}/raw/{name}")
    models = {"stg_commits": stg_commits(raw["commits"]),
              "stg_pull_request_commits": stg_pull_request_commits(raw["pull_request_commits"], as_of),
              "stg_branches": stg_branches(raw["branches"], as_of),
              "stg_repositories": stg_repositories(raw["repositories"], as_of)}
    for name, df in models.items():
        df.write.parquet(f"{root}/stg/{name}")
        stg[name] = spark.read.parquet(f"{root}/stg/{name}")
    stats = committer_stats(stg["stg_commits"], as_of)
    plans = dict(models)
    plans["committers (without ranks)"] = stats
    plans["commits mart"] = commits_mart(stg["stg_commits"], as_of)
    plans["pull_request_commits mart"] = pull_request_commits_mart(stg["stg_pull_request_commits"], as_of)
    plans["branches mart"] = branches_mart(stg["stg_branches"], as_of)
    plans["repositories mart"] = repositories_mart(stg["stg_repositories"], as_of)
    plans["incremental: watermark on raw"] = watermark_filter(raw["commits"], stg["stg_commits"], "_sdc_extracted_at")
    plans["incremental: upsert"] = upsert(
        stg["stg_commits"], stg["stg_commits"].where(F.col("_sdc_extracted_at") >= "2024-02-02"), ["sha"])
    marts = {"commits": plans["commits mart"], "committers": stats,
             "pull_request_commits": plans["pull_request_commits mart"], "branches": plans["branches mart"],
             "repositories": plans["repositories mart"]}
    plans["quality report"] = quality_report(marts, MART_CHECKS)
    plans["analyst: commits by type"] = plans["commits mart"].groupBy("commit_type").count()
    keys = list(PATTERNS) + ["pushed filters"]
    print("# PLANS\n")
    print(f"Physical plans (before AQE re-planning) of every model, generated by `tools/plans.py` on `{sf}`.")
    print("Marts read the written staging tables, as in a real build. Counts are plan nodes. Single-partition")
    print("exchanges appear only under global aggregates (one partial row per task, e.g. a check's failure count).\n")
    print("| plan | " + " | ".join(keys) + " |")
    print("|---|" + "---|" * len(keys))
    for name, df in plans.items():
        s = summary(df)
        print(f"| {name} | " + " | ".join(str(s[k]) for k in keys) + " |")
    print("\n## committers (without ranks), formatted\n\n```")
    print(stats._jdf.queryExecution().simpleString().split("== Physical Plan ==")[-1].strip()[:6000])
    print("```")
    spark.stop()


if __name__ == "__main__":
    main()
