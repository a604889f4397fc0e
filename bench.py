"""Benchmark: land the raw streams, then build staging, marts, checks and analyst queries.

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from commitlake.operators.incremental import VersionedTable, incremental_run  # noqa: E402
from commitlake.operators.quality import MART_CHECKS, quality_report  # noqa: E402
from commitlake.plans import (  # noqa: E402
    branches_mart, commits_mart, committers, pull_request_commits_mart, repositories_mart, stg_branches,
    stg_commits, stg_pull_request_commits, stg_repositories,
)
from commitlake.plans.build import staging_table  # noqa: E402
from commitlake.session import build_session, shared_dir  # noqa: E402
from commitlake.sources import fixtures as fx  # noqa: E402
from commitlake.sources.envelope import read_raw, write_raw  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {}
    scratch = tempfile.mkdtemp(prefix="commitlake-bench-")
    extra["spark.checkpoint.dir"] = f"{scratch}/checkpoint"
    if os.environ.get("BENCH_EVENT_LOG"):          # stage/task timings for analysis, written to a local folder
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), extra=extra)
    root = shared_dir(spark, "bench")
    times: dict[str, float] = {}
    as_of = fx.as_of_lit()

    def build(sf: str, tag: str, times: dict[str, float]) -> None:
        """Land the raw streams of ``sf`` and build every model, timing each step into ``times``."""

        def timed(name, fn):
            t0 = time.time()
            out = fn()
            times[name] = round(time.time() - t0, 3)
            return out

        def table(name):
            return VersionedTable(spark, f"{root}/{tag}/{name}")

        def commits_table(name):
            return staging_table(spark, f"{root}/{tag}/{name}", "commits")

        # 1. land raw envelopes (what the extractor/loader delivers)
        def land():
            for name, make in fx.RAW_STREAMS.items():
                write_raw(make(spark, sf, (0,)), f"{root}/{tag}/raw/{name}/batch=1")
                write_raw(make(spark, sf, (1,)), f"{root}/{tag}/raw/{name}/batch=2")
        timed("land_raw", land)
        raw = {n: read_raw(spark, f"{root}/{tag}/raw/{n}") for n in fx.RAW_STREAMS}
        raw_b1 = {n: read_raw(spark, f"{root}/{tag}/raw/{n}/batch=1") for n in fx.RAW_STREAMS}

        # 2. staging, full build
        stg = {}
        stg["commits"] = timed("stg_commits_full", lambda: commits_table("stg_commits").write(stg_commits(raw["commits"])))
        stg["pull_request_commits"] = timed("stg_pr_commits_full", lambda: table("stg_pr").write(
            stg_pull_request_commits(raw["pull_request_commits"], as_of)))
        stg["branches"] = timed("stg_branches_full", lambda: table("stg_branches").write(
            stg_branches(raw["branches"], as_of)))
        stg["repositories"] = timed("stg_repositories_full", lambda: table("stg_repos").write(
            stg_repositories(raw["repositories"], as_of)))

        # 3. staging, incremental: first batch, then the ~10 % second batch through watermark + upsert
        inc = commits_table("stg_commits_inc")
        incremental_run(raw_b1["commits"], stg_commits, inc, ["sha"], "_sdc_extracted_at")
        timed("stg_commits_incremental", lambda: incremental_run(raw["commits"], stg_commits, inc, ["sha"],
                                                                 "_sdc_extracted_at"))

        # 4. marts
        marts = {}
        marts["committers"] = timed("committers_mart", lambda: table("committers").write(
            committers(stg["commits"], as_of, as_of)))
        marts["commits"] = timed("commits_mart", lambda: table("commits").write(
            commits_mart(stg["commits"], as_of)))
        marts["pull_request_commits"] = timed("pr_commits_mart", lambda: table("pr_commits").write(
            pull_request_commits_mart(stg["pull_request_commits"], as_of)))
        marts["branches"] = timed("branches_mart", lambda: table("branches").write(
            branches_mart(stg["branches"], as_of)))
        marts["repositories"] = timed("repositories_mart", lambda: table("repositories").write(
            repositories_mart(stg["repositories"], as_of)))

        # 5. data-quality report over all marts (one job)
        timed("quality_report", lambda: quality_report(marts, MART_CHECKS).collect())

        # 6. analyst queries on the marts
        timed("commits_by_type", lambda: marts["commits"].groupBy("commit_type").count().collect())
        timed("top_committers", lambda: marts["committers"].orderBy(
            F.col("total_commits").desc(), F.col("committer_id")).limit(10).collect())

    # warm-up pass (JVM, class loading, code generation) on the smallest scale, not reported
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    build(warm_dir if os.path.isdir(warm_dir) else sf_dir, "warmup", {})
    build(sf_dir, "run", times)

    total = round(sum(v for k, v in times.items() if k != "land_raw"), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "build_seconds_excl_landing", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
