"""Landing in folders by date: the watermark chooses folders, older ones are not listed."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from commitlake.operators import PartitionedTable, incremental_run
from commitlake.operators.incremental import stored
from commitlake.plans import stg_commits
from commitlake.session import FREE_SHUFFLES, shared_dir
from commitlake.sources.envelope import Landing, open_raw, read_raw, write_raw


def micros(text):
    import datetime as dt
    return int(dt.datetime.fromisoformat(text + "+00:00").timestamp() * 1_000_000)


def new_landing(spark):
    return Landing(spark, shared_dir(spark, "tests", f"landing-{uuid.uuid4().hex}"))


def record(sha, message, extracted):
    return ({"sha": sha, "commit_timestamp": "2024-01-01T00:00:00Z", "commit": {"message": message}}, extracted)


def test_a_watermark_reads_its_folders_only(spark, envelope):
    landing = new_landing(spark)
    raw = envelope([record(f"s{d}-{h}", "fix: a", f"2024-01-{d:02}T{h:02}:00:00Z") for d in range(1, 11) for h in (0, 12, 23)])
    landing.append(raw.withColumn("more", F.lit(1)))
    assert landing.folders() == [f"2024-01-{d:02}" for d in range(1, 11)]
    assert landing.read().columns == raw.columns and landing.read().count() == 30
    fresh = landing.newer_than("_sdc_extracted_at", micros("2024-01-09T12:00:00"))
    assert {r[0] for r in fresh.select(F.get_json_object("data", "$.sha")).collect()} == {"s9-23", "s10-0", "s10-12", "s10-23"}
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed_on" in plan and "InMemoryFileIndex(2 paths)" in plan
    assert all("2024-01-09" in f or "2024-01-10" in f for f in fresh.inputFiles())


def test_undated_rows_and_an_empty_landing(spark, envelope):
    landing = new_landing(spark)
    assert landing.read().count() == 0 and landing.newer_than("_sdc_extracted_at", 0).count() == 0
    raw = envelope([record("a", "x", "2024-01-01T00:00:00Z")])
    landing.append(raw.withColumn("_sdc_extracted_at", F.lit(None).cast("timestamp")).unionByName(raw))
    assert landing.read().count() == 2
    assert landing.newer_than("_sdc_extracted_at", micros("2023-01-01T00:00:00")).count() == 1
    assert landing.newer_than("_sdc_extracted_at", micros("2024-01-01T00:00:00")).count() == 0
    assert landing.newer_than("_sdc_sequence", -1).count() == 2


def test_incremental_run_from_a_landing_equals_one_from_frames(spark, envelope):
    landing = new_landing(spark)
    table = PartitionedTable(spark, shared_dir(spark, "tests", f"landed-{uuid.uuid4().hex}"), "commit_timestamp", "month",
                             ["_sdc_extracted_at"])
    for rows in ([record("a", "fix: 1", "2024-01-01T05:00:00Z"), record("b", "fix: 1", "2024-01-02T05:00:00Z")],
                 [record("b", "fix: 2", "2024-01-02T06:00:00Z"), record("c", "fix: 2", "2024-01-05T00:00:00Z"),
                  record("a", "late", "2024-01-01T06:00:00Z")]):
        landing.append(envelope(rows))
        out = incremental_run(landing, stg_commits, table, ["sha"], "_sdc_extracted_at")
    assert {r.sha: r.commit_message for r in out.collect()} == {"a": "fix: 1", "b": "fix: 2", "c": "fix: 2"}


@pytest.mark.parametrize("dated", [True, False])
def test_open_raw_knows_the_layout(spark, envelope, dated):
    landing = new_landing(spark)
    raw = envelope([record("a", "x", "2024-01-01T00:00:00Z")])
    landing.append(raw) if dated else write_raw(raw, landing.path)
    found = open_raw(spark, landing.path)
    assert isinstance(found, Landing) == dated
    assert (found.read() if dated else found).collect() == raw.collect() and read_raw(spark, landing.path).count() == 1


def test_a_finished_write_leaves_no_shuffle_files(spark, envelope):
    """Landing, first run and batch: their shuffle files are deleted as each write ends, not by garbage collection."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {n for n in disk.getAllFiles().mkString(" ").split() if "shuffle_" in n and n.endswith(".data")}

    landing = new_landing(spark)
    table = PartitionedTable(spark, shared_dir(spark, "tests", f"freed-{uuid.uuid4().hex}"), "commit_timestamp", "month")
    raw = envelope([record(f"s{i}", "fix: a", "2024-01-01T00:00:00Z") for i in range(20)])
    before = shuffles()
    landing.append(raw)
    table.write(stg_commits(landing.read()))
    stored(stg_commits(landing.read()), spark, "freed")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before and table.read().count() == 20
    assert spark.conf.get(FREE_SHUFFLES) == "false"
