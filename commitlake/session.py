"""Session setup and the shared work folder.

All time logic assumes UTC instants (``DATE()`` / ``EXTRACT`` of the source
semantics are UTC), so every entry point calls :func:`configure`.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method of over 8000 bytes: stages that would need one run as split projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # VARIANT payloads are written as one parquet column per field, and scans read the fields asked for.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan relies on (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "commitlake", extra: dict | None = None) -> SparkSession:
    """Local/test session builder. On a cluster, pass the cluster's own session instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset in
    a local run (tests) a private folder is created and registered; on a
    cluster that would be a different folder on every machine, so it fails.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="commitlake-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    root = root.rstrip("/")
    return "/".join([root, *parts]) if parts else root


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def free_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside are deleted when it ends, not when the driver's garbage collector gets to them.

    Only for plans that are run once, as a write's is: a frame collected twice would build its shuffles again.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def remove_scratch(spark: SparkSession, *parts: str) -> None:
    """Delete a folder of intermediate tables (``rank``, ``batches``, ``llm`` ...) under the shared folder.

    Lazy results read from these folders; call this once they have been written elsewhere.
    """
    if not parts:
        raise ValueError("name the folder to delete")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, *parts))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (one namenode/object-store summary call per path)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def tune_shuffle_partitions(spark: SparkSession, paths: list[str],
                            target_bytes: int = 256 * 1024 * 1024) -> int:
    """Raise ``spark.sql.shuffle.partitions`` so each initial shuffle partition holds about
    ``target_bytes`` of input; AQE then coalesces small ones. Never lowers the current value."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, -(-input_bytes(spark, paths) // target_bytes))
    if wanted != current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_bytes, 256 * 1024 * 1024)))
    return wanted
