"""Helpers shared by the document operators: table access, shared scratch tables, word pattern."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.session import configure, shared_dir

SPACE = "\\x20\\x09-\\x0D"            # the white space that separates words, inside a regex class
WORD = f"[^{SPACE}]+"
CACHE_CHARS = 64                      # longer words are not remembered in a worker's cache
ARROW_ROWS = 1000                     # rows of one Arrow batch: texts are long, the default of 10,000 is not for them


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of every operator here (idempotent): UTC, AQE, small Arrow batches."""
    configure(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder; it may be removed once the result is written."""
    return shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` next to one struct ``row`` that carries every input column, whatever its name."""
    return docs.select(F.struct("*").alias("row")).select(
        "row", *[F.col("row")[c].alias(f"k{i}") for i, c in enumerate(columns)])


class Cache:
    """A dictionary of bounded size: two generations, the older one is dropped when the younger one is full."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size // 2, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(key) <= CACHE_CHARS:
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[key] = value
