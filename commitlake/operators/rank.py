"""Global row numbering without funnelling every row through one task."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlake.session import shared_dir

LANE_ROWS = 1_000_000   # rows of one value that are numbered by one task; a more frequent value is split into lanes
HIGH_BITS = 20          # values are added up in blocks of 2**20 neighbours

_ROW_BITS = 33  # monotonically_increasing_id: partition index in the upper bits, row index in the lower 33


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` computed in parallel.

    A window without PARTITION BY plans an Exchange to a single partition.
    Instead: range-partition and sort by ``order`` (distributed), tag each
    row with its partition index and position, and materialise that once in
    the shared checkpoint folder so the (sample-based) range bounds cannot
    change between the two passes. Per-partition counts - one row per
    partition, a size bound fixed by the partition count - are collected,
    turned into offsets and broadcast back. Row order of the result is not guaranteed.
    ``order`` must be a total order (add a unique tie-break column).
    """
    spark = df.sparkSession
    tagged = df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    path = shared_dir(spark, "rank", f"{name}-{uuid.uuid4().hex}")
    tagged.write.parquet(path)
    tagged = spark.read.parquet(path)
    # One (partition, rows) pair per partition: bounded by the partition count, so it may go to the driver.
    counts = sorted(tuple(r) for r in tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt")).collect())
    running, rows = 0, []
    for pid, cnt in counts:
        rows.append((pid, running))
        running += cnt
    offsets = spark.createDataFrame(rows, "_pid int, _off long")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _ROW_BITS)
    ranked = tagged.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + pos + 1)
    return ranked.drop("_pid", "_mid", "_off")


def rank_by_value(df: DataFrame, value: str, key: str, name: str, lane_rows: int = LANE_ROWS) -> DataFrame:
    """``row_number() OVER (ORDER BY value DESC NULLS LAST, key)`` for an integer ``value`` that many rows share.

    From a histogram instead of a sort of all rows: rows are counted per value (combined map-side), the counts give every
    value the number of rows before it, and inside a value rows are numbered by ``key``. A value with more than
    ``lane_rows`` rows, were it all of them, is split into lanes of about so many rows by quantiles of its keys. Nothing is
    written; ``df`` is read several times, so pass stored rows.

    ``key`` is a unique number. Sizes: to the driver go the values above ``lane_rows`` (at most rows / lane_rows) and as
    many lane borders. Counts are added up inside blocks of 2**20 values, then over the blocks; with values below 2**40 that
    last sum has at most 2**20 rows.
    """
    v, k = F.col(value), F.col(key)
    hot = [r[0] for r in df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > lane_rows).collect()]
    lane = F.lit(0)
    if hot:
        is_hot = v.isin([x for x in hot if x is not None]) | (v.isNull() if None in hot else F.lit(False))
        is_hot = F.coalesce(is_hot, F.lit(False))
        found = df.where(is_hot).agg(F.count(F.lit(1)).alias("n")).first()["n"]
        lanes = -(-found // lane_rows)
        borders = df.where(is_hot).agg(
            F.percentile_approx(k, [i / lanes for i in range(1, lanes)], 10 * lanes)).first()[0] if lanes > 1 else []
        borders = F.array(*[F.lit(x) for x in sorted(set(borders))])
        lane = F.when(is_hot, F.size(F.filter(borders, lambda b: b < k))).otherwise(0)
    high = F.shiftright(v.cast("bigint"), HIGH_BITS)
    laned = df.withColumn("_lane", lane)
    counts = laned.groupBy(value, "_lane").agg(F.count(F.lit(1)).alias("_n")).withColumn("_high", high)
    before = (Window.unboundedPreceding, -1)
    falling = Window.partitionBy("_high").orderBy(v.desc_nulls_last(), "_lane").rowsBetween(*before)
    blocks = counts.groupBy("_high").agg(F.sum("_n").alias("_n")).select(
        F.col("_high").alias("_block"),
        F.coalesce(F.sum("_n").over(Window.orderBy(F.col("_high").desc_nulls_last()).rowsBetween(*before)), F.lit(0))
        .alias("_blocks_before"))
    offsets = (counts.withColumn("_off", F.coalesce(F.sum("_n").over(falling), F.lit(0)))
               .join(blocks, F.col("_high").eqNullSafe(F.col("_block")))
               .select(v.alias("_value"), F.col("_lane").alias("_at"), (F.col("_off") + F.col("_blocks_before")).alias("_off")))
    placed = laned.withColumn("_place", F.row_number().over(Window.partitionBy(value, "_lane").orderBy(k)))
    return (placed.join(offsets, v.eqNullSafe(F.col("_value")) & (F.col("_lane") == F.col("_at")))
            .select(*df.columns, (F.col("_off") + F.col("_place")).alias(name)))
