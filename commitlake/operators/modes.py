"""Per-group mode and arg-max, written as aggregates (partial aggregation absorbs skew)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mode_by(df: DataFrame, key: str, value: str, out: str | None = None,
            null_bucket: bool = True, count_col: str | None = None) -> DataFrame:
    """Most frequent ``value`` per ``key``; ties go to the smallest value.

    With ``null_bucket=True`` a NULL value is a bucket of its own and, sorting
    first, wins ties (``ORDER BY n DESC, value ASC`` with NULLs first).
    Otherwise NULL values are ignored. ``count_col`` names an existing count
    column to sum instead of counting rows (for pre-aggregated input).

    Two aggregations: counts per (key, value), then ``min(struct(-n, value))``
    per key; both combine map-side, so no group is ever materialised whole.
    """
    src = df if null_bucket else df.where(F.col(value).isNotNull())
    n = F.sum(count_col) if count_col else F.count(F.lit(1))
    counts = src.groupBy(key, value).agg(n.alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("neg"), F.col(value).alias("v")))
    return counts.groupBy(key).agg(best.getField("v").alias(out or f"mode_{value}"))


def latest_by(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """Columns ``values`` of the row with the greatest ``order`` tuple per ``key``.

    NULLs order lowest, i.e. ``ORDER BY order DESC`` with NULLs last; a row
    with NULL order values is still returned when nothing else exists.

    The greatest value of the first order column is a plain hash aggregate; only the rows that have it go on to the
    arg-max, whose text buffers Spark aggregates by sorting. Their join is on key and value, so a key with very many
    rows is spread by its values.
    """
    first = order[0]
    top = df.groupBy(F.col(key).alias("_key")).agg(F.max(first).alias("_top"))
    last = df.select(key, *order, *[v for v in values if v not in order]).join(
        top, F.col(key).eqNullSafe(F.col("_key")) & F.col(first).eqNullSafe(F.col("_top")), "left_semi")
    pick = F.max_by(F.struct(*values), F.struct(*order))
    return last.groupBy(key).agg(pick.alias("_v")).select(key, *[F.col("_v").getField(v).alias(v) for v in values])
