"""Date dimensions and day arithmetic (UTC session)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def date_dims(ts: Column, prefix: str = "commit") -> list[Column]:
    """Date, Monday week, month, quarter, year, day of week (1 = Sunday) and hour."""
    d = F.to_date(ts)
    return [
        d.alias(f"{prefix}_date"),
        F.trunc(d, "week").alias(f"{prefix}_week"),
        F.trunc(d, "month").alias(f"{prefix}_month"),
        F.trunc(d, "quarter").alias(f"{prefix}_quarter"),
        F.trunc(d, "year").alias(f"{prefix}_year"),
        F.dayofweek(ts).cast("bigint").alias(f"{prefix}_day_of_week"),
        F.hour(ts).cast("bigint").alias(f"{prefix}_hour"),
    ]


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``: seconds difference truncated toward zero."""
    secs = F.unix_seconds(end) - F.unix_seconds(start)
    return ((secs - secs % SECONDS_PER_DAY) / SECONDS_PER_DAY).cast("bigint")


def since(as_of: Column, days: int) -> Column:
    """``as_of`` minus ``days`` whole days (timestamp arithmetic, not calendar)."""
    return as_of - F.make_dt_interval(F.lit(days))
