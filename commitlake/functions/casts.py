"""Safe casts with the warehouse's SAFE_CAST / SAFE.PARSE_TIMESTAMP semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3339: date 'T' time, optional fraction of 1 to 9 digits, offset required (Z or +hh:mm).
RFC3339_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS]XXX"


def safe_int(c: Column) -> Column:
    """String → bigint; NULL for non-integers such as '1.5' and on overflow."""
    return c.try_cast("bigint")


def safe_bool(c: Column) -> Column:
    """String → boolean accepting only true/false in any case (``try_cast`` would take 1/0/yes)."""
    low = F.lower(c)
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def parse_rfc3339(c: Column) -> Column:
    """RFC 3339 text → UTC timestamp; NULL for date-only, offset-less or invalid values."""
    return F.try_to_timestamp(c, F.lit(RFC3339_FORMAT))
