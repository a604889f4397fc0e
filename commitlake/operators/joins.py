"""Joins of facts to dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)``; rows with a NULL key match nothing and do not take part in the shuffle,
    where they would all meet in one partition. Frequent known keys are left to the adaptive skew join."""
    joined = fact.where(F.col(key).isNotNull()).join(dim, key, "left")
    added = {f.name: F.lit(None).cast(f.dataType) for f in dim.schema.fields if f.name != key}
    return joined.unionByName(fact.where(F.col(key).isNull()).withColumns(added))
