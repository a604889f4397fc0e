"""Connected components as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import materialise

FOREST_EDGES = 200_000     # edges that a task joins to trees before it hands them on


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is nobody's larger end."""
    ends = edges.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    if not ends.where("n > 1").isEmpty():
        return False
    return edges.select("a").distinct().join(ends.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()


def local_forests(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: those that meet in a task become stars around their smallest node, a bounded
    number of edges at a time."""
    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        held = 0

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        def stars() -> pa.RecordBatch:
            found = [(r, x) for x in list(parent) if (r := root(x)) != x]
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
            held += len(batch)
            if held >= FOREST_EDGES:
                yield stars()
                parent.clear()
                held = 0
        if parent:
            yield stars()

    return edges.repartition("b").mapInArrow(forest, "a long, b long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every end of ``edges`` (a, b); label is the smallest node of the component.

    Edges that share their larger end meet in one task first and become stars there (``local_forests``). Then
    alternating large-star and small-star steps (Kiveris et al., 2014): every node hands its larger, then its
    smaller neighbours to its smallest one, until each component is a star. Each round is three aggregates and two
    joins over the edges; its result is written to the shared folder. The number of rounds is logarithmic.
    """
    both = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    edges = materialise(local_forests(both).distinct(), "components")
    while not _is_forest_of_stars(edges):
        both = _both_ways(edges)                                            # large star
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b")
        low = large.groupBy("b").agg(F.min("a").alias("m"))                 # small star
        small = large.join(low, "b").select(F.inline(F.array(F.struct(F.col("m").alias("a"), F.col("b")),
                                                             F.struct(F.col("m").alias("a"), F.col("a").alias("b")))))
        edges = materialise(small.where("a < b").distinct(), "components")
    tops = edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(tops)
