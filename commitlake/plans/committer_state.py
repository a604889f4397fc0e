"""The committers mart kept up to date from stored day rows instead of rebuilt from all commits.

Beside the commits lie two tables in folders by month, one row per cell or per value of a cell (a cell is an author and
a day, commits without a time have a cell of their own):

* ``days``    the day rollup of the mart (counters, first and last time, hour histogram) with the profile of the day's
              latest commit;
* ``values``  commits per (author, day, kind, value) of repositories, pull requests and e-mail addresses.

Nothing in them depends on ``as_of``. A batch of commits touches the cells of its rows and those of the old rows that it
replaces (a commit may change its author or its day); only these are counted again, from the months that hold them, and
exchanged whole, so nothing is ever subtracted and repeating a step changes nothing. The touched cells are written down
before the commits change: a run that is lost afterwards finds them there and finishes first.

The mart sums day rows: every commit of a day after the cutoff's day lies in the window of a recency counter. The at most
four days on which a cutoff falls are counted from the commits of their months (a partition filter).

Hot authors: cells are grouped with map-side combine, the mart's own rollups likewise. Driver: names of months only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.functions.dates import since
from commitlake.operators.incremental import stored
from commitlake.operators.modes import latest_by
from commitlake.operators.partitioned import PartitionedTable
from commitlake.plans.committers import (
    AUTHOR, INPUT_COLUMNS, PROFILE, RECENCY_DAYS, author_days, author_totals, authored, ranked_committers, stats_from,
    value_counts, values_of,
)

c = F.col
CELL = [AUTHOR, "day"]
DATE = "commit_date"
UNDATED = "none"
RECENCY = {d: f"commits_last_{d}_days" for d in RECENCY_DAYS}


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.coalesce(c(DATE).cast("string"), F.lit(UNDATED)))


def day_rows(commits: DataFrame) -> DataFrame:
    """One row per cell: counters that no ``as_of`` moves, and sha and profile of its latest commit."""
    counted = _with_day(author_days(commits, F.lit(None).cast("timestamp")).drop(*RECENCY.values()))
    cell = F.struct(*CELL).alias("cell")
    latest = latest_by(commits.select("*", cell), "cell", ["commit_timestamp", "sha"], ["sha", *PROFILE])
    return counted.join(latest.select("cell.*", "sha", *PROFILE), CELL)


class MaintainedCommitters:
    """Commits staging with the rollups of the committers mart, under the folder ``root``.

    Has the methods that ``incremental_run`` asks of a table: ``built``, ``write``, ``merge``, ``high_watermark``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.commits = PartitionedTable(spark, f"{self.root}/commits", "commit_timestamp", "month", ["_sdc_extracted_at"])
        self.days = PartitionedTable(spark, f"{self.root}/days", DATE)
        self.values = PartitionedTable(spark, f"{self.root}/values", DATE)
        self.pending = f"{self.root}/pending"

    def _pending(self):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.pending)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def built(self) -> bool:
        return all(t.built() for t in (self.commits, self.days, self.values))

    def high_watermark(self, column: str):
        return self.commits.high_watermark(column)

    def write(self, stg_commits: DataFrame) -> DataFrame:
        """Replace everything; until the last table is written the whole counts as not built."""
        for table in (self.commits, self.days, self.values):
            table.forget()
        fs, place = self._pending()
        fs.delete(place, True)
        rows = _with_day(authored(self.commits.write(stg_commits)).select(*INPUT_COLUMNS))
        self.days.write(day_rows(rows))
        self.values.write(value_counts(rows, [*CELL, DATE]))
        return self.commits.read()

    def merge(self, batch: DataFrame, keys: list[str]) -> DataFrame:
        """Upsert a stored batch of commits by ``keys`` and count the cells it touches again."""
        self.settle()
        replaced = self.commits.read().select(*keys, AUTHOR, DATE).join(batch.select(*keys).distinct(), keys, "left_semi")
        cells = _with_day(authored(replaced.select(AUTHOR, DATE).union(batch.select(AUTHOR, DATE)))).distinct()
        cells.write.mode("append").parquet(self.pending)
        self.commits.merge(batch, keys)
        self.settle()
        return self.commits.read()

    def settle(self) -> None:
        """Count the cells that have been written down again; afterwards there are none."""
        fs, place = self._pending()
        if not fs.exists(place):
            return
        schema = self.days.read().select(AUTHOR, DATE, "day").schema
        cells = self.spark.read.schema(schema).parquet(self.pending).distinct()
        rows = _with_day(authored(self.commits.beside(cells.withColumnRenamed(DATE, "commit_timestamp"))).select(*INPUT_COLUMNS))
        rows = stored(rows.join(cells.select(*CELL), CELL, "left_semi"), self.spark, "cells")
        self.days.replace(stored(day_rows(rows), self.spark, "days"), cells, CELL)
        self.values.replace(stored(value_counts(rows, [*CELL, DATE]), self.spark, "values"), cells, CELL)
        fs.delete(place, True)

    def stats(self, as_of: Column) -> DataFrame:
        """The mart's columns without ranks, equal to ``committer_stats`` over all commits."""
        days = self.days.read()
        cuts = {d: since(as_of, d) for d in RECENCY_DAYS}
        whole = days.select("*", *[F.when(c(DATE) > F.to_date(cuts[d]), c("n")).otherwise(0).alias(name)
                                   for d, name in RECENCY.items()])
        on_edge = [(c(DATE) == F.to_date(cut)) & (c("commit_timestamp") >= cut) for cut in cuts.values()]
        edges = (authored(self.commits.at(list(cuts.values()))).groupBy(AUTHOR)
                 .agg(*[F.count_if(hit).alias(f"edge_{d}") for d, hit in zip(cuts, on_edge)]))
        totals = author_totals(whole, as_of).join(edges, AUTHOR, "left")
        totals = totals.withColumns({name: c(name) + F.coalesce(f"edge_{d}", F.lit(0)) for d, name in RECENCY.items()})
        values = self.values.read().groupBy(AUTHOR, "kind", "value").agg(F.sum("n").alias("n"))
        return stats_from(totals, values_of(values), latest_by(days, AUTHOR, ["day_last", "sha"], PROFILE), as_of)

    def mart(self, as_of: Column, built_at: Column | None = None, sort: bool = True) -> DataFrame:
        """The committers mart as of any moment."""
        return ranked_committers(self.stats(as_of), built_at, sort)
