"""A plain parquet table in folders by period, upserted by Spark's dynamic partition overwrite.

A merge rewrites the periods that hold a key of the batch or get a row of it, and no others: a batch of recent rows costs
its periods, whatever the size of the table. There are no file lists and no versions; Spark's own partition discovery
finds the files and its partition filters skip the others. New rows are dealt to files by ``REBALANCE`` on the period, so
a period with a third of all rows is split over tasks and files, and short periods share a task; old rows of a rewritten
period are not exchanged while the batch's keys in it are few (by their bytes).

A merge replaces its periods in rounds of some neighbouring ones, so that besides the table and the batch only a round's
files and keys lie on disk. A merge that is lost in between is repeated with the same batch, as the watermark moves only
after the last round: upserting a row twice changes nothing. There is one writer at a time, and frames read before a merge
have to be read again.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.operators.dedupe import keep_latest
from commitlake.operators.incremental import _plain, parquet_options, stored, watermark_value
from commitlake.session import free_shuffles, input_bytes

PERIOD = "period"
GRAINS = {"month": "'m'yyyy-MM", "day": "'d'yyyy-MM-dd"}       # the letter keeps the folder name a string
NO_TIME = "none"
STATE = "_state.json"      # names with an underscore are no data to Spark's readers
BROADCAST_BYTES = 32 << 20 # of a batch's keys, or of those that a round replaces; beyond it Spark joins by an exchange
ROUND_BYTES = 2 << 30      # of files that a round of a merge rewrites, more in a table of over ROUNDS times as many
ROUNDS = 16


class PartitionedTable:
    """The table under ``path``: one folder per ``grain`` (month or day) of ``time_column``; rows without a time have a
    folder of their own. ``watermarks``: timestamp or whole-number columns whose maxima are kept beside it, observed while they are written."""

    def __init__(self, spark: SparkSession, path: str, time_column: str, grain: str = "month",
                 watermarks: list[str] | None = None):
        self.spark, self.path, self.time_column = spark, path.rstrip("/"), time_column
        self.format = GRAINS[grain]
        self.watermarks = watermarks or []

    def _place(self, name: str):
        """(file system, path) of a name below the table."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _state(self) -> dict | None:
        """What the last finished write has left: schema and maxima of the watermark columns."""
        fs, place = self._place(STATE)
        if not fs.exists(place):
            return None
        stream = fs.open(place)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def built(self) -> bool:
        return self._state() is not None

    def periods(self) -> list[str]:
        fs, place = self._place("")
        names = [x.getPath().getName() for x in fs.listStatus(place)]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{PERIOD}="))

    def _dated(self, df: DataFrame) -> DataFrame:
        if PERIOD in df.columns:
            raise ValueError(f"the table's folders are named {PERIOD}: rename that column")
        return df.withColumn(PERIOD, F.coalesce(F.date_format(self.time_column, self.format), F.lit(NO_TIME)))

    def _rows(self) -> DataFrame:
        schema = T.StructType.fromJson(self._state()["schema"])
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._rows().drop(PERIOD)

    def since(self, moment: Column) -> DataFrame:
        """Rows at or after ``moment``, from the folders that can hold them only (a partition filter)."""
        return self._rows().where((F.col(PERIOD) >= F.date_format(moment, self.format)) & (F.col(PERIOD) != NO_TIME)
                                  & (F.col(self.time_column) >= moment)).drop(PERIOD)

    def at(self, moments: list[Column]) -> DataFrame:
        """Rows of the periods of ``moments``, other folders are not read (a partition filter)."""
        return self._rows().where(F.col(PERIOD).isin(*[F.date_format(m, self.format) for m in moments])).drop(PERIOD)

    def beside(self, rows: DataFrame) -> DataFrame:
        """Rows of the periods that ``rows``, which have the time column, lie in. The periods' names come to the driver."""
        names = [r[0] for r in self._dated(rows).select(PERIOD).distinct().collect()]
        return self._rows().where(F.col(PERIOD).isin(names)).drop(PERIOD)

    def _put(self, rows: DataFrame, mode: str) -> dict:
        """Write whole periods; the maxima of the watermark columns, observed on the way."""
        seen = Observation()
        if self.watermarks:
            rows = rows.observe(seen, *[F.max(_plain(c, rows.schema)).alias(c) for c in self.watermarks])
        with free_shuffles(self.spark):
            rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(PERIOD).options(
                **parquet_options(rows.columns)).parquet(self.path)
        return {c: seen.get[c] for c in self.watermarks}

    def _finish(self, schema: T.StructType, highs: list[dict], mode: str) -> None:
        """Leave the state of a write that has put all its rows."""
        high = {**((self._state() or {}).get("high", {}) if mode == "dynamic" else {})}
        for c in self.watermarks:
            high[c] = max((h[c] for h in [high, *highs] if h.get(c) is not None), default=None)
        self._leave_state({"schema": schema.jsonValue(), "high": high})

    def _leave_state(self, state: dict) -> None:
        fs, place = self._place(STATE)
        stream = fs.create(place, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()

    def write(self, df: DataFrame) -> DataFrame:
        """Replace the whole table."""
        rows = self._dated(df)
        self._finish(rows.schema, [self._put(rows.hint("rebalance", PERIOD), "static")], "static")
        return self.read()

    def high_watermark(self, column: str):
        """The greatest value of a watermark column that a finished write has left (timestamps as epoch microseconds)."""
        if column in self.watermarks:
            return self._state()["high"][column]
        return watermark_value(self.read(), column)

    def merge(self, batch: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
        """Insert ``batch``, whose rows replace those with their key; with ``order`` the first by it of the old row and
        the batch's stays. ``batch`` should be a stored table. The periods' names and counts come to the driver."""
        target = self._rows()
        batch = self._dated(batch.select(*[c for c in target.columns if c != PERIOD]))
        size = F.sum(sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(8))).alias("size")
        arriving = {r[PERIOD]: r["size"] or 0 for r in batch.groupBy(PERIOD).agg(size).collect()}
        if not arriving:
            return self.read()
        few = sum(arriving.values()) <= BROADCAST_BYTES
        batch_keys = batch.select(*keys).distinct()
        batch_keys = F.broadcast(batch_keys) if few else batch_keys
        if order:
            return self._merge_ordered(target, batch, batch_keys, arriving, keys, order)
        gone, replaced, emptied = batch_keys, {}, set()
        if not few:                        # the keys of old rows that go, by period: a round needs its own ones only
            gone = stored(target.select(PERIOD, *keys).join(batch_keys, keys, "left_semi").groupBy(PERIOD, *keys).agg(
                F.count(F.lit(1)).alias("hits_")), self.spark, "replaced")
            found = gone.groupBy(PERIOD).agg(F.sum("hits_").alias("hits"), size).collect()
            replaced = {r[PERIOD]: r["size"] for r in found}
            others = {r[PERIOD]: r.hits for r in found if r[PERIOD] not in arriving}
            if others:
                rows = target.where(F.col(PERIOD).isin(sorted(others))).groupBy(PERIOD).agg(F.count(F.lit(1)).alias("rows"))
                emptied = {r[PERIOD] for r in rows.collect() if r.rows == others[r[PERIOD]]}
        elif set(self.periods()) - set(arriving):               # else every period is rewritten anyway
            counts = self._counts(target, batch_keys, keys)
            replaced = dict.fromkeys((r[PERIOD] for r in counts), 0)
            emptied = {r[PERIOD] for r in counts if r.hits == r.rows} - set(arriving)
        highs = []
        for some in self._rounds(sorted({*arriving, *replaced} - emptied), replaced):
            old, new = (df.where(F.col(PERIOD).isin(some)) for df in (target, batch))   # of the table a partition filter
            going = gone if few else gone.where(F.col(PERIOD).isin(some)).select(*keys)
            if few or sum(replaced.get(p, 0) for p in some) <= BROADCAST_BYTES:
                # the rows that stay are not exchanged: they come in files of their period
                merged = old.join(F.broadcast(going), keys, "left_anti").unionByName(new.hint("rebalance", PERIOD))
            else:
                merged = old.join(going, keys, "left_anti").unionByName(new).hint("rebalance", PERIOD)
            highs.append(self._put(merged, "dynamic"))
        self._remove(emptied)
        self._finish(merged.schema, highs, "dynamic")
        return self.read()

    def _merge_ordered(self, target: DataFrame, batch: DataFrame, batch_keys: DataFrame, arriving: dict[str, int],
                       keys: list[str], order: list[Column]) -> DataFrame:
        """One round: which row of a key stays is known only where all its periods are read."""
        counts = self._counts(target, batch_keys, keys) if set(self.periods()) - set(arriving) else []
        touched = sorted({*arriving, *(r[PERIOD] for r in counts)})
        merged = keep_latest(target.where(F.col(PERIOD).isin(touched)).unionByName(batch), keys, order).hint("rebalance", PERIOD)
        emptied = {r[PERIOD] for r in counts if r.hits == r.rows} - set(arriving)
        if emptied:
            emptied -= {r[0] for r in merged.where(F.col(PERIOD).isin(sorted(emptied))).select(PERIOD).distinct().collect()}
        high = self._put(merged, "dynamic")
        self._remove(emptied)
        self._finish(merged.schema, [high], "dynamic")
        return self.read()

    def _counts(self, target: DataFrame, batch_keys: DataFrame, keys: list[str]) -> list:
        """(period, rows, hits) of the periods that hold a key of the batch."""
        hit = F.lit(1).alias("hit")
        return target.select(PERIOD, *keys).join(batch_keys.select(*keys, hit), keys, "left").groupBy(PERIOD).agg(
            F.count(F.lit(1)).alias("rows"), F.count("hit").alias("hits")).where("hits > 0").collect()

    def _rounds(self, periods: list[str], key_bytes: dict[str, int]) -> list[list[str]]:
        """Neighbouring periods together, up to the limits of a round; a longer period is a round of its own."""
        fs, place = self._place("")
        if fs.getContentSummary(place).getLength() <= ROUND_BYTES and sum(key_bytes.values()) <= BROADCAST_BYTES:
            return [periods]
        old = {p: input_bytes(self.spark, [f"{self.path}/{PERIOD}={p}"]) for p in periods}
        most = max(ROUND_BYTES, sum(old.values()) // ROUNDS), max(BROADCAST_BYTES, sum(key_bytes.values()) // ROUNDS)
        rounds, held = [], (0, 0)
        for p in periods:
            size = old[p], key_bytes.get(p, 0)
            held = held[0] + size[0], held[1] + size[1]
            if rounds and held[0] <= most[0] and held[1] <= most[1]:
                rounds[-1].append(p)
            else:
                rounds.append([p])
                held = size
        return rounds

    def _remove(self, periods: set[str]) -> None:
        """A period all of whose rows have moved elsewhere gets no new folder: it has to be removed."""
        for period in sorted(periods):
            fs, place = self._place(f"{PERIOD}={period}")
            fs.delete(place, True)

    def replace(self, batch: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
        """Delete every row whose ``keys`` (no NULLs) are in ``gone`` and insert ``batch``: whole cells are exchanged for
        others, and a cell may end empty. ``gone`` has the time column, whose periods hold all of its keys' rows; both
        should be stored tables. Repeating a lost replacement changes nothing."""
        target, gone = self._rows(), self._dated(gone.select(*{**dict.fromkeys(keys), self.time_column: None}))
        batch = self._dated(batch.select(*[c for c in target.columns if c != PERIOD]))
        touched = sorted(r[0] for r in gone.select(PERIOD).union(batch.select(PERIOD)).distinct().collect())
        if not touched:
            return self.read()
        stays = target.where(F.col(PERIOD).isin(touched)).join(gone.select(*keys).distinct(), keys, "left_anti")
        merged = stays.select(*target.columns).unionByName(batch.select(*target.columns))
        left = {r[0] for r in merged.select(PERIOD).distinct().collect()}
        high = self._put(merged.hint("rebalance", PERIOD), "dynamic")
        self._remove(set(touched) & set(self.periods()) - left)
        self._finish(merged.schema, [high], "dynamic")
        return self.read()

    def forget(self) -> None:
        """Take back ``built()`` before a rebuild of several tables that belong together."""
        fs, place = self._place(STATE)
        fs.delete(place, False)
