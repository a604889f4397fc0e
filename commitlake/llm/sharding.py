"""Sharding by histogram sort: shards of nearly equal bytes whose borders are found by counting, then one exchange.

A document's key is (hash of its text, hash of its id), so that equal texts are neighbours. The wanted borders are the
multiples of total / shards. Each pass counts the exact bytes in the candidate cells of the key space, one aggregate
over a narrow table, and keeps for every border the cell it falls into; the next pass probes that cell 4096 times
finer. A border is settled at a cell's edge once it misses the wanted byte by at most ``TOLERANCE`` of a shard, or
when the cell is a single key. The cell of a group of copies that holds a third of all rows is split further by the
ids' hashes, and a key that has more than a tolerance of bytes by itself (copies without ids, or repeated with theirs) by
the number of the row: such keys, of which there are at most shards / ``TOLERANCE``, are counted beforehand, and their
rows are numbered in the lanes of the stored table's partitions. A pass brings at most 4096 counts per open border to the
driver, whatever the input.

Everything is made of DataFrame functions.

Defined cases: a NULL text counts as empty; a NULL id hashes to one fixed value; rows that are equal in text and id are
split where the law needs it, and which of them goes where is open; an empty table has no rows; other columns are not
looked at (``shard_rows`` carries them along).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlake.llm.common import materialise, prepare

TOLERANCE = 0.001          # of a shard's bytes
STEP = 12                  # bits of the key that a pass resolves
OVERHEAD = 16              # bytes counted for a row besides its text
ROWS_PER_TASK = 250_000    # rows of a shard that one task numbers

LOWEST = -(1 << 63)
PARTS = ("g", "h", "i")    # of a key: hashes of text and id, and a number
Key = tuple[int, int, int]


def key_columns(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(text).alias("g"), F.xxhash64(F.col(id_col)).alias("h"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]


def stored_keys(rows: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """``rows`` with g, h and size, stored, with ``i``: rows of a key that has too many bytes are numbered, others have 0."""
    rows = materialise(rows.withColumn("n", F.monotonically_increasing_id()), "shard-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    large = rows.groupBy("g", "h").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).where(
        (F.col("bytes") > tolerance * total / n_shards) & (F.col("rows") > 1)).select("g", "h")
    large = materialise(large, "shard-large")
    if large.isEmpty():
        return rows.withColumn("i", F.lit(0).cast("long")).drop("n")
    large = F.broadcast(large)                                 # at most n_shards / tolerance rows
    hot = rows.join(large, ["g", "h"]).withColumn("lane", F.shiftright("n", 33))
    lanes = hot.groupBy("g", "h", "lane").agg(F.count(F.lit(1)).alias("rows"))
    first = lanes.withColumn("first", F.sum("rows").over(Window.partitionBy("g", "h").orderBy("lane")) - F.col("rows")).drop("rows")
    place = F.row_number().over(Window.partitionBy("g", "h", "lane").orderBy("n"))
    hot = hot.join(first, ["g", "h", "lane"]).withColumn("i", F.col("first") + place - 1)
    cold = rows.join(large, ["g", "h"], "left_anti").withColumn("i", F.lit(0).cast("long"))
    return materialise(cold.unionByName(hot.select(cold.columns)).drop("n"), "shard-numbered")


def find_borders(keys: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> list[Key]:
    """The first key of shards 1, 2, ...; ``keys`` has g, h, i and size and should be a stored table."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / n_shards
    settled: dict[int, Key] = {}

    def key(known: tuple[int, ...], value: int) -> Key:
        return (*known, value, *[LOWEST] * (len(PARTS) - len(known) - 1))

    # an open border: the bytes below the cell it lies in, and the cell: the key's parts that are known, and the leading
    # bits of the next part (their value, and how many bits are still open)
    open_: dict[int, tuple[int, tuple]] = {j: (0, ((), 0, 64)) for j in range(1, n_shards)} if total else {}
    while open_:
        depth, shift = min(((len(c[0]), c[2]) for _, c in open_.values()), key=lambda x: (x[0], -x[1]))
        now = sorted({c for _, c in open_.values() if (len(c[0]), c[2]) == (depth, shift)})
        part, finer = PARTS[depth], max(0, shift - STEP)
        groups: dict[tuple[int, ...], list[int]] = {}
        for known, cell, _ in now:
            groups.setdefault(known, []).append(cell)
        inside = F.lit(False)
        for known, found in groups.items():
            same = F.lit(True) if shift == 64 else F.shiftright(part, shift).isin(found)
            for name, value in zip(PARTS, known):
                same = (F.col(name) == value) & same
            inside = inside | same
        counts: dict[tuple, list[tuple[int, int]]] = {}
        for *known, cell, size in keys.where(inside).groupBy(*PARTS[:depth], F.shiftright(part, finer).alias("cell")).agg(
                F.sum("size")).collect():
            parent = tuple(known), cell >> (shift - finer) if shift < 64 else 0, shift
            counts.setdefault(parent, []).append((cell, size))
        for found in counts.values():
            found.sort()
        for j, (below, cell) in list(open_.items()):
            if cell not in now:
                continue
            known, wanted = cell[0], j * total / n_shards
            for value, size in counts[cell]:
                if below + size > wanted:
                    break
                below += size
            last = depth + 1 == len(PARTS) and finer == 0
            if wanted - below <= slack or (last and 2 * (wanted - below) <= size):
                settled[j] = key(known, value << finer)
            elif below + size - wanted <= slack or last:
                settled[j] = key(known, (value << finer) + (1 << finer))
            else:
                open_[j] = (below, (known, value, finer) if finer else ((*known, value), 0, 64))
                continue
            del open_[j]
    return [settled[j] for j in sorted(settled)]


def shard_of(borders: list[Key]) -> Column:
    """The shard of a row with columns g, h and i: how many borders are at or below its key."""
    if not borders:
        return F.lit(0)
    past = [(F.col("g") > g) | ((F.col("g") == g) & ((F.col("h") > h) | ((F.col("h") == h) & (F.col("i") >= i))))
            for g, h, i in borders]
    return sum((p.cast("int") for p in past[1:]), past[0].cast("int"))


def numbered(rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` (shard, g, h, i) with ``slot``, gapless from 0 in each shard; a large shard is numbered by several tasks."""
    counts = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("h", "g", "i"), F.lit(-(-most // ROWS_PER_TASK) or 1)).cast("int"))
    lanes = rows.groupBy("shard", "lane").agg(F.count(F.lit(1)).alias("n"))
    first = lanes.withColumn("first", F.sum("n").over(Window.partitionBy("shard").orderBy("lane")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("shard", "lane").orderBy("g", "h", "i", id_col))
    return rows.join(first, ["shard", "lane"]).withColumn("slot", F.col("first") + place - 1).drop("lane", "first")


def shard_table(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot."""
    prepare(docs.sparkSession)
    keys = stored_keys(docs.select(F.col(id_col), *key_columns(id_col, text_col)), n_shards)
    rows = keys.withColumn("shard", shard_of(find_borders(keys, n_shards)))
    return numbered(rows, id_col).select(id_col, "size", "text_crc32", "shard", "slot")


def shard_rows(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` as ``row``, with ``shard``, exchanged once so that a task holds one shard's rows."""
    prepare(docs.sparkSession)
    rows = stored_keys(docs.select(F.struct("*").alias("row"), *key_columns(id_col, text_col)), n_shards)
    borders = find_borders(rows.select(*PARTS, "size"), n_shards)
    return rows.withColumn("shard", shard_of(borders)).repartition("shard").sortWithinPartitions("shard", *PARTS).select(
        "row", "shard")
