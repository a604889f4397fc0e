"""Mixing sources to target weights by weighted fair queueing.

Each source has a target: its weight's share of all words, at most ``MAX_TIMES`` times its own size, the excess shared
among the others by weight. A source's documents queue in a shuffled order (by the MD5 of their id), up to
``MAX_TIMES`` times over. A queued document's virtual finish time is the words its source has queued up to and with
it, divided by the source's target. All queued documents are range-sorted by finish time and cut where their running
total reaches the budget; since every source's queue is served at the pace of its target, each ends near its target.

Rows with one id queue by a hash of all their columns, so only rows that are equal throughout are interchangeable: the
mix is the same however the rows are dealt. The rows are stored once with a number, which tells equal rows apart; flags,
finish times and documents all go by it. The running words of a source are sums over the range partitions of its queue
plus a window inside one of them, so a source, or an id, with a third of all rows is spread over tasks as the data grow.
The global running total is one sum per range partition, and a window inside the one partition in which the budget ends.
Only scalars and one row per partition come to the driver. Everything is made of DataFrame functions.

Defined cases: a NULL or blank text has size 0 and is never taken; a NULL source is a source, last in order; equal rows
are separate documents, of which the cut may take some; NULL ids are one id; without words all targets are 0; other
columns are carried along (maps do not take part in the hash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlake.llm.common import WORD, materialise, prepare
from commitlake.operators.rank import global_rank

WEIGHTS = (5, 2, 1)        # repeating, by the code point order of the sources
MAX_TIMES = 3              # of a source's own size, and of a document's

QUEUE = ("hash", "id", "tie", "n")
ORDER = ("finish", "source_no", *QUEUE)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_no, source_size, target) from (source, source_size); the loop's passes read only this table."""
    ranked = materialise(global_rank(sources, [F.col("source").asc_nulls_last()], "source_no"), "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("source_no") - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumn("weight", weight)
    most = MAX_TIMES * F.col("source_size")
    budget, total = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    pace = (budget or 0) / (total or 1)
    while True:                                          # words per unit of weight; rises until no target is above
        above = most <= F.col("weight") * F.lit(pace)
        full, open_weight = ranked.agg(F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))).first()
        new = (budget - (full or 0)) / open_weight if open_weight else pace
        if new == pace:
            break
        pace = new
    return ranked.withColumn("target", F.when(above, most.cast("double")).otherwise(F.col("weight") * F.lit(pace)))


def queued(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``rows`` (source, size and ``QUEUE``) with ``source_no``, ``source_size``, ``target`` and ``before``, the words that
    their source queues up to and with them in one round."""
    key = ("source", *QUEUE)
    ordered = rows.select("size", *key).repartitionByRange(*key).sortWithinPartitions(*key)
    ordered = materialise(ordered.withColumn("part", F.spark_partition_id()), "mix-queue")
    parts = ordered.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    offsets = parts.withColumn("offset", F.sum("part_size").over(
        Window.partitionBy("source").orderBy("part")) - F.col("part_size")).drop("part_size")
    offsets = offsets.alias("o").join(targets.drop("weight").alias("t"), F.expr("o.source <=> t.source")).select(
        F.col("o.source").alias("source_"), F.col("part").alias("part_"), "offset", "source_no", "source_size", "target")
    joined = ordered.join(offsets, ordered["source"].eqNullSafe(F.col("source_")) & (ordered["part"] == F.col("part_")))
    inside = Window.partitionBy("source", "part").orderBy(*QUEUE).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn("before", F.col("offset") + F.sum("size").over(inside)).drop(
        "source_", "part_", "offset", "part")


def finish_time(round_: Column) -> Column:
    return (round_ * F.col("source_size") + F.col("before")) / F.col("target")


def cut(queue: DataFrame) -> tuple | None:
    """The last queued document, in the order of ``ORDER``, at which the running total is within the budget."""
    rounds = F.least(F.lit(MAX_TIMES), F.floor(F.col("target") / F.col("source_size")).cast("int") + 1)
    items = queue.where("size > 0").withColumn("round", F.explode(F.sequence(F.lit(0), rounds - 1))).select(
        finish_time(F.col("round")).alias("finish"), "source_no", *QUEUE, "size")
    ordered = items.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    ordered = materialise(ordered.withColumn("part", F.spark_partition_id()), "mix-order")
    parts = sorted(tuple(r) for r in ordered.groupBy("part").agg(F.sum("size")).collect())    # one row per partition
    budget = queue.agg(F.sum("size")).first()[0] or 0
    running, last = 0, None
    for part, size in parts:
        if running + size > budget:
            last = part
            break
        running += size
    inside = ordered.where(F.col("part") == last).withColumn("total", F.sum("size").over(
        Window.partitionBy("part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)) + running)
    taken = ordered.where(F.col("part") < last) if last is not None else ordered
    taken = taken.select(*ORDER).union(inside.where(F.col("total") <= budget).select(*ORDER))
    top = taken.agg(F.max(F.struct(*ORDER)).alias("top")).first().top
    return tuple(top) if top is not None else None


def is_taken(round_: int, last: tuple, kinds: dict[str, str]) -> Column:
    """Whether a document is taken in one round: the order is lexicographic, as structs are compared."""
    item = F.struct(finish_time(F.lit(round_)).alias("finish"), *ORDER[1:])
    limit = F.struct(F.lit(last[0]).alias("finish"), *[F.lit(x).cast(kinds[c]).alias(c) for c, x in zip(ORDER[1:], last[1:])])
    return F.coalesce((F.col("size") > 0) & (item <= limit), F.lit(False))


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    return [F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("hash"),
            F.xxhash64(*hashed).alias("tie"), F.monotonically_increasing_id().alias("n")]


def plan_mix(rows: DataFrame) -> tuple[DataFrame, list[Column]]:
    """(queue, one taken-flag per round) of stored rows with the columns of ``_narrow``."""
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    queue = materialise(queued(rows, targets), "mix-queued")
    last = cut(queue)
    flags = [is_taken(r, last, dict(queue.dtypes)) for r in range(MAX_TIMES)] if last else [F.lit(False)] * MAX_TIMES
    return queue, flags


def mix_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target and the words that the mix takes of it."""
    prepare(docs.sparkSession)
    queue, flags = plan_mix(materialise(docs.select(*_narrow(docs, id_col, text_col, source_col)), "mix-rows"))
    copies = sum(f.cast("long") for f in flags)
    return queue.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix itself: each taken document with all its columns, once per time taken, sorted by finish time."""
    prepare(docs.sparkSession)
    rows = materialise(docs.select(F.struct("*").alias("row"), *_narrow(docs, id_col, text_col, source_col)), "mix-rows")
    queue, flags = plan_mix(rows)
    finishes = F.array_compact(F.array(*[F.when(f, finish_time(F.lit(r))) for r, f in enumerate(flags)]))
    taken = queue.select("n", "source_no", finishes.alias("finishes")).where(F.size("finishes") > 0)
    found = rows.select("row", *QUEUE).join(taken, "n").select("row", "source_no", *QUEUE, F.explode("finishes").alias("finish"))
    # what is read back may be NULL by its schema: columns of plain kinds that were declared without NULLs stay so
    plain = ("string", "boolean", "int", "bigint", "double")
    return found.orderBy(*ORDER).select(*[
        F.col("row")[f.name].alias(f.name) if f.nullable or f.dataType.simpleString() not in plain else
        F.coalesce(F.col("row")[f.name], F.lit("0").cast(f.dataType)).alias(f.name) for f in docs.schema])
