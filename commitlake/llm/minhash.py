"""MinHash near-duplicates with sequential Bayesian verification (after BayesLSH), as classes of documents.

1. Each text becomes the set of its distinct 5-word shingles and a signature of ``HASHES`` minima. Documents with
   equal sets are one node from here on, so a group of exact copies costs one node however large it is.
2. Signatures are banded; a bucket is the nodes that agree on a whole band. The number of rows per band follows from
   the threshold and the chosen chance ``BAND_MISS`` that a linked pair shares no bucket.
3. Candidates are not all pairs of a bucket. First every member meets its bucket's smallest node, then, where a
   bucket still holds several classes, the node nearest to its middle; only pairs that still lie in different classes
   after that are compared. Links inside a class cannot change the result, so nothing is lost, and a bucket of n near
   copies costs n comparisons. Shingles that a node shares with no other candidate bound its similarity to any of
   them: nodes that this exact bound keeps below the threshold are left out. In the last step the nodes around one
   middle are known by their differences from it: pairs that share too few of these, an exact bound again, are left out.
4. A candidate's signatures are compared batch by batch. With a uniform prior the similarity after m matches of n
   follows Beta(m + 1, n - m + 1); once P(similarity >= threshold) falls below ``PRUNE_MISS`` the pair is dropped.
5. Survivors are verified exactly on their full shingle sets.

Defined cases: a NULL, empty or blank text has an empty set and is linked with nothing; a text of fewer than 5 words
is one shingle; rows with equal ids are separate rows of the same id; a NULL id never becomes a class id while the
class has another one, and a class of NULL ids only has a NULL id; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlake.llm.common import materialise, packed, prepare
from commitlake.llm.graph import connected_components

SHINGLE = 5                # words
HASHES = 252               # minima of a signature
BATCH = 28                 # minima compared at a time
BAND_MISS = 1e-5           # chance that a pair at the threshold shares no bucket
PRUNE_MISS = 1e-5          # posterior below which a candidate is dropped
WORD_CACHE = 500_000       # word hashes remembered per worker

_rng = np.random.default_rng(20240229)
MULTIPLIERS = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
POWERS = _rng.integers(0, 1 << 62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def banding(threshold: int) -> tuple[int, int]:
    """(rows, bands) for a threshold in percent: as many rows per band as ``BAND_MISS`` allows."""
    t = threshold / 100
    fits = [r for r in range(1, HASHES + 1) if (1 - t ** r) ** (HASHES // r) <= BAND_MISS]
    return max(fits), HASHES // max(fits)


def fewest_matches(threshold: int) -> list[int]:
    """For each batch end n: the fewest matches m at which P(similarity >= threshold | m of n) >= ``PRUNE_MISS``.

    1 - I_t(m + 1, n - m + 1) equals the binomial sum P(Bin(n + 1, t) <= m).
    """
    t, out = threshold / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        p, m = 0.0, -1
        while p < PRUNE_MISS:
            m += 1
            p += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """The text's set as sorted distinct 64-bit hashes of its 5-word shingles."""
    words = (text or "").encode().lower().split()       # bytes: lower() and split() are ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = len(w) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        h += (w[i:i + n] ^ (w[i:i + n] >> np.uint64(29))) * POWERS[i]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)    # mix: the minima use the upper bits
    return np.unique(h ^ (h >> np.uint64(29)))


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of ``HASHES`` multiplicative hashes over a non-empty set."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 256):                      # blocks that stay in the processor's cache
        np.minimum(low, np.multiply.outer(x[i:i + 256], MULTIPLIERS).min(axis=0), out=low)
    return low


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    bands = len(minima) // rows
    m = minima[:bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(rows):
        key = (key ^ m[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


PROFILE = "n_shingles long, node long, bands array<long>, signature binary"


def profiles(docs: DataFrame, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id ``k``, a hash ``text_key`` of the text, set size, node (a hash of the set), band keys, signature."""
    rows, _ = banding(threshold)
    kind = dict(docs.dtypes)[id_col]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, bands, signs = [], [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py())
                sizes.append(len(found))
                if not len(found):
                    nodes.append(None), bands.append(None), signs.append(None)
                    continue
                minima = signature(found)
                nodes.append(xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63))
                bands.append(band_keys(minima, rows))
                signs.append((minima >> np.uint32(16)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                ["k", "text_key", "n_shingles", "node", "bands", "signature"])
        _hashes.clear()                    # the worker outlives this task

    texts = docs.select(F.col(id_col).alias("k"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("t"))
    return texts.mapInArrow(profile, f"k {kind}, text_key long, {PROFILE}")


def likely(pairs: DataFrame, signs: DataFrame, threshold: int) -> DataFrame:
    """``pairs`` (a, b) that survive the sequential comparison, with ``matches``, the equal minima of all batches."""
    fewest = fewest_matches(threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(n, HASHES) for i in (2, 3))
            alive, matches = np.arange(n), np.zeros(n, np.int64)
            for i, need in enumerate(fewest):
                part = slice(i * BATCH, (i + 1) * BATCH)
                matches[alive] += (x[alive, part] == y[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= need]
            left = pa.array(alive)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(left), batch.column(1).take(left), pa.array(matches[alive])],
                ["a", "b", "matches"])

    both = pairs.join(signs.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a").join(
        signs.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long, matches long")


def verified(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """``pairs`` (a, b) whose full sets have 100 * intersection >= threshold * union."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, np.ndarray] = {}

        def found(node: int, text: pa.Scalar) -> np.ndarray:
            if node not in last:
                if len(last) >= 64:
                    last.clear()
                last[node] = shingles(text.as_py())
            return last[node]

        for batch in batches:
            keep = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *batch.columns[2:]):
                x, y = found(a, ta), found(b, tb)
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= threshold * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.select(F.col("a").alias("one"), F.col("b").alias("two")).join(
        texts.select(F.col("node").alias("one"), F.col("t").alias("text_one")), "one").join(
        texts.select(F.col("node").alias("two"), F.col("t").alias("text_two")), "two")
    return both.select("one", "two", "text_one", "text_two").mapInArrow(verify, "a long, b long")


def _labelled(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` whose ends lie in different classes; a node without a class is its own."""
    a = classes.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = classes.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return pairs.join(a, "a", "left").join(b, "b", "left").where(
        F.coalesce("la", "a") != F.coalesce("lb", "b")).drop("la", "lb")


def node_classes(profiled: DataFrame, texts_of: DataFrame, threshold: int) -> DataFrame:
    """(node, label) for every node with a link; ``texts_of`` has (text_key, t) of every row."""
    buckets = profiled.where("node IS NOT NULL").select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = materialise(buckets.join(shared.select("bucket", "low"), "bucket").distinct(), "minhash-members")

    # signature and one text of each node that has a candidate
    some_text = profiled.where("node IS NOT NULL").groupBy("node").agg(F.min("text_key").alias("text_key"))
    wanted = some_text.join(members.select("node").distinct(), "node", "left_semi")
    one_text = texts_of.join(wanted.select("text_key"), "text_key", "left_semi").groupBy("text_key", "t").agg(
        F.lit(1).alias("one")).drop("one")
    texts = materialise(wanted.join(one_text, "text_key").select("node", "t"), "minhash-texts")
    signs = materialise(profiled.join(wanted, ["node", "text_key"], "left_semi").select("node", "signature").groupBy(
        "node", "signature").agg(F.lit(1).alias("one")).drop("one"), "minhash-signatures")

    # 1. every node against the smallest node of all its buckets, then against those of buckets that are still divided
    first = members.where("node != low").groupBy("node").agg(F.min("low").alias("low")).select(
        F.col("low").alias("a"), F.col("node").alias("b"))
    links = materialise(verified(likely(first, signs, threshold), texts, threshold), "minhash-links")
    classes = connected_components(links)
    placed = members.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lows = placed.where("node = low").select("bucket", F.col("label").alias("low_label"))
    stars = placed.join(lows, "bucket").where("label != low_label").select(
        F.col("low").alias("a"), F.col("node").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    near = materialise(verified(likely(stars, signs, threshold), texts, threshold), "minhash-links")
    classes = connected_components(_stars(classes).union(near))

    # 2. buckets with nodes of different classes: every node against the one nearest to the bucket's middle
    sizes = profiled.select("node", "n_shingles").distinct()
    placed = materialise(own_shingles(_divided(members, classes), texts, sizes, threshold), "minhash-placed")
    middle = placed.groupBy("bucket").agg(F.min(F.struct("own", "node")).alias("m")).select(
        "bucket", F.col("m.node").alias("middle"))
    placed = materialise(placed.join(middle, "bucket"), "minhash-placed")
    stars = placed.where("node != middle").select(
        F.least("node", "middle").alias("a"), F.greatest("node", "middle").alias("b")).distinct()
    near = likely(_labelled(stars, classes), signs, threshold)
    near = materialise(verified(near, texts, threshold), "minhash-links")
    classes = connected_components(_stars(classes).union(near))

    # 3. pairs around one middle that are still in different classes, that no bound rules out and that have not met yet
    placed = _divided(placed.drop("label"), classes)
    placed = materialise(placed.where("node != low AND node != middle"), "minhash-placed")
    across = alike_differences(placed, texts, threshold)
    more = materialise(verified(likely(across, signs, threshold), texts, threshold), "minhash-links")
    return classes if more.isEmpty() else connected_components(_stars(classes).union(more))


def _stars(classes: DataFrame) -> DataFrame:
    """The classes so far as one edge a node: the links that they come from need not be walked again."""
    return classes.select(F.col("label").alias("a"), F.col("node").alias("b")).where("a != b")


def _divided(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``members`` with their class ``label``, of the buckets that hold more than one class."""
    placed = members.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    divided = placed.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    return placed.join(divided.select("bucket"), "bucket", "left_semi")


def own_shingles(placed: DataFrame, texts: DataFrame, sizes: DataFrame, threshold: int) -> DataFrame:
    """``placed`` with ``n_shingles`` and ``own``, the shingles of a node that no other placed node has.

    They bound a pair's similarity: at most (n - own) shingles are common. A node whose own shingles alone keep it
    below the threshold is left out, it has no link; in a large group of loose copies these are the most.
    """
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()).view(np.int64) for t in batch.column(1)]
            nodes = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(found))], ["node", "shingle"])

    nodes = placed.select("node").distinct()
    items = texts.join(nodes, "node", "left_semi").select("node", "t").mapInArrow(explode, "node long, shingle long")
    single = items.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    own = single.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    counted = nodes.join(sizes, "node").join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    can_link = counted.where(100 * (F.col("n_shingles") - F.col("own")) >= threshold * F.col("n_shingles"))
    return placed.join(can_link, "node")


def differences(around: DataFrame, texts: DataFrame) -> DataFrame:
    """(middle, node, n_differ, shingle) for every row (node, middle): the ``n_differ`` shingles that only one has."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, np.ndarray] = {}
        for batch in batches:
            found = []
            for middle, t, middle_text in zip(batch.column(0).to_pylist(), *batch.columns[2:]):
                if middle not in last:
                    if len(last) >= 64:
                        last.clear()
                    last[middle] = shingles(middle_text.as_py())
                found.append(np.setxor1d(shingles(t.as_py()), last[middle], assume_unique=True).view(np.int64))
            sizes = np.array([len(x) for x in found], np.int64)
            ids = [np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (*ids, np.repeat(sizes, sizes), np.concatenate([np.zeros(0, np.int64), *found]))],
                ["middle", "node", "n_differ", "shingle"])

    both = around.select("node", "middle").join(texts.select("node", "t"), "node").join(
        texts.select(F.col("node").alias("middle"), F.col("t").alias("middle_text")), "middle")
    return both.select("middle", "node", "t", "middle_text").mapInArrow(
        explode, "middle long, node long, n_differ long, shingle long")


def alike_differences(placed: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of ``placed`` (node, middle, label, n_shingles) around one middle and in different classes, without
    those that an exact bound keeps below the threshold.

    D is the set of shingles that only a node or only its middle has. Two sets x and y are linked if and only if
    2 * (100 + t) * |Dx & Dy| >= u(x) + u(y) with u = (100 + t) * |D| - (100 - t) * size. Nodes linked with the middle
    share its class, so pairs in different classes need a common shingle in D, and more the larger u is. With each D
    in one order, rare shingles first, the first common one must come early enough in both to leave the rest room
    (prefix and position filter). Loose copies of one text share most of the text, but little of D.
    """
    whole, gap = 100 + threshold, 100 - threshold
    around = placed.select("node", "middle", "label", "n_shingles").distinct()
    divided = around.groupBy("middle").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    around = materialise(around.join(divided.select("middle"), "middle", "left_semi"), "minhash-around")
    items = differences(around, texts).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("middle", "shingle"))).where("n > 1")
    ordered = items.groupBy("middle", "node", "n_differ").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("shared"))        # those of one node come before
    u, n = F.col("u"), F.col("n_shingles")
    ordered = ordered.join(around, ["middle", "node"]).withColumn("u", whole * F.col("n_differ") - gap * n)
    # common shingles of D that a link needs: with a node of larger u, and with any (its size is at most 100 / t times n)
    least_above = F.greatest(F.lit(1), F.ceil(u / whole))
    least = F.greatest(F.lit(1), F.ceil((threshold * u - 100 * gap * n) / (threshold * whole)))
    room = F.greatest(F.size("shared") - least.cast("int") + 1, F.lit(0))
    early = ordered.select("middle", "node", "label", "u", least_above.alias("least_above"), F.size("shared").alias(
        "n_shared"), F.posexplode(F.slice("shared", F.lit(1), room)).alias("i", "item")).select(
        "middle", F.col("item.shingle").alias("shingle"), "node", "label", "u",
        (F.col("n_shared") - F.col("i")).alias("rest"), "least_above")
    early = materialise(early, "minhash-early")
    other = early.where("rest >= least_above").select(
        "middle", "shingle", *[F.col(c).alias(f"{c}_") for c in ("node", "label", "u", "rest")])
    return early.join(other, ["middle", "shingle"]).where(
        (F.col("label_") != F.col("label")) & (F.struct("u_", "node_") < F.struct("u", "node"))
        & (2 * whole * F.least("rest", "rest_") >= F.col("u") + F.col("u_"))).select(
        F.least("node_", "node").alias("a"), F.greatest("node_", "node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``text_key``, ``n_shingles``, ``component_id`` (the smallest id of its class),
    ``kept`` (the row has that id). ``threshold`` is the similarity in percent at which two sets are linked."""
    prepare(docs.sparkSession)
    profiled = materialise(profiles(docs, threshold, id_col, text_col), "minhash-profiles")
    texts = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("t"))
    classes = node_classes(profiled, texts, threshold)
    rows = profiled.select("k", "text_key", "n_shingles", "node").join(classes, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    smallest = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("k").alias("smallest"))
    found = rows.join(smallest, "label", "left").withColumn(
        "component_id", F.when(F.col("label").isNull(), F.col("k")).otherwise(F.col("smallest")))
    return found.select(F.col("k").alias(id_col), "text_key", "n_shingles", "component_id",
                        F.col("k").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one_of_each(docs: DataFrame, threshold: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their class, all columns as they are; repeated rows of one id and text
    stay once."""
    found = near_duplicates(docs, threshold, id_col, text_col)
    kept = found.where("kept").groupBy(F.col(id_col).alias("id"), F.col("text_key").alias("key")).agg(
        F.count(F.lit(1)).alias("copies"))
    rows = packed(docs, id_col, text_col).withColumn("key", F.xxhash64("k1"))
    rows = rows.join(kept, rows["k0"].eqNullSafe(kept["id"]) & (rows["key"] == kept["key"])).drop("key")
    once = rows.where("copies > 1").dropDuplicates(["k0", "k1"])
    return rows.where("copies = 1").unionByName(once).select("row.*")
