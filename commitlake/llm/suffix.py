"""Exact substring dedup with distributed suffix sorting: every byte of a ``LENGTH``-byte string that starts anywhere
else too is found, over all texts, same text included.

1. Anchors. Of the hashes of ``GRAM``-byte substrings the minimum of each window of ``WINDOW`` is chosen. A window and
   its substrings span exactly ``LENGTH`` bytes, so a repeated string holds an anchor at the same place in each of its
   occurrences; suffixes that start at anchors are enough, about one in a hundred. Anchors whose ``GRAM`` bytes occur
   once in the corpus (counted with map-side combine) cannot lie in a repeated string and are dropped.
2. Suffixes. An anchor's suffix is cut at ``LENGTH`` bytes and carries the bytes before it, reversed. Equal suffixes
   are combined before the sort, so a passage in a third of all texts is one row.
3. Sort. Splitters sampled from the suffixes range-partition them by their leading bytes: by the first ``GRAM`` bytes,
   and by all of them where more than ``HOT`` suffixes start alike. Each bucket is sorted locally by multikey quicksort on 8-byte words (only ties look at the next word), which also yields the common prefix lengths
   of neighbours, once for the suffixes and once for the reversed bytes before them. A string that starts d bytes
   before an anchor is repeated if two rows share LENGTH - d bytes of suffix and d bytes before it.
4. Borders. Only such hot groups can reach over a bucket's border: for their suffixes that equal the bucket's first or
   last one up to LENGTH - d bytes, a hash of the string is handed on and counted across buckets.

Equal texts are one text here; a text that occurs twice repeats as a whole. Texts are known by a 64-bit hash.

``passage_words`` also counts the places of a document where so many words start that another document holds too, white
space aside; such a passage may be shorter than ``LENGTH`` bytes, and nothing is removed for it. Anchors again: every
sequence of ``passage_words`` words has a mark, the least hash of its shorter word sequences. Whole sequences are hashed
and counted only where another text has the mark.

Defined cases: a NULL text counts as empty; texts of fewer than ``LENGTH`` bytes keep everything; repeated rows repeat
each other; NULL ids are kept; an empty table has no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlake.llm.common import SPACE, WORD, materialise, prepare

LENGTH = 400
GRAM = 200
WINDOW = LENGTH - GRAM + 1
HOT = 5000                 # suffixes with the same first bytes that need not share a bucket
PART = 1 << 20             # bytes of a text that are hashed at a time
_PLACE = np.uint64(PART - 1)
_SPACE = re.compile(f"[{SPACE}]".encode())

_BASE = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(PART + 1, _BASE, np.uint64))
    _INVERSE = np.cumprod(np.full(PART + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64))


def _window_minima(values: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """The minimum of every ``size`` consecutive values, from running minima inside blocks of that size."""
    n = len(values)
    blocks = np.full((-(-n // size), size), np.iinfo(np.uint64).max, np.uint64)
    blocks.reshape(-1)[:n] = values
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - size + 1], ahead[size - 1:n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes of the ``GRAM`` bytes there) of a text's anchors; the rightmost of equal minima is taken."""
    places, marks = [], []
    for start in range(0, max(1, len(data) - LENGTH + 1), PART - LENGTH):
        part = np.frombuffer(data, np.uint8, min(len(data) - start, PART), start) if len(data) >= LENGTH else b""
        n = len(part) - GRAM + 1
        if len(part) < LENGTH:
            continue
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _POWER[:len(part)], out=sums[1:])
        h = (sums[GRAM:] - sums[:n]) * _INVERSE[:n]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        found = np.unique(_PLACE - (_window_minima((h & ~_PLACE) | (_PLACE - np.arange(n, dtype=np.uint64))) & _PLACE))
        places.append(found.astype(np.int64) + start)
        marks.append(h[found.astype(np.int64)].view(np.int64))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    all_places, first = np.unique(np.concatenate(places), return_index=True)
    return all_places, np.concatenate(marks)[first]


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word of a text, in order."""
    parts, start = [np.zeros(0, np.uint64)], 0
    while start < len(data):
        cut = _SPACE.search(data, start + PART)
        end = cut.start() if cut else len(data)
        words = data[start:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        start = end
    return np.concatenate(parts)


def sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words, from the words' hashes."""
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h *= _BASE
        h += words[k:k + n]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def passage_marks(words: np.ndarray, size: int) -> np.ndarray:
    """The mark of every ``size`` consecutive words."""
    part = size // 5 + 1
    if len(words) < size:
        return np.zeros(0, np.int64)
    return _window_minima(sequence_hashes(words, part), size - part + 1).view(np.int64)


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix length of each row with the one before it in that order) of fixed-width byte rows."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order, shared = np.arange(n), np.zeros(n, np.int64)
    tied = np.ones(n, bool)                   # equal so far to the row before it
    tied[:1] = False
    for depth in range(words.shape[1]):
        more = np.flatnonzero(tied | np.append(tied[1:], False))
        if not len(more):
            break
        group = np.cumsum(~tied)[more]
        own = order[more]
        order[more] = own[np.lexsort((words[own, depth], group))]
        at = np.flatnonzero(tied)
        differ = words[order[at], depth] ^ words[order[at - 1], depth]
        for byte in range(8):
            shared[at] += (differ >> np.uint64(56 - 8 * byte)) == 0
        tied[at] = differ == 0
    return order, np.minimum(shared, width)


def _hash(data: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(data)
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def suffix_hash(left: bytes, right: bytes) -> tuple[int, int]:
    return _hash(len(left).to_bytes(2, "little") + left + right)


BUCKET = "s1 long, s2 long, low int, high int, w1 long, w2 long, d int"


def sort_bucket(lefts: list[bytes], rights: list[bytes], counts: np.ndarray, hot: np.ndarray) -> list[tuple]:
    """Rows of ``BUCKET`` for one bucket of distinct suffixes: the least and greatest d at which a string that starts
    d bytes before the anchor is repeated, and the strings that may go on in another bucket (w1, w2, d; with s1 where
    the bucket itself has no second one)."""
    n = len(rights)

    def matrix(parts: list[bytes], width: int) -> np.ndarray:
        return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(n, width)

    r_len, l_len = np.fromiter(map(len, rights), np.int64, n), np.fromiter(map(len, lefts), np.int64, n)
    r_order, r_same = multikey_sort(matrix(rights, LENGTH))
    l_order, l_same = multikey_sort(matrix(lefts, WINDOW - 1))
    low, high = np.full(n, LENGTH), np.full(n, -1)
    whole_low, whole_high = np.maximum(0, LENGTH - r_len), np.minimum(WINDOW - 1, l_len)
    whole = (counts > 1) & (whole_low <= whole_high)
    low[whole], high[whole] = whole_low[whole], whole_high[whole]
    r_class, l_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    out = []
    for d in range(WINDOW):
        h = LENGTH - d
        r_class[r_order] = np.cumsum(r_same < h)
        l_class[l_order] = np.cumsum(l_same < d)
        at_border = hot & ((r_class == r_class[r_order[0]]) | (r_class == r_class[r_order[-1]]))
        sizes = np.bincount(r_class)
        own = np.flatnonzero((r_len >= h) & (l_len >= d) & ((sizes[r_class] > 1) | at_border))
        if not len(own):
            continue
        _, first, inverse, times = np.unique(r_class[own] * (n + 1) + l_class[own], return_index=True,
                                             return_inverse=True, return_counts=True)
        hit = own[times[inverse] > 1]
        low[hit], high[hit] = np.minimum(low[hit], d), np.maximum(high[hit], d)
        for k, alone in zip(own[first], times == 1):
            if at_border[k]:
                left, right = lefts[k], rights[k]
                s = suffix_hash(left, right) if alone else (None, None)
                out.append((*s, None, None, *_hash(left[:d][::-1] + right[:h]), d))
    for k in np.flatnonzero(high >= 0):
        out.append((*suffix_hash(lefts[k], rights[k]), int(low[k]), int(high[k]), None, None, None))
    return out


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
             "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      [name for name, _ in fields])


def _met_elsewhere(rows: DataFrame, by: str) -> DataFrame:
    """The rows whose value of ``by`` stands in rows of another text_key too."""
    same = Window.partitionBy(by)
    ends = {"a": F.min("text_key").over(same), "b": F.max("text_key").over(same)}
    return rows.withColumns(ends).where("a < b").drop("a", "b")


def shared_marks(texts: DataFrame, size: int) -> DataFrame:
    """(text_key, marks): marks of ``size`` words that another text of (text_key, t) has as well."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [np.unique(passage_marks(word_hashes(t.as_py().encode()), size)) for t in batch.column(1)]
            if marks:
                keys = np.repeat(batch.column(0).to_numpy(), [len(m) for m in marks])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(marks)), pa.array(keys)], ["mark", "text_key"])

    met = _met_elsewhere(texts.mapInArrow(find, "mark long, text_key long"), "mark")
    return met.groupBy("text_key").agg(F.collect_set("mark").alias("marks"))


def count_passages(marked: DataFrame, size: int) -> DataFrame:
    """(text_key, n_passages) from (text_key, t, marks) of distinct texts: places where ``size`` words start that another
    text holds too; texts without any are left out."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, marks in zip(*batch.columns):
                words = word_hashes(text.as_py().encode())
                kept = np.isin(passage_marks(words, size), marks.values.to_numpy())
                found, n = np.unique(sequence_hashes(words, size)[kept].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), key.as_py(), np.int64)),
                                                  pa.array(n)], ["passage", "text_key", "n"])

    rows = marked.where("marks IS NOT NULL").select("text_key", "t", "marks")
    met = _met_elsewhere(rows.mapInArrow(find, "passage long, text_key long, n long"), "passage")
    return met.groupBy("text_key").agg(F.sum("n").alias("n_passages"))


def find_repeats(texts: DataFrame, passage_words: int | None = None) -> tuple[DataFrame, DataFrame]:
    """From (text_key, t), a row per text or copy of it: (text_key, start, end) of the repeated ranges of distinct texts
    (ranges of one text may overlap), and (text_key, t, places) of the texts that have anchors in question, with
    ``passage_words`` also those with marks in question (text_key, t, places, marks; either may be NULL)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, marks = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                at, mark = anchors(text.as_py().encode())
                keys.append(np.full(len(at), key, np.int64)), places.append(at), marks.append(mark)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (marks, keys, places)],
                                                 ["mark", "text_key", "place"])

    found = materialise(texts.mapInArrow(find, "mark long, text_key long, place long"), "suffix-anchors")
    occurrence = F.xxhash64("text_key", "place")
    repeated = found.groupBy("mark").agg(F.min(occurrence).alias("a"), F.max(occurrence).alias("b"),
                                           (F.count(F.lit(1)) > HOT).alias("hot")).where("a < b")
    kept = found.join(repeated.select("mark", "hot"), "mark").groupBy("text_key").agg(
        F.collect_set(F.struct("place", "hot")).alias("places"))
    if passage_words:
        kept = kept.join(shared_marks(texts, passage_words), "text_key", "full")
    one_text = texts.groupBy("text_key").agg(F.any_value("t").alias("t"))
    marked = materialise(one_text.join(kept, "text_key"), "suffix-texts")

    def cut(narrow: bool):
        def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for key, text, places in zip(*(c for c in batch.columns)):
                    data, rows = text.as_py().encode(), []
                    for p, hot in map(dict.values, places.as_py()):
                        left, right = data[max(0, p - WINDOW + 1):p][::-1], data[p:p + LENGTH]
                        rows.append((*suffix_hash(left, right), key.as_py(), p) if narrow else (right, left, hot))
                    yield _arrow(rows, NARROW if narrow else WIDE)
        return suffixes

    cuts = marked.where("places IS NOT NULL").select("text_key", "t", "places")
    suffixes = cuts.mapInArrow(cut(False), WIDE).groupBy("right", "left", "hot").agg(F.count(F.lit(1)).alias("n"))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rights, lefts, hot, counts = columns = [], [], [], []
        for batch in batches:
            for column, values in zip(columns, batch.columns):
                column += values.to_pylist()
        if rights:
            yield _arrow(sort_bucket(lefts, rights, np.array(counts), np.array(hot)), BUCKET)

    rest = F.when(F.col("hot"), F.struct("right", "left"))
    sorted_ = materialise(suffixes.repartitionByRange(F.substring("right", 1, GRAM), rest).mapInArrow(sort, BUCKET),
                          "suffix-sorted")
    at_border = sorted_.where("d IS NOT NULL")
    across = at_border.groupBy("w1", "w2", "d").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = at_border.where("s1 IS NOT NULL").join(across, ["w1", "w2", "d"], "left_semi").select(
        "s1", "s2", F.col("d").alias("low"), F.col("d").alias("high"))
    reach = sorted_.where("d IS NULL").select("s1", "s2", "low", "high").union(met).groupBy("s1", "s2").agg(
        F.min("low").alias("low"), F.max("high").alias("high"))
    ranges = cuts.mapInArrow(cut(True), NARROW).join(reach, ["s1", "s2"]).select(
        "text_key", (F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + LENGTH).alias("end"))
    return ranges, marked


NARROW = "s1 long, s2 long, text_key long, place long"
WIDE = "right binary, left binary, hot boolean"


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted maximal runs of possibly overlapping or touching ranges."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(e for _, e in runs)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(s for s, _ in runs), len(data)]))


REMOVED = "text_key long, n_removed long, n_spans long, kept_sha256 string"


def dedup_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                passage_words: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes that are left; with
    ``passage_words`` also n_passages, the places where so many words start that another row holds too."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    n_words = [F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words")] if passage_words else []
    least = min(LENGTH, 2 * passage_words - 1) if passage_words else LENGTH
    rows = materialise(docs.select(F.col(id_col).alias("k"), F.xxhash64(text).alias("text_key"), F.octet_length(text).cast(
        "long").alias("n_bytes"), F.sha2(text, 256).alias("sha"), *n_words), "suffix-rows")
    texts = docs.select(F.xxhash64(text).alias("text_key"), text.alias("t")).where(F.octet_length("t") >= least)
    ranges, marked = find_repeats(texts, passage_words)
    spans = ranges.groupBy("text_key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, content, found in zip(*batch.columns):
                data, runs = content.as_py().encode(), merged([(x["start"], x["end"]) for x in found.as_py()])
                left = without(data, runs)
                out.append((key.as_py(), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest()))
            yield _arrow(out, REMOVED)

    removed = marked.join(spans, "text_key").select("text_key", "t", "ranges").mapInArrow(remove, REMOVED)
    copied = rows.where(F.col("n_bytes") >= least).groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    copied = copied.where("copies > 1")
    found = rows.join(removed, "text_key", "left").join(copied, "text_key", "left")
    whole = F.col("copies").isNotNull() & (F.col("n_bytes") >= LENGTH)
    n_passages = []
    if passage_words:
        found = found.join(count_passages(marked, passage_words), "text_key", "left")
        n_passages = [F.when(F.col("copies").isNotNull(), F.greatest(F.col("n_words") - (passage_words - 1), F.lit(0)))
                      .otherwise(F.coalesce("n_passages", F.lit(0))).alias("n_passages")]
    return found.select(
        F.col("k").alias(id_col), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        *n_passages)
