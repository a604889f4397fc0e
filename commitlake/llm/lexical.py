"""Ranked lexical search: accumulator-limited term-at-a-time scoring of documents for a table of queries.

Terms are runs of digits, Latin letters and everything beyond ASCII, with only A-Z lower-cased. The score of a document
is a sum of whole numbers over the query's distinct terms, w * ((10^9 tf) div (1000 tf + 20 m)), with w from the term's
document frequency and m from the document's length.

1. Forward index. One pass over the texts keeps, for each document, its length and the (term, tf) pairs of terms that
   some query holds; all other words only count towards the length. Document frequencies, the number of documents and
   their total length are aggregates over it.
2. Term-at-a-time. Documents stay where they are: a task takes its documents in blocks of ``BLOCK`` and, for each query,
   its terms from the rarest on. A term's postings give new documents an accumulator only as long as the sum of the
   bounds of this and the remaining terms reaches the kth score so far (of the task's earlier blocks, or of this block's
   partial scores); from then on no document without an accumulator can enter the first k, and the remaining terms only
   update the accumulators there are, exactly. A term's bound is its greatest contribution in the block. Ties with the
   kth score still get one, so equal scores are ranked by id without loss.
3. The tasks' first k of each query meet in one window by query; a task sends at most k rows a query.

No text is shuffled and no posting list is sent to one task, so a term in every document or a document repeated a
million times costs each task its own share. Queries are taken in blocks of at most ``QUERY_BYTES`` of text, which
bounds what a task holds of them; each block is one pass.

Defined cases: a NULL text, or one without terms, is no document (it is not counted); a NULL or termless query has no
rows; repeated documents are ranked one by one; NULL ids come first among equal scores; repeated queries each have their
rows; an empty table has no rows; other columns are not looked at. Ids are cast to long.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlake.llm.common import materialise, prepare

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
A_TO_Z = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
TOP = 50
BLOCK = 16_384             # documents of a block
QUERY_BYTES = 8 << 20      # text of the queries of one pass

FORWARD = "k long, n long, terms array<int>, tfs array<long>"
HITS = "query int, score long, k long"


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, in order, with repeats."""
    return TERM.findall((text or "").translate(A_TO_Z) if text and not text.isascii() else (text or "").lower())


def forward_index(docs: DataFrame, vocabulary: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """(k, n, terms, tfs) of each document with terms: its length, and the numbers and counts of the query terms in it."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lengths, terms, tfs, ends = [], [], [], [], [0]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms_of(text.as_py())
                if found:
                    held = Counter(filter(vocabulary.__contains__, found))
                    keys.append(key), lengths.append(len(found))
                    terms += map(vocabulary.__getitem__, held)
                    tfs += held.values()
                    ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], ["k", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t")).mapInArrow(index, FORWARD)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The first ``top`` hits of one query, by score, then by key (NULL keys first)."""

    def __init__(self, top: int):
        self.top, self.scores, self.keys, self.known = top, *(np.zeros(0, np.int64) for _ in range(2)), np.zeros(0, bool)

    def least(self) -> int:
        """The score that a document must reach to enter; 1 while there is room."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, keys: np.ndarray, known: np.ndarray) -> None:
        scores, keys, known = (np.concatenate(x) for x in ((self.scores, scores), (self.keys, keys), (self.known, known)))
        order = np.lexsort((keys, known, -scores))[:self.top]
        self.scores, self.keys, self.known = scores[order], keys[order], known[order]


def score_block(postings: dict[int, tuple[np.ndarray, np.ndarray]], bounds: dict[int, int], terms: list[int], n_docs: int,
                least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the documents of a block that may be among the first ``top``; ``terms`` from the rarest on,
    ``postings`` has each term's places and contributions, ``least`` is a score that ``top`` documents are known to reach."""
    terms = [t for t in terms if t in postings]
    rest = sum(bounds[t] for t in terms)               # no document without an accumulator can get more
    total, held = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    creating, kth = True, least
    for t in terms:
        places, gains = postings[t]
        if creating and rest < kth:
            creating = False
        if creating:
            held[places] = True
            total[places] += gains
            partial = total[held]
            if len(partial) >= top:
                kth = max(kth, int(np.partition(partial, len(partial) - top)[len(partial) - top]))
        else:
            own = held[places]
            total[places[own]] += gains[own]
        rest -= bounds[t]
    found = np.flatnonzero(held & (total >= kth))
    return found, total[found]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= BLOCK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def best_of_tasks(forward: DataFrame, queries: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int,
                  top: int) -> DataFrame:
    """(query, score, k): each task's first ``top`` documents of each query (lists of term numbers, rarest first)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in queries]
        for block in _blocks(batches):
            keys = block["k"].combine_chunks()
            known = ~np.asarray(keys.is_null())
            keys = np.asarray(keys.fill_null(0))
            lists = block["terms"].combine_chunks()
            lengths = np.asarray(lists.value_lengths())
            term, tf = np.asarray(lists.flatten()).astype(np.int64), np.asarray(block["tfs"].combine_chunks().flatten())
            m = 50 + (50 * np.asarray(block["n"]).astype(np.int64) * n_docs) // n_terms
            place = np.repeat(np.arange(len(lengths)), lengths)
            gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[place]))
            order = np.argsort(term, kind="stable")
            term, place, gain = term[order], place[order], gain[order]
            starts = np.flatnonzero(np.diff(term, prepend=-1))
            postings, bounds = {}, {}
            for a, b in zip(starts, [*starts[1:], len(term)]):
                t = int(term[a])
                postings[t] = place[a:b], gain[a:b]
                bounds[t] = int(gain[a:b].max())
            for q, terms in enumerate(queries):
                found, scores = score_block(postings, bounds, terms, len(lengths), best[q].least(), top)
                if len(found):
                    best[q].add(scores, keys[found], known[found])
        for q, b in enumerate(best):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(b.scores), q, np.int32)), pa.array(b.scores),
                    pa.array(b.keys, mask=~b.known)], ["query", "score", "k"])

    return forward.select("k", "n", "terms", "tfs").mapInArrow(search, HITS)


def _query_blocks(queries: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, list[str]]]]:
    """The queries with their distinct terms, in blocks of bounded size."""
    block, size = [], 0
    for item, text in queries.select(item_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        block.append((item, sorted(set(terms_of(text)))))
        size += len(text)
        if size >= QUERY_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search_documents(docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                     item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """(item, rank, id, score): the ``top`` highest-scoring documents of each query, scores above 0 only."""
    spark = prepare(docs.sparkSession)
    item_type = queries.schema[item_col].dataType.simpleString()
    found = spark.createDataFrame([], f"{item_col} {item_type}, rank int, {id_col} long, score long")
    for block in _query_blocks(queries, item_col, query_col):
        words = sorted({t for _, terms in block for t in terms})
        forward = materialise(forward_index(docs, {t: i for i, t in enumerate(words)}, id_col, text_col), "search-forward")
        n_docs, n_terms = forward.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs or not words:
            continue
        df = np.zeros(len(words), np.int64)                            # one row per query term of this block
        for t, n in forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
            df[t] = n
        weights = np.array([weight(n_docs, int(n)) for n in df], np.int64)
        number = {t: i for i, t in enumerate(words)}
        lists = [sorted((number[t] for t in terms if weights[number[t]] > 0), key=lambda t: (df[t], t)) for _, terms in block]
        hits = best_of_tasks(forward, lists, weights, n_docs, n_terms, top)
        first = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("k").asc_nulls_first())
        ranked = hits.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
        items = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], f"query int, {item_col} {item_type}")
        found = found.union(ranked.join(items, "query").select(item_col, "rank", F.col("k").alias(id_col), "score"))
    return found
