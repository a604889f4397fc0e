"""Language-model scores: marginal likelihood over all subword segmentations, beside an add-one unigram base.

The pieces are those of an existing vocabulary; a piece's weight is its relative frequency when the existing
vocabulary's own scores segment the training words. A word's probability is the sum over all of its segmentations
into pieces (bytes stand for characters without a piece), computed in log space by forward recursion over the
word's lattice. No piece crosses the start of a word, so the lattice of a text is the chain of its words' lattices
and the text's log probability is the sum over its words plus that of the end.

Every distinct word of the corpus is counted and scored once, in a table. The ``FREQUENT`` most frequent words
(a fixed number) are handed to every task; the other words of a text are looked up by a join on the word, which has
no hot keys since the frequent ones are gone.

Defined cases: a NULL, empty or blank text has the end token only; a row with a NULL id belongs to the training
part; without training rows counts are 0 and pieces are equally likely; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import materialise, prepare

FREQUENT = 50_000          # words handed to every task
FLUSH = 300_000            # distinct words a task counts before it sends them on
END = ""                   # the end token in the word table: no word is empty
START = "▁"           # the mark before a word in the vocabulary
MAX_PIECE = 16             # characters of the longest piece
PRIOR = 0.5                # added to each piece's count


def held_out(id_col: Column) -> Column:
    """The rows that take no part in the training: crc32 of the decimal id modulo 7 is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def count_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n, n_train) over every row; the end token is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, other = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = list(train.keys() | other.keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in words], pa.string()),
                 pa.array([train[w] + other[w] for w in words], pa.int64()),
                 pa.array([train[w] for w in words], pa.int64())], ["word", "n", "n_train"])
            train.clear(), other.clear()
            return out

        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1).to_pylist()):
                part = other if held else train
                part.update((text.as_py() or "").encode().lower().split())
                part[b""] += 1
                if len(train) + len(other) > FLUSH:
                    yield flush()
        if train or other:
            yield flush()

    rows = docs.select(F.col(text_col).alias("t"), held_out(F.col(id_col)).alias("h"))
    return rows.mapInArrow(count, "word string, n long, n_train long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


class Lattice:
    """Forward recursion over all segmentations of a word into weighted pieces."""

    def __init__(self, weights: dict[str, float], byte_weights: list[float]):
        self.weights, self.bytes = weights, byte_weights

    def log_probability(self, word: str) -> float:
        """Natural log of the sum over segmentations of the marked word."""
        s = START + word
        get, exp, log1p = self.weights.get, math.exp, math.log1p
        ahead = [0.0]
        for j in range(1, len(s) + 1):
            total = ahead[j - 1] + sum(self.bytes[b] for b in s[j - 1].encode())
            for i in range(max(0, j - MAX_PIECE), j):
                if (w := get(s[i:j])) is not None:
                    x = ahead[i] + w
                    if x > total:
                        x, total = total, x
                    total += log1p(exp(x - total))
            ahead.append(total)
        return ahead[-1]


def piece_counts(words: DataFrame, vocabulary: str) -> dict[int, int]:
    """How often each piece occurs when the vocabulary's own scores segment the training words; at most one row per
    piece of the vocabulary comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor
        pieces = SentencePieceProcessor(model_file=vocabulary)
        total = np.zeros(pieces.get_piece_size(), np.int64)
        for batch in batches:
            texts, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            ids = pieces.encode(texts, num_threads=1)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for x in ids for i in x), np.int64, int(lengths.sum()))
            np.add.at(total, flat, np.repeat(n, lengths))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

    rows = words.where((F.col("n_train") > 0) & (F.col("word") != END)).select("word", "n_train").mapInArrow(
        count, "piece long, n long")
    return {r.piece: r.n for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def fit_lattice(words: DataFrame, vocabulary: str, ends: int) -> tuple[Lattice, float]:
    """The lattice and the log probability of the end, from the training counts of ``words``."""
    from sentencepiece import SentencePieceProcessor
    pieces = SentencePieceProcessor(model_file=vocabulary)
    counts = piece_counts(words, vocabulary)
    usable = [i for i in range(pieces.get_piece_size()) if not (
        pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i))]
    total = sum(counts.get(i, 0) + PRIOR for i in usable) + ends + PRIOR
    weight = {i: math.log((counts.get(i, 0) + PRIOR) / total) for i in usable}
    bytes_ = [weight[pieces.piece_to_id(f"<0x{b:02X}>")] for b in range(256)]
    plain = {pieces.id_to_piece(i): w for i, w in weight.items() if not pieces.is_byte(i)}
    return Lattice(plain, bytes_), math.log((ends + PRIOR) / total)


def score_words(words: DataFrame, lattice: Lattice) -> DataFrame:
    """(word, n, c, score): the training count and the log10 probability of each distinct word."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lattice.log_probability(w) / math.log(10) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())],
                                             ["word", "n", "c", "score"])

    return words.where(F.col("word") != END).select("word", "n", F.col("n_train").alias("c")).mapInArrow(
        score, "word string, n long, c long, score double")


PARTIAL = "row long, n_words long, known long, log_c double, score double, rare array<string>, rare_n array<int>"


def score_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = prepare(docs.sparkSession)
    words = materialise(count_words(docs, id_col, text_col), "lm-words")
    figures = words.agg(F.sum("n_train"), F.sum((F.col("n_train") > 0).cast("long")),
                        F.sum(F.when(F.col("word") == END, F.col("n_train")))).first()
    n_train, n_types, ends = (int(x or 0) for x in figures)
    lattice, end_score = fit_lattice(words, vocabulary, ends)
    end_score /= math.log(10)
    scored = materialise(score_words(words, lattice), "lm-scores")
    top = scored.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = spark.sparkContext.broadcast({r.word.encode(): (r.c, math.log10(r.c + 1), r.score) for r in top})
    least = (top[-1].n, top[-1].word) if len(top) == FREQUENT else (0, "")
    kind = dict(docs.dtypes)[id_col]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, row = frequent.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for text in batch.column(1):
                known, log_c, score, rare = 0, 0.0, 0.0, []
                found = Counter((text.as_py() or "").encode().lower().split())
                for word, n in found.items():
                    if hit := table.get(word):
                        known += n * (hit[0] > 0)
                        log_c += n * hit[1]
                        score += n * hit[2]
                    else:
                        rare.append((word.decode(), n))
                out.append((row, found.total(), known, log_c, score, [w for w, _ in rare], [n for _, n in rare]))
                row += 1
            kinds = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.list_(pa.string()), pa.list_(pa.int32())]
            names = ["row", "n_words", "known", "log_c", "score", "rare", "rare_n"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]], ["k", *names])

    rows = materialise(docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(
        partial, f"k {kind}, {PARTIAL}"), "lm-documents")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("times"))
    seldom = scored.where((F.col("n") < least[0]) | ((F.col("n") == least[0]) & (F.col("word") > least[1])))
    looked_up = rare.join(seldom.select("word", "c", F.col("score").alias("s")), "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_rare"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("log_c_rare"),
        F.sum(F.col("times") * F.col("s")).alias("score_rare"))
    zero = F.lit(0.0)
    n_tokens = F.col("n_words") + 1
    return rows.drop("rare", "rare_n").join(looked_up, "row", "left").select(
        F.col("k").alias(id_col), held_out(F.col("k")).alias("held_out"), n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("known_rare", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("log_c") + F.coalesce("log_c_rare", zero) + math.log10(ends + 1)
         - n_tokens * math.log10(n_train + n_types + 1)).alias("base_score"),
        (F.col("score") + F.coalesce("score_rare", zero) + end_score).alias("score"))
