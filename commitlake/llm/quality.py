"""Quality rules: counting rules and a hashed n-gram log-likelihood ratio, one verdict for every document.

Two multinomials over hashed byte n-grams are compared: one of trusted documents (a bounded, deterministic
choice of labelled rows, the operator's only sample) and one of the whole corpus. A document's score is the
mean over its n-grams of ``ln(p_trusted / p_corpus)``; below ``min_llr`` it is rejected. Weights are kept as
whole micro-nats, so a sum does not depend on the order of rows and the verdict is the same in every run.

Defined cases: a NULL or blank text has no words and fails the base rule; a text of fewer than ``NGRAM`` bytes
scores 0; without trusted documents every weight is 0 and only the base rule decides; repeated rows get the
same verdict each; NULL ids are kept as they are; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import prepare

NGRAM = 4                  # bytes of an n-gram
BITS = 14                  # 2^BITS hash buckets: the bound of the model and of what the driver holds
MULTIPLIER = 2654435761    # multiplicative (Knuth) hash
BLEND = 0.1                # share of the corpus multinomial mixed into the trusted one: bounds the weights below
MIN_LLR = -0.3             # nats per n-gram
MAX_TRUSTED = 50_000       # trusted rows used for the fit
MICRO = 1_000_000

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def ngram_buckets(data: bytes) -> np.ndarray:
    """Hash bucket of each byte n-gram of ``data``."""
    n = len(data) - NGRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    a = np.frombuffer(data, np.uint8)
    gram = np.zeros(n, np.uint32)
    for i in range(NGRAM):
        gram |= a[i:i + n].astype(np.uint32) << np.uint32(8 * i)
    return (gram * np.uint32(MULTIPLIER)) >> np.uint32(32 - BITS)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs at least twice among ``words``."""
    n = len(words) - 2
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    if len(seen) == len(words):
        return 0
    if len(seen) < 1 << 21:
        window = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:                                  # too many distinct words for one 63-bit key: number the pairs first
        _, pair = np.unique((ids[:-1] << 32) | ids[1:], return_inverse=True)
        window = (pair[:-1].astype(np.int64) << 32) | ids[2:]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[hit + k] = True
    return int(covered.sum())


def text_features(text: str | None) -> tuple[int, int, int, int, int]:
    """The counting rules' figures for one text, in the order of ``FEATURES``."""
    data = (text or "").encode()
    words = data.split()                   # bytes split at exactly the ASCII white space of the word pattern
    lines = [x for x in data.split(b"\n") if x.strip(WHITE)]
    return (len(words), len(text or "") - (len(data) - len(data.translate(None, WHITE))),
            len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                limit: int = MAX_TRUSTED) -> DataFrame:
    """At most ``limit`` ids of rows labelled 1, the same ones in every run (lowest hash first)."""
    ids = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("trusted_id")).dropna().distinct()
    return ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(limit)


def fit_weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Whole micro-nats of ``ln(p_trusted / p_corpus)`` per bucket, counted over every row of ``docs``.

    One scan; each task sends at most 2^BITS counts, and the driver receives 2^BITS rows whatever the input.
    """
    prepare(docs.sparkSession)
    marked = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(
        F.broadcast(trusted.withColumn("is_trusted", F.lit(True))), F.col("k") == F.col("trusted_id"), "left"
    ).select("t", F.coalesce("is_trusted", F.lit(False)).alias("is_trusted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, chosen = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = np.bincount(ngram_buckets((text or "").encode()), minlength=1 << BITS)
                corpus += n
                if good:
                    chosen += n
        used = np.flatnonzero(corpus)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(corpus[used]),
                                          pa.array(chosen[used])], ["bucket", "n_corpus", "n_trusted"])

    rows = marked.mapInArrow(count, "bucket int, n_corpus long, n_trusted long").groupBy("bucket").agg(
        F.sum("n_corpus").alias("n_corpus"), F.sum("n_trusted").alias("n_trusted")).collect()
    corpus, chosen = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for bucket, n_corpus, n_trusted in rows:
        corpus[bucket], chosen[bucket] = n_corpus, n_trusted
    if not chosen.sum():
        return np.zeros(1 << BITS, np.int64)
    p = (corpus + 1) / (corpus.sum() + len(corpus))
    ratio = (chosen / chosen.sum() + BLEND * p) / ((1 + BLEND) * p)
    return np.round(MICRO * np.log(ratio)).astype(np.int64)


def judge(text: str | None, weights: np.ndarray, min_llr: float = MIN_LLR) -> tuple:
    """Features, n-gram count, score and verdict of one text."""
    f = text_features(text)
    grams = ngram_buckets((text or "").encode())
    total = int(weights[grams].sum())
    failed = f[0] < 50 or 100 * f[4] > 50 * f[0]
    kept = not failed and total >= min_llr * MICRO * len(grams)
    return (*f, len(grams), total / MICRO / max(1, len(grams)), failed, kept)


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
          "n_grams long, llr double, base_failed boolean, kept boolean"


def quality_verdicts(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                     min_llr: float = MIN_LLR) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the features, score and verdict. No shuffle."""
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t, weights, min_llr) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows)) if rows else [()] * 9
            kinds = [pa.int64()] * 6 + [pa.float64(), pa.bool_(), pa.bool_()]
            names = [f.split()[0] for f in VERDICT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["k", *names])

    out = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(
        score, f"k {kind}, {VERDICT}")
    return out.withColumnRenamed("k", id_col)


def keep_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text", min_llr: float = MIN_LLR) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they are."""
    prepare(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([judge(t, weights, min_llr)[-1] for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
