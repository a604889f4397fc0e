import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from commitlake.llm import quality


def brute_features(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(inside))


def brute_buckets(text):
    data = (text or "").encode()
    return [(int.from_bytes(data[i:i + 4], "little") * 2654435761 % 2 ** 32) >> 18 for i in range(len(data) - 3)]


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_verdicts_by_brute_force(request, spark, name):
    docs = request.getfixturevalue(name)
    labels = spark.createDataFrame([(1, 1), (3, 1), (8, 0), (None, 1), (25, 1), (26, None)], "doc_id long, quality int")
    weights = quality.fit_weights(docs, quality.trusted_ids(labels))
    corpus, trusted = np.zeros(1 << 14), np.zeros(1 << 14)
    rows = docs.select("doc_id", "text").collect()
    for r in rows:
        for b in brute_buckets(r.text):
            corpus[b] += 1
            trusted[b] += r.doc_id in (1, 3, 25)
    if rows:
        p = (corpus + 1) / (corpus.sum() + (1 << 14))
        want = np.round(1e6 * np.log((trusted / trusted.sum() + 0.1 * p) / (1.1 * p))).astype(int)
        assert np.array_equal(weights, want)
    got = Counter(map(tuple, quality.quality_verdicts(docs, weights).drop("llr", "n_grams").collect()))
    want = Counter()
    for r in rows:
        f, grams = brute_features(r.text), brute_buckets(r.text)
        failed = f[0] < 50 or 100 * f[4] > 50 * f[0]
        want[(r.doc_id, *f, failed, not failed and int(weights[grams].sum()) >= -300_000 * len(grams))] += 1
    assert got == want


def test_keep_good_keeps_whole_rows(edge, clashing):
    weights = np.zeros(1 << quality.BITS, np.int64)
    kept = quality.keep_good(clashing, weights)
    assert kept.schema == clashing.schema
    verdicts = quality.quality_verdicts(edge, weights)
    assert kept.count() == verdicts.where("kept").count() > 0


def test_pair_numbering_for_many_distinct_words():
    words = [str(i).encode() for i in range((1 << 21) + 5)] + [b"a", b"b", b"c", b"a", b"b", b"c"]
    assert quality.repeated_words(words) == 6


def test_trusted_ids_are_bounded_and_steady(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")).repartition(7)
    first = {r[0] for r in quality.trusted_ids(labels, limit=100).collect()}
    assert len(first) == 100 and first == {r[0] for r in quality.trusted_ids(labels.repartition(3), limit=100).collect()}


def test_symbol_spam_is_rejected(spark):
    import random
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(200)]
    clean = [" ".join(rng.choice(vocabulary) for _ in range(120)) for _ in range(60)]
    spam = [" ".join(rng.choice(vocabulary) + rng.choice(["$$$", "###", "%%%"]) for _ in range(120)) for _ in range(10)]
    docs = spark.createDataFrame(list(enumerate(clean + spam)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality.quality_verdicts(
        docs, quality.fit_weights(docs, quality.trusted_ids(labels))).collect()}
    assert all(kept[i] for i in range(60)) and not any(kept[i] for i in range(60, 70))
