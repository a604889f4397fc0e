import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from commitlake.llm import lexical

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, queries, top=50):
    counted = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in queries:
        scored = []
        for d, c, length in counted:
            m = 100 - 50 + (50 * length * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, d is not None, d or 0))
        out += [(item, r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:top], 1)]
    return out


def key(rows):
    return sorted(((r[0] is None, r[0] or 0), r[1], (r[2] is not None, r[2] or 0), r[3]) for r in map(tuple, rows))


def corpus(n=1500):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)] + ["Été", "ÉTÉ", "中文", "İx", "ẞ", "x9", "ſ", "K"]
    pick = lambda k: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=k))
    docs = [(i, pick(rng.choice([0, 1, 5, 30, 200]))) for i in range(n)]
    docs += [(2000 + i, "w250 same copy W1") for i in range(200)] + [(None, "w250 w3"), (None, "w250 w3"), (5, "w250"), (7000, None)]
    queries = [(i, pick(rng.randrange(1, 30))) for i in range(25)] + [(90, None), (91, ""), (92, "nowhere"), (93, "w250 w250 W250"),
                                                                   (None, "w250"), (94, "w0"), (94, "w0 w250")]
    return docs, queries


@pytest.mark.parametrize("block", [64, 16384])
def test_ranks_equal_brute_force(spark, monkeypatch, block):
    docs, queries = corpus()
    monkeypatch.setattr(lexical, "BLOCK", block)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = lexical.search_documents(frame, spark.createDataFrame(queries, "item_id long, text string"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert key(found.collect()) == key(brute(docs, queries))


def test_queries_in_blocks(spark, monkeypatch):
    docs, queries = corpus(300)
    monkeypatch.setattr(lexical, "QUERY_BYTES", 200)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    found = lexical.search_documents(frame, spark.createDataFrame(queries, "item_id long, text string"), top=7)
    assert key(found.collect()) == key(brute(docs, queries, 7))


def test_accumulators_are_limited_and_survivors_exact():
    """A rare, heavy term fills the first k; a common, light one then makes no accumulators but updates theirs."""
    n = 1000
    rare, common = np.arange(0, 60), np.arange(n)
    postings = {0: (rare, np.full(60, 500, np.int64)), 1: (common, np.arange(n, dtype=np.int64) % 7 + 1)}
    found, scores = lexical.score_block(postings, {0: 500, 1: 7}, [0, 1], n, 1, 50)
    assert set(found) <= set(rare) and list(scores) == [500 + i % 7 + 1 for i in found]
    assert len(found) >= 50
    none, _ = lexical.score_block(postings, {0: 500, 1: 7}, [0, 1], n, 600, 50)
    assert not len(none), "a block that cannot reach the known kth score makes no accumulator at all"


def test_edges(spark, edge, clashing, nothing):
    queries = spark.createDataFrame([(1, "w1 w2", 3), (2, None, 4)], "item_id long, text string, rank long")
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    want = key(brute(rows, [(1, "w1 w2")]))
    assert key(lexical.search_documents(edge, queries).collect()) == want
    assert key(lexical.search_documents(clashing, queries).collect()) == want
    assert lexical.search_documents(nothing, queries).count() == 0
    assert lexical.search_documents(edge, queries.limit(0)).count() == 0
