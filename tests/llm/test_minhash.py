import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from commitlake.llm import graph, minhash


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows, threshold):
    return Counter(brute_rows(rows, threshold))


def brute_rows(rows, threshold):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and
             100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    out = []
    for i, (doc, _) in enumerate(rows):
        if not sets[i]:
            found = doc
        else:
            found = min((d for k, (d, _) in enumerate(rows) if label[k] == label[i] and d is not None and sets[k]), default=None)
        out.append((doc, len(sets[i]), found, doc == found))
    return out


def loose_copies(rng, n, edits, words=220):
    base = [f"b{rng.randrange(500)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(edits)):
            t[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
        texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("threshold", [80, 85])
def test_classes_by_brute_force(spark, threshold):
    rng = random.Random(threshold)
    texts = loose_copies(rng, 90, 12) + loose_copies(rng, 40, 4) + loose_copies(rng, 30, 25)
    texts += [" ".join(f"r{rng.randrange(900)}" for _ in range(rng.randrange(1, 150))) for _ in range(60)]
    texts += [texts[0]] * 5 + ["One two", "one TWO", "one", "", None, "  "]
    chain = [f"c{i}" for i in range(400)]
    texts += [" ".join(chain[4 * i:4 * i + 200]) for i in range(40)]          # each overlaps its neighbours only
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, minhash.near_duplicates(docs, threshold).drop("text_key").collect()))
    assert got == brute(rows, threshold)


def variant_copies(rng, n, words=150, variants=3):
    """Loose copies that share their changed words, so that few shingles are a copy's own."""
    base = [f"b{i}" for i in range(words)]
    texts = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(2, 7)):
            at = rng.randrange(5, words - 5)
            t[at] = f"v{at}-{rng.randrange(variants)}"
        texts.append(" ".join(t))
    return texts


def test_large_group_of_loose_copies(spark, monkeypatch):
    """Of the 79,800 pairs of a group of copies that are mostly not linked, few are compared in the last step."""
    compared, likely = [], minhash.likely

    def counted(pairs, signs, threshold):
        compared.append(pairs.count())
        return likely(pairs, signs, threshold)

    monkeypatch.setattr(minhash, "likely", counted)
    rows = list(enumerate(variant_copies(random.Random(5), 400)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80).drop("text_key")
    assert Counter(map(tuple, found.collect())) == brute(rows, 80)
    assert compared[-1] < 15 * len(rows)


@pytest.mark.parametrize("threshold", [80, 85])
def test_differences_lose_no_link(spark, threshold):
    """Every linked pair whose ends are not linked with the middle comes out, and few others do."""
    texts = variant_copies(random.Random(threshold), 150)
    sets = [set(minhash.shingles(t).tolist()) for t in texts]

    def linked(x, y):
        return 100 * len(x & y) >= threshold * len(x | y)

    label = [0 if linked(s, sets[0]) else i for i, s in enumerate(sets)]
    pairs = {(i, j) for j in range(1, len(sets)) for i in range(1, j) if label[i] != label[j] and linked(sets[i], sets[j])}
    placed = spark.createDataFrame([(i, 0, label[i], len(sets[i])) for i in range(1, len(sets))],
                                   "node long, middle long, label long, n_shingles long")
    texts = spark.createDataFrame(list(enumerate(texts)), "node long, t string")
    found = {(r.a, r.b) for r in minhash.alike_differences(placed, texts, threshold).collect()}
    assert pairs and pairs <= found
    assert len(found) < 0.05 * math.comb(len(sets), 2)


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_edges(request, name):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = Counter(map(tuple, minhash.near_duplicates(docs, 85).drop("text_key").collect()))
    assert got == brute(rows, 85)
    kept = minhash.keep_one_of_each(docs, 85)
    assert kept.schema == docs.schema
    want = {row for row, found in zip(rows, brute_rows(rows, 85)) if found[3]}
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want), "one row for each kept id and text"


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    errors = []
    for share in (0.3, 0.6, 0.85, 0.95):
        for _ in range(20):
            common = rng.integers(0, 1 << 63, int(400 * share), dtype=np.uint64)
            rest = rng.integers(0, 1 << 63, (2, int(400 * (1 - share) / 2)), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([common, x])) for x in rest)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((minhash.signature(a) == minhash.signature(b)).mean() - true)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_pruning_misses_seldom():
    """Pairs at the threshold pass all batches but for a share near the chosen miss probability."""
    rng, fewest = np.random.default_rng(6), minhash.fewest_matches(85)
    matches = np.cumsum((rng.random((200_000, minhash.HASHES)) < 0.85).reshape(200_000, -1, minhash.BATCH).sum(axis=2), axis=1)
    assert (matches < np.array(fewest)).any(axis=1).mean() < 1e-3
    far = np.cumsum((rng.random((10_000, minhash.HASHES)) < 0.5).reshape(10_000, -1, minhash.BATCH).sum(axis=2), axis=1)
    assert (far < np.array(fewest)).any(axis=1).mean() > 0.99
    for t in (80, 85):
        rows, bands = minhash.banding(t)
        assert (1 - (t / 100) ** rows) ** bands <= minhash.BAND_MISS


@pytest.mark.parametrize("threshold", [80, 85])
def test_miss_chance_in_the_readme(threshold):
    """The exact chance that a pair at the threshold shares no bucket or falls out at one of the batches."""
    t, passed, lost = threshold / 100, {0: 1.0}, 0.0
    for fewest in minhash.fewest_matches(threshold):
        after = Counter()
        for m, p in passed.items():
            for j in range(minhash.BATCH + 1):
                after[m + j] += p * math.comb(minhash.BATCH, j) * t ** j * (1 - t) ** (minhash.BATCH - j)
        passed = {m: p for m, p in after.items() if m >= fewest}
        lost += sum(p for m, p in after.items() if m < fewest)
    rows, bands = minhash.banding(threshold)
    readme = (Path(__file__).parents[2] / "README.md").read_text()
    stated = float(re.search(r"misses a pair\s+at the threshold with a chance of some (\S+)", readme)[1])
    assert round(lost + (1 - t ** rows) ** bands, 5) == stated


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [
        (rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.node: r.label for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(70):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {x: p for x, p in parent.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
