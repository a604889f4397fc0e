import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from commitlake.llm import suffix
from commitlake.llm.queries import op2_suffix_dedup


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept) per text by counting every LENGTH-byte string."""
    datas = [(t or "").encode() for t in texts]
    n = suffix.LENGTH
    count = Counter(d[i:i + n] for d in datas for i in range(len(d) - n + 1))
    out = []
    for d in datas:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - n + 1):
            if count[d[i:i + n]] > 1:
                gone[i:i + n] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(d) else 0))
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, parts=5):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    found = {r.doc_id: tuple(r)[1:] for r in suffix.dedup_table(docs).collect()}
    for i, want in enumerate(brute(texts)):
        assert found[i] == want, (i, texts[i][:80] if texts[i] else texts[i])


def prose(rng, n, alphabet="abcdefgh éü  "):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_passages_of_many_lengths(spark):
    rng = random.Random(3)
    shared = prose(rng, 1500)
    texts = [None, "", "short", shared, shared, "x" * 1200, "ab" * 700, "y" * 399, "y" * 400, "z" * 401]
    for n in (380, 395, 399, 400, 401, 410, 450, 600, 900):
        at = rng.randrange(0, 1500 - n)
        while len(shared[at:at + n].encode()) < n:
            n += 1
        texts += [prose(rng, rng.randrange(0, 300)) + shared[at:at + n] + prose(rng, rng.randrange(0, 300)) for _ in range(3)]
    texts += [prose(rng, rng.randrange(300, 900)) for _ in range(10)]
    check(spark, texts)


def test_exact_border_of_the_length(spark):
    rng = random.Random(4)
    body = "".join(rng.choice("abcd") for _ in range(420))
    texts = ["P" + body[:n] + "Q" * 5 + str(n) for n in range(396, 406)] + ["R" + body[10:10 + n] + "S" for n in (399, 400)]
    check(spark, texts)


@pytest.mark.parametrize("hot", [4, 5000])
def test_near_copies_and_a_hot_passage(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    rng = random.Random(5)
    base = prose(rng, 1800, "abcdefghij ")
    texts = []
    for _ in range(12):
        t = list(base)
        for _ in range(4):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    hot = prose(rng, 700, "klmnop ")
    texts += [prose(rng, rng.randrange(50, 250)) + hot[rng.randrange(0, 60):700 - rng.randrange(0, 200)] + prose(rng, 100) for _ in range(80)]
    check(spark, texts, 9)


def test_buckets_that_cut_through_groups():
    """However a sorted run is cut into buckets, local results and the strings at their borders give the same."""
    rng = random.Random(6)
    tails = [prose(rng, 150, "ab").encode() for _ in range(3)]
    heads = [prose(rng, 90, "cd").encode() for _ in range(3)]
    rows = sorted({(("m" * 300).encode() + rng.choice(tails)[:rng.randrange(100)], rng.choice(heads)[:rng.randrange(90)])
                   for _ in range(120)})

    def solve(cuts):
        low, high, borders = {}, {}, []
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            part = rows[a:b]
            for s1, s2, lo, hi, w1, w2, d in suffix.sort_bucket([x for _, x in part], [x for x, _ in part], np.ones(len(part)),
                                                                     np.ones(len(part), bool)):
                if d is None:
                    low[s1, s2], high[s1, s2] = min(low.get((s1, s2), 999), lo), max(high.get((s1, s2), -1), hi)
                else:
                    borders.append((w1, w2, d, s1, s2))
        times = Counter(x[:3] for x in borders)
        for w1, w2, d, s1, s2 in borders:
            if s1 is not None and times[w1, w2, d] > 1:
                low[s1, s2], high[s1, s2] = min(low.get((s1, s2), 999), d), max(high.get((s1, s2), -1), d)
        return low, high

    assert solve([40, 80]) == solve([]) == solve(list(range(7, 110, 7)))


def test_multikey_sort():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 21)).astype(np.uint8)
    order, shared = suffix.multikey_sort(rows)
    as_bytes = [rows[i].tobytes() for i in order]
    assert as_bytes == sorted(as_bytes)
    for k in range(1, 300):
        a, b = as_bytes[k - 1], as_bytes[k]
        assert shared[k] == next((i for i in range(21) if a[i] != b[i]), 21)


def test_anchors_are_chosen_by_content_in_parts():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, suffix.PART + 5000).astype(np.uint8).tobytes()
    whole, _ = suffix.anchors(data)
    for at in (0, 1000, suffix.PART - suffix.LENGTH - 50, suffix.PART - 300, suffix.PART + 100):
        piece, _ = suffix.anchors(data[at:at + suffix.LENGTH])
        assert len(piece) == 1 and piece[0] + at in whole


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_edges(request, name):
    docs = request.getfixturevalue(name)
    rows = docs.select("doc_id", "text").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(((r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows]))), key=key)
    assert sorted((tuple(r) for r in suffix.dedup_table(docs).collect()), key=key) == want


def brute_passages(texts, size):
    """Per text, the places where ``size`` words start that another of the texts holds too."""
    sequences = []
    for t in texts:
        words = (t or "").encode().split()
        sequences.append([tuple(words[i:i + size]) for i in range(len(words) - size + 1)])
    held = Counter(s for found in sequences for s in set(found))
    return [sum(held[s] > 1 for s in found) for found in sequences]


def test_passages_of_over_50_words_below_the_length(spark):
    rng = random.Random(8)

    def words(n):
        return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8))) for _ in range(n)]

    passages = [words(n) for n in (49, 50, 51, 52, 55, 60, 68, 120)]
    texts = [" ".join(words(rng.randrange(90)) + p + words(rng.randrange(90))) for p in passages for _ in range(3)]
    alone = words(150)
    texts += [" ".join(alone + words(5) + alone), " ".join(words(300)), None, "", " ".join(passages[3]), " ".join(passages[4])]
    texts += ["\n".join(passages[5]), " ".join(words(60)), "a " * 90, "a " * 70 + "b", "x" * 1000, texts[3]]
    texts += [" ".join(["pq"] * 60)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: tuple(r)[1:] for r in suffix.dedup_table(docs, passage_words=51).collect()}
    want = [(*b, n) for b, n in zip(brute(texts), brute_passages(texts, 51))]
    assert [found[i] for i in range(len(texts))] == want
    assert all(found[i][1] == 0 and found[i][4] > 0 for i in range(6, 18))      # 51 to 60 words, none of 400 bytes
    assert found[24][1] > 0 and found[24][4] == 0                               # repeats itself, no other document


def test_query_counts_passages(spark, tmp_path):
    rng = random.Random(10)

    def words(n):
        return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8))) for _ in range(n)]

    passage = words(51)
    texts = [" ".join(words(40) + passage + words(40)) for _ in range(2)] + [" ".join(words(131))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.n_removed, r.n_passages) for r in op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert found == {0: (0, 1), 1: (0, 1), 2: (0, 0)}


def test_words_are_hashed_in_parts(monkeypatch):
    rng = random.Random(9)
    data = " \t\n".join(prose(rng, rng.randrange(0, 40), "abc\n é") for _ in range(200)).encode()
    whole = suffix.word_hashes(data)
    assert len(whole) == len(data.split())
    monkeypatch.setattr(suffix, "PART", 64)
    assert (suffix.word_hashes(data) == whole).all()


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_passages_of_edges(request, name):
    docs = request.getfixturevalue(name)
    rows = docs.select("doc_id", "text").collect()
    texts = [r.text for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(((r.doc_id, *b, n) for r, b, n in zip(rows, brute(texts), brute_passages(texts, 51))), key=key)
    assert sorted((tuple(r) for r in suffix.dedup_table(docs, passage_words=51).collect()), key=key) == want
