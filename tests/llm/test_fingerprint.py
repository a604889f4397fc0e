import hashlib
import random
import re

import pytest

from commitlake.llm import fingerprint as fp


def parsed(text):
    return [(int(h, 16), int(p)) for h, p in (x.split(":") for x in text.split(","))] if text else []


def test_winnowing_rules(spark):
    """The chosen positions are those of the rightmost minimum of each window of the text's own k-gram hashes."""
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(n)) for n in (0, 1, 4, 5, 6, 19, 20, 21, 22, 60, 400)]
    texts += ["same " * 100, "a b " * 60]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    grams = {}
    singles = rows.selectExpr("i", "posexplode(regexp_extract_all(t, '[^ ]+', 0)) AS (p, w)")
    words = {}
    for r in singles.selectExpr("i", "p", "xxhash64(w) AS h").collect():
        words.setdefault(r.i, {})[r.p] = r.h
    folded = spark.createDataFrame([(i, p, [w.get(p + k) for k in range(5)]) for i, w in words.items() for p in w
                                    if p + 5 <= len(w) or p == 0], "i long, p long, w array<long>")
    for r in folded.selectExpr("i", "p", "xxhash64(xxhash64(xxhash64(w[0], w[1]), xxhash64(w[2], w[3])), w[4]) AS h",
                               "size(filter(w, x -> x IS NOT NULL)) AS n").collect():
        if r.n == 5:
            grams.setdefault(r.i, {})[r.p] = r.h & 0xFFFFFFFF
    for r in fp.fingerprints(rows, "t", "f").select("i", fp.written("f").alias("f")).collect():
        g = grams.get(r.i)
        if not g:
            assert len(parsed(r.f)) == (1 if texts[r.i].split() else 0)
            continue
        n, want = len(g), set()
        for start in range(max(1, n - fp.WINDOW + 1)):
            window = range(start, min(n, start + fp.WINDOW))
            least = min(g[p] for p in window)
            at = max(p for p in window if g[p] == least)
            want.add((least, at))
        assert parsed(r.f) == sorted(want, key=lambda x: x[1]), r.i


def test_match_guarantee(spark):
    rng = random.Random(2)
    common = " ".join(f"c{rng.randrange(1000)}" for _ in range(fp.K + fp.WINDOW - 1))
    texts = [" ".join([*(f"x{rng.randrange(1000)}" for _ in range(rng.randrange(40))), common,
                       *(f"y{rng.randrange(1000)}" for _ in range(rng.randrange(40)))]) for _ in range(30)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    found = [{h for h, _ in parsed(r.f)} for r in fp.fingerprints(rows, "t", "f").select(fp.written("f").alias("f")).collect()]
    assert all(a & b for a in found for b in found)


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_table_by_brute_force(request, spark, name):
    docs = request.getfixturevalue(name)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (doc, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[:len(text) - half] + rows[(i + 1) % len(rows)][1][:half]
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, rows[(i + 1) % len(rows)][1]))
    got = fp.fingerprint_table(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted((tuple(r)[:3] for r in got), key=key) == sorted((w[:3] for w in want), key=key)
    if not rows:
        return
    texts = spark.createDataFrame(sorted({(t,) for w in want for t in w[3:]}), "t string")
    prints = {r.t: r.f for r in fp.fingerprints(texts, "t", "f").select("t", fp.written("f").alias("f")).collect()}
    hashes = {t: {h for h, _ in parsed(f)} for t, f in prints.items()}

    def like(a, b):
        a, b = hashes[a], hashes[b]
        return len(a & b) / len(a | b) if a | b else 1.0

    expected = sorted(((w[0], *w[1:3], prints[w[3]], prints[w[4]], like(w[3], w[4]), like(w[3], w[5])) for w in want), key=key)
    for g, w in zip(sorted(map(tuple, got), key=key), expected):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:])


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert fp.fingerprint_table(docs).first().edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_native(edge):
    assert not re.search("Python|Arrow|Pandas", fp.fingerprint_table(edge)._jdf.queryExecution().toString())
