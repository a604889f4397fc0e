import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from commitlake.llm import mixing


def brute(rows):
    """{row index: (size, source_size, target, taken)} by one sort of everything."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {n: sum(z for z, (*_, s) in zip(size, rows) if s == n) for n in names}
    weight = {n: mixing.WEIGHTS[i % 3] for i, n in enumerate(names)}
    budget, full = sum(size), set()
    while True:
        rest = sum(weight[n] for n in names if n not in full)
        pace = (budget - sum(3 * total[n] for n in full)) / rest if rest else 0
        more = {n for n in names if n not in full and 3 * total[n] <= weight[n] * pace}
        if not more:
            break
        full |= more
    target = {n: 3.0 * total[n] if n in full else weight[n] * pace for n in names}
    hashed = [hashlib.md5(("" if d is None else str(d)).encode()).hexdigest() for d, *_ in rows]
    items = []
    for n in names:
        own = sorted((i for i in range(len(rows)) if rows[i][2] == n), key=lambda i: (hashed[i], rows[i][0] or 0))
        before = 0
        for i in own:
            before += size[i]
            for r in range(3):
                if size[i] and r < target[n] / total[n] + 1:
                    items.append(((r * total[n] + before) / target[n], names.index(n), hashed[i], i))
    taken, running = dict.fromkeys(range(len(rows)), 0), 0
    for *_, i in sorted(items):
        running += size[i]
        if running > budget:
            break
        taken[i] += size[i]
    return {i: (size[i], total[rows[i][2]], target[rows[i][2]], taken[i]) for i in range(len(rows))}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    return [(i, " ".join("w" for _ in range(rng.choice([0, 3, 10, 40, 300]))), rng.choice(["b", "b", "b", "a", "é", None, "A", "z"]))
            for i in range(700)]


def test_mix_by_brute_force(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, source string").repartition(6)
    got = {r[0]: tuple(r)[1:] for r in mixing.mix_table(docs).collect()}
    want = brute(corpus)
    assert all(got[i][:2] == want[i][:2] and got[i][3] == want[i][3] for i in want)
    assert all(got[i][2] == pytest.approx(want[i][2]) for i in want)
    again = {r[0]: tuple(r)[1:] for r in mixing.mix_table(docs.repartition(3)).collect()}
    assert again == got, "reruns agree however the rows are dealt"


def table_of(frame):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(map(tuple, mixing.mix_table(frame).collect()), key=key)


def documents_of(frame):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(map(tuple, mixing.mixed_documents(frame).collect()), key=key)


@pytest.mark.parametrize("kind", ["null", "repeated", "edge"])
def test_reruns_agree_without_ids_and_with_repeated_ones(spark, edge, kind):
    rng = random.Random(6)
    rows = [(None if kind == "null" or i % 3 else i % 7, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.choice([1, 5, 40]))),
             rng.choice("aab"), i % 5) for i in range(3000)]
    rows += rows[:50] * 3
    frame = edge if kind == "edge" else spark.createDataFrame(rows, "doc_id long, text string, source string, other long")
    dealt = [frame.repartition(1), frame.repartition(5), frame.orderBy(F.rand(3)).repartition(3)]
    first, *others = map(table_of, dealt)
    assert all(x == first for x in others)
    first_documents, *others = map(documents_of, dealt)
    assert all(x == first_documents for x in others)
    taken = sum(r[-1] for r in first)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in first_documents)
    assert words == taken > 0, "the documents are those that the table takes"


def test_each_source_comes_near_its_target(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, source string")
    table = mixing.mix_table(docs).join(docs.select("doc_id", "source"), "doc_id")
    for r in table.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"),
                                         F.max("size").alias("largest")).collect():
        assert abs(r.taken - r.target) <= 2 * r.largest
    assert table.where("taken > 3 * size").count() == 0


def test_documents_of_the_mix(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, source string").withColumn("size", F.lit("own")).repartition(4)
    mixed = mixing.mixed_documents(docs)
    assert mixed.schema == docs.schema
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for r in mixing.mix_table(docs).collect():
        assert times.get(r.doc_id, 0) * r.size == r.taken


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_edges(request, name):
    docs = request.getfixturevalue(name)
    table = mixing.mix_table(docs)
    assert table.count() == docs.count()
    assert table.where("taken > 3 * size OR taken IS NULL OR target IS NULL").count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_texts_without_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in mixing.mix_table(docs).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_native(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, source string")
    assert not re.search("Python|Arrow|Pandas", mixing.mix_table(docs)._jdf.queryExecution().toString())
