import random
import re
import zlib
from collections import defaultdict

import pytest

from commitlake.llm import sharding


def rows_of(docs, n):
    found = sharding.shard_table(docs, n).collect()
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r)
    for shard, rows in by_shard.items():
        assert 0 <= shard < n
        assert sorted(r.slot for r in rows) == list(range(len(rows))), "slots are gapless from 0"
    return found, by_shard


def test_bytes_are_near_equal_with_a_hot_group_of_copies(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randrange(20, 120))) for _ in range(4000)] + ["hot copy " * 12] * 2500
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    found, by_shard = rows_of(docs, 40)
    for r in found:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    sizes = [sum(r.size for r in by_shard[s]) for s in range(40)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in found) + 2 * sharding.TOLERANCE * sum(sizes) / 40
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard_table(docs.repartition(3), 40).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in found}
    split = defaultdict(set)
    for r in found:
        split[texts[r.doc_id]].add(r.shard)
    assert sum(len(s) > 1 for t, s in split.items() if t != "hot copy " * 12) <= 1


def test_borders_are_exact(spark):
    """Each border is the first key at which the bytes below miss the wanted number by at most the tolerance."""
    docs = spark.createDataFrame([(i, "x" * (i % 90)) for i in range(3000)], "doc_id long, text string")
    keys = sharding.stored_keys(docs.select(*sharding.key_columns("doc_id", "text")), 16).cache()
    borders = sharding.find_borders(keys, 16)
    assert borders == sorted(borders) and len(borders) == 15
    rows = [(r.g, r.h, r.i, r["size"]) for r in keys.collect()]
    total = sum(r[3] for r in rows)
    for j, border in enumerate(borders, 1):
        below = sum(s for *key, s in rows if tuple(key) < border)
        assert abs(below - j * total / 16) <= max(106, sharding.TOLERANCE * total / 16)


@pytest.mark.parametrize("ids", ["null", "repeated"])
def test_law_holds_for_copies_without_ids_or_with_one(spark, ids):
    """A third of all rows has one text and no id, or one id: the law holds to a tolerance and one row."""
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abc ") for _ in range(rng.randrange(100, 900)))) for i in range(800)]
    rows += [(None if ids == "null" else 5, "the same text without an id " * 18)] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, by_shard = rows_of(docs.repartition(6), 40)
    sizes = [sum(r.size for r in by_shard[s]) for s in range(40)]
    mean = sum(sizes) / 40
    assert max(abs(s - mean) for s in sizes) <= 2 * (max(r.size for r in found) + sharding.TOLERANCE * mean)
    assert all(by_shard[s] for s in range(40))
    whole = sharding.shard_rows(docs.repartition(3), 40).groupBy("shard").count().collect()
    again = sorted((r.shard, r.doc_id or 0, r.size) for r in sharding.shard_table(docs.repartition(1), 40).collect())
    assert again == sorted((r.shard, r.doc_id or 0, r.size) for r in found), "however the rows are dealt"
    assert {r.shard: r["count"] for r in whole} == {s: len(by_shard[s]) for s in range(40)}


def test_many_lanes_number_like_one(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(2000)], "doc_id long, text string")
    monkeypatch.setattr(sharding, "ROWS_PER_TASK", 50)
    rows_of(docs, 4)


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_edges(request, name):
    docs = request.getfixturevalue(name)
    found, _ = rows_of(docs, 40)
    assert len(found) == docs.count()
    whole = sharding.shard_rows(docs, 40)
    assert whole.select("row.*").schema == docs.schema and whole.count() == docs.count()


def test_native(edge):
    assert not re.search("Python|Arrow|Pandas", sharding.shard_table(edge, 40)._jdf.queryExecution().toString())
