import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows():
    """NULLs in every column, empty and blank texts, repeated rows and ids, copies, near copies, a very long text."""
    rng = random.Random(7)
    base = words(rng, 300)
    near = " ".join(base.split()[:290] + ["changed"] * 3 + base.split()[293:])
    rows = [(1, base, "en", "src1", len(base)), (2, base, "en", "src1", len(base)), (3, near, "en", "src0", len(near)),
            (4, "", "en", "src0", 0), (5, None, None, None, None), (6, " \t\n ", "en", "src2", 4), (7, "one two", "en", None, 7),
            (8, words(rng, 120), "en", "src2", 9), (8, words(rng, 120), "en", "src2", 9), (None, words(rng, 80), "en", "src0", 1),
            (None, base, "en", "src1", 2), (9, words(rng, 60) + "\n" + base.upper() + " é　ü 中文", "de", "src1", 3),
            (10, "x" * 30000, "en", "src3", 30000), (11, words(rng, 20000, 3000), "en", "src3", 5),
            (12, "same line here\nsame line here\n" * 30, "en", "src3", 6)]
    rows += [rows[7], rows[7]]
    rows += [(i, words(rng, rng.randrange(1, 200)), "en", f"src{i % 4}", i) for i in range(20, 60)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def clashing(spark):
    """The same rows with extra columns that bear names the operators use themselves."""
    names = ("k", "t", "row", "id", "key", "node", "size", "g", "h", "shard", "base", "terms", "hash", "target", "kept",
             "token_ids", "word", "label", "bucket")
    rows = [(*r, *[i for i in range(len(names))]) for r in edge_rows()]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", {n} long" for n in names)).repartition(4)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
