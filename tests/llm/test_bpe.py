import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from commitlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_equals_the_library(library):
    own, rng = bpe.ByteBpe(PATH), random.Random(1)
    pieces = ["a", "Hello", " world", "'ll", "'s", " ", "  ", "\n", "\t ", " ", " ", "é", "ß", "中文", "𝄞", "123", "!?", ".,",
              "\x85", "\x1c", "<|endoftext|>", "<|", "\U0003dfe8", "⁫", "ﬁ", "½", "\x00"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_one_endless_word_and_a_small_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_SIZE", 20)
    own, rng = bpe.ByteBpe(PATH), random.Random(2)
    text = "".join(rng.choice("abcdeéA1") for _ in range(20000)) + " " + " ".join(
        "".join(rng.choice("xyz.,") for _ in range(rng.randrange(1, 9))) for _ in range(3000))
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_digests_and_round_trip(request, library, name):
    docs = request.getfixturevalue(name)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.token_digests(docs, PATH).collect())) == want
    tokens = bpe.encode_documents(docs, PATH)
    assert set(tokens.columns) == set(docs.columns) | {"token_ids"}
    back = bpe.decode_documents(tokens, PATH)
    assert back.where("decoded != coalesce(text, '')").count() == 0 and back.count() == docs.count()


def test_null_ids_decode_to_nothing(spark):
    tokens = spark.createDataFrame([(1, None), (2, [15496])], "doc_id long, token_ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode_documents(tokens, PATH).collect()} == {1: "", 2: "Hello"}
