import itertools
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from commitlake.llm import lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_forward_recursion_sums_over_all_segmentations():
    weights = {"▁": math.log(0.05), "▁a": math.log(0.1), "a": math.log(0.2), "ab": math.log(0.03), "b": math.log(0.07),
               "bab": math.log(0.01), "▁ab": math.log(0.02), "ba": math.log(0.04)}
    bytes_ = [math.log(0.001)] * 256
    lattice = lm.Lattice(weights, bytes_)
    for word in ("a", "ab", "abab", "é", "abé", "bbabab"):
        s, total = "▁" + word, 0.0
        for cuts in itertools.product([0, 1], repeat=len(s) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(s)]
            p = 1.0
            for x, y in zip(at, at[1:]):
                piece = s[x:y]
                own = math.exp(weights[piece]) if piece in weights else 0.0
                p *= own + (0.001 ** len(piece.encode()) if len(piece) == 1 else 0.0)
            total += p
        assert lattice.log_probability(word) == pytest.approx(math.log(total), abs=1e-9)
    assert math.isfinite(lattice.log_probability("x" * 5000))


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
@pytest.mark.parametrize("frequent", [5, 50_000])
def test_scores_by_brute_force(request, monkeypatch, name, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    docs = request.getfixturevalue(name)
    rows = docs.select("doc_id", "text").collect()
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    count = Counter(w for r, h in zip(rows, held) if not h for w in [*words(r.text), ""])
    total, types = sum(count.values()), len(count)
    sp = SentencePieceProcessor(model_file=PATH)
    pieces = Counter()
    for w, n in count.items():
        if w:
            for i in sp.encode(w):
                pieces[i] += n
    usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    mass = sum(pieces[i] + 0.5 for i in usable) + count[""] + 0.5
    weight = {i: math.log((pieces[i] + 0.5) / mass) for i in usable}
    lattice = lm.Lattice({sp.id_to_piece(i): w for i, w in weight.items() if not sp.is_byte(i)},
                         [weight[sp.piece_to_id(f"<0x{b:02X}>")] for b in range(256)])
    known = {w: lattice.log_probability(w) / math.log(10) for r in rows for w in words(r.text)}
    end = math.log10((count[""] + 0.5) / mass)
    want = sorted((repr(r.doc_id), h, len(ws) + 1, sum(count[w] > 0 for w in ws) + (count[""] > 0), total,
                   round(sum(math.log10((count[w] + 1) / (total + types + 1)) for w in [*ws, ""]), 5),
                   round(sum(known[w] for w in ws) + end, 5))
                  for r, h in zip(rows, held) for ws in [words(r.text)])
    got = sorted((repr(r[0]), *r[1:5], round(r[5], 5), round(r[6], 5)) for r in lm.score_documents(docs, PATH).collect())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], abs=1e-3)


def test_held_out_texts_beat_equal_pieces(spark):
    """On texts that took no part in the fit, fitted weights are better than equal ones by far."""
    import random
    rng = random.Random(2)
    parts = ["tion", "ing", "er", "the", "an", "on", "re", "ed", "st", "ent", "is", "or"]
    texts = [" ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(80)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    equal = lm.Lattice(dict.fromkeys(map(SentencePieceProcessor(model_file=PATH).id_to_piece, range(259, 32000)),
                                     -math.log(32000)), [-math.log(32000)] * 256)
    held = [r for r in lm.score_documents(docs, PATH).collect() if r.held_out]
    assert len(held) > 20
    for r in held:
        assert r.score > sum(equal.log_probability(w) for w in words(texts[r.doc_id])) / math.log(10) + 50
