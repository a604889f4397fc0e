import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from commitlake.llm import tokenfile
from commitlake.llm.common import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_words_encode_like_texts(library):
    own, rng = tokenfile.WordEncoder(PATH), random.Random(3)
    pieces = list(" \n\t\x0b'sabcABC019.,éİΣς") + ["<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "'ll", "'LL", "word,", "Word.,", "...",
                                                   "́", "中", " ", " ", "𝄞", "\x85", "\x1c"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 30)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["edge", "clashing", "nothing"])
def test_files_hold_every_document_in_order(request, spark, library, monkeypatch, name):
    monkeypatch.setattr(tokenfile, "FRAME_IDS", 500)
    docs = request.getfixturevalue(name)
    manifest = tokenfile.write_tokens(docs, PATH, 2, scratch_path(spark, "tokens"))
    got = sorted((tuple(r) for r in tokenfile.read_tokens(manifest).collect()), key=lambda r: r[1])
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert [r[1:3] for r in got] == [r[1:3] for r in want]
    assert got == want


def test_seek_table_frames_and_checksums(tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "FRAME_IDS", 50)
    path, rng = str(tmp_path / "x.zst"), np.random.default_rng(1)
    docs = [rng.integers(0, 49000, n).astype("<u4") for n in (0, 10, 60, 5, 5, 45, 200, 1)]
    writer = tokenfile.Writer(path)
    for i, ids in enumerate(docs):
        writer.add(i if i != 3 else None, ids.tobytes())
    assert writer.close() == (8, 326)
    reader = tokenfile.Reader(path)
    assert reader.ids == [0, 1, 2, None, 4, 5, 6, 7] and len(reader.frames) == 4
    read = []
    monkeypatch.setattr(tokenfile.Reader, "frame", lambda self, k, old=tokenfile.Reader.frame: (read.append(k), old(self, k))[1])
    assert [(i, x.tolist()) for i, x in reader.documents([6, 3])] == [(3, docs[3].tolist()), (6, docs[6].tolist())]
    assert read == [1, 2], "only the frames of the wanted documents are decompressed"
    data = open(path, "rb").read()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"".join(d.tobytes() for d in docs), "any zstandard reader skips the index and the seek table"
    bad = bytearray(data)
    bad[len(data) - 9 - 4] ^= 1
    open(path, "wb").write(bad)
    with pytest.raises(ValueError, match="checksum"):
        list(tokenfile.Reader(path).documents())
