"""Byte-level BPE encoding and decoding with a given, already trained tokenizer file.

Each pre-token is merged with a priority queue of merge ranks over a doubly linked symbol list: the lowest
(rank, position) pair is merged, the two new neighbour pairs are pushed, and queue entries whose symbols have
changed meanwhile are recognised as stale and skipped. A pre-token of n bytes costs O(n log n), so one endless
word is no special case. Merged pre-tokens are remembered per Python worker in a cache of bounded size.
Decoding concatenates vocabulary strings.

Defined cases: a NULL text counts as empty and has no ids; special tokens written in a text get their id;
repeated rows are encoded each; NULL ids and other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from commitlake.llm.common import Cache, prepare

CACHE_SIZE = 1_200_000     # words, and pre-tokens, remembered per worker (some 200 bytes each)
STAGE_CACHE = 300_000      # the same where the encoder shares its workers with other stages; released with the task
BEFORE_WORD = re.compile(r" (?=\S)")    # a pre-token starts here, whatever stands before


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder of one byte-level BPE file in the tokenizers library's JSON format."""

    def __init__(self, path: str, cache_size: int | None = None):
        self.cache_size = cache_size or CACHE_SIZE
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        to_byte = {c: bytes([b]) for b, c in enumerate(symbols)}
        vocab = spec["model"]["vocab"]
        self.byte_ids = [vocab[c] for c in symbols]
        self.to_latin = {ord(c): b for b, c in enumerate(symbols)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.pairs = [(vocab[a], vocab[b]) for a, b in merges]
        self.merged = [vocab[a + b] for a, b in merges]
        self.rank = {pair: rank for rank, pair in enumerate(self.pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        strings = {i: b"".join(to_byte[c] for c in s) for s, i in vocab.items()}
        strings |= {i: s.encode() for s, i in self.special.items()}
        self.strings = [strings.get(i, b"") for i in range(max(strings) + 1)]
        self.numbers = [str(i) for i in range(len(self.strings))]
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.split = ByteLevel(add_prefix_space=False, use_regex=True)    # the published split into pre-tokens
        self.forget()

    def forget(self) -> None:
        """Empty the caches: a worker outlives its task, and other operators' tasks follow in it."""
        self.tokens, self.words = Cache(self.cache_size), Cache(self.cache_size)

    def merge(self, token: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = list(map(self.byte_ids.__getitem__, token))
        rank, pairs, merged = self.rank, self.pairs, self.merged
        # a queue entry is (rank, position) in one integer
        queue = [(r << 32) | i for i, r in enumerate(map(rank.get, zip(ids, ids[1:]))) if r is not None]
        if not queue:
            return ids
        heapify(queue)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids.append(-1)                                     # the end of the list: no pair has it
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if (ids[i], ids[j]) != pairs[r := entry >> 32]:
                continue                                   # stale: this symbol or its neighbour has merged since
            ids[i], ids[j] = (new := merged[r]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get((new, ids[k]))) is not None:
                    heappush(queue, (r << 32) | i)
            if (p := before[i]) >= 0 and (r := rank.get((ids[p], new))) is not None:
                heappush(queue, (r << 32) | p)
        return [x for x in ids if x >= 0]

    def token(self, token: bytes) -> bytes:
        ids = self.tokens.get(token)
        if ids is None:
            ids = array("I", self.merge(token)).tobytes()
            self.tokens.put(token, ids)
        return ids

    def pretokens(self, text: str) -> bytes:
        return b"".join([self.token(symbols.translate(self.to_latin).encode("latin-1"))
                         for symbols, _ in self.split.pre_tokenize_str(text)])

    def word(self, word: str) -> bytes:
        """Ids of a space and a word; letters with stops behind them are the common case and split as one would think."""
        letters = word.rstrip(".,")
        if not letters.isalpha():
            return self.pretokens(" " + word)
        ids = self.token(b" " + letters.encode())
        return ids + self.token(word[len(letters):].encode()) if len(letters) < len(word) else ids

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens, cut before each word so that whole words can be remembered."""
        pieces = BEFORE_WORD.split(text)
        pieces[0], first = "", pieces[0]
        found = list(map(self.words.young.get, pieces))
        found[0] = self.pretokens(first)
        for i in [i for i, ids in enumerate(found) if ids is None]:
            ids = self.words.get(pieces[i])
            if ids is None:
                ids = self.word(pieces[i])
                self.words.put(pieces[i], ids)
            found[i] = ids
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        if not any(s in text for s in self.special):
            return array("I", self.plain(text)).tolist()
        out = array("I")
        for part in self.at_special.split(text):
            out.frombytes(array("I", [self.special[part]]).tobytes() if part in self.special else self.plain(part))
        return out.tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")

    def listed(self, ids: list[int]) -> str:
        """The ids as decimals joined by commas."""
        return ",".join(map(self.numbers.__getitem__, ids))


_loaded: dict[tuple, ByteBpe] = {}


def loaded(path: str, cache_size: int | None = None) -> ByteBpe:
    """The encoder of ``path``, read once per Python worker."""
    key = (path, cache_size)
    if key not in _loaded:
        _loaded[key] = ByteBpe(path, cache_size)
    return _loaded[key]


def encode_documents(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` plus ``ids_col`` (array<int>); an input column of that name is replaced."""
    prepare(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary, STAGE_CACHE)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("t"))
            ids = pa.array([bpe.encode(t.as_py() or "") for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["row", "ids"])
        bpe.forget()

    rest = docs.drop(ids_col)
    packed = rest.select(F.struct("*").alias("row"), F.col(text_col).alias("t"))
    kind = rest.schema.simpleString()
    out = packed.mapInArrow(encode, f"row {kind}, ids array<int>")
    return out.select("row.*", F.col("ids").alias(ids_col))


def decode_documents(tokens: DataFrame, vocabulary: str, ids_col: str = "token_ids",
                     text_col: str = "decoded") -> DataFrame:
    """All columns of ``tokens`` plus ``text_col``, the decoded ids; NULL ids decode to the empty text."""
    prepare(tokens.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            texts = pa.array([bpe.decode(x.as_py() or []) for x in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["row", "text"])

    rest = tokens.drop(text_col)
    kind = rest.schema.simpleString()
    out = rest.select(F.struct("*").alias("row"), F.col(ids_col).alias("ids")).mapInArrow(
        decode, f"row {kind}, text string")
    return out.select("row.*", F.col("text").alias(text_col))


def token_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass and return the id, token count and SHA-256 digests of both."""
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(bpe.listed(ids).encode()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(
        digest, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("k", id_col)
