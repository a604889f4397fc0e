"""Token ids in seekable zstandard files, written and read by Spark tasks.

One file per range of ids. A file is a run of independent zstandard frames, each with the ids of some documents as
little-endian unsigned 32-bit integers (a document is never split over frames), then a skippable frame with the
document index (id, token count, documents per frame), then the seek table of the public seekable format: compressed
size, plain size and checksum (lower half of XXH64) of every frame. A reader opens the file from its end and
decompresses only the frames that hold the documents it wants.

A task writes under a name of its own and its row in the manifest, a Parquet table, is what makes the file part of
the data set: a lost or repeated task leaves at most a file that no manifest names.

Defined cases: a NULL or empty text has the end id only; rows with a NULL id come first, equal ids follow each other
in the order of a hash of their texts; ids are cast to long, and one that is not a whole number counts as NULL; an empty
table gives no file; other columns are not looked at.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.llm.bpe import byte_symbols
from commitlake.llm.common import Cache, materialise, prepare

FRAME_IDS = 1 << 18        # ids after which a frame is closed
LEVEL = 1                  # zstandard level
CACHE_SIZE = 1_200_000     # words remembered per worker (some 200 bytes each)

LATIN = "\u024f"           # last letter of the Latin blocks

# Fixed values of the seekable zstandard format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80


def open_file(uri: str, mode: str) -> BinaryIO:
    """A file of the shared folder: plain paths and file: URIs directly, other stores through pyarrow's file systems."""
    url = urlparse(uri)
    if url.scheme in ("", "file"):
        path = unquote(url.path)
        if mode == "wb":
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(path, compression=None) if mode == "wb" else store.open_input_file(path)


class Writer:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, uri: str):
        self.file, self.uri = open_file(uri, "wb"), uri
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.part, self.held, self.frames = [], 0, []
        self.ids, self.counts, self.per_frame = [], [], [0]

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.part.append(ids)
        self.held += len(ids) // 4
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.per_frame[-1] += 1
        if self.held >= FRAME_IDS:
            self._frame()

    def _frame(self) -> None:
        plain = b"".join(self.part)
        packed = self.pack.compress(plain)
        self.file.write(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.part, self.held = [], 0
        self.per_frame.append(0)

    def close(self) -> tuple[int, int]:
        """(documents, ids) written."""
        if self.per_frame[-1]:
            self._frame()
        self.per_frame.pop()
        known = np.array([x is not None for x in self.ids], np.uint8)
        index = zstandard.compress(
            struct.pack("<QQ", len(self.ids), len(self.frames)) + np.array(self.per_frame, "<u4").tobytes()
            + np.array([x or 0 for x in self.ids], "<i8").tobytes() + np.array(self.counts, "<u4").tobytes()
            + known.tobytes())
        self.file.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEK_MAGIC)
        self.file.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.file.close()
        return len(self.ids), sum(self.counts)


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str):
        self.file = open_file(uri, "rb")
        end = self.file.seek(0, os.SEEK_END)
        self.file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError(f"{uri} has no seek table with checksums")
        self.file.seek(end - 9 - 12 * n)
        self.frames = np.frombuffer(self.file.read(12 * n), "<u4").reshape(n, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        self.file.seek(int(self.offsets[-1]))
        magic, size = struct.unpack("<II", self.file.read(8))
        if magic != SKIPPABLE_INDEX:
            raise ValueError(f"{uri} has no document index")
        index = zstandard.decompress(self.file.read(size))
        docs, frames = struct.unpack_from("<QQ", index)
        self.per_frame = np.frombuffer(index, "<u4", frames, 16)
        at = 16 + 4 * frames
        ids = np.frombuffer(index, "<i8", docs, at)
        self.counts = np.frombuffer(index, "<u4", docs, at + 8 * docs).astype(np.int64)
        known = np.frombuffer(index, np.uint8, docs, at + 12 * docs)
        self.ids = [int(x) if k else None for x, k in zip(ids, known)]
        self.starts = np.cumsum(self.counts) - self.counts
        self.frame_of = np.repeat(np.arange(frames), self.per_frame)
        self.unpack = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        self.file.seek(int(self.offsets[k]))
        plain = self.unpack.decompress(self.file.read(int(self.frames[k, 0])), max_output_size=int(self.frames[k, 1]))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.frames[k, 2]:
            raise ValueError(f"checksum of frame {k}")
        return plain

    def documents(self, places: Iterable[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of the documents at ``places`` in the file, all by default; each needed frame is read once."""
        places = range(len(self.ids)) if places is None else sorted(places)
        held, plain, first = -1, b"", 0
        for i in places:
            if (k := int(self.frame_of[i])) != held:
                held, plain = k, self.frame(k)
                first = int(self.starts[int(self.per_frame[:k].sum())])
            at = int(self.starts[i]) - first
            yield i, np.frombuffer(plain, "<u4", int(self.counts[i]), 4 * at)

    def close(self) -> None:
        self.file.close()


_encoders: dict[str, WordEncoder] = {}


def stem(word: bytes) -> int:
    """The length of ``word`` without the stops behind its last letter: a pre-token ends there."""
    if word[-1] not in b".,":
        return len(word)
    core = word.rstrip(b".,")
    return len(core) if core and core.decode()[-1].lower()[-1].isalpha() else len(word)


class WordEncoder:
    """Encodes texts with a lower-casing tokenizer whose pre-tokens span neither white space nor the end of a word before
    stops: distinct words are encoded once and remembered, as little-endian bytes, so that a text's ids are a join of
    byte strings. Unknown words go straight to the merges if they are plain letters, and are otherwise encoded many at
    a time, with a special token between them to cut at."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = min((t for t in self.tokenizer.get_added_tokens_decoder().items() if t[1].special), key=lambda t: t[0])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.symbols = dict(enumerate(byte_symbols()))
        self.words = Cache(CACHE_SIZE)            # kept over the tasks of a worker: most words come again

    def as_symbols(self, word: bytes) -> str | None:
        """The symbols of the one pre-token that ``word`` is, where that is plain to see: Latin letters, which lower case
        and composition treat one by one. NULL for any other word."""
        if word.isalpha() and word.islower():
            return word.decode()
        text = word.decode()
        if not text.isalpha() or max(text) > LATIN or "\u0130" in text:
            return None
        return text.lower().encode().decode("latin-1").translate(self.symbols)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; ``words`` hold no special token."""
        number, token = self.cut
        text = token.content.join([w.decode() for w in words])
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        cuts, raw = np.flatnonzero(ids == number), ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip([0, *(cuts + 1)], [*cuts, len(ids)])]

    def encode(self, text: str) -> bytes:
        data = text.encode()
        if b"<" in data and any(t in text for t in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = data.lower().split()
        if b"<|" in data:                  # lower case could make a special token of a word: encode these as they are
            words = data.split()
        found = list(map(self.words.young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            parts: dict[bytes, bytes | None] = {}
            for i in missing:
                word = words[i]
                if (ids := self.words.get(word)) is None:
                    n = stem(word)
                    parts[word[:n]] = parts[word[n:]] = None
                found[i] = ids
            unknown = []
            for part in parts:
                if (ids := self.words.get(part) if part else b"") is None:
                    unknown.append(part)
                parts[part] = ids
            other = []
            for part in unknown:
                symbols = self.as_symbols(part)
                if symbols is None:
                    other.append(part)
                else:
                    parts[part] = array("I", [t.id for t in self.tokenizer.model.tokenize(symbols)]).tobytes()
            if other:
                parts.update(zip(other, self.encode_words(other)))
            for part in unknown:
                self.words.put(part, parts[part])
            for i in missing:
                if found[i] is None:
                    n = stem(words[i])
                    found[i] = parts[words[i][:n]] + parts[words[i][n:]]
                    self.words.put(words[i], found[i])
        return b"".join(found)


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int, folder: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Encode ``docs`` and write them in ascending order of ``id_col``; returns the manifest (file, part, docs, ids).

    One exchange (a range partitioning by id); encoding and writing happen in the sorted tasks.
    """
    prepare(docs.sparkSession)
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, out, uri = encoder(vocabulary), None, f"{folder}/{uuid.uuid4().hex}.zst"
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                out = out or Writer(uri)
                out.add(doc_id.as_py(), code.encode(text.as_py() or "") + end)
        if out:
            n_docs, n_ids = out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([uri]), pa.array([TaskContext.get().partitionId()], pa.int32()),
                 pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())], ["file", "part", "docs", "ids"])

    rows = docs.select(F.col(id_col).try_cast("long").alias("k"), F.col(text_col).alias("t"))
    # a hash of the text after the id: rows without an id, or with one and the same, are spread like all others
    order = [F.col("k").asc_nulls_first(), F.xxhash64("t"), "t"]
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    manifest = rows.mapInArrow(write, "file string, part int, docs long, ids long")
    return materialise(manifest, "manifest")


def read_tokens(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) and, if wanted, ids of every document, read back from the files.

    The manifest has one row per file; only those rows come to the driver, for the running start of each file.
    """
    spark = manifest.sparkSession
    files, start = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r.part):
        files.append((row.file, start))
        start += row.ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(*(c.to_pylist() for c in batch.columns)):
                source = Reader(uri)
                rows: list[tuple] = []
                for i, ids in source.documents():
                    rows.append((source.ids[i], first + int(source.starts[i]), len(ids), zlib.crc32(ids), ids))
                    if len(rows) == 500:
                        yield _batch(rows, with_ids)
                        rows = []
                if rows:
                    yield _batch(rows, with_ids)
                source.close()

    table = spark.createDataFrame(files, "file string, start long").repartition(max(1, len(files)))
    return table.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"
                            + ", ids array<int>" * with_ids)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    *figures, ids = zip(*rows)
    columns = [pa.array(x, pa.int64()) for x in figures]
    if with_ids:
        columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(
        columns, ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)
