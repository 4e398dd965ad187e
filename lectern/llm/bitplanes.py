"""Token ids in files of compressed bit planes.

A file holds the ids of consecutive documents, cut into chunks of a fixed number of ids. A chunk's
ids are transposed into byte planes (all lowest bytes, all second bytes, ...) or bit planes, and
each plane is compressed with zstandard by itself; the high planes of frequent ids are nearly empty. After the
chunks comes the index (chunk offsets and the documents' ids and lengths), then a trailer of
TRAILER bytes that tells where the index begins. Every part ends in a line feed, which lets Spark's
text writer store the bytes on any file system and commit them by task; all integers are
little-endian.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.words import blocks

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
CHUNK = 1 << 16
FILE_BYTES = 64 << 20
LEVEL = 3
CHUNK_MAGIC, INDEX_MAGIC = b"BPLC", b"BPLI"
TRAILER = struct.Struct("<Q4sx")
#: Words that a worker remembers at most; others are encoded each time.
KNOWN_WORDS = 1_000_000

_latin = bytes(range(256)).decode("latin-1")
#: Lower case within Latin-1, where it is one letter for one.
LOWER = bytes(ord(c.lower()) if len(c.lower()) == 1 and ord(c.lower()) < 256 else ord(c) for c in _latin)
LETTERS = "a-z\xdf-\xf6\xf8-\xff"
#: A word and the marks that end it: the tokenizer always cuts between the two.
CORE = re.compile(rf"([{LETTERS}]+)([.,!?;:|]*)\Z")

_encoders: dict = {}


class Encoder(dict):
    """Ids of whole texts as the tokenizer gives them, without special tokens.

    A text within Latin-1 is cut at white space, which the tokenizer drops, and each word's ids
    are looked up here; a new word of letters and ending marks goes to the tokenizer's model,
    any other word through the whole tokenizer. Texts with other characters, or with a special
    token's brackets, are encoded whole. The values are ids as 32-bit integers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters = re.findall(f"[{LETTERS}]", _latin)
        # the model sees the characters that stand for a letter's UTF-8 bytes
        self.shown = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("latin-1")
        match = CORE.match(text)
        if not match:
            ids = self._whole([text])[0]
        elif match[2]:
            ids = self[match[1].encode("latin-1")] + self._part(match[2])
        else:
            ids = self._part(text.translate(self.shown))
        if len(self) < KNOWN_WORDS:
            self[word] = ids
        return ids

    def _part(self, shown: str) -> bytes:
        return np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def texts(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            try:
                plain = text.encode("latin-1") if "<|" not in text else None
            except UnicodeEncodeError:
                plain = None
            out.append(self._whole([text])[0] if plain is None else b"".join(map(self.__getitem__, plain.translate(LOWER).split())))
        return out


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(ids: np.ndarray, planes: str = "byte") -> bytes:
    """One chunk: magic, number of ids, bits a plane (8 or 1), number of planes, compressed sizes,
    the planes from the lowest up. Planes that hold only zeros above the highest bit are left out."""
    width = {"byte": 8, "bit": 1}[planes]
    count = -(-int(ids.max()).bit_length() // width) if len(ids) else 0
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if width == 8:
        rows = [table[:, k].tobytes() for k in range(count)]
    else:
        bits = np.unpackbits(table[:, : -(-count // 8)], axis=1, bitorder="little")
        rows = [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(count)]
    press = zstandard.ZstdCompressor(level=LEVEL)
    small = [press.compress(x) for x in rows]
    return CHUNK_MAGIC + struct.pack("<IBB", len(ids), width, count) + np.array([len(x) for x in small], "<u4").tobytes() + b"".join(small)


def unpack(data: memoryview) -> np.ndarray:
    if bytes(data[:4]) != CHUNK_MAGIC:
        raise ValueError("no chunk begins here")
    n, width, count = struct.unpack_from("<IBB", data, 4)
    sizes = np.frombuffer(data, "<u4", count, 10)
    at, table = 10 + 4 * count, np.zeros((n, 4 * 8 // width), np.uint8)
    for k, size in enumerate(sizes):
        plane = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data[at : at + size]), max_output_size=n), np.uint8)
        table[:, k] = plane if width == 8 else np.unpackbits(plane, count=n, bitorder="little")
        at += size
    return (table if width == 8 else np.packbits(table, axis=1, bitorder="little")).view("<u4").ravel()


def file_parts(batches: Iterator[tuple[list, list[bytes]]], part: int) -> Iterator[bytes]:
    """Chunks, index and trailer of one file. batches: document ids (None: null) and their token ids."""
    held, held_n, at = [], 0, 0
    offsets, names, lengths = [], [], []
    for docs, coded in batches:
        names += docs
        lengths += [len(c) // 4 for c in coded]
        held.append(np.frombuffer(b"".join(coded), "<u4"))
        held_n += len(held[-1])
        if held_n >= CHUNK:
            ids = np.concatenate(held)
            full = held_n // CHUNK * CHUNK
            for i in range(0, full, CHUNK):
                yield (chunk := pack(ids[i : i + CHUNK]))
                offsets.append(at)
                at += len(chunk) + 1
            held, held_n = [ids[full:]], held_n - full
    if not names:
        return
    if held_n:
        yield (chunk := pack(np.concatenate(held)))
        offsets.append(at)
        at += len(chunk) + 1
    nulls = np.array([x is None for x in names], np.uint8)
    table = [np.array(offsets, "<i8"), np.array([0 if x is None else x for x in names], "<i8"), nulls, np.array(lengths, "<i8")]
    yield INDEX_MAGIC + struct.pack("<III", part, len(offsets), len(names)) + b"".join(x.tobytes() for x in table)
    yield TRAILER.pack(at, INDEX_MAGIC)[:-1]


def read_file(data: bytes) -> tuple[int, list, np.ndarray, Iterator[np.ndarray]]:
    """Part number, document ids, their lengths, and the ids of each document in turn."""
    at, magic = TRAILER.unpack(data[-TRAILER.size :])
    if magic != INDEX_MAGIC or data[at : at + 4] != INDEX_MAGIC:
        raise ValueError("no index where the trailer says")
    part, n_chunks, n_docs = struct.unpack_from("<III", data, at + 4)
    at += 16
    offsets = np.frombuffer(data, "<i8", n_chunks, at)
    names = np.frombuffer(data, "<i8", n_docs, at + 8 * n_chunks)
    nulls = np.frombuffer(data, np.uint8, n_docs, at + 8 * (n_chunks + n_docs))
    lengths = np.frombuffer(data, "<i8", n_docs, at + 8 * (n_chunks + n_docs) + n_docs)

    def documents() -> Iterator[np.ndarray]:
        view, nxt, rest = memoryview(data), 0, np.zeros(0, "<u4")
        for n in lengths:
            have = [rest]
            held = len(rest)
            while held < n:
                have.append(unpack(view[offsets[nxt] :]))
                held, nxt = held + len(have[-1]), nxt + 1
            rest = np.concatenate(have) if len(have) > 1 else rest
            yield rest[:n]
            rest = rest[n:]

    return part, [None if z else int(x) for x, z in zip(names, nulls)], lengths, documents()


def write(docs: DataFrame, path: str, tokenizer: str, file_bytes: int = FILE_BYTES) -> None:
    """Token ids of all rows in ascending doc_id order (null first, equal ids by text), END_ID after each.

    A null text is END_ID alone; no rows write no file. Rows are dealt by ranges of doc_id into
    about one file for `file_bytes` of text; rows of one doc_id stay in one file.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(max(least, -(-total // file_bytes)), "doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)

        def coded():
            for batch in batches:
                names, texts = batch.column(0).to_pylist(), batch.column(1)
                sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
                for a, b in blocks(sizes):
                    words = [t or "" for t in texts.slice(a, b - a).to_pylist()]
                    yield names[a:b], [c + end for c in coder.texts(words)]

        for part in file_parts(coded(), TaskContext.get().partitionId()):
            yield pa.record_batch([pa.array([part], pa.binary())], ["value"])

    packed = dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    packed.write.option("lineSep", "\n").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 for each document in the files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                part, names, lengths, documents = read_file(content)
                yield pd.DataFrame({
                    "part": part, "doc_id": pd.array(names, "Int64"), "first": np.cumsum(lengths) - lengths, "n_tokens": lengths,
                    "ids_crc32": [zlib.crc32(np.ascontiguousarray(ids, "<u4")) for ids in documents]})

    files = spark.read.format("binaryFile").load(path).select("content")
    found = files.mapInPandas(run, "part int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return found.join(bases, "part").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
