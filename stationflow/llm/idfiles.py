"""Operator 2: token ids in a binary file format with a shared dictionary.

``encode_documents`` orders the documents by id, encodes them and writes files
of chunks. One chunk is a self-contained block of bytes (kept as a binary
Parquet cell, so that any store Spark writes to can hold it):

    magic "SFID0001" | sha256 of the dictionary (32) | bytes per id (u4) |
    documents n (u8) | document ids (i8 x n) | null marks of the ids (u1 x n) |
    ids per document (u4 x n) | frame offsets (u8 x (n + 1)) | frames

Every document is a zstandard frame of its own, compressed with one dictionary
that is trained on the serialized id arrays of a bounded sample of documents.
With the offset index a short document is read by decompressing its frame only,
and the least and greatest document id beside each chunk tell which to open;
the hash in the header refuses a wrong dictionary.

Defined results: a null text has no ids but the end id; a null doc_id sorts
first and stays null; rows that share a doc_id are ordered by their text's hash
(equal rows in any order, which shows nowhere); an empty table gives no chunk;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.store import hash_below, saved
from stationflow.llm.units import units_for

MAGIC = b"SFID0001"
# Documents whose ids the dictionary is trained on (about so many: those whose
# hash lies in the share of hashes that this number is of all documents).
TRAINING_DOCUMENTS = 1000
DICTIONARY_BYTES = 1 << 16
# Id bytes that close a chunk (a longer document has a chunk of its own).
CHUNK_BYTES = 4 << 20
LEVEL = 1

CHUNK_SCHEMA = ("part int, chunk int, start long, n_docs long, n_tokens long, "
                "dict_sha256 string, first_id long, last_id long, payload binary")
ROW_SCHEMA = "doc_id long, part int, start long, n_tokens long, ids binary"


@dataclass(frozen=True)
class Encoding:
    """Which tokenizer file, how its texts split into units, and the end id."""

    path: str
    kind: str
    end_id: int | None = None


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; too few samples to train on are its content."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError, ZeroDivisionError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def pack(doc_ids: list[int | None], arrays: list[np.ndarray], dictionary: bytes, width: int) -> bytes:
    """One chunk of documents."""
    compressor = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=_dictionary(dictionary) if dictionary else None)
    kind = "<u2" if width == 2 else "<u4"
    frames = [compressor.compress(a.astype(kind).tobytes()) for a in arrays]
    n = len(doc_ids)
    return b"".join((
        MAGIC, hashlib.sha256(dictionary).digest(), struct.pack("<IQ", width, n),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "<u1").tobytes(),
        np.array([len(a) for a in arrays], "<u4").tobytes(),
        np.concatenate(([0], np.cumsum([len(f) for f in frames]))).astype("<u8").tobytes(),
        *frames))


class Chunk:
    """Reader of one chunk: the index is parsed, frames only when asked for."""

    def __init__(self, payload: bytes, dictionary: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a chunk of token ids")
        if payload[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("the chunk was written with another dictionary")
        width, n = struct.unpack_from("<IQ", payload, 40)
        at = 52
        self.kind = "<u2" if width == 2 else "<u4"
        ids = np.frombuffer(payload, "<i8", n, at)
        null = np.frombuffer(payload, "<u1", n, at + 8 * n)
        self.doc_ids = [None if x else i for i, x in zip(ids.tolist(), null.tolist())]
        self.sizes = np.frombuffer(payload, "<u4", n, at + 9 * n)
        self.offsets = np.frombuffer(payload, "<u8", n + 1, at + 13 * n).astype(np.int64)
        self.frames = memoryview(payload)[at + 13 * n + 8 * (n + 1):]
        self.decompressor = zstandard.ZstdDecompressor(
            dict_data=_dictionary(dictionary) if dictionary else None)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, i: int) -> np.ndarray:
        frame = self.frames[self.offsets[i]:self.offsets[i + 1]]
        raw = self.decompressor.decompress(frame, max_output_size=int(self.sizes[i]) * 4 + 1)
        return np.frombuffer(raw, self.kind).astype("<u4")


def sample_dictionary(docs: DataFrame, encoding: Encoding, width: int) -> bytes:
    share = TRAINING_DOCUMENTS / max(docs.count(), 1)
    # Equal rows share their hash and count once, so the sample stays near its bound.
    rows = (docs.select("text", F.xxhash64(F.lit("dictionary"), "doc_id", "text").alias("h"))
            .where(hash_below(F.col("h"), share) & (F.length("text") > 0))
            .groupBy("h").agg(F.min("text").alias("text")).orderBy("h").collect())
    units = units_for(encoding.path, encoding.kind)
    kind = "<u2" if width == 2 else "<u4"
    samples = []
    for _, ids, first in units.encode(pa.array([r.text for r in rows], pa.string())):
        samples += [ids[a:b].astype(kind).tobytes() for a, b in zip(first[:-1], first[1:])]
    return train_dictionary(samples)


def encode_documents(docs: DataFrame, encoding: Encoding) -> tuple[DataFrame, bytes]:
    """Write all documents in ascending doc_id order; returns the table of
    chunks as read back, and the dictionary."""
    sc = docs.sparkSession.sparkContext
    width = 2 if units_for(encoding.path, encoding.kind).tokenizer.get_vocab_size() <= 1 << 16 else 4
    dictionary = sample_dictionary(docs, encoding, width)
    shared = sc.broadcast(dictionary)
    name = hashlib.sha256(dictionary).hexdigest()
    end = [] if encoding.end_id is None else [encoding.end_id]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, start = TaskContext.get().partitionId(), 0, 0
        units = units_for(encoding.path, encoding.kind)
        doc_ids, arrays, held = [], [], 0
        tail = np.array(end, "<u4")

        def flush():
            nonlocal chunk, start, doc_ids, arrays, held
            n = sum(map(len, arrays))
            known = [d for d in doc_ids if d is not None]
            row = [part, chunk, start, len(doc_ids), n, name, min(known, default=None), max(known, default=None),
                   pack(doc_ids, arrays, shared.value, width)]
            chunk, start, doc_ids, arrays, held = chunk + 1, start + n, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (
                    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
                    pa.binary()))],
                names=["part", "chunk", "start", "n_docs", "n_tokens", "dict_sha256", "first_id", "last_id",
                       "payload"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, ids, begin in units.encode(batch.column(1)):
                for i in range(len(begin) - 1):
                    a = np.concatenate((ids[begin[i]:begin[i + 1]], tail))
                    doc_ids.append(keys[first + i])
                    arrays.append(a)
                    held += width * len(a)
                    if held >= CHUNK_BYTES:
                        yield flush()
        if doc_ids:
            yield flush()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    return saved(ordered.mapInArrow(write, CHUNK_SCHEMA), "id_files"), dictionary


def read_documents(chunks: DataFrame, dictionary: bytes, then=lambda batches: batches,
                   schema: str = ROW_SCHEMA) -> DataFrame:
    """All documents of the files: doc_id, part, start, n_tokens, ids (little-endian
    unsigned 32-bit). ``start`` counts the ids of all documents before it. Only
    one total per part is brought to the driver. ``then`` may turn the batches
    into others of ``schema`` in the same step."""
    sc = chunks.sparkSession.sparkContext
    totals = chunks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, before = {}, 0
    for r in totals:
        base[r.part] = before
        before += r.n
    shared = sc.broadcast((dictionary, base))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, base = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["payload"], dictionary)
                sizes = c.sizes.astype(np.int64)
                starts = base[row["part"]] + row["start"] + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.doc_ids, pa.int64()), pa.array([row["part"]] * len(c), pa.int32()),
                     pa.array(starts), pa.array(sizes),
                     pa.array([c.ids(i).tobytes() for i in range(len(c))], pa.binary())],
                    names=["doc_id", "part", "start", "n_tokens", "ids"])

    return chunks.select("part", "chunk", "start", "payload").mapInArrow(
        lambda batches: then(read(batches)), schema)


def read_document(chunks: DataFrame, dictionary: bytes, doc_id: int) -> list[np.ndarray]:
    """The ids of one document, decompressing its own frames only, in the tasks.
    Chunks whose range of document ids leaves it out are not unpacked."""
    shared = chunks.sparkSession.sparkContext.broadcast(dictionary)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["payload"], shared.value)
                at = [i for i, d in enumerate(c.doc_ids) if d == doc_id]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(at), pa.int32()), pa.array([row["chunk"]] * len(at), pa.int32()),
                     pa.array(at, pa.int32()), pa.array([c.ids(i).tobytes() for i in at], pa.binary())],
                    names=["part", "chunk", "place", "ids"])

    rows = (chunks.where(F.lit(doc_id).between(F.col("first_id"), F.col("last_id")))
            .select("part", "chunk", "payload")
            .mapInArrow(find, "part int, chunk int, place int, ids binary").collect())
    return [np.frombuffer(r.ids, "<u4") for r in sorted(rows, key=lambda r: (r.part, r.chunk, r.place))]


def op2_token_files(spark: SparkSession, docs: DataFrame, encoding: Encoding) -> DataFrame:
    """Contract columns from the files read back: the digest of each document's ids."""
    chunks, dictionary = encode_documents(docs, encoding)

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = [zlib.crc32(x.as_py()) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_documents(chunks, dictionary, then=crc,
                          schema="doc_id long, start long, n_tokens long, ids_crc32 long")
