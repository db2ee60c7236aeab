"""Operator 3: token ids in a binary format with directly addressable codes.

An id is cut into 8-bit chunks. Level k holds chunk k of every id that has one,
and a bitmap that says which ids go on; the rank of a bit in the bitmap is the
id's place in the next level. A rank directory (ones before each 512 bits)
makes the rank, and so any token of a segment, a matter of a few look-ups: no
block is decoded.

A segment is the ids of whole consecutive documents, about SEGMENT_TOKENS of
them, and is one binary value of a Parquet table that Spark writes and commits,
with the documents' ids and places beside it:

    magic "DAC1" | count u64 | levels u32 | per level: size u64, chunks, bitmap, directory u32s

Edge cases: a null or empty text is its end id alone. Documents are in order of
id, null ids first; equal ids keep one row each, in the order of their texts.
An empty table gives no segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import word_ids

#: A segment ends with the document that reaches this many ids.
SEGMENT_TOKENS = 1 << 20
#: Bits between two entries of the rank directory.
RANK_STEP = 512

SEGMENT_SCHEMA = (
    "part int, segment int, first bigint, n_tokens bigint, doc_ids array<bigint>, starts array<bigint>, codes binary"
)


def encode(ids: np.ndarray) -> bytes:
    """The binary form of unsigned ids below 2^32."""
    rest = np.ascontiguousarray(ids, np.uint32)
    levels = []
    while len(rest) or not levels:
        goes_on = rest > 0xFF
        bits = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-len(rest) // RANK_STEP) * RANK_STEP, bool)
        padded[: len(rest)] = goes_on
        ones = padded.reshape(-1, RANK_STEP).sum(1, dtype=np.uint32)
        directory = np.concatenate([[0], np.cumsum(ones)]).astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + directory.tobytes())
        rest = rest[goes_on] >> 8
    return b"DAC1" + struct.pack("<QI", len(ids), len(levels)) + b"".join(levels)


class Codes:
    """Random and sequential access to an encoded segment; nothing is copied."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"DAC1":
            raise ValueError("not a segment of directly addressable codes")
        self.count, n = struct.unpack_from("<QI", raw, 4)
        at, self.levels = 16, []
        for _ in range(n):
            (size,) = struct.unpack_from("<Q", raw, at)
            at += 8
            chunks = np.frombuffer(raw, np.uint8, size, at)
            at += size
            bits = np.frombuffer(raw, np.uint8, -(-size // 8), at)
            at += len(bits)
            directory = np.frombuffer(raw, "<u4", -(-size // RANK_STEP) + 1, at)
            at += 4 * len(directory)
            self.levels.append((chunks, bits, directory))

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, index: int) -> int:
        """The id at one place: a chunk, a bit and a rank on each level that it reaches."""
        if not 0 <= index < self.count:
            raise IndexError(index)
        value = 0
        for level, (chunks, bits, directory) in enumerate(self.levels):
            value |= int(chunks[index]) << 8 * level
            if not bits[index >> 3] >> (index & 7) & 1:
                break
            block = index // RANK_STEP
            inside = np.unpackbits(bits[block * RANK_STEP // 8 : (index >> 3) + 1], bitorder="little")
            index = int(directory[block]) + int(inside[: index - block * RANK_STEP].sum())
        return value

    def all(self) -> np.ndarray:
        values = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            this = chunks.astype(np.uint32)
            if len(values):
                this[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)] |= values << 8
            values = this
        return values


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, partitions: int | None = None) -> None:
    """Encode every whole text, append ``end_id``, and write the segments to ``path`` in order of doc_id.

    One shuffle, by ranges of doc_id; a task holds one segment at a time.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        end = struct.pack("<I", end_id)
        part, doc_ids, starts, parts, size, done, number = None, [], [], [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            codes = encode(np.frombuffer(b"".join(parts), "<u4"))
            row = [part, number, done, size, doc_ids, starts, codes]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, TYPES)], names=NAMES)

        for batch in batches:
            for this, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                part = this
                ids = words.encode((text or "").encode()) + end
                doc_ids.append(doc)
                starts.append(size)
                parts.append(ids)
                size += len(ids) // 4
                if size >= SEGMENT_TOKENS:
                    yield segment()
                    done, number, doc_ids, starts, parts, size = done + size, number + 1, [], [], [], 0
        if doc_ids:
            yield segment()

    (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
        .mapInArrow(segments, SEGMENT_SCHEMA)
        .write.parquet(path)
    )


TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
NAMES = ["part", "segment", "first", "n_tokens", "doc_ids", "starts", "codes"]


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the number of ids in all segments before.

    The running total goes over one row per part of the range partitioning, so
    its size, and that of the broadcast, is the number of partitions of the job
    that wrote the files.
    """
    from pyspark.sql import Window

    files = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(parts), "part").withColumn("start", F.col("base") + F.col("first")).drop("base")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, and nothing that was not read from the files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, doc_ids, starts, raw in zip(*(batch.column(i) for i in range(4))):
                ids = Codes(raw.as_py()).all()
                at = np.array(starts.as_py() + [len(ids)], np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:])]
                yield pa.record_batch(
                    [doc_ids.values, pa.array(at[:-1] + start.as_py()), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return (
        read_segments(spark, path)
        .select("start", "doc_ids", "starts", "codes")
        .mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """(place, token) for rows of ``places`` (column ``place``: index in the whole token stream).

    Each place finds its segment by a range join on the running totals, then its
    token by ranks; places outside the stream and nulls give no row.
    """

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, raw, wanted in zip(*(batch.column(i) for i in range(3))):
                codes, at = Codes(raw.as_py()), wanted.as_py()
                yield pa.record_batch([pa.array(at, pa.int64()), pa.array([codes[p - start.as_py()] for p in at], pa.int64())], names=["place", "token"])

    segments = read_segments(spark, path)
    spans = segments.select("part", "segment", "start", (F.col("start") + F.col("n_tokens")).alias("stop"))
    hits = places.select(F.col("place").cast("bigint")).join(spans, F.expr("place >= start and place < stop"))
    wanted = hits.groupBy("part", "segment").agg(F.collect_list("place").alias("wanted"))
    return segments.join(wanted, ["part", "segment"]).select("start", "codes", "wanted").mapInArrow(look_up, "place bigint, token bigint")
