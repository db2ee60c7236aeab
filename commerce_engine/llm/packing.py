"""Operator 6: best-fit decreasing packing of token pieces into sequences.

Texts are tokenised and cut into pieces of at most the sequence length; only
longer documents are cut. Pieces are dealt at random into groups of bounded size
and each group is packed by itself: pieces go in order of falling length into
the open sequence with the least room that still takes them. A segment tree over
the capacities 0..length finds that sequence in logarithmic time. A group of
GROUP_PIECES pieces leaves at most a few sequences unfilled, so the whole comes
within a fraction of a per cent of one global packing, while no task holds more
than one group.

A table whose row order says something (the mix of a corpus) is packed in that
order instead: group g holds the pieces g * GROUP_PIECES and on, counted along the
rows, and its sequences have the ids from g * GROUP_PIECES on, in a random order
within the group. So sequences read by their ids follow the order of the rows but
for the places within one group. The ids leave gaps between groups.

Edge cases: a null or empty text is its end id alone; null ids and repeated rows
are packed like any other; ties in length go by doc_id and piece; an empty table
gives no row. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import written
from .tokens import word_ids

#: Pieces packed together in one task, about.
GROUP_PIECES = 50_000
#: Rows of a file that are numbered together.
BUCKET_ROWS = 4096

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


#: Where a table's row stands.
PLACE = ", file string, row bigint"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int, with_ids: bool = False, with_place: bool = False) -> DataFrame:
    """The pieces of every document, with their ids (little-endian u32) or their row's file and index if asked for. No shuffle.

    ``with_place`` needs the read of a table, as :func:`as_table` gives it.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, step = word_ids(tokenizer), struct.pack("<I", end_id), 4 * length
        for batch in batches:
            rows, of = [], []
            for at_row, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                ids = words.encode((text or "").encode()) + end
                for i, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc, i, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                    of.append(at_row)
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            keep = 6 if with_ids else 5
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:keep]
            made = [pa.array(c, t) for c, t in zip(columns, types)][:keep]
            if with_place:
                made += [batch.column(c).take(pa.array(of, pa.int64())) for c in (2, 3)]
                names += ["file", "row"]
            yield pa.record_batch(made, names=names)

    place = ["_metadata.file_path", "_metadata.row_index"] if with_place else []
    schema = PIECES + (", ids binary" if with_ids else "") + (PLACE if with_place else "")
    return docs.select(F.col("doc_id").cast("bigint"), "text", *place).mapInArrow(cut, schema)


def as_table(docs: DataFrame) -> DataFrame:
    """docs as the plain read of a table, whose files know the place of each row; any other frame is written, in its order."""
    plain = docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    return docs if plain else written(docs.select("doc_id", "text"), "ordered")


def numbered(parts: DataFrame) -> DataFrame:
    """parts with ``number``: the place of each piece in the order of file, row and piece, from 0.

    Files go by the number that Spark's writer gives them, then by path. Counts of
    a bucket of rows give the number at which the next one begins.
    """
    parts = parts.withColumn("bucket", F.expr(f"row div {BUCKET_ROWS}"))
    written_as = F.lpad(F.regexp_extract("file", r"part-(\d+)[^/]*$", 1), 10, "0")
    before = Window.orderBy(written_as, "file", "bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    starts = parts.groupBy("file", "bucket").count().select("file", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin"))
    inside = F.row_number().over(Window.partitionBy("file", "bucket").orderBy("row", "piece")) - 1
    joined = parts.withColumn("inside", inside).join(starts, ["file", "bucket"])
    return joined.withColumn("number", F.col("begin") + F.col("inside")).drop("file", "row", "bucket", "begin", "inside")


class OpenBins:
    """Segment tree over room 0..capacity: is there an open bin with that room, and which is tightest."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        at = self.size + room
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The bin with the least room >= need, taken out: (room, number)."""
        at = self.size + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the given order of equals."""
    order = np.argsort(-lengths, kind="stable")
    numbers, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins, bins = OpenBins(capacity), 0
    for i, need in zip(order.tolist(), lengths[order].tolist()):
        if not 0 <= need <= capacity:
            raise ValueError(f"a piece of {need} does not fit into {capacity}")
        found = open_bins.take(need)
        if found is None:
            found, bins = (capacity, bins), bins + 1
        room, number = found
        numbers[i], offsets[i] = number, capacity - room
        open_bins.add(room - need, number)
    return numbers, offsets


RESULT = PIECES + ", sequence_id bigint, offset bigint"


def pack(parts: DataFrame, length: int, group_pieces: int | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces (columns doc_id, piece, length and any others).

    ``parts`` is the read of a written table. The number of groups follows from a
    count of the pieces; the deal is by a hash of each row's values and of its place
    in the table, so groups are alike, also when ids or whole rows repeat, and a rerun
    over the same files and splits gives the same.
    """
    groups = max(1, -(-parts.count() // (group_pieces or GROUP_PIECES)))
    schema = StructType([*parts.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        numbers, offsets = best_fit_decreasing(group["length"].to_numpy(), length)
        number = key[0].as_py()
        group = group.drop_columns(["pack_group"])
        return group.append_column("sequence_id", pa.array(numbers * groups + number)).append_column("offset", pa.array(offsets))

    place_of = [F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1), F.col("_metadata.row_index")]
    key = F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32", *place_of)
    dealt = parts.withColumn("pack_group", F.pmod(key, F.lit(groups)))
    return dealt.groupBy("pack_group").applyInArrow(place, schema)


def pack_in_order(parts: DataFrame, length: int, group_pieces: int | None = None) -> DataFrame:
    """:func:`pack` for pieces with file and row, which go: groups are contiguous ranges of the row order, ids rise with the groups."""
    size = group_pieces or GROUP_PIECES

    def place(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("number")
        numbers, offsets = best_fit_decreasing(group["length"].to_numpy(), length)
        number = key[0].as_py()
        # Bins open in order of falling length: without a shuffle long documents, and their sources, would come first.
        shuffled = np.random.default_rng(number).permutation(int(numbers.max()) + 1)
        group = group.drop_columns(["pack_group", "number"])
        return group.append_column("sequence_id", pa.array(number * size + shuffled[numbers])).append_column("offset", pa.array(offsets))

    dealt = numbered(parts).withColumn("pack_group", F.expr(f"number div {size}"))
    return dealt.groupBy("pack_group").applyInArrow(place, RESULT)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, length: int, in_order: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The pieces (a few numbers each) are written once, so texts are tokenised once.
    With ``in_order`` the sequences follow the order of the rows of ``docs``.
    """
    if in_order:
        return pack_in_order(written(pieces(as_table(docs), tokenizer, end_id, length, with_place=True), "pieces"), length)
    return pack(written(pieces(docs, tokenizer, end_id, length), "pieces"), length)
