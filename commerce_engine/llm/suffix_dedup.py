"""Operator 2: removal of repeated byte strings with suffix arrays.

Every byte that lies in a string of LENGTH bytes which also starts earlier (in a
document before it in order of id, or in the same document) is removed. Strings
are judged on the input.

1. Texts are written once as a table bucketed by shard, so the passes over them
   join small facts without shuffling the texts again. A text equal to that of an
   earlier document is a copy: one rule for the whole of it, and no further work.
2. In each window of LENGTH bytes the GRAM-byte string with the least hash is its
   anchor. Equal windows have equal anchors, so a window whose anchor hash occurs
   once in the corpus repeats nowhere. Shards send their distinct anchor hashes, and
   learn which of them other shards hold as well.
3. Only stretches of text around repeated anchors go on. They are dealt by the least
   anchor of their document, which brings near copies together, into shards of at most
   SHARD_BYTES. Each shard sorts its suffixes by Larsson-Sadakane refinement and groups
   equal windows by Kasai common prefixes; all but the first of a group are repeats.
4. The windows that are first in their shard meet those of other shards by anchor:
   each one is looked up by binary search in the merged, sorted windows of all shards,
   compared byte by byte with what it finds, and is a repeat unless it is the earliest.
5. Repeats go back to their texts as intervals, are united and cut out.

Ties and gaps: documents without an id come first, rows with equal ids are in order
of their texts, and of equal rows the first stays: such tables are numbered anew
before step 1. A null text is empty. A text shorter than LENGTH loses nothing. An
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written
from .suffixes import common_prefixes, ordered
from .text_arrays import U64, mix

LENGTH = 100
GRAM = 32
SHARD_BYTES = 1 << 20
#: Shards of texts in one shuffle partition; a task of steps 2 and 5 holds one at a time.
SHARDS = 4
#: Bytes of one family of near copies that one task sorts, shard after shard.
FAMILY_BYTES = 32 << 20

_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(1, 2**63, 4, dtype=U64) * U64(2) + U64(1)
_BASE = 0xD1342543DE82EF95
_PLACE = U64((1 << 24) - 1)
_CHUNK = 1 << 23  # places of a text that are numbered at once


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, number of windows, anchor hash.

    A window is the LENGTH bytes from a place; its anchor is the least, then
    leftmost, hash of the GRAM-byte strings in it.
    """
    n = len(text)
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(U64)
    if n > _CHUNK:
        parts = []
        for a in range(0, n - LENGTH + 1, _CHUNK - LENGTH + 1):
            first, count, value = anchors(text[a : a + _CHUNK])
            parts.append((first + a, count, value))
        return tuple(np.concatenate(p) for p in zip(*parts))
    words = np.ndarray((n - 7,), "<u8", text.data, strides=(1,))
    m = n - GRAM + 1
    h = words[:m] * _FACTORS[0]
    for k in range(1, 4):
        h ^= h >> U64(29)
        h += words[8 * k : 8 * k + m] * _FACTORS[k]
    h = mix(h)
    least = (h & ~_PLACE) | np.arange(m, dtype=U64)
    width = LENGTH - GRAM + 1
    done = 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: -(width - done)], least[width - done :])
    place = (least & _PLACE).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    return first, np.diff(np.append(first, len(place))), h[place[first]]


def bytes_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint8) if v.is_valid else np.zeros(0, np.uint8) for v in column]


def unite(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, sorted; touching ones are joined."""
    if not len(start):
        return start, end
    at = np.argsort(start, kind="stable")
    start, end = start[at], np.maximum.accumulate(end[at])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def numbered(docs: DataFrame) -> DataFrame:
    """place, doc_id, text (bytes): place is a unique number in the order of the documents; doc_id itself where that will do."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    again = docs.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).count().where("doc_id is null or count > 1")
    if again.isEmpty():
        return rows.select(F.col("doc_id").alias("place"), "doc_id", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = rows.repartitionByRange(n, "doc_id", F.sha2("text", 256)).sortWithinPartitions("doc_id", F.sha2("text", 256))
    return written(in_order.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text"), "numbered")


def shard_of(spark: SparkSession, n: int) -> Column:
    """The shard of a place: SHARDS numbers for each of n buckets, all of which Spark's hash sends there."""
    number = F.col("id").cast("int")
    sent = spark.range(40 * SHARDS * n + 1000).groupBy(F.pmod(F.hash(number), F.lit(n)).alias("bucket"))
    taken = sent.agg(F.expr(f"slice(array_sort(collect_list(cast(id as int))), 1, {SHARDS})").alias("numbers")).collect()
    numbers = [x for r in sorted(taken, key=lambda r: r["bucket"]) for x in r["numbers"]]
    return F.element_at(F.array(*map(F.lit, numbers)), (F.pmod(F.xxhash64("place"), F.lit(len(numbers))) + 1).cast("int"))


def bucketed(docs: DataFrame, n: int, shard: Column) -> DataFrame:
    """The texts as a table bucketed by shard: (shard, place, doc_id, key, text)."""
    spark = docs.sparkSession
    name = f"texts_{uuid.uuid4().hex}"
    rows = numbered(docs).withColumn("shard", shard)
    rows = rows.select("shard", "place", "doc_id", F.sha2("text", 256).alias("key"), "text").repartition(n, "shard")
    rows.write.option("path", scratch_path(spark, name)).bucketBy(n, "shard").sortBy("shard").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files, and the plan that reads them, stay
    return table


def hash_rows(texts: DataFrame, copies: DataFrame, n: int) -> DataFrame:
    """(bucket, shard, hashes): the distinct anchor hashes of each shard, dealt by value into n buckets."""

    def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        skip = set(right["place"].to_pylist())
        found = [np.zeros(0, U64)]
        for place, text in zip(left["place"].to_pylist(), bytes_of(left["text"])):
            if place not in skip:
                found.append(anchors(text)[2])
        values = np.unique(np.concatenate(found))
        bucket = (values % U64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        values, edges = values[order], np.searchsorted(bucket[order], np.arange(n + 1))
        rows = [(b, values[i:j].tobytes()) for b, (i, j) in enumerate(zip(edges.tolist(), edges[1:].tolist())) if j > i]
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in rows], pa.int32()),
                "shard": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "hashes": pa.array([h for _, h in rows], pa.binary()),
            }
        )

    return texts.groupBy("shard").cogroup(copies.groupBy("shard")).applyInArrow(work, "bucket int, shard int, hashes binary")


def common_hashes(hashes: DataFrame) -> DataFrame:
    """(shard, hashes): the hashes of a shard that another shard has too."""

    def work(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(h, U64) for h in group["hashes"].to_pylist()]
        every = np.sort(np.concatenate(parts))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        kept = []
        for p in parts:
            at = np.searchsorted(twice, p)
            kept.append(p[twice[np.minimum(at, len(twice) - 1)] == p].tobytes() if len(twice) else b"")
        return pa.table({"shard": group["shard"], "hashes": pa.array(kept, pa.binary())})

    return hashes.groupBy("bucket").applyInArrow(work, "shard int, hashes binary")


STRETCHES = "family bigint, place bigint, starts binary, lengths binary, first binary, count binary, anchor binary, text binary"


def stretches(texts: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per text with repeated anchors: its stretches around them and their runs of windows."""

    def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        skip = set(right["place"].drop_null().to_pylist())
        known = [np.frombuffer(h, U64) for h in right["hashes"].drop_null().to_pylist()]
        runs = []
        for place, text in zip(left["place"].to_pylist(), bytes_of(left["text"])):
            if place not in skip and len(text) >= LENGTH:
                runs.append((place, text, *anchors(text)))
        own = np.sort(np.concatenate([r[4] for r in runs] + [np.zeros(0, U64)]))
        repeated = np.unique(np.concatenate([*known, own[1:][own[1:] == own[:-1]]])) if len(own) else own
        rows = []
        for place, text, first, count, value in runs:
            at = np.minimum(np.searchsorted(repeated, value), max(len(repeated) - 1, 0))
            hit = repeated[at] == value if len(repeated) else np.zeros(len(value), bool)
            if not hit.any():
                continue
            first, count, value = first[hit], count[hit], value[hit]
            a, b = unite(first, first + count + LENGTH - 1)
            cut = np.concatenate([text[i:j] for i, j in zip(a.tolist(), b.tolist())])
            family = int(value.min().view(np.int64))
            rows.append((family, place, a.tobytes(), (b - a).tobytes(), first.tobytes(), count.tobytes(), value.tobytes(), cut.tobytes()))
        names = [c.split()[0] for c in STRETCHES.split(", ")]
        columns = list(zip(*rows)) if rows else [()] * 8
        return pa.table({n: pa.array(c, pa.int64() if i < 2 else pa.binary()) for i, (n, c) in enumerate(zip(names, columns))})

    return texts.groupBy("shard").cogroup(facts.groupBy("shard")).applyInArrow(work, STRETCHES)


FOUND = "place bigint, start bigint, stop bigint, anchor bigint, text binary"


def repeats_in(rows: list[dict]) -> pa.RecordBatch:
    """One shard: intervals of repeats (anchor null), and segments of first windows (anchor, text).

    Windows are numbered in the order of (place, start), so the first of a group is the least.
    """
    rows = sorted(rows, key=lambda r: r["place"])
    parts = [{k: np.frombuffer(r[k], np.uint8 if k == "text" else U64 if k == "anchor" else np.int64) for k in ("starts", "lengths", "first", "count", "anchor", "text")} for r in rows]
    base = np.concatenate([[0], np.cumsum([len(p["text"]) for p in parts])])
    text = np.concatenate([p["text"] for p in parts])
    # Stretches: where each begins in the shard, and how far that is from its place in its text.
    stretch_at = np.concatenate([base[k] + np.cumsum(p["lengths"]) - p["lengths"] for k, p in enumerate(parts)])
    stretch_shift = stretch_at - np.concatenate([p["starts"] for p in parts])
    stretch_place = np.repeat(np.array([r["place"] for r in rows], np.int64), [len(p["starts"]) for p in parts])
    known = np.concatenate([[0], np.cumsum([len(p["starts"]) for p in parts])])
    which = np.concatenate([known[k] + np.searchsorted(p["starts"], p["first"], "right") - 1 for k, p in enumerate(parts)])
    run_at = np.concatenate([p["first"] for p in parts]) + stretch_shift[which]
    run_n = np.concatenate([p["count"] for p in parts])
    run_value = np.concatenate([p["anchor"] for p in parts])

    marks = np.zeros(len(text) + 1, np.int64)
    marks[run_at] += 1
    np.subtract.at(marks, run_at + run_n, 1)
    window = np.cumsum(marks[:-1]) > 0
    order = ordered(text, LENGTH)
    order = order[window[order]]
    same = common_prefixes(text, order, LENGTH) >= LENGTH
    group = np.flatnonzero(~same)
    first = np.repeat(np.minimum.reduceat(order, group), np.diff(np.append(group, len(order))))
    repeat = np.zeros(len(text), bool)
    repeat[order[order != first]] = True

    # Bytes under a repeat, as intervals; a window never leaves its stretch, but stretches touch.
    at = np.flatnonzero(repeat)
    stretch = np.searchsorted(stretch_at, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] > at[:-1] + LENGTH) | (stretch[1:] != stretch[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at))[: len(heads)] - 1
    shift = stretch_shift[stretch[heads]]
    spans = (stretch_place[stretch[heads]], at[heads] - shift, at[tails] + LENGTH - shift)

    # Of each run, the windows from its first to its last one that is no repeat.
    slots = np.arange(len(text))
    following = np.minimum.accumulate(np.where(repeat, len(text), slots)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(repeat, -1, slots))
    low, high = following[run_at], before[run_at + run_n - 1]
    some = low <= high
    low, high, run_stretch = low[some], high[some], which[some]
    size = high + LENGTH - low
    ends = np.cumsum(size)
    inside = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
    raw = text[np.repeat(low, size) + inside]
    segments = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(raw)])
    shift = stretch_shift[run_stretch]
    columns = [np.concatenate(c) for c in zip(spans, (stretch_place[run_stretch], low - shift, high + 1 - shift))]
    anchor = pa.concat_arrays([pa.nulls(len(heads), pa.int64()), pa.array(run_value[some].view(np.int64))])
    strings = pa.concat_arrays([pa.nulls(len(heads), pa.binary()), segments])
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), anchor, strings], names=["place", "start", "stop", "anchor", "text"])


def shard_repeats(rows: DataFrame) -> DataFrame:
    """Step 3 over all stretches. A family above FAMILY_BYTES is dealt to several tasks."""
    sizes = rows.groupBy("family").agg(F.sum(F.octet_length("text")).alias("size")).where(F.col("size") > FAMILY_BYTES)
    parts = F.coalesce(F.ceil(F.col("size") / FAMILY_BYTES).cast("bigint"), F.lit(1))
    dealt = rows.join(sizes, "family", "left").withColumn("salt", F.pmod(F.xxhash64("place"), parts)).drop("size")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and size + len(row["text"]) > SHARD_BYTES:
                    yield repeats_in(held)
                    held, size = [], 0
                if len(row["text"]) > SHARD_BYTES:
                    yield from long_text(row)
                    continue
                held.append(row)
                size += len(row["text"])
        if held:
            yield repeats_in(held)

    dealt = dealt.repartition("family", "salt").sortWithinPartitions("family", "salt", "place")
    return dealt.select(*[c.split()[0] for c in STRETCHES.split(", ")]).mapInArrow(work, FOUND)


def long_text(row: dict) -> Iterator[pa.RecordBatch]:
    """A text of more than a shard: its runs in several shards, compared with each other in step 4."""
    starts, lengths = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["lengths"], np.int64)
    first, count, value = np.frombuffer(row["first"], np.int64), np.frombuffer(row["count"], np.int64), np.frombuffer(row["anchor"], U64)
    base = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    which = np.searchsorted(starts, first, "right") - 1
    at, text = base[which] + first - starts[which], row["text"]
    i = 0
    while i < len(first):
        j = i + 1
        while j < len(first) and at[j] + count[j] + LENGTH - at[i] <= SHARD_BYTES // 2:
            j += 1
        lo, hi = int(at[i]), int(at[j - 1] + count[j - 1] + LENGTH - 1)
        inside = np.arange(which[i], which[j - 1] + 1)
        s = np.maximum(starts[inside], starts[inside] + lo - base[inside])
        e = np.minimum(starts[inside] + lengths[inside], starts[inside] + hi - base[inside])
        yield repeats_in(
            [{"place": row["place"], "starts": s.tobytes(), "lengths": (e - s).tobytes(), "first": first[i:j].tobytes(), "count": count[i:j].tobytes(), "anchor": value[i:j].tobytes(), "text": text[lo:hi]}]
        )
        i = j


def window_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the LENGTH bytes from every place of the text."""
    n = len(text)
    up = np.full(n, U64(_BASE))
    up[0] = 1
    up = np.multiply.accumulate(up)
    down = np.full(n, U64(pow(_BASE, -1, 2**64)))
    down[0] = 1
    down = np.multiply.accumulate(down)
    total = np.zeros(n + 1, U64)
    np.cumsum((text.astype(U64) + U64(1)) * up, out=total[1:])
    return mix((total[LENGTH:] - total[:-LENGTH]) * down[: n - LENGTH + 1])


def merged_repeats(segments: DataFrame) -> DataFrame:
    """Step 4: (place, start, stop) of windows that another shard has earlier.

    Segments come sorted by (anchor, place, start) and are taken in blocks. Of an
    anchor that goes on into the next block only the segments with first windows
    are carried over, so memory holds distinct strings, however many shards have them.
    """

    def block(anchor: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per window: its segment, its place there, and whether an earlier segment has it."""
        size = np.array([len(t) for t in texts])
        text = np.frombuffer(b"".join(texts), np.uint8)
        base = np.concatenate([[0], np.cumsum(size)])
        windows = size - LENGTH + 1
        segment = np.repeat(np.arange(len(texts)), windows)
        inside = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = base[segment] + inside
        key = mix(window_hashes(text)[at] ^ anchor[segment])
        merged, earliest = np.unique(key, return_index=True)  # sorted windows of all shards, with the first of each
        first = earliest[np.searchsorted(merged, key)]
        repeat = np.flatnonzero(first != np.arange(len(key)))
        words = np.ndarray((len(text) - 7,), "<u8", text.data, strides=(1,))
        right = np.ones(len(repeat), bool)
        for k in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
            right &= words[at[repeat] + k] == words[at[first[repeat]] + k]
        if not right.all():  # two strings with one hash: settle them by their bytes
            earlier: dict[tuple[int, bytes], int] = {}
            odd = np.isin(key, key[repeat[~right]])
            is_repeat = np.zeros(len(key), bool)
            is_repeat[repeat] = True
            for i in np.flatnonzero(odd).tolist():
                string = text[at[i] : at[i] + LENGTH].tobytes()
                is_repeat[i] = earlier.setdefault((int(anchor[segment[i]]), string), i) != i
            return segment, inside, is_repeat
        is_repeat = np.zeros(len(key), bool)
        is_repeat[repeat] = True
        return segment, inside, is_repeat

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[tuple[int, bytes]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch.to_pydict()
            anchor_in = table["anchor"]
            carried = [c for c in carried if c[0] == anchor_in[0]]
            k = len(carried)
            anchor = np.array([c[0] for c in carried] + anchor_in, np.int64).view(U64)
            texts = [c[1] for c in carried] + table["text"]
            segment, inside, is_repeat = block(anchor, texts)
            at = np.flatnonzero(is_repeat & (segment >= k))
            if len(at):
                seg, ins = segment[at], inside[at]
                new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (ins[1:] != ins[:-1] + 1)])
                heads = np.flatnonzero(new)
                tails = np.append(heads[1:] - 1, len(at) - 1)
                place, start = np.array(table["place"], np.int64), np.array(table["start"], np.int64)
                own = seg[heads] - k
                yield pa.record_batch(
                    [pa.array(place[own]), pa.array(start[own] + ins[heads]), pa.array(start[own] + ins[tails] + LENGTH)], names=["place", "start", "stop"]
                )
            fresh = np.unique(segment[~is_repeat])
            carried = [(int(anchor[i].view(np.int64)), texts[i]) for i in fresh.tolist() if anchor[i] == anchor[-1]]

    rows = segments.select("anchor", "place", "start", "text").repartition("anchor").sortWithinPartitions("anchor", "place", "start")
    return rows.mapInArrow(work, "place bigint, start bigint, stop bigint")


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def cut(texts: DataFrame, facts: DataFrame, with_text: bool) -> DataFrame:
    """Step 5. facts: shard, place, start, stop; start -1 marks a copy."""

    def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        place = right["place"].to_numpy()
        order = np.argsort(place, kind="stable")
        place, start, stop = place[order], right["start"].to_numpy()[order], right["stop"].to_numpy()[order]
        rows = []
        for doc, at, text in zip(left["doc_id"].to_pylist(), left["place"].to_pylist(), bytes_of(left["text"])):
            i, j = np.searchsorted(place, [at, at + 1])
            a, b = start[i:j], stop[i:j]
            if len(a) and a.min() < 0:
                a, b = (np.array([0]), np.array([len(text)])) if len(text) >= LENGTH else (a[:0], b[:0])
            a, b = unite(a, b)
            edges = np.concatenate([[0], np.column_stack([a, b]).ravel(), [len(text)]]).astype(np.int64).reshape(-1, 2)
            kept = b"".join(text[x:y].tobytes() for x, y in edges.tolist())
            rows.append((doc, len(text), len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        columns = list(zip(*rows)) if rows else [()] * 6
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        return pa.table({n.split()[0]: pa.array(c, t) for n, c, t in zip(RESULT.split(", "), columns, types)})

    return texts.groupBy("shard").cogroup(facts.groupBy("shard")).applyInArrow(work, RESULT)


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes) of every row."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard = shard_of(spark, n)
    texts = bucketed(docs, n, shard)
    keys = texts.select("shard", "place", "key")
    first = keys.groupBy("key").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = written(keys.join(first, "key").where("place <> first").select("shard", "place"), "copies")
    common = common_hashes(hash_rows(texts, copies, n))
    none = F.lit(None)
    facts = common.select("shard", none.cast("bigint").alias("place"), "hashes").union(copies.select("shard", "place", none.cast("binary").alias("hashes")))
    found = written(shard_repeats(written(stretches(texts, facts), "stretches")), "repeats")
    intervals = found.where("anchor is null").select("place", "start", "stop").union(merged_repeats(found.where("anchor is not null")))
    marks = copies.select("shard", "place", F.lit(-1).cast("bigint").alias("start"), F.lit(-1).cast("bigint").alias("stop"))
    marks = marks.union(intervals.select(shard.alias("shard"), "place", "start", "stop"))
    result = cut(texts, marks, with_text)
    return result if with_text else result.drop("kept")
