"""Operator 1: near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors fall into buckets by quantised Gaussian projections,
floor((a.x + b) / WIDTH), ``projections`` of them to a table, in several
independent tables. The number of projections grows with the logarithm of the
number of vectors, so that a bucket holds about FILL unrelated ones, and the
number of tables follows from the wanted recall for a pair right at the threshold.

Vectors of one bucket are compared on their components rounded to LEVELS steps, with a
margin of four standard deviations: a few hundredths of a cosine, so that among millions
of vectors chance does not chain strangers into one group, as it does on some hundred sign
bits. Linked ones form candidate groups, whose pairs are all compared by exact cosine
in double precision, in blocks of BLOCK x BLOCK products. So a pair counts
once, whatever the number of tables it met in, and equal vectors are one
representative with a count.

A bucket with more than LEAF vectors is peeled: its rows meet a pivot, chosen by
hash, with a margin so wide that neighbours of the pivot's neighbours pass; the rest
is a bucket of its own. What is still large after EXTRA pivots is compared by matrix
products, pair by pair, so that strangers in it stay apart; only above WHOLE vectors it
is one candidate group as a whole. Nothing is cut.

The tables, hundreds over millions of vectors, are never stored. They are made some
at a time, so many that their entries take about twice the bytes of the vectors. The
entries of one batch for one task are one binary value, so neither Spark's rows nor its
tasks grow with the entries: a task takes PART bytes of them.

Edge cases: vectors that are null, empty, zero, or hold a null or a non-finite
component link with nothing (n_links 0, own component, kept), and so does a vector
whose length no other vector has. Null ids link with nothing: null component, kept.
Rows with equal ids are counted as separate vectors under one id, whose links add up
over its rows' classes. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_written, written_so_far
from .candidates import groups_of, node_forest, spanning
from .common import components, written
from .text_arrays import U64, buffers, mix

WIDTH = 2.0
FILL = 8
RECALL = 0.998
LEAF = 256
EXTRA = 3
BLOCK = 1024
WHOLE = 1 << 15
LEVELS = 127
WORD = 8
MOST = 1024  # bytes of a rounded vector; the components of a longer one are folded
PART = 24 << 20
LITTLE = 1 << 20  # less is not worth a task of its own
HELD = 64 << 20
ENTRIES = 256 << 20  # so many bytes are worth a round of their own
CODES = 1 << 21  # projections computed, or words packed, at once
#: A written table is all that later steps read, so the shuffles behind it can go at once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised Gaussian projection agrees for two points at that distance."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def parameters(count: int, threshold: float) -> tuple[int, int]:
    """Projections in a table, and tables."""
    far, near = collision(math.sqrt(2)), collision(math.sqrt(2 - 2 * threshold))
    projections = max(1, math.ceil(math.log(max(count / FILL, 1)) / -math.log(far)))
    return projections, max(1, math.ceil(math.log(1 - RECALL) / math.log1p(-(near**projections))))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows over their norms in double precision, each by its own components only; nan where there is no norm."""
    x = x.astype(np.float64)
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        x /= np.abs(x).max(1, keepdims=True)  # no overflow in the norm
        x /= np.sqrt((x * x).sum(1, keepdims=True))
    return x


def by_width(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each length, and their packed vectors as a matrix."""
    if not len(column):
        return
    offsets, data = buffers(column)
    widths = np.diff(offsets)
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        part = data if len(at) == len(widths) else data[offsets[at][:, None] + np.arange(width)]
        yield at, part.reshape(-1).view(kind).reshape(len(at), -1)


def component_kind(vectors: DataFrame) -> str:
    """How components are packed: as they come if they are floats, else as doubles."""
    return "f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "f8"


def normalised(vectors: DataFrame) -> DataFrame:
    """vec_id, class, raw: a hash of the vector over its norm, and its components as they come; null where it cannot link."""
    kind = component_kind(vectors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            starts = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)  # a null component becomes nan
            lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), starts[1:] - starts[:-1], 0)
            classes, raws = [None] * len(column), [None] * len(column)
            for width in np.unique(lengths[lengths > 0]).tolist():
                at = np.flatnonzero(lengths == width)
                x = values[starts[at][:, None] + np.arange(width)].astype(kind)
                unit = unit_rows(x)
                for i, row, u, ok in zip(at.tolist(), x, unit, np.isfinite(unit).all(1).tolist()):
                    if ok:
                        classes[i], raws[i] = blake2b(u.tobytes(), digest_size=16).digest(), row.tobytes()
            yield pa.record_batch([batch.column(0), pa.array(classes, pa.binary()), pa.array(raws, pa.binary())], names=["vec_id", "class", "raw"])

    packed = F.col("embedding").cast("array<float>" if kind == "f4" else "array<double>")
    return vectors.select(F.col("vec_id").cast("bigint"), packed).mapInArrow(work, "vec_id bigint, class binary, raw binary")


def rounding(width: int, length: int) -> tuple[np.ndarray | None, np.ndarray]:
    """A matrix that folds the components if there are more than ``length``, and what is added before they are cut to whole numbers."""
    rng = np.random.default_rng([7, width])
    fold = None
    if width > length:
        fold = np.zeros((width, length))
        fold[np.arange(width), rng.integers(0, length, width)] = rng.choice([-1.0, 1.0], width)
    return fold, rng.uniform(size=min(width, length))


def rounded(unit: np.ndarray, fold: np.ndarray | None, add: np.ndarray, length: int) -> np.ndarray:
    """Components in LEVELS steps, up or down by their distance, in ``length`` bytes."""
    x = unit if fold is None else unit @ fold
    out = np.zeros((len(x), length), np.int8)
    out[:, : x.shape[1]] = np.clip(np.floor(x * LEVELS + add), -LEVELS, LEVELS)
    return out


def least_cosine(cosine: float, width: int, length: int, deviations: float = 4) -> float:
    """The cosine of rounded vectors for two of that cosine, less some standard deviations."""
    rounding_error = 0.5 / LEVELS * math.sqrt(2)
    folding_error = math.sqrt(2 / length) if width > length else 0.0
    return cosine - deviations * math.hypot(rounding_error, folding_error)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rounded vectors, row by row; one row of b meets all of a."""
    a, b = a.view(np.int8), np.broadcast_to(b.view(np.int8), (len(a), b.shape[1] * WORD))
    out = np.empty(len(a), np.float32)
    for i in range(0, len(a), 8192):
        out[i : i + 8192] = np.einsum("ij,ij->i", a[i : i + 8192].astype(np.float32), b[i : i + 8192].astype(np.float32))
    return out / (LEVELS * LEVELS)


def buckets(reps: DataFrame, kind: str, projections: int, tables: range, parts: int, length: int) -> DataFrame:
    """(part, entries): the vectors in these tables as records (node, id, rounded vector of ``length`` bytes); a node is in one part."""
    count = len(tables)

    def planes(width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        drawn = []
        for t in tables:
            rng = np.random.default_rng([7, width, t + 1])
            factors = rng.integers(0, 1 << 63, projections, dtype=np.uint64) * U64(2) + U64(1)
            drawn.append((rng.normal(size=(width, projections)) / WIDTH, rng.uniform(0, 1, projections), factors))
        a, b, factors = zip(*drawn)
        return np.concatenate(a, 1).astype(np.float32), np.concatenate(b).astype(np.float32), np.stack(factors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        rows = max(64, CODES // (count * max(projections, 2 + length // WORD)))
        for whole in batches:
            for first in range(0, whole.num_rows, rows):
                batch = whole.slice(first, rows)
                n = batch.num_rows
                node, short = np.empty((n, count), U64), np.empty((n, length // WORD), U64)
                for at, x in by_width(batch.column(1), kind):
                    width = x.shape[1]
                    if width not in known:
                        known[width] = *planes(width), *rounding(width, length)
                    a, b, factors, fold, add = known[width]
                    unit = unit_rows(x)
                    short[at] = rounded(unit, fold, add, length).view(U64)
                    code = unit.astype(np.float32) @ a
                    code += b
                    code = np.floor(code, out=code).astype(np.int64).view(U64).reshape(len(at), count, projections)
                    code *= factors
                    table = mix(np.array([width * 100_003 + t for t in tables], U64))
                    node[at] = mix(code.sum(2) + table)
                node = node.reshape(-1)
                part = ((node >> U64(32)) * U64(parts) >> U64(32)).astype(np.uint16 if parts < 1 << 16 else np.int64)
                order = np.argsort(part, kind="stable")
                part, row = part[order], order // count
                record = np.empty((n * count, 2 + length // WORD), U64)
                record[:, 0] = node[order]
                record[:, 1] = batch.column(0).to_numpy().view(U64)[row]
                record[:, 2:] = short[row]
                edges = np.concatenate([np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
                offsets = np.concatenate([[0], edges]).astype(np.int32) * np.int32(WORD * record.shape[1])
                entries = pa.Array.from_buffers(pa.binary(), len(edges), [None, pa.py_buffer(offsets), pa.py_buffer(record)])
                yield pa.record_batch([pa.array(part[edges - 1].astype(np.int32)), entries], names=["part", "entries"])

    return reps.select("vec_id", "raw").mapInArrow(work, "part int, entries binary")


def matrix_forest(short: np.ndarray, least: float) -> np.ndarray:
    """The smallest row that each rounded vector reaches; all pairs, as products of blocks."""
    x = short.view(np.int8).astype(np.float32) / LEVELS
    rows = np.arange(len(x))
    left, right = [rows[:0]], [rows[:0]]
    for i in range(0, len(x), BLOCK):
        for j in range(i, len(x), BLOCK):
            a, b = np.nonzero(x[i : i + BLOCK] @ x[j : j + BLOCK].T >= least)
            if len(a):
                # Both blocks' rows, by the smallest that they reach: as many links as rows, not as pairs.
                both = np.concatenate([rows[i : i + BLOCK], rows[j : j + BLOCK]]) if i != j else rows[i : i + BLOCK]
                label = spanning(len(both), a, b + (BLOCK if i != j else 0))
                left.append(both)
                right.append(both[label])
    return spanning(len(x), np.concatenate(left), np.concatenate(right))


def peeled(record: np.ndarray, wide: float, leaf: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of one large bucket by the pivots they hang on, the pivot last; and the rows that hang on none."""
    hung, rest = [], np.arange(len(record))
    for turn in range(EXTRA):
        if len(rest) <= leaf:
            break
        pivot = rest[np.argmin(mix(record[rest, 1] ^ mix(record[rest, 0] + U64(turn))))]
        near = cosines(record[rest, 2:], record[pivot : pivot + 1, 2:]) >= wide
        near[rest == pivot] = True
        hung.append(np.append(rest[near & (rest != pivot)], pivot))
        rest = rest[~near]
    return hung, rest


def to_smallest(ids: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Links (src, dst) from the ids of each group (rows of one label) to its smallest id."""
    smallest = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(smallest, label, ids)
    links = np.stack([ids, smallest[label]], 1)
    return links[links[:, 0] != links[:, 1]]


def bucket_links(record: np.ndarray, least: float, wide: float, leaf: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (src, dst) in whole buckets, to the smallest id of a group, and the records that stay.

    Unless they are the last, more records follow: then only large buckets are peeled, and pivots stay.
    """
    record = record[np.argsort(record[:, 0], kind="stable")]
    node, ids = record[:, 0], record[:, 1].view(np.int64)
    edges = np.concatenate([[0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(node)]])
    stays = np.ones(len(node), bool)
    links = [np.zeros((0, 2), np.int64)]
    for k in np.flatnonzero(np.diff(edges) > leaf).tolist():
        hung, rest = peeled(record[edges[k] : edges[k + 1]], wide, leaf)
        if last and len(rest) > leaf:
            rest = rest + edges[k]
            label = matrix_forest(record[rest, 2:], least) if len(rest) <= WHOLE else np.zeros(len(rest), np.int64)
            links.append(to_smallest(ids[rest], label))
            stays[rest] = False
        for rows in hung:
            rows = rows + edges[k]
            stays[rows if last else rows[:-1]] = False
            links.append(to_smallest(ids[rows], np.zeros(len(rows), np.int64)))
    record = record if stays.all() else record[stays]
    if last:
        label = node_forest(record[:, 0], record[:, 2:], lambda a, b: cosines(a, b) >= least)
        links.append(to_smallest(record[:, 1].view(np.int64), label))
    return np.concatenate(links), record


def candidate_links(reps: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Links between vectors that share a bucket and look similar there."""
    size = F.length("raw")
    count, total, longest = reps.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    projections, tables = parameters(count, threshold)
    longest //= np.dtype(kind).itemsize
    length = WORD * math.ceil(max(1, min(longest, MOST)) / WORD)
    least = least_cosine(threshold, longest, length)
    # Twice the threshold's angle: the farthest that a neighbour of the pivot's neighbour can be.
    wide = least_cosine(math.cos(2 * math.acos(threshold)), longest, length)
    leaf, words = LEAF, 2 + length // WORD

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(links: np.ndarray) -> pa.RecordBatch:
            links = np.unique(links, axis=0)
            return pa.record_batch([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["src", "dst"])

        held, size, most = [np.zeros((0, words), U64)], 0, HELD
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(buffers(batch.column(1))[1].view(U64).reshape(-1, words))
            size += held[-1].nbytes
            if size > most:
                links, kept = bucket_links(np.concatenate(held), least, wide, leaf, last=False)
                held, size, most = [kept], kept.nbytes, HELD + kept.nbytes
                yield out(links)
        yield out(bucket_links(np.concatenate(held), least, wide, leaf, last=True)[0])

    spark, links = reps.sparkSession, None
    width = min(tables, max(1, max(2 * total, ENTRIES) // (words * WORD * max(count, 1))))
    for first in range(0, tables, width):
        now = range(first, min(tables, first + width))
        size = count * len(now) * words * WORD
        parts = max(1, math.ceil(size / PART), min(math.ceil(size / LITTLE), int(spark.conf.get("spark.sql.shuffle.partitions"))))
        met = buckets(reps, kind, projections, now, parts, length).repartitionById(parts, F.col("part")).mapInArrow(meet, "src bigint, dst bigint")
        links = written((met if links is None else met.union(links)).distinct(), "links")
    return links


def reached(linked: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches over a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label, len(label)).min(1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def exact_pairs(units: DataFrame, threshold: float, kind: str) -> tuple[DataFrame, DataFrame]:
    """(id, n) links counted exactly, and a spanning forest (src, dst) of them.

    units: unit, side, vec_id, copies, raw. Side 0 meets side 1; a unit of side 2 meets itself.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, 1):
            unit = table.column(0).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]])
            for i, j in zip(edges.tolist(), edges[1:].tolist()):
                part = table.slice(i, j - i)
                side, ids, copies = (part.column(c).to_numpy() for c in (1, 2, 3))
                n = len(ids)
                linked = np.zeros((n, n), bool)
                for at, x in by_width(part.column(4).combine_chunks(), kind):
                    x = unit_rows(x)
                    linked[np.ix_(at, at)] = x @ x.T >= threshold
                linked &= ~np.eye(n, dtype=bool) if side[0] == 2 else side[:, None] != side[None, :]
                counts = linked @ copies.astype(np.float64)  # exact: far below 2^53
                label = reached(linked)
                at = np.flatnonzero(counts)
                yield pa.record_batch([pa.array(ids[at]), pa.array(counts[at].astype(np.int64)), pa.array(ids[label[at]])], names=["id", "n", "root"])

    found = written(units.repartition("unit").sortWithinPartitions("unit", "side", "vec_id").mapInArrow(work, "id bigint, n bigint, root bigint"), "pairs")
    return found.groupBy("id").agg(F.sum("n").alias("n")), found.select(F.col("id").alias("src"), F.col("root").alias("dst")).distinct()


def similar_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding).

    The result, a few numbers a row, is written; the tables on the way to it are removed.
    """
    with shuffles_removed(vectors.sparkSession):
        return _similar_vectors(vectors, threshold)


def _similar_vectors(vectors: DataFrame, threshold: float) -> DataFrame:
    before = written_so_far()
    kind = component_kind(vectors)
    # Vectors are read twice, and kept once for each class, in the components they come in.
    rows = written(normalised(vectors).select("vec_id", "class"), "classes-of-rows")
    usable = normalised(vectors).where("vec_id is not null and class is not null")
    least = usable.groupBy("class").agg(F.min(F.struct("vec_id", "raw")).alias("least"), F.count("*").alias("copies"))
    reps = written(least.select("class", "least.vec_id", "copies", "least.raw"), "representatives")
    classes = reps.select("class", F.col("vec_id").alias("rep"), "copies")
    member = components(candidate_links(reps, threshold, kind)).withColumnRenamed("id", "vec_id")
    sizes = member.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("bigint").alias("n_blocks"))
    placed = member.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("n_blocks")))
    # A group of b blocks is b * (b + 1) / 2 units; a unit of one block has side 0 only.
    other = F.explode(F.expr("sequence(0L, n_blocks - 1)"))
    spread = placed.withColumn("other", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(low == high, 2).otherwise((F.col("block") > F.col("other")).cast("int"))
    spread = spread.select(F.xxhash64("component", low, high).alias("unit"), side.alias("side"), "vec_id")
    units = spread.join(reps, "vec_id").select(spread["unit"], "side", "vec_id", "copies", "raw")
    counts, links = exact_pairs(units, threshold, kind)
    joined = components(links).withColumnRenamed("id", "rep")
    of_class = classes.join(counts.withColumnRenamed("id", "rep"), "rep", "left").join(joined, "rep", "left")
    of_class = of_class.select("class", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("of_class"))
    ids = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("class")).alias("class"))
    found = ids.join(of_class, "class", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("of_class", "vec_id"))
    found = found.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
    result = written(found, "vector-groups")
    remove_written(before, keep=1)
    return result
