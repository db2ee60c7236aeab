"""Operator 5: near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. Documents with equal sets become one
class. Class representatives then walk down independent trees, as many as their depth needs: a node picks
one or two coordinates of a minwise signature (1 / threshold on average, chosen by
a hash of the node, so alike for all documents in it) and each document goes to
the child that its value at a picked coordinate names. A pair at the threshold
stays together in one child on average, unrelated documents part at once.

Nodes of at most LEAF documents are compared exhaustively on 32-byte sketches, with
a margin of four standard deviations below the threshold. Larger nodes branch
further; what is still large after EXTRA levels is taken as similar as a whole, so
nothing is cut. The documents linked so far form candidate groups, whose pairs are
all compared on their full sets as counts of common shingles. A group larger than BLOCK
is dealt out in blocks that share a few pivots; afterwards only the documents that are
not yet in the group's largest component are compared with the rest, block by block.
Links therefore hold exactly, and only a miss in every tree, or on the sketch, can lose
one: at most MISS for a pair at the threshold, at every depth (see ``missed``).

Edge cases: a null text, or one without words, has an empty set and links with
nothing; a text with fewer words than a shingle is one shingle. Rows without an
id link with nothing: null component, kept. Of rows with equal ids each has the
component of its own text. Ties go to the smallest id. An empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove_written, written_so_far
from .candidates import fixed, groups_of, node_links, spanning
from .common import components, written
from .text_arrays import U64, blocks, buffers, mix, words

COORDINATES = 64
SKETCH = 32  # coordinates of which a sketch keeps a byte
TREES = 10  # at least
MISS = 0.001
LEAF = 1024
EXTRA = 1
BLOCK = 512
PIVOTS = 16

_RNG = np.random.default_rng(5)
FACTORS = _RNG.integers(1, 2**63, COORDINATES, dtype=U64) * U64(2) + U64(1)
TERMS = _RNG.integers(0, 2**63, COORDINATES, dtype=U64)
STEP = U64(0x9E3779B97F4A7C15)


def survival(threshold: float, depth: int, trees: int = TREES) -> float:
    """Chance that a pair at the threshold shares a node at the given depth of at least one tree."""
    p, extra = 1.0, 1 / threshold - 1
    for _ in range(depth):
        p = 1 - ((1 - extra) * (1 - threshold * p) + extra * (1 - threshold * p) ** 2)
    return 1 - (1 - p) ** trees


def least_equal(threshold: float) -> float:
    """Equal bytes that two sketches need."""
    return (threshold - 4 * math.sqrt(threshold * (1 - threshold) / SKETCH)) * SKETCH


def missed(threshold: float, depth: int, trees: int) -> float:
    """Chance that a pair at the threshold parts in all trees above the given depth, or fails on its sketches.

    All trees share the pair's COORDINATES, of which a binomial number agree; given
    that number the trees are independent, and the sketch is a draw of SKETCH of them.
    """
    found, extra = 0.0, 1 / threshold - 1
    low = math.ceil(least_equal(threshold) - 1e-9)
    for equal in range(COORDINATES + 1):
        chance = math.comb(COORDINATES, equal) * threshold**equal * (1 - threshold) ** (COORDINATES - equal)
        draws = sum(math.comb(equal, k) * math.comb(COORDINATES - equal, SKETCH - k) for k in range(low, min(equal, SKETCH) + 1))
        share, p = equal / COORDINATES, 1.0
        for _ in range(depth):
            p = 1 - ((1 - extra) * (1 - share * p) + extra * (1 - share * p) ** 2)
        found += chance * draws / math.comb(COORDINATES, SKETCH) * (1 - (1 - p) ** trees)
    return 1 - found


def trees_for(threshold: float, depth: int) -> int:
    """The fewest trees, TREES or more, that miss a pair at the threshold with a chance of MISS at most."""
    trees = TREES
    while missed(threshold, depth, trees) > MISS:
        trees += 1
    return trees


def shingle_sets(offsets: np.ndarray, data: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block."""
    w = words(offsets, data, lower=True)
    n = len(offsets) - 1
    first = np.searchsorted(w.doc, np.arange(n + 1))
    key = w.hash.copy()
    for k in range(1, size):
        if len(w.hash) > k:
            key[:-k] = mix(key[:-k] * STEP + w.hash[k:])
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(key[a : b - size + 1]))
        elif b > a:
            whole = w.hash[a : a + 1]
            for k in range(a + 1, b):
                whole = mix(whole * STEP + w.hash[k : k + 1])
            out.append(whole.copy())
        else:
            out.append(np.zeros(0, U64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minwise values, 32 bits each."""
    least = np.full(COORDINATES, U64(2**64 - 1))
    for a in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[a : a + 2048, None] * FACTORS + TERMS).min(0), out=least)
    return (mix(least) >> U64(32)).astype("<u4")


def summaries(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (16 bytes, null for an empty set), signature of every row. No shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            counts, keys, signatures = [], [], []
            for a, b in blocks(offsets):
                for s in shingle_sets(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]], size):
                    counts.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    signatures.append(signature(s).tobytes() if len(s) else None)
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "signature"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, "doc_id bigint, n_shingles bigint, set_key binary, signature binary")


def children(node: np.ndarray, signatures: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the children that each row of a node goes to: one, and a second for a share of the nodes."""
    h = mix(node)
    every = np.arange(len(node))
    pick = (h % U64(COORDINATES)).astype(np.int64)
    second = (h >> U64(32)) % U64(10_000) < U64(round(10_000 * (1 / threshold - 1)))
    other = (pick + 1 + (h >> U64(8)) % U64(COORDINATES - 1)).astype(np.int64) % COORDINATES
    rows = np.concatenate([every, every[second]])
    coordinate = np.concatenate([pick, other[second]])
    value = signatures[rows, coordinate].astype(U64)
    return rows, mix(node[rows] * STEP + mix(value + U64(2**33) * coordinate.astype(U64)))


NODES = "node bigint, doc_id bigint, sketch binary"


def descend(rows: DataFrame, threshold: float, levels: int, trees: int | None) -> DataFrame:
    """Rows of the nodes ``levels`` further down; from the roots of ``trees`` trees, or from column node."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            values = fixed(batch.column(1), "<u4", COORDINATES)
            sketches = (values[:, :SKETCH] & 0xFF).astype(np.uint8)
            if trees is None:
                starts = [(np.arange(len(ids)), batch.column(2).to_numpy(zero_copy_only=False).view(U64))]
            else:
                starts = [(np.arange(len(ids)), np.full(len(ids), mix(np.array([t + 1], U64))[0])) for t in range(trees)]
            for row, node in starts:
                for _ in range(levels):
                    at, node = children(node, values[row], threshold)
                    row = row[at]
                raw = sketches[row].tobytes()
                yield pa.record_batch(
                    [pa.array(node.view(np.int64)), pa.array(ids[row]), pa.array([raw[i : i + SKETCH] for i in range(0, len(raw), SKETCH)], pa.binary())],
                    names=["node", "doc_id", "sketch"],
                )

    columns = ["doc_id", "signature"] + (["node"] if trees is None else [])
    return rows.select(*columns).mapInArrow(work, NODES)


def candidate_links(reps: DataFrame, threshold: float) -> DataFrame:
    """Links (src, dst) that join every two documents which share a small node and look similar there."""
    count = reps.count()
    least = least_equal(threshold)

    def agrees(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a == b).sum(1) >= least

    depth = max(1, math.ceil(math.log(max(1, count / LEAF)) / math.log(16)))
    nodes = written(descend(reps, threshold, depth, trees_for(threshold, depth + EXTRA)), "nodes")
    found = []
    for level in range(EXTRA + 1):
        large = written(nodes.groupBy("node").agg(F.count("*").alias("size"), F.min("doc_id").alias("least")).where(F.col("size") > LEAF), "large-nodes")
        found.append(written(node_links(nodes.join(large, "node", "left_anti"), agrees), "links"))
        if large.isEmpty():
            break
        rest = nodes.join(large.select("node", "least"), "node")
        if level == EXTRA:
            found.append(rest.select(F.col("doc_id").alias("src"), F.col("least").alias("dst")).distinct())
        else:
            nodes = written(descend(rest.select("node", "doc_id").join(reps.select("doc_id", "signature"), "doc_id"), threshold, 1, None), "nodes")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def common_counts(members: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common shingles of each left with each right member, as a product of 0/1 matrices.

    It goes by slices of the shingles that occur twice or more, so memory is bounded.
    """
    n = len(members)
    owner = np.repeat(np.arange(n), [len(s) for s in members])
    flat = np.concatenate(members)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    number = np.cumsum(np.concatenate([[True], flat[1:] != flat[:-1]])) - 1
    often = np.bincount(number) > 1
    keep = often[number]
    owner, number = owner[keep], (np.cumsum(often) - 1)[number[keep]]
    total = int(number[-1]) + 1 if len(number) else 0
    common = np.zeros((len(left), len(right)), np.float32)
    width = max(1, (1 << 22) // n)
    for a in range(0, total, width):
        i, j = np.searchsorted(number, [a, a + width])
        has = np.zeros((n, min(width, total - a)), np.float32)
        has[owner[i:j], number[i:j] - a] = 1
        common += has[left] @ has[right].T
    return common.astype(np.int64)


def exact_links(units: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Documents of a unit (unit, side, doc_id, large) compared on full sets; a spanning forest of the links.

    Side 0 meets itself, sides 1 and 2 meet each other. A unit holds at most a few
    BLOCKs of documents. Links (src, dst, large) lead to the smallest id that a
    document reaches in its unit.
    """
    percent = round(threshold * 100)

    def links(side: np.ndarray, members: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(s) for s in members])
        left = np.flatnonzero(side != 2)
        right = np.flatnonzero(side != 1)
        common = common_counts(members, left, right)
        i, j = np.nonzero(100 * common >= percent * (sizes[left][:, None] + sizes[right][None, :] - common))
        return left[i], right[j]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, 1):
            unit, ids, side = (table.column(c).to_numpy() for c in (0, 1, 2))
            raw, kind = table.column(3), table.column(4)
            edges = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]])
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                if b - a < 2:
                    continue
                left, right = links(side[a:b], [np.frombuffer(raw[i].as_py(), U64) for i in range(a, b)])
                label = spanning(b - a, left, right)
                moved = np.flatnonzero(label != np.arange(b - a))
                if len(moved):
                    large = pa.array([kind[a].as_py()] * len(moved), pa.bool_())
                    yield pa.record_batch([pa.array(ids[a:b][moved]), pa.array(ids[a:b][label[moved]]), large], names=["src", "dst", "large"])

    members = units.distinct().join(sets, "doc_id").select("unit", "doc_id", "side", "shingles", "large")
    return members.repartition("unit").sortWithinPartitions("unit", "doc_id", "side").mapInArrow(work, "src bigint, dst bigint, large boolean")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles) of the wanted ids, one row each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            for a, b in blocks(offsets):
                found = shingle_sets(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]], size)
                yield pa.record_batch([batch.column(0)[a:b], pa.array([s.tobytes() for s in found], pa.binary())], names=["doc_id", "shingles"])

    # The same plan at every size: the wanted ids grow with the documents.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(wanted.hint("merge"), "doc_id", "left_semi")
    return texts.mapInArrow(work, "doc_id bigint, shingles binary")


def joined_documents(docs: DataFrame, reps: DataFrame, size: int, threshold: float) -> DataFrame:
    """(id, component) of the representatives that link with others."""
    member = components(candidate_links(reps, threshold)).withColumnRenamed("id", "doc_id")
    sizes = member.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("bigint").alias("n_blocks"))
    placed = member.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")))
    placed = written(placed, "blocks")
    sets = written(full_sets(docs, placed, size), "sets")
    large = placed.where("n_blocks > 1")
    pivots = large.where("block = 0").groupBy("component", "n_blocks").agg(F.expr(f"slice(array_sort(collect_list(doc_id)), 1, {PIVOTS})").alias("pivots"))
    shared = pivots.select("component", F.explode("pivots").alias("doc_id"), "n_blocks")
    shared = shared.select("component", "doc_id", F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("block"), F.lit(True).alias("large"))
    units = placed.select("component", "doc_id", "block", (F.col("n_blocks") > 1).alias("large")).union(shared)
    units = units.select(F.xxhash64("component", "block").alias("unit"), "doc_id", F.lit(0).alias("side"), "large")
    links = written(exact_links(units, sets, threshold), "links")
    # A group of one unit is settled: its links lead to the smallest id of each component.
    whole = links.where("not large").select(F.col("src").alias("id"), F.col("dst").alias("component"))
    if large.isEmpty():
        return whole
    # Second pass, large groups only: whoever is not in the largest component so far meets everyone of the group.
    first = links.where("large").select("src", "dst")
    now = components(first).withColumnRenamed("id", "doc_id").withColumnRenamed("component", "joined")
    state = written(large.join(now, "doc_id", "left").withColumn("joined", F.coalesce("joined", "doc_id")), "state")
    parts = state.groupBy("component", "joined").count()
    main = parts.groupBy("component").agg(F.max_by("joined", F.struct("count", "joined")).alias("main"))
    outside = state.join(main, "component").where("joined <> main").select("component", "doc_id")
    counted = outside.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("bigint").alias("chunks"))
    outside = outside.join(counted, "component").withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("chunks")))
    blocks_of = large.select("component", "block").distinct()
    unit = F.xxhash64("component", "chunk", "block").alias("unit")
    left = outside.join(blocks_of, "component").select(unit, "doc_id", F.lit(1).alias("side"))
    right = state.join(counted, "component").select("component", "doc_id", "block", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"))
    right = right.select(unit, "doc_id", F.lit(2).alias("side"))
    second = exact_links(left.union(right).withColumn("large", F.lit(True)), sets, threshold).select("src", "dst")
    return whole.union(components(state.where("joined <> doc_id").select(F.col("doc_id").alias("src"), F.col("joined").alias("dst")).union(second)))


def numbered_rows(docs: DataFrame) -> DataFrame | None:
    """docs with a unique number ``_place`` in the order of ids, written; None where ids already are unique.

    Rows without an id get no number.
    """
    ids = docs.groupBy(F.col("doc_id").cast("bigint").alias("id")).count()
    if ids.where("id is not null and count > 1").isEmpty():
        return None
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").cast("bigint"), F.sha2("text", 256)]
    ranged = docs.repartitionByRange(n, *order).sortWithinPartitions(*order)
    place = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    return written(ranged.withColumn("_place", place), "numbered")


def first_documents(docs: DataFrame, words_in_shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with their columns, without near copies: of each component the first row of its smallest id."""
    rows = numbered_rows(docs)
    if rows is None:
        groups, key, rows = groups_by_id(docs, words_in_shingle, threshold), "doc_id", docs
    else:
        groups, key = groups_by_id(rows.select(F.col("_place").alias("doc_id"), "text"), words_in_shingle, threshold), "_place"
    # The rejected ids grow with the documents: one plan, a merge, at every size.
    copies = groups.where("not kept").select(F.col("doc_id").alias(key)).hint("merge")
    return rows.join(copies, key, "left_anti").select(*docs.columns)


def similar_groups(docs: DataFrame, words_in_shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Rows that share an id are documents of their own. The result, a few numbers a row,
    is written; the tables on the way to it are removed.
    """
    before = written_so_far()
    rows = numbered_rows(docs.select("doc_id", "text"))
    if rows is None:
        return groups_by_id(docs, words_in_shingle, threshold)
    found = groups_by_id(rows.select(F.col("_place").alias("doc_id"), "text"), words_in_shingle, threshold)
    ids = rows.where("_place is not null").select("_place", F.col("doc_id").cast("bigint").alias("id"))
    own = ids.withColumnsRenamed({"_place": "doc_id", "id": "own"})
    first = ids.withColumnsRenamed({"_place": "component_id", "id": "first"})
    named = found.join(own, "doc_id", "left").join(first, "component_id", "left")
    kept = F.coalesce(F.col("own") == F.col("first"), F.lit(True)).alias("kept")
    result = written(named.select(F.col("own").alias("doc_id"), "n_shingles", F.col("first").alias("component_id"), kept), "groups")
    remove_written(before, keep=1)
    return result


def groups_by_id(docs: DataFrame, words_in_shingle: int, threshold: float) -> DataFrame:
    """As :func:`similar_groups`, for ids that are unique or null."""
    before = written_so_far()
    rows = written(summaries(docs, words_in_shingle), "summaries")
    usable = rows.where("doc_id is not null and set_key is not null")
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))  # equal sets, equal signatures
    classes = written(classes, "representatives")
    reps = classes.select(F.col("rep").alias("doc_id"), "signature")
    joined = joined_documents(docs, reps, words_in_shingle, threshold)
    of_class = classes.join(joined, F.col("rep") == F.col("id"), "left").select("set_key", F.coalesce("component", "rep").alias("of_class"))
    found = rows.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_class", "doc_id"))
    found = found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
    result = written(found, "groups")
    remove_written(before, keep=1)
    return result
