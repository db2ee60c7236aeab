"""Operator 12: product codes of vectors by Lloyd rounds over partition-local cover trees.

Components become integers floor(1024 x); a vector is cut into four equal parts, and
each part position has a codebook. Rows are put into cover trees once, in sets of a
bounded number of rows inside their partition, one tree a part position: the children
of a node lie within half its scale of it and further than that from each other.
The trees are written and every round reads them: a node whose centre is nearer to one
entry than to any other by more than twice its radius gives its whole subtree to that
entry by the triangle inequality, and cumulative sums give the subtree's sum without
touching its rows. Ambiguous nodes hand the entries that are still possible down to
their children; what is ambiguous at the bottom is compared exactly, in integers.

A round sends at most one sum an entry, part position and task through the shuffle and
the sums of all entries (parts x entries x width numbers) to the driver.

Edge cases: rows whose vector is null or holds null or non-finite components are left
out. A shorter vector counts as filled up with zeros to the longest one, and to a
multiple of four. Components beyond +-2^20 after scaling are cut to that. Equal
vec_ids and equal vectors are rows of their own; the first entries go by (vec_id,
vector), null ids last. Fewer than 256 rows give fewer entries. Of equal entries the
lowest index wins. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = 1 << 20
#: Rows of one set of trees, fewer for wide vectors; members of a node that is not split further.
ROWS, SET_NUMBERS, LEAF = 2048, 1 << 21, 8
#: Neighbouring nodes or points whose distances are one matrix product.
BLOCK = 128


class Tree(NamedTuple):
    """Points in tree order, and nodes as ranges of them. Children of a node have consecutive numbers; a leaf has none."""

    order: np.ndarray  # tree position -> row of the set
    points: np.ndarray
    center: np.ndarray  # a tree position, one of the node's own points
    radius: np.ndarray  # largest distance of a point of the node from its centre
    lo: np.ndarray
    hi: np.ndarray
    child: np.ndarray
    children: np.ndarray

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: v.astype(np.int32) if k != "radius" else v for k, v in self._asdict().items()})
        return out.getvalue()

    @classmethod
    def unpack(cls, raw: bytes) -> Tree:
        with np.load(io.BytesIO(raw)) as z:
            return cls(*(z[k] for k in cls._fields))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each range, one after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


def grow(x: np.ndarray) -> Tree:
    """The cover tree of the rows of ``x``, level by level for all nodes of a level at once."""
    n = len(x)
    x = x.astype(float)
    order = np.arange(n)
    first = ((x - x[0]) ** 2).sum(1)
    center, radius, lo, hi = [np.array([0])], [np.sqrt(first.max(keepdims=True))], [np.array([0])], [np.array([n])]
    child, children = [np.array([0])], [np.array([0])]
    total = 1
    while True:
        c, r, a, b = center[-1], radius[-1], lo[-1], hi[-1]
        split = np.flatnonzero((b - a > LEAF) & (r > 0))
        if not len(split):
            break
        size = (b - a)[split]
        at = ranges(a[split], size)
        node = np.repeat(np.arange(len(split)), size)
        rows = order[at]
        reach = (2.0 ** (np.ceil(np.log2(r[split])) - 1)) ** 2
        centers, turn, far = c[split].copy(), np.zeros(len(at), np.int64), np.zeros(len(at))
        chosen, left, t = [], np.arange(len(at)), 0
        present = np.arange(len(split))
        while len(left):
            chosen.append((present, np.full(len(present), t), centers[present]))
            away = x[rows[left]] - x[centers[node[left]]]
            d = np.einsum("ij,ij->i", away, away)
            near = d <= reach[node[left]]
            turn[left[near]], far[left[near]] = t, d[near]
            left = left[~near]
            present, where = np.unique(node[left], return_index=True)
            centers[present] = rows[left[where]]
            t += 1
        key = node * t + turn
        sort = np.argsort(key, kind="stable")
        order[at] = rows[sort]
        key, far = key[sort], far[sort]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        which, turns, heads = (np.concatenate(v) for v in zip(*chosen))
        heads = heads[np.argsort(which * t + turns)]
        count = np.bincount(key[begin] // t, minlength=len(split))
        child[-1][split] = total + np.cumsum(count) - count
        children[-1][split] = count
        center.append(heads)
        radius.append(np.sqrt(np.maximum.reduceat(far, begin)))
        lo.append(at[begin])
        hi.append(at[begin] + np.diff(np.append(begin, len(key))))
        child.append(np.zeros(len(begin), np.int64))
        children.append(np.zeros(len(begin), np.int64))
        total += len(begin)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    joined = [np.concatenate(v) for v in (center, radius, lo, hi, child, children)]
    return Tree(order, x[order], place[joined[0]], *joined[1:])


def assign(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, int]:
    """The nearest entry of every point in tree order, ties to the lower index; and the number of distances computed.

    A level is walked in blocks of neighbours, whose entries that are still possible
    are much the same; only those take part in the block's matrix product.
    """
    points, book = tree.points.astype(float), book.astype(float)
    norm, book_norm = (points * points).sum(1), (book * book).sum(1)
    code = np.full(len(points), -1, np.int64)
    item, is_point, compared = np.array([0]), np.array([False]), 0
    possible = np.zeros((1, len(book)), bool)
    possible[0, np.unique(book, axis=0, return_index=True)[1]] = True  # an equal entry of higher index never wins
    while len(item):
        node = np.where(is_point, 0, item)
        middle = np.where(is_point, item, tree.center[node])
        radius = np.where(is_point, 0.0, tree.radius[node])
        lo = np.where(is_point, item, tree.lo[node])
        size = np.where(is_point, 1, tree.hi[node] - tree.lo[node])
        nearest, settled = np.empty(len(item), np.int64), np.empty(len(item), bool)
        for i in range(0, len(item), BLOCK):
            at = slice(i, i + BLOCK)
            entries = np.flatnonzero(possible[at].any(0))
            m, r = middle[at], radius[at]
            d2 = norm[m][:, None] - 2 * (points[m] @ book[entries].T) + book_norm[entries]  # integers, exact in a double
            d2[~possible[at][:, entries]] = np.inf
            compared += d2.size
            best = d2.argmin(1)
            reach = (np.sqrt(d2[np.arange(len(best)), best]) + 2 * r) * (1 + 1e-12) + 1e-9
            keep = d2 <= (reach * reach)[:, None]
            nearest[at], settled[at] = entries[best], (r == 0) | (keep.sum(1) == 1)
            possible[i : i + BLOCK, entries] = keep
        code[ranges(lo[settled], size[settled])] = np.repeat(nearest[settled], size[settled])
        open_ = np.flatnonzero(~settled)
        leaf = tree.children[node[open_]] == 0
        heirs = np.where(leaf, size[open_], tree.children[node[open_]])
        item = ranges(np.where(leaf, lo[open_], tree.child[node[open_]]), heirs)
        is_point, possible = np.repeat(leaf, heirs), possible[np.repeat(open_, heirs)]
    return code, compared


def run_sums(tree: Tree, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and sum of the points of each entry: one difference of cumulative sums for each run of equal codes, such as a subtree."""
    running = np.zeros((len(code) + 1, tree.points.shape[1]), np.int64)
    np.cumsum(tree.points, axis=0, out=running[1:])
    start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    end = np.append(start[1:], len(code))
    sums = np.zeros((entries, tree.points.shape[1]), np.int64)
    np.add.at(sums, code[start], running[end] - running[start])
    return np.bincount(code, minlength=entries), sums


# ---------------------------------------------------------------------- jobs
def usable(vector: str = "embedding") -> Column:
    """True where a vector has no null or non-finite component."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def integers(rows: list | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of scaled integers, filled up with zeros."""
    column = rows if isinstance(rows, pa.Array) else pa.array(rows, pa.list_(pa.float64()))
    length = column.value_lengths().to_numpy()
    flat = np.clip(np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE), -LARGEST, LARGEST).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), length), ranges(np.zeros(len(length), np.int64), length)] = flat
    return out


def tree_sets(vectors: DataFrame, width: int) -> DataFrame:
    """One row a set: ids, labels and one packed tree for each part position."""
    rows = max(64, min(ROWS, SET_NUMBERS // width))

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(held: pa.Table) -> pa.RecordBatch:
            held = held.combine_chunks()
            x = integers(held.column(2).chunk(0), width)
            trees = [grow(p).pack() for p in np.split(x, PARTS, axis=1)]
            ids, labels = (pa.array([held.column(i).to_pylist()], pa.list_(t)) for i, t in ((0, pa.int64()), (1, pa.string())))
            return pa.record_batch([ids, labels, pa.array([trees], pa.list_(pa.binary()))], names=["ids", "labels", "trees"])

        held = None
        for batch in batches:
            held = pa.Table.from_batches([*(held.to_batches() if held is not None else []), batch])
            while held.num_rows >= rows:
                yield of(held.slice(0, rows))
                held = held.slice(rows)
        if held is not None and held.num_rows:
            yield of(held)

    return vectors.mapInArrow(plant, "ids array<bigint>, labels array<string>, trees array<binary>")


def entry_sums(sets: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, n, sums): the points nearest to each entry, one row a task at most before they are added up."""
    width, entries = books[0].shape[1], len(books[0])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((PARTS, entries), np.int64), np.zeros((PARTS, entries, width), np.int64)
        for batch in batches:
            for packed in batch.column(0):
                for part, raw in enumerate(packed):
                    tree = Tree.unpack(raw.as_py())
                    count, total = run_sums(tree, assign(tree, books[part])[0], entries)
                    n[part] += count
                    sums[part] += total
        part, entry = np.nonzero(n)
        values = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * width, pa.array(sums[part, entry].ravel()))
        yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), values], names=["part", "entry", "n", "sums"])

    partial = sets.select("trees").mapInArrow(work, "part int, entry int, n bigint, sums array<bigint>")
    totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals)


def codes(sets: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, packed in zip(batch.column(0), batch.column(1), batch.column(2)):
                found = np.empty((len(ids), PARTS), np.uint8)
                error = np.zeros(len(ids), np.int64)
                for part, raw in enumerate(packed):
                    tree = Tree.unpack(raw.as_py())
                    code, _ = assign(tree, books[part])
                    found[tree.order, part] = code
                    error[tree.order] += ((tree.points.astype(np.int64) - books[part][code]) ** 2).sum(1)
                text = [row.tobytes().hex() for row in found]
                yield pa.record_batch([ids.values, labels.values, pa.array(text), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return sets.mapInArrow(work, "vec_id bigint, label string, code string, error bigint")


def trained(sets: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks after some rounds: each entry becomes the floor of its points' mean; unused entries stay."""
    for _ in range(rounds):
        books = [b.copy() for b in books]
        for row in entry_sums(sets, books).collect():
            books[row["part"]][row["entry"]] = np.array(row[3:], np.int64) // row["n"]
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compressed(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where(usable())
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    width = max(PARTS, -(-(longest or 0) // PARTS) * PARTS)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    sets = written(tree_sets(rows, width), "cover-trees")
    books = np.split(integers([r["embedding"] for r in first], width), PARTS, axis=1)
    books = trained(sets, books, rounds) if first else books
    done = written(codes(sets, books), "codes")
    by_label = done.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return done.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _round_sql(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (SELECT p.id, p.part, arg_min(b.entry, (p.xx - 2 * list_inner_product(p.v, b.v) + b.xx, b.entry)) AS entry
  FROM p JOIN b{i} b USING (part) GROUP BY p.id, p.part),
m{i} AS (SELECT part, entry, j, floor(sum(v[j]) / count(*)) AS x FROM a{i} JOIN p USING (id, part), range(1, 17) r(j) GROUP BY part, entry, j),
u{i} AS (SELECT part, entry, list(x ORDER BY j) AS v FROM m{i} GROUP BY part, entry),
b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(u.v, b.v) AS v, list_inner_product(coalesce(u.v, b.v), coalesce(u.v, b.v)) AS xx
  FROM b{i} b LEFT JOIN u{i} u USING (part, entry)),"""


#: Vectors of 64 components without repeated ids; squared distances by inner products of integers, exact in a DOUBLE.
CODES_SQL = f"""
WITH
k AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT id, part, v[part * 16 + 1:part * 16 + 16] AS v, list_inner_product(v[part * 16 + 1:part * 16 + 16], v[part * 16 + 1:part * 16 + 16]) AS xx
  FROM k, range(4) r(part)),
b0 AS MATERIALIZED (SELECT part, id AS entry, v, xx FROM p WHERE id < 256),{"".join(_round_sql(i) for i in range(ROUNDS))}
a AS MATERIALIZED (SELECT p.id, p.part, arg_min(b.entry, (p.xx - 2 * list_inner_product(p.v, b.v) + b.xx, b.entry)) AS entry,
  min(p.xx - 2 * list_inner_product(p.v, b.v) + b.xx) AS d FROM p JOIN b{ROUNDS} b USING (part) GROUP BY p.id, p.part),
c AS (SELECT id, string_agg(printf('%02x', CAST(entry AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a GROUP BY id),
h AS (SELECT sha256(string_agg(list_aggregate(list_transform(v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ','), ',' ORDER BY part, entry)) AS books FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT books FROM h) AS codebooks_sha256
FROM k JOIN c USING (id)
"""
