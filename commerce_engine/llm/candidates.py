"""Small nodes of hashed rows: streaming whole groups, comparing sketches, spanning forests of links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

def fixed(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """A binary column of equal lengths as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each of n rows over the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def groups_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Tables of whole groups (rows sorted by column 0), about ``width`` rows or one group at a time."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < width:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(0).to_numpy()
        last = int(np.searchsorted(keys, keys[-1], "left"))
        if last:
            yield table.slice(0, last)
            table = table.slice(last).combine_chunks()
        held, rows = table.to_batches(), table.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def node_forest(node: np.ndarray, sketch: np.ndarray, agrees: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The smallest row that each row reaches over rows of equal ``node`` (sorted) whose sketches agree."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    distance, at = 1, np.arange(len(node) - 1)
    while len(at):
        at = at[node[at] == node[at + distance]]
        same = agrees(sketch[at], sketch[at + distance])
        left.append(at[same])
        right.append(at[same] + distance)
        distance += 1
        at = at[at + distance < len(node)]
    return spanning(len(node), np.concatenate(left), np.concatenate(right))


def node_links(nodes: DataFrame, agrees: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Links (src, dst) between rows of equal ``node`` whose sketches agree; a spanning forest, not all pairs.

    nodes: node, id, sketch (all of one length). The caller keeps nodes small: a node
    is compared exhaustively. ``agrees`` takes two matrices of sketches, row by row.
    The links of a group lead to its smallest id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, 4096):
            node = table.column(0).to_numpy()
            ids = table.column(1).to_numpy()
            raw = table.column(2).combine_chunks()
            sketch = fixed(raw, np.uint8, len(raw[0].as_py()))
            label = node_forest(node, sketch, agrees)
            moved = np.flatnonzero(label != np.arange(len(label)))
            if len(moved):
                yield pa.record_batch([pa.array(ids[moved]), pa.array(ids[label[moved]])], names=["src", "dst"])

    return nodes.repartition("node").sortWithinPartitions("node", nodes.columns[1]).mapInArrow(work, "src bigint, dst bigint")
