"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and \\x09-\\x0D. Word hashes are 64-bit
polynomials over the word's bytes, mixed; equal words have equal hashes in every
task, and different ones differ but for a chance of about 2^-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document makes a block of its own.
BLOCK_BYTES = 1 << 19

U64 = np.uint64
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E6C63D0676A9A99  # any odd number
_BYTE_VALUES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=U64)
_powers: dict[str, np.ndarray] = {}


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    cumulative: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string or binary column; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of documents of about BLOCK_BYTES each."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK_BYTES, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        inverse = pow(_BASE, -1, 2**64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, U64(base))
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def words(offsets: np.ndarray, data: np.ndarray, lower: bool = False) -> Words:
    """Words of one block, in order; offsets start at 0."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(U64), np.zeros(1, U64))
    if lower:
        data = LOWER[data]
    space = IS_SPACE[data]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[firsts] = True
    after[lasts] = True
    start, end = np.flatnonzero(before & ~space), np.flatnonzero(after & ~space) + 1
    up, down = _power(len(data) + 1)
    cumulative = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=cumulative[1:])
    value = (cumulative[end] - cumulative[start]) * down[start]
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(start, end, doc, mix(value), cumulative)


def part_hash(w: Words, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the bytes [start, end) of the block that ``w`` was made from."""
    _, down = _power(len(w.cumulative))
    return mix((w.cumulative[end] - w.cumulative[start]) * down[start] + U64(salt))


def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a per-byte array within each document."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
