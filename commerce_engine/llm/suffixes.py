"""Suffix arrays of one shard in numpy: Larsson-Sadakane refinement and Kasai common prefixes."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Positions of a shard whose rank, next rank and place fit into one sorted 64-bit key.
PLACE_BITS = 21
MOST = (1 << PLACE_BITS) - 2


def ordered(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` sorted by the ``depth`` bytes from each (fewer at the end), ties by position.

    The first ranks come from four bytes; each round then doubles the prefix by
    sorting the groups that are still undecided by the rank of the place behind
    the prefix, and leaves singletons alone. A rank is the first slot of a group,
    so decided groups keep theirs.
    """
    n = len(text)
    if n > MOST:
        raise ValueError(f"a shard holds at most {MOST} bytes")
    if not n:
        return np.zeros(0, np.int64)
    bits, mask = U64(PLACE_BITS), U64((1 << PLACE_BITS) - 1)
    padded = np.zeros(n + 4, U64)  # 0 beyond the end, below every byte
    padded[:n] = text.astype(U64) + U64(1)
    key = padded[:n].copy()
    for k in range(1, 4):
        key = key * U64(257) + padded[k : n + k]
    key = np.sort(key << bits | np.arange(n, dtype=U64))
    order = (key & mask).astype(np.int64)
    key >>= bits
    head = np.ones(n, bool)
    head[1:] = key[1:] != key[:-1]
    rank = np.zeros(n + depth, U64)  # 0 beyond the end
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0)).astype(U64) + U64(1)
    done = 4
    while done < depth:
        step = min(done, depth - done)
        alone = head & np.append(head[1:], True)
        open_slots = np.flatnonzero(~alone)
        if not len(open_slots):
            break
        place = order[open_slots]
        key = np.sort(rank[place] << U64(2 * PLACE_BITS) | rank[place + step] << bits | place.astype(U64))
        place = (key & mask).astype(np.int64)
        key >>= bits
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        order[open_slots] = place
        head[open_slots] = new
        rank[place] = open_slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))].astype(U64) + U64(1)
        done += step
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each slot of ``order``, the bytes its suffix shares with the one before, ``most`` at most (slot 0: 0).

    Kasai's walk in text order: while neighbours move on together, their common
    prefix shrinks by one, so a run of such places is compared once along its
    diagonal and only its last place looks further.
    """
    n, m = len(text), len(order)
    out = np.zeros(m, np.int64)
    if m < 2:
        return out
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.flatnonzero(before >= 0)
    other = before[at]
    padded = np.concatenate([text, np.zeros(most + 8, np.uint8)])
    last = np.ones(len(at), bool)
    last[:-1] = (at[1:] != at[:-1] + 1) | (other[1:] != other[:-1] + 1)
    equal = text[at] == text[other]
    # Run ends that still agree: compare eight bytes at a time until they differ.
    ends = np.flatnonzero(last & equal)
    reach = np.zeros(len(at), np.int64)
    words = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    active, length = ends, 0
    while len(active) and length < most:
        a, b = at[active] + length, other[active] + length
        differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        room = n - np.maximum(a, b)
        found = np.full(len(active), 8)
        some = differ != 0
        low = differ[some] & (~differ[some] + U64(1))
        found[some] = np.log2(low.astype(np.float64)).astype(np.int64) // 8
        found = np.minimum(found, np.maximum(room, 0))
        reach[active] = length + found
        active = active[found == 8]
        length += 8
    # The first place from here on, in the same run, where the diagonal breaks off.
    stop = np.where(equal, np.iinfo(np.int64).max, np.arange(len(at)))
    run_end = np.where(last, np.arange(len(at)), np.iinfo(np.int64).max)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    run_end = np.minimum.accumulate(run_end[::-1])[::-1]
    index = np.arange(len(at))
    lengths = np.where(stop <= run_end, stop - index, run_end - index + reach[run_end])
    full = np.zeros(n, np.int64)
    full[at] = np.minimum(lengths, most)
    out[1:] = full[order[1:]]
    return out
