"""Plain Python versions of what the operators return, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text: str | None, size: int) -> frozenset:
    words = [w.lower() for w in WORD.findall((text or "").encode())]
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(size))))


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def similar(ids: list[int], texts: list[str | None], size: int) -> dict[int, int]:
    """doc_id -> smallest id reachable over pairs with 100 * common >= 80 * union; ids ascending."""
    sets, groups, holders = [shingles(t, size) for t in texts], Union(len(ids)), {}
    for i, s in enumerate(sets):
        for j, common in Counter(j for x in s for j in holders.get(x, ())).items():
            if 100 * common >= 80 * (len(s) + len(sets[j]) - common):
                groups.join(i, j)
        for x in s:
            holders.setdefault(x, []).append(i)
    return {d: ids[groups.root(i)] for i, d in enumerate(ids)}


def near_vectors(ids: list[int], vectors: list) -> dict[int, tuple[int, int]]:
    """vec_id -> (links, component) by cosine >= 0.9 in double precision."""
    groups, links = Union(len(ids)), Counter()
    units = []
    for v in vectors:
        x = None if v is None or None in list(v) else np.array(v, float)
        ok = x is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
        units.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9:
                groups.join(i, j)
                links[i] += 1
                links[j] += 1
    return {d: (links[i], ids[groups.root(i)]) for i, d in enumerate(ids)}


def without_repeats(texts: list[bytes], length: int = 100) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of texts in order."""
    seen, out = set(), []
    for b in texts:
        cut = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                cut[i] += 1
                cut[i + length] -= 1
            seen.add(w)
        gone = np.cumsum(cut)[: len(b)] > 0
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rule_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, inside, lines, again = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside.update(range(i, i + 5))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)
