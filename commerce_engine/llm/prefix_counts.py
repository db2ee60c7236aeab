"""Operator 9: exact token counts at every prefix of a text, by dynamic programming.

A byte-level BPE text splits into chunks (white space, then other characters)
whose boundary no token crosses. Inside a chunk's pre-tokens, the last token of
the encoding of every prefix follows from shorter prefixes: it is the one token
that ends there and keeps its shape beside the last token of the prefix before
it (two tokens are *stable* if encoding their joined bytes gives the two back).
So one pass gives the count at every prefix. Counts are stored as one signed
byte per code point, the change from the prefix before; their running sum
answers any count, truncation or budget question without encoding again.

Edge cases: a null text is empty and has 0 tokens and an empty ``deltas``; null
ids, repeated rows and extra columns pass through; an empty table gives an empty
table. The special string inside a text is one token once it is complete, and
ordinary characters before.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import byte_symbols

#: Distinct chunks and token pairs that one worker keeps, and the longest chunk (in characters) that it keeps.
CACHE_CHUNKS = 400_000
LONGEST_KEPT = 64
CACHE_PAIRS = 1_000_000

#: What the pre-tokenizer's \s matches.
SPACE = "\t-\r \x85\xa0  -     　"

SCHEMA = "doc_id bigint, n_bytes bigint, n_chars bigint, n_tokens bigint, deltas binary"


class Runs(dict):
    """pre-token -> signed bytes: per code point, the change of its token count."""

    def __init__(self, spec: dict):
        super().__init__()
        import ahocorasick

        model = spec["model"]
        self.symbols = byte_symbols()
        self.text_of = {i: t for t, i in model["vocab"].items()}
        self.token = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (self.token[t] for t in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank[left, right] = rank
            self.halves[self.token[self.text_of[left] + self.text_of[right]]] = (left, right, rank)
        self.spines: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, bool] = {}
        self.ends = ahocorasick.Automaton()
        for t, i in self.token.items():
            self.ends.add_word(t, (len(t), i))
        self.ends.make_automaton()

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The outermost parts of a token on one side (0 left, 1 right) as merging builds it up, each with the rank that ends it."""
        known = self.spines[side].get(token)
        if known is None:
            known, at, ends = [], token, float("inf")
            while True:
                known.append((at, ends))
                if at not in self.halves:
                    break
                *parts, ends = self.halves[at]
                at = parts[side]
            known.reverse()
            self.spines[side][token] = known
        return known

    def stable(self, a: int, b: int) -> bool:
        """Whether the bytes of token a, then b, encode to just these two tokens.

        Merges run by rank, equal ranks from left to right. The two stay apart
        unless, at some moment, the parts that touch merge before either of
        them grows within its own token.
        """
        left, right = self.spine(a, 1), self.spine(b, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            across = self.rank.get((x, y))
            if across is not None and across < x_ends and across <= y_ends:
                return False
            if x_ends <= y_ends:
                if i + 1 == len(left):
                    return True
                i += 1
            else:
                j += 1

    def __missing__(self, piece: str) -> bytes:
        """The dynamic programme: last token and count of every prefix, from the prefixes before it."""
        text = piece.encode()
        n, pairs = len(text), self.pairs
        last, count, done = [0] * (n + 1), [0] * (n + 1), 0
        for end, (length, this) in self.ends.iter(text.decode("latin-1").translate(self.symbols)):
            if end < done:  # tokens that end here come longest first, and one is right
                continue
            start = end + 1 - length
            if start:
                key = last[start] << 32 | this
                known = pairs.get(key)
                if known is None:
                    if len(pairs) > CACHE_PAIRS:
                        pairs.clear()
                    known = pairs[key] = self.stable(last[start], this)
                if not known:
                    continue
            done = end + 1
            last[done] = this
            count[done] = count[start] + 1
        if n != len(piece):
            count = [0] + [count[i] for i in range(1, n + 1) if i == n or text[i] & 0xC0 != 0x80]
        out = changes(count)
        if len(piece) <= LONGEST_KEPT:
            if len(self) > CACHE_CHUNKS:
                self.clear()
            self[piece] = out
        return out


def changes(counts: list[int]) -> bytes:
    """Differences of neighbours as signed bytes. Up to 64 counts cannot differ by more; beyond, it is checked."""
    if len(counts) <= 64:
        return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])
    change = np.diff(counts)
    if np.abs(change).max() > 127:
        raise ValueError("the token count changes by more than a signed byte holds")
    return change.astype(np.int8).tobytes()


def signed(deltas: bytes) -> list[int]:
    return np.frombuffer(deltas, np.int8).tolist()


class PrefixCounter(dict):
    """chunk of text -> signed bytes: per code point, the change of the token count."""

    def __init__(self, path: str):
        super().__init__()
        import re

        import regex
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.runs = Runs(spec)
        self.chunk = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.space = re.compile(f"[{SPACE}]*")
        self.pattern = regex.compile(PATTERN)

    def tokens(self, piece: str) -> int:
        return sum(b - 256 if b > 127 else b for b in self.runs[piece])

    def ordinary(self, text: str) -> list[int]:
        """Counts at every prefix of a chunk, special strings read as characters: linear in its length.

        A prefix of blanks alone is one pre-token. Once something follows, the last blank
        leaves the run (a space joins what follows, any other stands alone) and the count
        goes on from the run without it. Behind that, a cut leaves the pre-tokens before it
        as they are, and only a contraction ("'ll") reads differently when it is cut itself.
        """
        blank = self.space.match(text).end()
        counts = [0, *accumulate(signed(self.runs[text[:blank]]))] if blank else [0]
        if blank == len(text):
            return counts
        joins = text[blank - 1 : blank] == " "
        base = counts[blank - 1] if blank else 0
        if blank and not joins:
            base += self.tokens(text[blank - 1])
        parts = []
        for piece in self.pattern.findall(text[blank - joins :]):
            if piece[0] == "'" and piece[1:2].isalpha():
                cut = [sum(map(self.tokens, self.pattern.findall(piece[:i]))) for i in range(len(piece) + 1)]
                parts.append(changes(cut))
            else:
                parts.append(self.runs[piece])
        after = accumulate(signed(b"".join(parts)), initial=base)
        return counts + list(islice(after, 1 + joins, None))

    def counts(self, chunk: str) -> list[int]:
        """Counts at every prefix of a chunk; a special string is one token once it is complete."""
        out, base = [0], 0
        while chunk:
            found = min(((chunk.index(s), s) for s in self.special if s in chunk), default=None)
            if found is None:
                out += [base + c for c in self.ordinary(chunk)[1:]]
                break
            at, s = found
            before = self.ordinary(chunk[: at + len(s) - 1])
            out += [base + c for c in before[1:]]
            base += before[at] + 1
            out.append(base)
            chunk = chunk[at + len(s) :]
        return out

    def __missing__(self, chunk: str) -> bytes:
        blank = self.space.match(chunk).end()
        if blank > 1 or "'" in chunk or any(s in chunk for s in self.special):
            out = changes(self.counts(chunk))
        elif chunk[blank:].isalpha() and chunk[:blank] in ("", " "):
            out = self.runs[chunk]
        else:
            # Any other cut leaves the pre-tokens before it as they are, so the changes stand side by side.
            out = b"".join(map(self.runs.__getitem__, self.pattern.findall(chunk)))
        if len(chunk) <= LONGEST_KEPT:
            if len(self) > CACHE_CHUNKS:
                self.clear()
            self[chunk] = out
        return out

    def deltas(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.chunk.findall(text)))


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: sizes, token count, and ``deltas`` that sum to the count at every prefix.

    ``path``: a byte-level BPE in the tokenizers library's JSON format, without
    normaliser. No shuffle; every text is read once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_chunk = counter(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [by_chunk.deltas(t) if t else b"" for t in texts]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                    pa.array([len(d) for d in found], pa.int64()),
                    pa.array([int(np.frombuffer(d, np.int8).sum(dtype=np.int64)) for d in found], pa.int64()),
                    pa.array(found, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_chars", "n_tokens", "deltas"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(count, SCHEMA)


def counts_at_every_prefix(deltas: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... code points."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(deltas or b"", np.int8), dtype=np.int64)])


def longest_within(prefixes: DataFrame, budget: int) -> DataFrame:
    """doc_id, cut_chars, cut_tokens: the longest prefix of each text with at most ``budget`` tokens.

    Counts can fall as a text grows, so this is the last prefix within the
    budget, not the first one that reaches it. A null ``deltas`` counts as empty.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, tokens = [], []
            for d in batch.column(1).to_pylist():
                counts = counts_at_every_prefix(d)
                at.append(int(np.flatnonzero(counts <= budget)[-1]))
                tokens.append(int(counts[at[-1]]))
            yield pa.record_batch([batch.column(0), pa.array(at, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "cut_chars", "cut_tokens"])

    return prefixes.select("doc_id", "deltas").mapInArrow(cut, "doc_id bigint, cut_chars bigint, cut_tokens bigint")
