"""Operator 13: language of every word, and of every document, by a linear-chain conditional random field.

The chain runs over the words (runs of letters) of a text; its labels are the languages
that labelled documents name. A word's features are the word, its first and last bytes,
the byte n-grams inside, all hashed, and a lexicon: how often the word occurs in each
language over *all* labelled documents. Weights and transitions between languages are
learned by gradient ascent on the likelihood. Chains to learn from join pieces of a few
words from many documents, so that languages switch inside them. Forward-backward gives
each word its probabilities; a document's language has the largest mean over its words.

One pass over the labelled texts counts the lexicon and takes the pieces; a second one
over all texts applies the model. Neither shuffles a text. Forward-backward walks all
documents of a block at once: stretches of equal length are multiplied up side by side,
their ends joined one after the other, and a new document resets the chain.

Bounded, documented sample: the weights are fitted on FIT_PIECES pieces at most (equal
shares of the languages, taken by hash, from any place in a text); the lexicon is counted
over all labelled documents into a table of fixed size.

Edge cases: a null text and a text without a letter are ``und`` with score 0; so is
every text if nothing can be learned. Documents with crc32(doc_id) mod 5 = 0 are held
out: nothing is learned from them. A row without an id is predicted, counts as not held
out, and is not learned from. Repeated rows give repeated results. With one known
language every text with a letter has it. Columns other than doc_id, text and lang are
not read, and lang only of rows that are learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .text_arrays import LOWER, U64, Words, blocks, buffers, mix, part_hash, per_doc, words

FIT_PIECES = 8192
PIECE_WORDS, PIECES_A_ROW = 12, 4
#: Hashed weights and lexicon rows; fewer where there are many languages.
WEIGHTS, LEXICON = 1 << 20, 1 << 17
SMOOTHING = 4.0
EPOCHS, RATE, DECAY = 30, 0.15, 1e-5
STRETCH = 64
FOLDS = 5
SEED = 20

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def bits_for(table: int, languages: int) -> int:
    """Bits of a hash so that table rows times languages stay bounded."""
    return max(10, int(np.log2(max(table // max(languages, 1), 1))))


# ------------------------------------------------------------------- words
def letters_only(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes in lower case (ASCII and Latin-1 letters), anything but letters blanked.

    Bytes from 0x80 on count as letters but for U+0080 to U+00BF (without the letters
    among them) and the general punctuation U+2000 to U+207F.
    """
    letter = ASCII_LETTER[data] | (data >= 0x80)
    out = LOWER[data]
    if len(data) > 1:
        lead, second = data[:-1], data[1:]
        sign = np.flatnonzero((lead == 0xC2) & ~np.isin(second, [0xAA, 0xB5, 0xBA]))
        letter[sign] = letter[sign + 1] = False
        mark = np.flatnonzero((lead == 0xE2) & ((second == 0x80) | (second == 0x81)))
        letter[mark] = letter[mark + 1] = False
        letter[np.minimum(mark + 2, len(data) - 1)] = False
        capital = np.flatnonzero((lead == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)) + 1
        out[capital] += 0x20
    return np.where(letter, out, 0x20).astype(np.uint8)


def cut(offsets: np.ndarray, data: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a block, the first place of each different word, and which one each word is."""
    w = words(offsets, letters_only(data))
    _, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
    return w, first, which


def features(w: Words, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hashed feature) of the words ``at``: itself, affixes of 2 and 3 bytes, n-grams of 2 and 3 bytes."""
    start, end = w.start[at], w.end[at]
    every = np.arange(len(at))
    owner, keys = [every], [w.hash[at]]
    for k in (2, 3):
        owner += [every, every]
        keys += [part_hash(w, start, np.minimum(start + k, end), 10 + k), part_hash(w, np.maximum(end - k, start), end, 20 + k)]
        n = np.maximum(end - start - k + 1, 0)
        ends = np.cumsum(n)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - n), n)
        owner.append(np.repeat(every, n))
        keys.append(part_hash(w, place, place + k, 30 + k))
    return np.concatenate(owner), (np.concatenate(keys) >> U64(64 - bits)).astype(np.int64)


# ------------------------------------------------------------------- chain
def normal(x: np.ndarray, axis: int = -1) -> np.ndarray:
    return x / x.sum(axis, keepdims=True)


def forward_backward(score: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the labels of each word, and expected moves between labels.

    score: words x labels, in logarithms. first: whether a word begins a document.
    start, move: potentials of a first label, and from label to label. A document's
    first word forgets what came before: its incoming matrix has ``start`` in each row.
    """
    n, k = score.shape
    if not n:
        return np.zeros((0, k)), np.zeros((k, k))
    stretch = min(STRETCH, n)
    rows = -(-n // stretch)
    emit = np.ones((rows * stretch, k))
    emit[:n] = np.exp(score - score.max(1, keepdims=True)) + 1e-30
    fresh = np.ones(rows * stretch, bool)
    fresh[:n] = first
    fresh[0] = True
    emit, fresh = emit.reshape(rows, stretch, k), fresh.reshape(rows, stretch)

    def onward(x: np.ndarray, t: int) -> np.ndarray:
        """One step of row vectors (the last axis), all stretches at once."""
        extra = (slice(None),) + (None,) * (x.ndim - 1)
        return normal(np.where(fresh[:, t][extra], x.sum(-1, keepdims=True) * start, x @ move) * emit[:, t].reshape(rows, *(1,) * (x.ndim - 2), k))

    # Products of each stretch, up to a factor per row that is kept apart as weights.
    product, weight = np.broadcast_to(np.eye(k), (rows, k, k)).copy(), np.zeros((rows, k))
    for t in range(stretch):
        raw = np.where(fresh[:, t][:, None, None], product.sum(-1, keepdims=True) * start, product @ move) * emit[:, t][:, None, :]
        total = raw.sum(-1)
        product, weight = raw / total[..., None], weight + np.log(total)
    product = product * np.exp(weight - weight.max(1, keepdims=True))[..., None]
    into, back = np.empty((rows, k)), np.empty((rows, k))
    x = normal(np.ones(k))
    for r in range(rows):
        into[r] = x
        x = normal(x @ product[r] + 1e-300)
    x = normal(np.ones(k))
    for r in range(rows - 1, -1, -1):
        back[r] = x
        x = normal(product[r] @ x + 1e-300)

    ahead = np.empty((rows, stretch, k))
    x = into
    for t in range(stretch):
        x = ahead[:, t] = onward(x, t)
    behind = np.empty((rows, stretch, k))
    x = back
    for t in range(stretch - 1, -1, -1):
        behind[:, t] = x
        seen = emit[:, t] * x
        x = normal(np.where(fresh[:, t][:, None], (seen @ start)[:, None], seen @ move.T))
    ahead, behind = ahead.reshape(-1, k)[:n], behind.reshape(-1, k)[:n]
    both = normal(ahead * behind)
    seen = (emit.reshape(-1, k)[:n] * behind)[1:]
    inner = ~first[1:]
    before, seen = ahead[:-1][inner], seen[inner]
    total = ((before @ move) * seen).sum(1)
    return both, (before / total[:, None]).T @ seen * move


class Field(NamedTuple):
    """The learned model: hashed weights and a lexicon a language, potentials of starts and moves."""

    languages: list[str]
    weights: np.ndarray  # languages x buckets
    lexicon: np.ndarray  # languages x buckets
    trust: np.ndarray  # weight of the lexicon for each language
    start: np.ndarray
    move: np.ndarray

    def scores(self, w: Words, first: np.ndarray) -> np.ndarray:
        """Label scores of the different words of a block."""
        owner, key = features(w, first, bits_for(WEIGHTS, len(self.languages)))
        known = self.lexicon[:, lexicon_row(w.hash[first], len(self.languages))]
        sums = [np.bincount(owner, weights=v[key], minlength=len(first)) for v in self.weights]
        return (np.array(sums).reshape(len(self.languages), len(first)) + self.trust[:, None] * known).T

    def words(self, offsets: np.ndarray, data: np.ndarray) -> tuple[Words, np.ndarray]:
        """Words of a block and their probabilities."""
        w, first, which = cut(offsets, data)
        if not len(w.doc):
            return w, np.zeros((0, len(self.languages)))
        begins = np.concatenate([[True], w.doc[1:] != w.doc[:-1]])
        return w, forward_backward(self.scores(w, first)[which], begins, self.start, self.move)[0]


def lexicon_row(hashes: np.ndarray, languages: int) -> np.ndarray:
    return (mix(hashes + U64(99)) >> U64(64 - bits_for(LEXICON, languages))).astype(np.int64)


def learn(languages: list[str], pieces: list[bytes], labels: np.ndarray, counts: np.ndarray) -> Field:
    """Fit weights, trust and moves on chains of pieces; counts: languages x lexicon rows."""
    k = len(languages)
    share = counts / np.maximum(counts.sum(1, keepdims=True), 1) * counts.sum() / k + SMOOTHING
    lexicon = np.log(share / share.mean(0))
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    w, first, which = cut(offsets, np.frombuffer(b"".join(pieces), np.uint8))
    gold = labels[w.doc]
    owner, key = features(w, first, bits_for(WEIGHTS, k))
    known = lexicon[:, lexicon_row(w.hash[first], k)]
    size = 1 << bits_for(WEIGHTS, k)
    begins = np.zeros(len(gold), bool)
    begins[0] = True
    moves = np.zeros((k, k))
    np.add.at(moves, (gold[:-1], gold[1:]), 1)
    found = [np.bincount(which[gold == j], minlength=len(first)) for j in range(k)]

    values = {"weights": np.zeros((k, size)), "trust": np.full(k, 0.5), "move": np.eye(k)}
    steps = {n: (np.zeros_like(v), np.zeros_like(v)) for n, v in values.items()}
    start = np.full(k, 1.0 / k)
    for epoch in range(1, EPOCHS + 1):
        sums = np.array([np.bincount(owner, weights=v[key], minlength=len(first)) for v in values["weights"]])
        score = (sums + values["trust"][:, None] * known).T
        likely, expected = forward_backward(score[which], begins, start, np.exp(values["move"]))
        miss = np.array([found[j] - np.bincount(which, weights=likely[:, j], minlength=len(first)) for j in range(k)]) / len(gold)
        slope = {
            "weights": np.array([np.bincount(key, weights=m[owner], minlength=size) for m in miss]) - DECAY * values["weights"],
            "trust": (miss * known).sum(1),
            "move": (moves - expected) / len(gold) - DECAY * values["move"],
        }
        for name, g in slope.items():  # Adam
            m, s = steps[name]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            values[name] += RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(s / (1 - 0.99**epoch)) + 1e-8)
    return Field(languages, values["weights"].astype(np.float32), lexicon.astype(np.float32), values["trust"], start, np.exp(values["move"]))


# -------------------------------------------------------------------- jobs
def fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def gather(docs: DataFrame, languages: dict[str, tuple[int, float]]) -> DataFrame:
    """Lexicon counts of a task's labelled texts, and pieces of those of its rows that the sample takes.

    docs: doc_id, text, lang. languages: number and sampling rate of each. Rows are
    (lang, bucket, n, null, null) or (lang, null, null, place, piece).
    """
    k, names = len(languages), ["lang", "bucket", "n", "place", "piece"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((k, 1 << bits_for(LEXICON, k)), np.int64)
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            known = [languages[x] for x in batch.column(2).to_pylist()]
            number, rate = np.array([x[0] for x in known], np.int64), np.array([x[1] for x in known])
            for a, b in blocks(offsets):
                w, first, which = cut(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
                pairs, times = np.unique(number[a:b][w.doc] * len(first) + which, return_counts=True) if len(first) else (np.zeros(0, np.int64),) * 2
                row = lexicon_row(w.hash[first], k)
                np.add.at(counts, (pairs // max(len(first), 1), row[pairs % max(len(first), 1)]), times)
                begin = np.searchsorted(w.doc, np.arange(b - a + 1))
                # Copies of a row differ in nothing; they are sampled together.
                draw = mix(ids[a:b].astype(U64) + U64(SEED))
                taken = np.flatnonzero(((draw >> U64(11)).astype(float) / 2**53 < rate[a:b]) & (np.diff(begin) > 0))
                out = []
                for d in taken:
                    here = -(-int(begin[d + 1] - begin[d]) // PIECE_WORDS)
                    for j in range(min(here, PIECES_A_ROW)):
                        p = (int(draw[d]) % here + j * here // min(here, PIECES_A_ROW)) % here
                        i, e = begin[d] + p * PIECE_WORDS, min(begin[d] + (p + 1) * PIECE_WORDS, begin[d + 1]) - 1
                        place = int(mix(draw[d : d + 1] + U64(p + 1))[0] >> U64(1))
                        out.append((int(number[a + d]), place, data[offsets[a] + w.start[i] : offsets[a] + w.end[e]].tobytes() + b" "))
                if out:
                    n, place, piece = zip(*out)
                    none = pa.nulls(len(out), pa.int32()), pa.nulls(len(out), pa.int64())
                    yield pa.record_batch([pa.array(n, pa.int32()), *none, pa.array(place, pa.int64()), pa.array(piece, pa.binary())], names=names)
        lang, bucket = np.nonzero(counts)
        none = pa.nulls(len(lang), pa.int64()), pa.nulls(len(lang), pa.binary())
        yield pa.record_batch([pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[lang, bucket]), *none], names=names)

    return docs.mapInArrow(work, "lang int, bucket int, n bigint, place bigint, piece binary")


def fit(docs: DataFrame) -> Field | None:
    """Learn from the documents that are not held out and name a language."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = plain.where((fold() != 0) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    quota = max(64, FIT_PIECES // len(sizes))
    found = written(gather(rows, {x: (i, min(1.0, quota / sizes[x])) for i, x in enumerate(sorted(sizes))}), "lexicon")
    counts = np.zeros((len(sizes), 1 << bits_for(LEXICON, len(sizes))))
    table = found.where("piece is null").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[table["lang"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    order = Window.partitionBy("lang").orderBy("place", "piece")
    taken = found.where("piece is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= quota)
    sample = taken.select("lang", "place", "piece").toArrow().sort_by([("place", "ascending"), ("piece", "ascending"), ("lang", "ascending")])
    if not sample.num_rows:
        return None
    return learn(sorted(sizes), sample["piece"].to_pylist(), sample["lang"].to_numpy().astype(np.int64), counts)


def has_letter(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Which texts of a block hold a letter of any script."""
    found = per_doc(ASCII_LETTER[data], offsets) > 0
    for i in np.flatnonzero(~found & (per_doc(data >= 0x80, offsets) > 0)):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def predicted(docs: DataFrame, model: Field | None) -> DataFrame:
    """doc_id, lang_pred and score of every document; lang is not read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            names, scores = [], []
            for a, b in blocks(offsets):
                at, raw = offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]]
                best, mean = np.full(b - a, -1), np.zeros(b - a)
                if model:
                    w, likely = model.words(at, raw)
                    count = np.bincount(w.doc, minlength=b - a)
                    sums = np.array([np.bincount(w.doc, weights=v, minlength=b - a) for v in likely.T])
                    known = has_letter(at, raw) & (count > 0)
                    best[known] = sums.argmax(0)[known]
                    mean[known] = np.clip(sums.max(0)[known] / count[known], 0, 1)
                names += [model.languages[i] if i >= 0 else "und" for i in best]
                scores.append(mean)
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))], names=["doc_id", "lang_pred", "score"])

    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return ids.mapInArrow(work, "doc_id bigint, lang_pred string, score double")


def spans(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id and the stretches of one language in a text: begin and end in bytes, and the language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            found: list[list[dict]] = []
            for a, b in blocks(offsets):
                w, likely = model.words(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
                label = likely.argmax(1) if len(likely) else np.zeros(0, np.int64)
                here: list[list[dict]] = [[] for _ in range(b - a)]
                new = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (w.doc[1:] != w.doc[:-1])])) if len(label) else np.zeros(0, np.int64)
                for i, e in zip(new, np.append(new[1:], len(label)) - 1):
                    base = offsets[a + w.doc[i]] - offsets[a]
                    here[w.doc[i]].append({"begin": int(w.start[i] - base), "end": int(w.end[e] - base), "lang": model.languages[label[i]]})
                found += here
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
            yield pa.record_batch([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return ids.mapInArrow(work, "doc_id bigint, spans array<struct<begin: bigint, end: bigint, lang: string>>")


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, by a model learned from the others."""
    found = predicted(docs, fit(docs))
    return found.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
