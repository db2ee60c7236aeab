"""Operator 8: isolation forest on rule statistics of documents.

Each text gives word, symbol, line and repetition counts. Trees of random splits
isolate rows; rows with short paths are anomalies. The trees grow on a bounded,
documented sample (FIT_ROWS labelled rows, taken by hash); the threshold is
calibrated on the scores of *all* labelled rows, counted per score step in Spark:
it is the lowest score at which at most ``max_false`` of the good rows are lost.

Edge cases: a null or empty text has all counts 0 and fails the base rules.
Rows with null ids are scored like others but calibrate nothing. Without good
labelled rows the forest grows on all rows, and without labelled rows of both
kinds no threshold is set: every row that passes the base rules is kept.
Repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .text_arrays import IS_SPACE, U64, blocks, buffers, mix, per_doc, words

FIT_ROWS = 8192
TREES = 128
SAMPLE = 256
STEPS = 4096  # score steps of the calibration table
SEED = 20

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

STATS = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(hashes: np.ndarray, doc: np.ndarray, window: int = 5) -> np.ndarray:
    """Which words lie in a window of words found twice or more in their document."""
    inside = np.zeros(len(hashes), bool)
    n = len(hashes) - window + 1
    if n <= 0:
        return inside
    key = mix(doc[:n].astype(U64) + U64(1))
    for k in range(window):
        key = mix(key + hashes[k : k + n])
    at = np.flatnonzero(doc[:n] == doc[window - 1 :])
    key = key[at]
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marks = np.zeros(len(hashes) + 1, np.int64)
    marks[at[twice]] += 1
    np.subtract.at(marks, at[twice] + window, 1)
    return np.cumsum(marks)[:-1] > 0


def statistics(docs: DataFrame) -> DataFrame:
    """The counts of every whole text; no shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            out = [[] for _ in range(5)]
            for a, b in blocks(offsets):
                at, raw = offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]]
                w = words(at, raw)
                chars = ~IS_SPACE[raw] & ((raw & 0xC0) != 0x80)
                repeat = repeated_words(w.hash, w.doc)
                out[0].append(np.bincount(w.doc, minlength=b - a))
                out[1].append(per_doc(chars, at))
                out[2].append(per_doc(SYMBOL[raw], at))
                whole = raw.tobytes()
                out[3].append([repeated_lines(whole[at[i] : at[i + 1]]) for i in range(b - a)])
                out[4].append(np.bincount(w.doc[repeat], minlength=b - a))
            columns = [pa.array(np.concatenate(c).astype(np.int64)) if c else pa.array([], pa.int64()) for c in out]
            yield pa.record_batch([batch.column(0), *columns], names=[c.split()[0] for c in STATS.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(count, STATS)


def base_failed() -> F.Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) -> np.ndarray:
    n, c = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    return np.column_stack([word_chars / n, n_symbols / c, n_dup_lines / n, n_repeat_words / n, np.log1p(n_words)])


class Forest:
    """Isolation trees in arrays: a row walks all trees at once, level by level."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.sample = min(sample, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(self.sample, 2)))))
        size = 2 ** (self.depth + 1)
        self.feature = np.zeros((trees, size), np.int64)
        self.split = np.full((trees, size), -np.inf)  # an inner node sends x < split to the left
        self.path = np.zeros((trees, size))
        self.leaf = np.ones((trees, size), bool)
        for t in range(trees):
            self._grow(t, 1, rows[rng.choice(len(rows), self.sample, replace=False)], 0, rng)

    def _grow(self, t: int, node: int, rows: np.ndarray, depth: int, rng: np.random.Generator) -> None:
        low, high = rows.min(0), rows.max(0)
        usable = np.flatnonzero(high > low)
        if depth == self.depth or len(rows) < 2 or not len(usable):
            self.path[t, node] = depth + expected_path(len(rows))
            return
        f = int(rng.choice(usable))
        cut = rng.uniform(low[f], high[f])
        left = rows[:, f] < cut
        if not left.any():  # the cut fell on the least value
            cut, left = np.nextafter(low[f], np.inf), rows[:, f] <= low[f]
        self.leaf[t, node], self.feature[t, node], self.split[t, node] = False, f, cut
        self._grow(t, 2 * node, rows[left], depth + 1, rng)
        self._grow(t, 2 * node + 1, rows[~left], depth + 1, rng)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2^(-mean path / expected path): near 1 for anomalies, below 0.5 for ordinary rows."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for t in range(len(self.leaf)):
            node = np.ones(len(rows), np.int64)
            for _ in range(self.depth):
                right = rows[every, self.feature[t, node]] >= self.split[t, node]
                node = np.where(self.leaf[t, node], node, 2 * node + right)
            total += self.path[t, node]
        return 2.0 ** (-total / len(self.leaf) / max(expected_path(self.sample), 1e-9))


def expected_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of n keys."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def quality_verdicts(docs: DataFrame, labels: DataFrame, max_false: float = 0.01, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Statistics, base_failed, score and kept of every document.

    The statistics (a few numbers a document) are written once and used three
    times: to fit, to calibrate, to judge. ``fit_rows`` rows, and STEPS counts,
    reach the driver.
    """
    stats = written(statistics(docs), "statistics")
    usable = stats.where(~base_failed())
    good = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality")).where("quality is not null")
    names = [c.split()[0] for c in STATS.split(", ")][1:]
    chosen = usable.join(good.where("quality = 1"), "doc_id", "left_semi")
    rows = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).select(*names).collect()
    if not rows:
        rows = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).select(*names).collect()
    forest = Forest(features(*np.array(rows, float).T)) if rows else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = forest.score(features(*(batch.column(n).to_numpy(zero_copy_only=False) for n in names))) if forest and batch.num_rows else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "score"])

    scored = stats.mapInArrow(score, STATS + ", score double")
    step = F.floor(F.col("score") * STEPS).cast("int").alias("step")
    table = scored.where(~base_failed()).join(good, "doc_id").groupBy(step).agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") == 0).cast("long")).alias("bad"))
    limit = threshold({r["step"]: (r["good"], r["bad"]) for r in table.collect()}, max_false)
    failed = base_failed()
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") < F.lit(limit)))


def threshold(counts: dict[int, tuple[int, int]], max_false: float) -> float:
    """The lowest score limit that rejects at most that share of good rows; infinite unless both kinds are there."""
    good, bad = sum(g for g, _ in counts.values()), sum(b for _, b in counts.values())
    if not good or not bad:
        return float("inf")
    limit, lost = float("inf"), 0
    for step in sorted(counts, reverse=True):
        lost += counts[step][0]
        if lost > max_false * good:
            break
        limit = step / STEPS
    return limit
