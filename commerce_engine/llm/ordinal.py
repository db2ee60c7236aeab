"""Operator 10: ordinal cumulative-link regression over hashed text.

P(grade <= k) = sigmoid(theta_k - w.x) with one weight vector w for all grades
and ordered thresholds theta. x holds the hashed words, word starts and word
ends that occur in a text (each once) and a few shares of repeated words, symbols
and capitals. The model gives the expected grade and the tail probability
P(grade >= k) on which documents are selected.

The model is fitted on a bounded, documented sample of rated rows (``fit_rows``,
taken by hash); the selection limit is calibrated on counts over *all* rated
rows. Applying it is one pass over the texts without a shuffle.

Edge cases: a null or empty text has the always-on feature alone. Null ids and
repeated rows are scored like others; a document rated more than once counts
with its lowest grade; null ratings are ignored. Without two different grades
there is nothing to learn: every expected grade is null and every row is kept.
Other columns pass through where the caller asks for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import remove_written, written_so_far
from .common import written
from .text_arrays import IS_SPACE, U64, blocks, buffers, mix, part_hash, words

FIT_ROWS = 12_000
BITS = 20
#: A feature has a weight if it occurs in at least this many rows of the sample.
LEAST_ROWS = 12
EPOCHS = 8
SEED = 20
STEPS = 1000  # probability steps of the calibration table

CAPITAL = np.zeros(256, bool)
CAPITAL[65:91] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>!"]] = True


def grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good; null where both ratings are missing."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality.isNotNull() | toxic.isNotNull(), 2)


def hashed(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every distinct feature of the texts of a block, sorted."""
    w = words(offsets, data, lower=True)
    n = len(offsets) - 1
    length = w.end - w.start
    keys = [w.hash, part_hash(w, w.start, np.minimum(w.start + 5, w.end), 1), part_hash(w, np.maximum(w.end - 2, w.start), w.end, 2)]
    size = 1 << BITS
    found = [w.doc * size + (k >> U64(64 - BITS)).astype(np.int64) for k in keys]
    count = np.maximum(np.bincount(w.doc, minlength=n), 1)
    same = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1]) if len(w.hash) else np.zeros(0, bool)
    doc_of = np.repeat(np.arange(n), np.diff(offsets))
    letters = np.maximum(np.bincount(doc_of[~IS_SPACE[data]], minlength=n), 1)
    shares = [
        np.bincount(w.doc[1:][same], minlength=n) / count if len(w.hash) else np.zeros(n),
        np.bincount(doc_of[SYMBOL[data]], minlength=n) / letters,
        np.bincount(doc_of[CAPITAL[data]], minlength=n) / letters,
        np.bincount(w.doc, weights=length, minlength=n) / count / 64,
    ]
    for i, share in enumerate(shares):
        level = (2 * np.log2(1 + 1024 * np.minimum(share, 1))).astype(U64)
        found.append(np.arange(n) * size + (mix(level + U64(1000 * (i + 1))) >> U64(64 - BITS)).astype(np.int64))
    found.append(np.arange(n) * size)
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & (size - 1)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Ordinal:
    """weights (one vector) and ordered thresholds, one fewer than grades."""

    def __init__(self, grades: int):
        self.weights = np.zeros(1 << BITS)
        self.used = np.ones(1 << BITS, bool)
        self.cuts = np.linspace(-1.0, 1.0, grades - 1) if grades > 2 else np.zeros(grades - 1)

    @staticmethod
    def scale(lengths: np.ndarray) -> np.ndarray:
        """Long texts have more features; their sum counts less, by the fourth root."""
        return np.maximum(lengths, 1) ** -0.25

    def fit(self, features: list[np.ndarray], grades: np.ndarray, epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-6, batch: int = 32) -> Ordinal:
        """Adagrad on the likelihood; rows of rare grades weigh more, up to four times."""
        rng = np.random.default_rng(SEED)
        top = len(self.cuts)
        share = np.bincount(grades, minlength=top + 1)
        weigh = np.minimum(4.0, np.sqrt(share.max() / np.maximum(share, 1)))
        self.used = np.bincount(np.concatenate(features), minlength=1 << BITS) >= LEAST_ROWS
        self.used[0] = True  # always on
        features = [f[self.used[f]] for f in features]
        seen, seen_cuts = np.full(1 << BITS, 1e-3), np.full(top, 1.0)
        for epoch in range(epochs):
            for rows in np.array_split(rng.permutation(len(grades)), max(1, len(grades) // batch)):
                parts = [features[r] for r in rows]
                lengths = np.array([len(p) for p in parts])
                flat, scale = np.concatenate(parts), self.scale(lengths)
                score = np.add.reduceat(self.weights[flat], np.concatenate([[0], np.cumsum(lengths)[:-1]])) * scale
                y = grades[rows]
                below = np.where(y > 0, sigmoid(self.cuts[np.maximum(y - 1, 0)] - score), 0.0)
                upto = np.where(y < top, sigmoid(self.cuts[np.minimum(y, top - 1)] - score), 1.0)
                gap = np.maximum(upto - below, 1e-6)
                d_upto, d_below = upto * (1 - upto) / gap, below * (1 - below) / gap
                g_score = (d_upto - d_below) * weigh[y]  # of the negative log likelihood
                touched, where = np.unique(flat, return_inverse=True)
                g = np.bincount(where, weights=np.repeat(g_score * scale, lengths), minlength=len(touched)) + decay * self.weights[touched]
                seen[touched] += g * g
                self.weights[touched] -= rate * g / np.sqrt(seen[touched])
                g_cuts = np.zeros(top)
                np.add.at(g_cuts, y[y < top], (-d_upto * weigh[y])[y < top])
                np.add.at(g_cuts, y[y > 0] - 1, (d_below * weigh[y])[y > 0])
                seen_cuts += g_cuts * g_cuts
                self.cuts = np.maximum.accumulate(self.cuts - rate * g_cuts / np.sqrt(seen_cuts) + 1e-6 * np.arange(top))
            rate *= 0.7
        return self

    def tails(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """P(grade >= k) for k = 1.. of n documents; their sum is the expected grade."""
        doc, feature = doc[self.used[feature]], feature[self.used[feature]]
        score = np.bincount(doc, weights=self.weights[feature], minlength=n) * self.scale(np.bincount(doc, minlength=n))
        return 1.0 - sigmoid(self.cuts[None, :] - score[:, None])


def fit(docs: DataFrame, ratings: DataFrame, grades: int, fit_rows: int = FIT_ROWS) -> Ordinal | None:
    """Fit on at most ``fit_rows`` rated texts (docs: doc_id, text; ratings: doc_id, grade).

    The sample comes to the driver as hashed features, a few kB a row.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            for a, b in blocks(offsets):
                doc, feature = hashed(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
                at = np.searchsorted(doc, np.arange(b - a + 1))
                packed = [feature[i:j].astype("<i4").tobytes() for i, j in zip(at, at[1:])]
                yield pa.record_batch([batch.column(0)[a:b], batch.column(2)[a:b], pa.array(packed, pa.binary())], names=["doc_id", "grade", "packed"])

    keys = ratings.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rated = docs.select("doc_id", "text").join(F.broadcast(keys), "doc_id").select("doc_id", "text", "grade")
    rows = rated.mapInArrow(features, "doc_id bigint, grade int, packed binary").toArrow().sort_by("doc_id")
    y = np.array(rows["grade"].to_pylist(), np.int64)
    if len(np.unique(y)) < 2:
        return None
    return Ordinal(grades).fit([np.frombuffer(p, "<i4") for p in rows["packed"].to_pylist()], y)


def apply(docs: DataFrame, model: Ordinal | None, keep_text: bool = True) -> DataFrame:
    """docs (doc_id, text, any others; without text if not wanted) with expected_grade and p_good = P(highest grade)."""
    names = docs.columns
    text = names.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(text))
            expected, good = [np.zeros(0)], [np.zeros(0)]
            for a, b in blocks(offsets):
                tails = model.tails(*hashed(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]]), b - a)
                expected.append(tails.sum(1))
                good.append(tails[:, -1])
            kept = [i for i in range(len(names)) if keep_text or i != text]
            columns = [*(batch.column(i) for i in kept), pa.array(np.concatenate(expected)), pa.array(np.concatenate(good))]
            yield pa.RecordBatch.from_arrays(columns, names=[*(names[i] for i in kept), "expected_grade", "p_good"])

    if model is None:
        return (docs if keep_text else docs.drop("text")).withColumns({"expected_grade": F.lit(None).cast("double"), "p_good": F.lit(None).cast("double")})
    fields = (docs if keep_text else docs.drop("text")).schema.fields
    schema = StructType([*fields, StructField("expected_grade", DoubleType()), StructField("p_good", DoubleType())])
    return docs.mapInArrow(judge, schema)


def ratings_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from columns quality and toxic: the lowest grade of each rated document."""
    rated = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return rated.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def judged(docs: DataFrame, labels: DataFrame, max_false: float, fit_rows: int) -> tuple[DataFrame, Ordinal | None, float | None]:
    """doc_id and grades of all documents, written once (a few numbers a row), the model, and the limit on p_good.

    The limit comes from a table of at most STEPS rows counted over all rated
    documents: the highest one, up to a half, that loses at most ``max_false`` of the good.
    """
    ratings = ratings_of(labels)
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    model = fit(ids, ratings, 3, fit_rows)
    rows = apply(ids, model, keep_text=False)
    if model is None:
        return rows, None, None
    rows = written(rows, "grades")
    step = F.floor(F.col("p_good") * STEPS).cast("int").alias("step")
    good = rows.select("doc_id", "p_good").join(ratings.where("grade = 2"), "doc_id").groupBy(step).count().collect()
    return rows, model, lowest_limit({r["step"]: r["count"] for r in good}, max_false)


def passes(limit: float | None) -> Column:
    return F.lit(True) if limit is None else F.col("p_good") >= F.lit(limit)


def graded(docs: DataFrame, labels: DataFrame, max_false: float = 0.01, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, expected_grade, p_good and kept of every document."""
    rows, _, limit = judged(docs, labels, max_false, fit_rows)
    return rows.select("doc_id", "expected_grade", "p_good", passes(limit).alias("kept"))


def selected(docs: DataFrame, labels: DataFrame, max_false: float = 0.01, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, with their columns, that the classifier keeps.

    Texts are scored a second time on the way through, which is cheaper than to
    write or shuffle them.
    """
    before = written_so_far()
    _, model, limit = judged(docs, labels, max_false, fit_rows)
    remove_written(before)
    plain = docs.drop("expected_grade", "p_good")
    return apply(plain, model).where(passes(limit)).select(*plain.columns)


def lowest_limit(good: dict[int, int], max_false: float) -> float:
    lost, allowed = 0, max_false * sum(good.values())
    for step in range(STEPS // 2):
        lost += good.get(step, 0)
        if lost > allowed:
            return step / STEPS
    return 0.5
