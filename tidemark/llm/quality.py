"""A quality classifier: ordinal regression with cumulative links on hashed text.

Grades are ordered (0 worst). One weight per hashed feature is shared by all grades and ordered thresholds cut the
score: P(grade <= k) = sigmoid(threshold_k - weights . features). A text is selected by its tail probability, the chance
of at least a wanted grade; the expected grade is the sum of the tail probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, id_text, split_words

BITS = 18
#: Labelled documents that fit the model at most, those with the smallest hash of their id.
TRAIN_DOCS = 8000
#: Characters that surround words.
EDGE = ".,;:!?\"'()[]{}<>|%$&#*=+-_/\\~^`@"
SHAPES = 9
#: A text is selected from this tail probability on.
LEAST = 0.4


@dataclass(frozen=True)
class Model:
    """weights (2^BITS hashed words, then shape features) and ascending thresholds, one fewer than grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..: a column each."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed distinct words of each text (index, offsets) and its shape: shares of words in capitals, with marks around
    them, with repeated marks, of digits, of single letters, of repeats, and the logarithm of the number of words."""
    words, index, offsets = split_words(text, lower=False)
    core = pc.utf8_trim(words, characters=EDGE)
    lower = pc.ascii_lower(core)
    hashed = np.array([xxhash.xxh3_64_intdigest(w) & ((1 << BITS) - 1) for w in lower.cast(pa.binary()).to_pylist()], np.int64)
    size = pc.utf8_length(core).to_numpy(zero_copy_only=False)
    marks = pc.utf8_length(words).to_numpy(zero_copy_only=False) - size
    shape = np.stack(
        [
            pc.utf8_is_upper(core).to_numpy(zero_copy_only=False) & (size > 1),
            (marks > 0) & (size > 0),
            marks > 1,
            pc.utf8_is_digit(core).to_numpy(zero_copy_only=False),
            size == 1,
            size == 0,
        ],
        axis=1,
    ).astype(np.float64)
    count = np.diff(offsets)
    doc = np.repeat(np.arange(len(count)), count)
    out = np.zeros((len(count), SHAPES))
    for k in range(shape.shape[1]):
        out[:, k] = np.bincount(doc, weights=shape[index, k], minlength=len(count))
    pairs = np.unique(doc << BITS | hashed[index][: len(doc)]) if len(doc) else np.zeros(0, np.int64)
    ends = np.searchsorted(pairs >> BITS, np.arange(len(count) + 1))
    out[:, 6] = count - np.diff(ends)
    out /= np.maximum(count, 1)[:, None]
    out[:, :6] = np.minimum(1, 5 * out[:, :6])
    out[:, 7] = 3 * np.maximum(0, out[:, 6] - 0.7)
    out[:, 8] = np.log1p(count) / 10
    return (pairs & ((1 << BITS) - 1)).astype(np.int32), ends, 4 * out


def fit(index: list[np.ndarray], shapes: np.ndarray, grades: np.ndarray, n_grades: int, steps: int = 400, l1: float = 6e-4, rate: float = 0.3, least_docs: int = 6) -> Model:
    """Proximal Adagrad on the mean negative log likelihood; words in fewer than least_docs texts keep a weight of 0."""
    dim = (1 << BITS) + SHAPES
    seen = np.bincount(np.concatenate(index) if index else np.zeros(0, int), minlength=dim) >= least_docs
    index = [x[seen[x]] for x in index]
    size, flat = np.array([len(x) for x in index], np.int64), np.concatenate(index) if index else np.zeros(0, np.int64)
    del index
    used, flat = np.unique(flat, return_inverse=True)
    flat, doc = flat.astype(np.int32), np.repeat(np.arange(len(size), dtype=np.int32), size)
    w, v, cuts = np.zeros(len(used)), np.zeros(SHAPES), np.linspace(-1, 1, n_grades - 1) if n_grades > 2 else np.zeros(1)
    sums = [np.full(len(x), 1e-8) for x in (w, v, cuts)]
    share = np.maximum(np.bincount(grades, minlength=n_grades) / max(1, len(grades)), 1e-9)
    weight = (1 / np.sqrt(share))[grades]
    weight /= weight.sum() if len(weight) else 1
    for _ in range(steps if len(grades) else 0):
        score = np.bincount(doc, weights=w[flat], minlength=len(size)) + shapes @ v
        edges = np.concatenate([np.full((len(size), 1), -60.0), cuts[None, :] - score[:, None], np.full((len(size), 1), 60.0)], axis=1)
        cdf = _sigmoid(edges)
        at = np.arange(len(size))
        upper, lower = cdf[at, grades + 1], cdf[at, grades]
        p = np.maximum(upper - lower, 1e-9)
        up, down = upper * (1 - upper) * (grades + 1 < n_grades), lower * (1 - lower) * (grades > 0)
        g_score = weight * (up - down) / p
        g_cuts = np.zeros(n_grades + 1)
        np.add.at(g_cuts, grades + 1, -weight * up / p)
        np.add.at(g_cuts, grades, weight * down / p)
        for x, g, s, penalty in ((w, np.bincount(flat, weights=g_score[doc], minlength=len(w)), sums[0], l1), (v, g_score @ shapes, sums[1], 0), (cuts, g_cuts[1:-1], sums[2], 0)):
            s += g * g
            step = rate / np.sqrt(s)
            x -= step * g
            if penalty:
                x[:] = np.sign(x) * np.maximum(np.abs(x) - step * penalty, 0)
        cuts[:] = np.maximum.accumulate(cuts)
    weights = np.zeros(dim)
    weights[used], weights[1 << BITS :] = w, v
    return Model(weights.astype(np.float32), cuts)


def score(model: Model, text: pa.Array) -> np.ndarray:
    index, ends, shapes = features(text)
    sums = np.concatenate([[0], np.cumsum(model.weights[index], dtype=np.float64)])
    return sums[ends[1:]] - sums[ends[:-1]] + shapes @ model.weights[1 << BITS :]


def train(docs: DataFrame, graded: DataFrame, n_grades: int, id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_DOCS) -> Model:
    """Fits on the documents that `graded` (doc_id, grade) covers, at most `limit` of them.

    Rows with a null id, no grade or one beyond n_grades are left out; of several grades of an id the lowest counts; a null text counts as empty; of rows that
    share an id one counts. Without any row the weights are 0, so all texts are graded alike.
    """
    chosen = graded.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, n_grades - 1)).groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # at most `limit` rows

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 1000):
            index, ends, shapes = features(b.column("text"))
            lists = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(index))
            flat = pa.ListArray.from_arrays(np.arange(0, shapes.size + 1, SHAPES, dtype=np.int32), pa.array(shapes.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("grade").cast(pa.int32()), lists, flat], ["doc_id", "grade", "words", "shape"])

    found = texts.select("doc_id", "grade", "text").mapInArrow(of, "doc_id long, grade int, words array<int>, shape array<double>")
    rows = found.groupBy("doc_id").agg(F.min(F.struct("grade", "words", "shape")).alias("x")).select("doc_id", "x.*").toArrow().sort_by("doc_id")
    words = rows.column("words").combine_chunks() if rows.num_rows else None
    index = np.split(words.flatten().to_numpy(), (words.offsets.to_numpy() - words.offsets[0].as_py())[1:-1]) if words is not None else []
    shapes = rows.column("shape").combine_chunks().flatten().to_numpy().reshape(-1, SHAPES) if rows.num_rows else np.zeros((0, SHAPES))
    given = rows.column("grade").to_numpy().astype(np.int64)
    rows = words = None
    model = fit(index, shapes, given, n_grades)
    pa.default_memory_pool().release_unused()
    return model


def classify(docs: DataFrame, model: Model, wanted: int, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, expected_grade, tail_probability (of at least the wanted grade), selected.

    A null text counts as empty. An empty text has the grade that the thresholds alone give. Rows that repeat are graded
    alike; other columns are ignored; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BITS

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 1000):
            tails = held.value.tails(score(held.value, b.column(1)))
            tail = tails[:, wanted - 1]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= least)], ["doc_id", "expected_grade", "tail_probability", "selected"])

    return id_text(docs, id_col, text_col).mapInArrow(of, "doc_id long, expected_grade double, tail_probability double, selected boolean")


def select(docs: DataFrame, model: Model, wanted: int, least: float = LEAST, text_col: str = "text") -> DataFrame:
    """The rows of docs whose tail probability reaches `least`; the columns stay as they are.

    A null text counts as empty, whose grade the thresholds alone give; ids play no part, and rows that repeat stay or go alike.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def good(text: pa.Array) -> pa.Array:
        parts = [held.value.tails(score(held.value, text.slice(at, 1000)))[:, wanted - 1] >= least for at in range(0, len(text), 1000)]
        return pa.array(np.concatenate(parts) if parts else [], pa.bool_())

    return docs.where(good(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def grades(labels: DataFrame) -> DataFrame:
    """Of the labels table: 0 toxic, 1 of low quality, 2 good. Rows with a null label are left out."""
    return labels.select("doc_id", F.when(F.col("toxic") > 0, 0).otherwise(1 + F.col("quality").cast("int")).alias("grade")).where("grade IS NOT NULL")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, train(docs, grades(labels), 3), wanted=2)
