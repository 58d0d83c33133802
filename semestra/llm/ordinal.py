"""Quality classifier: ordinal cumulative-link regression on graded ratings.

All grades share one weight for each hashed feature; ordered thresholds turn the score
into P(grade <= j) = sigmoid(threshold_j - score). This gives an expected grade and the
probability of the upper tail by which documents are selected.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from semestra.llm import features as ft
from semestra.llm.optimise import minimum
from semestra.llm.text import column_pieces, text_bytes

#: Labelled rows the model is fitted on, and those the cut is chosen on.
TRAIN_ROWS, HELD_ROWS = 4000, 2000


def grades(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 low quality, 2 good; null where both ratings are missing."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


class OrdinalModel(NamedTuple):
    """``weights`` of ``buckets``, ordered ``thresholds``, and the least tail probability kept."""

    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float

    def at_most(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= j) of every score, for every threshold."""
        return 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds, -500, 500)))


def _thresholds(free: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def fit(sample: ft.Sample, top: int, penalty: float = 1e-4, least_z: float = 5.0) -> tuple:
    """Buckets, weights and thresholds for grades 0..top by penalised likelihood."""
    labels = sample.labels
    splits = [labels >= j for j in range(1, top + 1)]
    buckets = ft.telling_buckets(sample, splits, least_z, least_rows=5)
    places = ft.bucket_places(buckets)[sample.buckets]
    used = places >= 0
    rows, places, weights = sample.rows[used], places[used], sample.values[used]
    n, k = len(labels), len(buckets)
    every = np.arange(n)

    def loss(x):
        w, cuts = x[:k], _thresholds(x[k:])
        score = np.bincount(rows, w[places] * weights, minlength=n)
        below = 1 / (1 + np.exp(np.clip(score[:, None] - cuts, -40, 40)))
        steep = np.pad(below * (1 - below), ((0, 0), (1, 1)))
        below = np.pad(below, ((0, 0), (1, 1)), constant_values=(0, 1))
        below[:, -1] = 1
        chance = np.maximum(below[every, labels + 1] - below[every, labels], 1e-12)
        upper, lower = steep[every, labels + 1] / chance, steep[every, labels] / chance
        pull = np.bincount(places, (upper - lower)[rows] * weights, minlength=k) / n
        by_cut = np.bincount(labels, -upper, minlength=top + 1)[:top] + np.bincount(labels, lower, minlength=top + 1)[1:]
        # A later threshold moves with every gap before it
        by_free = np.cumsum(by_cut[::-1])[::-1] / n * np.concatenate(([1.0], np.exp(x[k + 1 :])))
        value = -np.log(chance).mean() + penalty / 2 * (w @ w)
        return value, np.concatenate((pull + penalty * w, by_free))

    start = np.zeros(k + top)
    start[k] = -2.0
    x = minimum(loss, start)
    return buckets, x[:k], _thresholds(x[k:])


def chosen_cut(tail: np.ndarray, good: np.ndarray) -> float:
    """The probability that best parts good rows from others; the middle of equal ones."""
    if good.all() or not good.any():
        return 0.5
    steps = np.linspace(0.02, 0.98, 49)
    gain = np.array([(tail[good] >= t).mean() - (tail[~good] >= t).mean() for t in steps])
    return float(np.mean(steps[gain >= gain.max() - 1e-3]))


def train(
    docs: DataFrame, ratings: DataFrame, top: int = 2, key: str = "doc_id", text: str = "text",
    train_rows: int = TRAIN_ROWS, held_rows: int = HELD_ROWS,
) -> OrdinalModel | None:
    """A model from a bounded sample of rated rows; None with fewer than two grades.

    Two thirds of the sample, up to ``train_rows``, fit the weights; the others choose the
    cut on the probability of the top grade.
    """
    sample = ft.labelled_sample(docs, ratings, train_rows + held_rows, key, text)
    if len(np.unique(sample.labels)) < 2:
        return None
    size = min(train_rows, max(1, len(sample.labels) * train_rows // (train_rows + held_rows)))
    fitted, held = ft.head(sample, size)
    model = OrdinalModel(*fit(fitted, top), 0.5)
    places = ft.bucket_places(model.buckets)[held.buckets]
    used = places >= 0
    scores = np.bincount(held.rows[used], model.weights[places[used]] * held.values[used], minlength=len(held.labels))
    tail = 1 - model.at_most(scores)[:, -1]
    return model._replace(cut=chosen_cut(tail, held.labels == top))


def graded(docs: DataFrame, model: OrdinalModel | None, text: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``__words, __grade, __tail, __kept``.

    Every row is scored over its whole text. Null and empty texts have no features and
    the score 0. Without a model the grade is null, the tail 1 and every row is kept. An
    empty table gives no rows.
    """
    if model is None:
        return docs.withColumns({
            "__words": F.lit(None).cast("bigint"), "__grade": F.lit(None).cast("double"),
            "__tail": F.lit(1.0), "__kept": F.lit(True),
        })
    places, weights = ft.bucket_places(model.buckets), model.weights[:, None]

    @arrow_udf("struct<words bigint, grade double, tail double, kept boolean>")
    def verdict(column: pa.Array) -> pa.Array:
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for piece in column_pieces(column):
            scores, words = ft.row_scores(*text_bytes(piece), places, weights)
            below = model.at_most(scores[:, 0])
            tail = 1 - below[:, -1]
            for part, value in zip(parts, (words.astype(np.int64), (1 - below).sum(1), tail, tail >= model.cut)):
                part.append(value)
        kinds = (pa.int64(), pa.float64(), pa.float64(), pa.bool_())
        arrays = [pa.array(np.concatenate(p) if p else [], k) for p, k in zip(parts, kinds)]
        return pa.StructArray.from_arrays(arrays, ["words", "grade", "tail", "kept"])

    # Only texts go to Python; kept from being evaluated once more below a filter
    out = docs.withColumn("__verdict", verdict.asNondeterministic()(F.col(f"`{text}`")))
    return out.select(
        *[F.col(f"`{n}`") for n in docs.columns], F.col("__verdict.words").alias("__words"),
        F.col("__verdict.grade").alias("__grade"), F.col("__verdict.tail").alias("__tail"),
        F.col("__verdict.kept").alias("__kept"),
    )


def ratings(labels: DataFrame) -> DataFrame:
    """doc_id and label (grade) of rated documents, the least of several ratings."""
    return (
        labels.select("doc_id", grades(F.col("quality"), F.col("toxic")).alias("grade"))
        .groupBy("doc_id").agg(F.min("grade").alias("label"))
    )
