"""Mixing sources to target weights with soft membership.

A classifier fitted on labelled rows predicts how much of every document belongs to each
domain. Nonnegative rates are then fitted by projected-gradient least squares so that the
expected tokens of every domain, over all documents, match the targets.
"""

from __future__ import annotations

import warnings
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from semestra.llm import features as ft
from semestra.llm.optimise import minimum
from semestra.llm.storage import dropped, stored
from semestra.llm.text import column_pieces, text_bytes

#: Labelled rows the classifier is fitted on.
TRAIN_ROWS = 4000
#: Posteriors are given in this many steps, so that equal ones can be added up.
STEPS = 200
#: First rounds of the fit, by the plain gradient; rounds between storing its state; and rounds
#: that may pass without a hundredth less error.
PLAIN, HELD, IDLE = 15, 15, 8


class DomainModel(NamedTuple):
    """``weights`` of ``buckets`` (a column for each domain) and the domains' offsets."""

    buckets: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(1, keepdims=True))
    return powers / powers.sum(1, keepdims=True)


def fit(sample: ft.Sample, domains: int, penalty: float = 1e-4, least_z: float = 6.0) -> DomainModel:
    """Multinomial regression on the buckets that tell some domain from the others."""
    labels, n = sample.labels, len(sample.labels)
    splits = [labels == d for d in range(domains)]
    buckets = ft.telling_buckets(sample, splits, least_z, least_rows=5)
    places = ft.bucket_places(buckets)[sample.buckets]
    used = places >= 0
    rows, places, values = sample.rows[used], places[used], sample.values[used]
    k = len(buckets)
    goal = np.stack(splits, 1).astype(float)

    def loss(x):
        w, offsets = x[: k * domains].reshape(domains, k), x[k * domains :]
        scores = np.stack([np.bincount(rows, w[d, places] * values, minlength=n) for d in range(domains)], 1)
        chance = softmax(scores + offsets)
        off = (chance - goal) / n
        slope = np.stack([np.bincount(places, off[rows, d] * values, minlength=k) for d in range(domains)])
        value = -np.log(np.maximum(chance[goal > 0], 1e-12)).mean() + penalty / 2 * (w**2).sum()
        return value, np.concatenate(((slope + penalty * w).ravel(), off.sum(0)))

    x = minimum(loss, np.zeros((k + 1) * domains), rounds=40)
    return DomainModel(buckets, x[: k * domains].reshape(domains, k).T.copy(), x[k * domains :])


def posteriors(docs: DataFrame, model: DomainModel, text: str = "text") -> DataFrame:
    """All columns of ``docs``, ``__tokens`` (words) and ``__shares``, the domains' posteriors.

    Shares are whole steps of 1/``STEPS`` that add up to one. Texts without words, null
    ones among them, have the shares of the offsets alone and no tokens.
    """
    places, domains = ft.bucket_places(model.buckets), len(model.offsets)

    @arrow_udf("struct<tokens bigint, shares array<double>>")
    def shares(column: pa.Array) -> pa.Array:
        tokens, rows = [np.zeros(0, np.int64)], [np.zeros((0, domains))]
        for piece in column_pieces(column):
            scores, words = ft.row_scores(*text_bytes(piece), places, model.weights)
            chance = softmax(scores + model.offsets) * STEPS
            whole = np.floor(chance)
            # The steps that are left go to the largest remainders
            order = np.argsort(np.argsort(whole - chance, axis=1, kind="stable"), axis=1)
            tokens.append(words.astype(np.int64))
            rows.append(whole + (order < (STEPS - whole.sum(1, keepdims=True))))
        flat = np.concatenate(rows) / STEPS
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * domains, pa.int32()), pa.array(flat.ravel()))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(tokens)), lists], ["tokens", "shares"])

    # Only texts go to Python; kept from being evaluated once for each of the two
    out = docs.withColumn("__posterior", shares.asNondeterministic()(F.col(f"`{text}`")))
    return out.select(
        *[F.col(f"`{n}`") for n in docs.columns], F.col("__posterior.tokens").alias("__tokens"),
        F.col("__posterior.shares").alias("__shares"),
    )


class Rates(NamedTuple):
    """Steps of the fit: a document's rate follows from them and its shares."""

    pulls: list[list[float]]
    momenta: list[float]
    totals: list[float]

    def column(self, shares: Column, looked_ahead: bool = False, start: Column | None = None) -> Column:
        """The rate after all steps, or the point at which the next pull is taken.

        ``start`` is the state before the first of them, 1 if None.
        """
        if start is None:
            start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
        if not self.pulls:
            return start["ahead" if looked_ahead else "rate"]
        steps = F.array(*[
            F.struct(F.array(*map(F.lit, pull)).alias("pull"), F.lit(m).alias("momentum"))
            for pull, m in zip(self.pulls, self.momenta)
        ])

        def step(state: Column, s: Column) -> Column:
            pulled = F.aggregate(
                F.zip_with(shares, s["pull"], lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y
            )
            rate = F.greatest(F.lit(0.0), state["ahead"] - pulled)
            return F.struct(rate.alias("rate"), (rate + s["momentum"] * (rate - state["rate"])).alias("ahead"))

        return F.aggregate(steps, start, step)["ahead" if looked_ahead else "rate"]


def fitted_rates(shared: DataFrame, targets: list[float], rounds: int = 300, close: float = 1e-4) -> Rates:
    """Rates >= 0, from 1, whose expected domain tokens match ``targets`` times all tokens.

    ``shared`` has ``__tokens`` and ``__shares``. Each round adds up the domains' tokens over
    all documents, in Spark, and takes one projected-gradient step with momentum; documents
    of equal shares have equal rates, so they are added up once beforehand, to at most one
    row for each point of the grid of shares, whose state is stored from time to time.

    After ``PLAIN`` rounds the gradient is scaled by the inverse of the domains' Gram matrix
    so that a rare domain beside a large one converges as fast, and momentum starts anew
    where the error rises. Targets met within ``close`` end the fit. Where the error stays,
    as they can't be met, plain rounds follow until it stays again, and a warning tells what
    the rates of least error miss. Without tokens all rates stay 1.
    """
    k = len(targets)
    groups = stored(
        shared.groupBy("__shares").agg(F.sum("__tokens").cast("double").alias("tokens")).where("tokens > 0")
        .withColumnRenamed("__shares", "shares").repartition(1 + shared.sparkSession.sparkContext.defaultParallelism // 4),
        "shares",
    )
    share = [F.col("shares")[i] for i in range(k)]
    grams = groups.agg(F.sum("tokens"), *[F.sum(F.col("tokens") * a * b) for a in share for b in share]).first()
    rates = Rates([], [], [])
    if not grams[0]:
        return rates
    total = grams[0]
    gram = np.array(grams[1:]).reshape(k, k) / total
    # The largest curvature of the squared error bounds the plain step; that of the scaled one is 1
    plain = np.eye(k) / np.linalg.eigvalsh(gram).max()
    scaled = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    goal = np.array(targets)
    groups = groups.withColumn("state", F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead")))
    held = begun = 0
    idle, stays = 0, 0
    last, best = np.inf, (np.inf, 0, [], 0.0)
    for n in range(rounds + 1):
        since = rates._replace(pulls=rates.pulls[held:], momenta=rates.momenta[held:])
        rate, ahead = (since.column(F.col("shares"), looked, F.col("state")) for looked in (False, True))
        if n - held == HELD:
            before = groups
            groups = stored(groups.withColumn("state", F.struct(rate.alias("rate"), ahead.alias("ahead"))), "rates")
            if held:
                dropped(before)
            held, rate, ahead = n, F.col("state.rate"), F.col("state.ahead")
        weighed = groups.select("shares", (F.col("tokens") * rate).alias("rate"), (F.col("tokens") * ahead).alias("ahead"))
        sums = np.array(weighed.agg(*[F.sum(F.col(c) * s) for c in ("rate", "ahead") for s in share]).first())
        rates = rates._replace(totals=[float(x) for x in sums[:k]])
        rest = sums[:k] / total - goal
        if np.abs(rest).max() <= close:
            return rates
        error = float(rest @ rest)
        idle = 0 if error < 0.99 * best[0] else idle + 1
        if (n >= PLAIN or n == rounds) and error < best[0]:
            best = (error, n, rates.totals, float(np.abs(rest).max()))
        if n >= PLAIN and (error > last or n == PLAIN):
            begun = n
        if n >= PLAIN and idle >= IDLE:
            stays, idle, begun = stays + 1, 0, n
        if n == rounds or stays == 2:
            break
        last = error
        step = scaled if n >= PLAIN and not stays else plain
        rates.pulls.append([float(x) for x in step @ (sums[k:] / total - goal)])
        rates.momenta.append((n - begun) / (n - begun + 3))
    _, kept, totals, missed = best
    warnings.warn(f"the fitted rates miss a target by {missed:.2g} of all words after {n} rounds", stacklevel=2)
    return Rates(rates.pulls[:kept], rates.momenta[:kept], totals)


def mixed(
    docs: DataFrame, labels: DataFrame, targets: dict, domain: str = "lang", text: str = "text",
    key: str = "doc_id", train_rows: int = TRAIN_ROWS, keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all if None), ``__tokens, __shares`` (in the order of ``targets``), ``__rate`` and ``__copies``.

    The classifier learns the ``domain`` of the documents listed in ``labels`` (at most
    ``train_rows``); other documents need none, and null or unknown domains are left out of
    the fit. ``__copies`` is the rate rounded up or down by a hash of the key and text, so
    that its mean is the rate; repeated rows get equal copies. Null keys are hashed like
    any other. Without labelled rows all shares are equal; an empty table gives no rows.
    """
    names = list(targets)
    number = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    listed = labels.select(key).distinct()
    known = (
        docs.select(F.col(f"`{key}`").alias(key), number[F.col(f"`{domain}`")].alias("label")).join(listed, key, "left_semi")
        .groupBy(key).agg(F.min("label").alias("label"))
    )
    sample = ft.labelled_sample(docs, known, train_rows, key, text)
    model = fit(sample, len(names)) if len(sample.labels) else DomainModel(
        np.zeros(0, np.int64), np.zeros((0, len(names))), np.zeros(len(names))
    )
    chance = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"), F.lit("copies")), F.lit(1 << 31))
    kept = [F.col(f"`{n}`") for n in (docs.columns if keep is None else keep)]
    shared = stored(
        posteriors(docs, model, text).select(*kept, "__tokens", "__shares", (chance / float(1 << 31)).alias("__chance")),
        "posteriors",
    )
    whole = sum(targets.values())
    rates = fitted_rates(shared, [t / whole for t in targets.values()])
    rate = F.col("__rate")
    more = (F.col("__chance") < rate - F.floor(rate)).cast("int")
    return shared.withColumn("__rate", rates.column(F.col("__shares"))).withColumn(
        "__copies", (F.floor(rate) + more).cast("int")
    ).drop("__chance")


def realised(docs: DataFrame, labels: DataFrame, targets: dict, **rules) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say."""
    rated = mixed(docs, labels, targets, **rules).where("__copies > 0")
    return rated.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(
        *[F.col(f"`{n}`") for n in docs.columns]
    )


def numbered(docs: DataFrame, out: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``out``: the number, from 0, of every row among those of its key and text, as of copies."""
    same = Window.partitionBy(F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))).orderBy(F.lit(0))
    return docs.withColumn(out, F.row_number().over(same) - 1)
