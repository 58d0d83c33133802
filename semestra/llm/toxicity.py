"""Toxicity: a convolutional text classifier in numpy, with thresholds by language.

A word is embedded as the sum of hashed parts of it. Filters of several widths slide over
the words of the whole text; each keeps its two greatest answers, so that one chance hit
is told from several, and a logistic output reads these. Word parts that were not seen in
training add nothing.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from semestra.llm import text as texts
from semestra.llm.storage import dropped, stored

#: Buckets of word parts, as a power of two; numbers that embed a part.
BITS, SIZE = 18, 8
#: Words that a filter reads, and filters of each width.
WIDTHS, FILTERS = (1, 2, 3), 12
#: Answers of a filter that are kept of a row.
TOPS = 2
#: First bytes of a word that are parts of it, beside the whole word.
PREFIXES = (4, 5, 6, 7, 8)
PARTS = 1 + len(PREFIXES)
_SALTS = [np.uint64(0x1111 * n) for n in range(PARTS)]
_LONGER = np.uint64(1 << 40)

#: Rated rows of either label that the model begins on, chosen by a hash of their key among
#: those of at most so many bytes. Bounds what comes to the driver.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_BYTES = 1500, 3000, 1 << 15
#: One in how many rated rows calibrates; ratings of a language that it takes for its own threshold.
HELD, LEAST = 4, 10
#: Rated rows that a task learns from; logits that are told apart in one unit by the calibration.
PART_ROWS, STEPS = 1 << 13, 64
#: Ratings that are sent to all tasks at once.
SENT = 1 << 20
#: Words that go through the filters at once.
BLOCK = 1 << 15

_byte = np.arange(256)
#: Letters, digits and all bytes beyond ASCII make words.
IN_WORD = (_byte >= 128) | ((_byte >= 48) & (_byte < 58)) | ((_byte | 32) >= 97) & ((_byte | 32) < 123)


def _cuts(data: np.ndarray, limit: int = texts.PIECE_POWERS) -> Iterator[tuple[int, int]]:
    """Spans of about ``limit`` bytes that end behind a whole word."""
    start = 0
    while start < len(data):
        stop = min(len(data), start + limit)
        while stop < len(data) and IN_WORD[data[stop]]:
            rest = IN_WORD[data[stop : stop + 4096]]
            stop += len(rest) if rest.all() else int(np.argmin(rest))
        yield start, stop
        start = stop


def word_parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the parts of every word, and for each row the index of its first word."""
    found, starts_seen = [np.zeros((0, PARTS), np.int32)], [np.zeros(0, np.int64)]
    for a, b in _cuts(data):
        lower = texts.LOWER[data[a:b]]
        edges = np.unique(np.clip(offsets, a, b)) - a
        inside = IN_WORD[lower]
        first = np.zeros(b - a + 1, bool)
        first[edges] = True
        first[[0, -1]] = True
        starts = np.flatnonzero(inside & (first[:-1] | ~np.concatenate(([False], inside[:-1]))))
        ends = np.flatnonzero(inside & (first[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        sums = texts.prefix_sums(lower)
        parts = np.empty((len(starts), PARTS), np.int32)
        for column, (size, salt) in enumerate(zip((b - a, *PREFIXES), _SALTS)):
            # The start of a longer word is another part than a word that ends there
            longer = (ends > starts + size).astype(np.uint64) * _LONGER
            hashes = texts.span_hashes(sums, starts, np.minimum(ends, starts + size))
            parts[:, column] = texts.mixed(hashes ^ salt ^ longer) >> np.uint64(64 - BITS)
        found.append(parts)
        starts_seen.append(starts + a)
    return np.concatenate(found), np.searchsorted(np.concatenate(starts_seen), offsets)


class Network(NamedTuple):
    """Embedding of parts, filters for each width with their shifts, output and its bias.

    A probability is the logistic of ``scale`` times the output plus ``offset``.
    ``thresholds`` are by language, under None for all others.
    """

    embedding: np.ndarray
    filters: tuple[np.ndarray, ...]
    shifts: tuple[np.ndarray, ...]
    output: np.ndarray
    bias: float
    scale: float = 1.0
    offset: float = 0.0
    thresholds: tuple[tuple[str | None, float], ...] = ((None, 0.5),)

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return logistic(self.scale * logits + self.offset)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def new_network(rng: np.random.Generator) -> Network:
    """Parts start at nothing, so that those never seen stay without effect."""
    taps = tuple(rng.normal(0, 0.5, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS)
    shifts = tuple(np.full(FILTERS, 0.1, np.float32) for _ in WIDTHS)
    output = np.abs(rng.normal(0, 0.3, (TOPS, len(WIDTHS) * FILTERS)))
    output[:, 1::2] *= -1
    return Network(np.zeros((1 << BITS, SIZE), np.float32), taps, shifts, output.astype(np.float32), 0.0)


def _tops(answer: np.ndarray, edges: np.ndarray, start: int):
    """The greatest answers of every row and filter, and their places; uses up ``answer``."""
    lengths = np.diff(np.append(edges, len(answer)))
    found, places = [], []
    columns = np.arange(answer.shape[1])
    for _ in range(TOPS):
        top = np.maximum.reduceat(answer, edges, axis=0)
        where = np.where(answer == np.repeat(top, lengths, 0), np.arange(len(answer), dtype=np.int32)[:, None], np.int32(len(answer)))
        place = np.minimum.reduceat(where, edges, axis=0)
        answer[place, columns] = -np.inf
        found.append(top)
        places.append(place.astype(np.int64) + start)
    return np.stack(found, 1), np.stack(places, 1)


def pooled(net: Network, parts: np.ndarray, firsts: np.ndarray):
    """The greatest answers of every filter in every row, and the places where they start;
    the embedded words, and the place of each.

    Behind each row come some words of nothing, so that filters never see two rows, and a
    row without words has the answers to nothing.
    """
    further = max(WIDTHS) - 1
    pad = TOPS + further
    rows, total = len(firsts) - 1, len(parts)
    at = np.arange(total) + np.repeat(np.arange(rows) * pad, np.diff(firsts))
    begins = firsts[:-1] + np.arange(rows) * pad
    length = total + rows * pad
    words = np.zeros((length + pad, SIZE), np.float32)
    # Filters do not start where they would read on into the next row
    outside = np.zeros(length, bool)
    for back in range(1, further + 1):
        outside[begins[1:] - back] = True
    outside[length - further :] = True
    for start in range(0, total, BLOCK):
        words[at[start : start + BLOCK]] = net.embedding[parts[start : start + BLOCK]].sum(1)
    shape = (rows, TOPS, len(WIDTHS) * FILTERS)
    best, places = np.full(shape, -np.inf, np.float32), np.zeros(shape, np.int64)
    for start in range(0, length, BLOCK):
        stop = min(length, start + BLOCK)
        # Rows of this block: the first may have begun in the block before
        low = int(np.searchsorted(begins, start, "right")) - 1
        high = int(np.searchsorted(begins, stop))
        edges = np.maximum(begins[low:high], start) - start
        answers = []
        for taps, shift in zip(net.filters, net.shifts):
            answer = np.repeat(shift[None], stop - start, 0)
            for j in range(len(taps)):
                answer += words[start + j : stop + j] @ taps[j]
            answers.append(answer)
        joined = np.concatenate(answers, 1)
        joined[outside[start:stop]] = -np.inf
        top, place = _tops(joined, edges, start)
        best[low + 1 : high], places[low + 1 : high] = top[1:], place[1:]
        # The first row may hold answers of the block before
        both = np.concatenate((best[low], top[0])), np.concatenate((places[low], place[0]))
        order = np.argsort(-both[0], 0, kind="stable")[:TOPS]
        best[low], places[low] = (np.take_along_axis(x, order, 0) for x in both)
    return best, places, words, at


def logits(net: Network, parts: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    best = pooled(net, parts, firsts)[0]
    return (np.einsum("rkf,kf->r", np.maximum(best, 0), net.output) + net.bias).astype(np.float64)


class Sample(NamedTuple):
    """Word parts of rated rows, the index of each row's first word, labels and languages."""

    parts: np.ndarray
    firsts: np.ndarray
    labels: np.ndarray
    languages: np.ndarray

    def rows(self, chosen: np.ndarray) -> Sample:
        spans = [self.parts[self.firsts[r] : self.firsts[r + 1]] for r in chosen]
        ends = np.cumsum([0, *map(len, spans)])
        parts = np.concatenate([np.zeros((0, PARTS), np.int32), *spans])
        return Sample(parts, ends, self.labels[chosen], self.languages[chosen])


def _row_counts(sample: Sample) -> np.ndarray:
    """In how many rows each bucket occurs."""
    counts = np.zeros(1 << BITS, np.int32)
    for a, b in zip(sample.firsts, sample.firsts[1:]):
        counts[np.unique(sample.parts[a:b])] += 1
    return counts


def slopes(net: Network, part: Sample):
    """Slopes of the mean loss by filters, shifts and output, by the bias, and by the
    embedding of the parts that gave the greatest answers; all other parts have none."""
    best, places, words, at = pooled(net, part.parts, part.firsts)
    active = np.maximum(best, 0)
    told = np.einsum("rkf,kf->r", active, net.output) + net.bias
    off = ((logistic(told) - part.labels) / len(part.labels)).astype(np.float32)
    back = off[:, None, None] * net.output * (best > 0)
    word_of = np.full(len(words), -1, np.int64)
    word_of[at] = np.arange(len(at))
    by_array, touched, pulls = [], [], []
    for n, taps in enumerate(net.filters):
        columns = slice(n * FILTERS, (n + 1) * FILTERS)
        place, pull = places[:, :, columns], back[:, :, columns]
        slope = np.empty_like(taps)
        for j in range(len(taps)):
            slope[j] = np.einsum("rkfs,rkf->sf", words[place + j], pull)
            touched.append(word_of[place + j].ravel())
            pulls.append((pull[..., None] * taps[j].T).reshape(-1, SIZE))
        by_array.append(slope)
    by_array += [back[:, :, n * FILTERS : (n + 1) * FILTERS].sum((0, 1)) for n in range(len(WIDTHS))]
    by_array.append(np.einsum("rkf,r->kf", active, off))
    # Embeddings: only parts of the words that answered
    touched, pulls = np.concatenate(touched), np.concatenate(pulls)
    real = (touched >= 0) & pulls.any(1)
    ids = part.parts[touched[real]]
    buckets, back_to = np.unique(ids, return_inverse=True)
    change = np.zeros((len(buckets), SIZE), np.float32)
    np.add.at(change, back_to.reshape(ids.shape), pulls[real][:, None, :])
    return by_array, float(off.sum()), buckets, change


class Learner:
    """A network in training, and the squares of its past slopes, with which steps shrink."""

    def __init__(self, net: Network, common: np.ndarray, rate: float = 0.1, skipped: float = 0.3, fading: float = 0.001):
        self.net, self.common = net, common
        self.rate, self.skipped, self.fading = rate, skipped, fading
        self.past_embedding = np.full(net.embedding.shape, 1e-6, np.float32)
        self.past = [np.full_like(a, 1e-6) for a in (*net.filters, *net.shifts, net.output)]
        self.past_bias = 1e-6

    def learn(self, part: Sample, rng: np.random.Generator) -> None:
        """One step on a batch."""
        net = self.net
        if self.skipped:
            stays = rng.random(len(part.parts)) >= self.skipped
            ends = np.concatenate(([0], np.cumsum(stays)))[part.firsts]
            part = part._replace(parts=part.parts[stays], firsts=ends)
        by_array, by_bias, buckets, change = slopes(net, part)
        change += self.fading * net.embedding[buckets]
        buckets, change = buckets[self.common[buckets]], change[self.common[buckets]]
        self.past_embedding[buckets] += change * change
        net.embedding[buckets] -= self.rate * change / np.sqrt(self.past_embedding[buckets])
        arrays = []
        for value, slope, squares in zip((*net.filters, *net.shifts, net.output), by_array, self.past):
            squares += slope * slope
            arrays.append(value - self.rate / 4 * slope / np.sqrt(squares))
        self.past_bias += by_bias**2
        k = len(WIDTHS)
        self.net = net._replace(
            filters=tuple(arrays[:k]), shifts=tuple(arrays[k : 2 * k]), output=arrays[-1],
            bias=net.bias - self.rate / 4 * by_bias / self.past_bias**0.5,
        )


def begun(
    sample: Sample, rounds: int = 10, rate: float = 0.1, batch: int = 32, seed: int = 11,
    least_rows: int = 4, skipped: float = 0.3, fading: float = 0.001,
) -> Learner:
    """Minibatches with steps that shrink with the squares of past slopes.

    Against learning rows by heart, parts in fewer than ``least_rows`` rows stay without
    effect, a share of the words, drawn anew for every batch, is ``skipped``, and what is
    learnt of a part is pulled back a little whenever the part is met.
    """
    rng = np.random.default_rng(seed)
    net = new_network(rng)
    net = net._replace(bias=float(np.log((sample.labels.sum() + 1) / ((sample.labels == 0).sum() + 1))))
    learner = Learner(net, _row_counts(sample) >= least_rows, rate, skipped, fading)
    for _ in range(rounds):
        order = rng.permutation(len(sample.labels))
        for start in range(0, len(order), batch):
            learner.learn(sample.rows(order[start : start + batch]), rng)
    return learner


def fitted(sample: Sample, **settings) -> Network:
    """The network of ``begun``."""
    return begun(sample, **settings).net


def _threshold(chances: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the chances at which the harmonic mean of precision and recall is best."""
    steps = np.linspace(0.02, 0.98, 49)
    hits = np.array([weights[(chances >= t) & (labels == 1)].sum() for t in steps])
    told = np.array([weights[chances >= t].sum() for t in steps])
    gain = 2 * hits / np.maximum(told + weights[labels == 1].sum(), 1e-9)
    return float(np.mean(steps[gain >= gain.max() - 1e-9]))


def calibrated(net: Network, held: Sample, weights: np.ndarray) -> Network:
    """Scale and offset by logistic regression on held-out rows, then a threshold for every
    language with enough of either label, and one for all others.

    ``weights`` restore the shares that the labels have outside the sample.
    """
    found = logits(net, held.parts, held.firsts)
    return calibrated_on(net, found, held.labels, held.languages, weights, np.ones(len(found)))


def calibrated_on(
    net: Network, found: np.ndarray, labels: np.ndarray, languages: np.ndarray, weights: np.ndarray, rows: np.ndarray,
) -> Network:
    """``calibrated`` by the logits of held-out rows; each stands for a number of ``rows``."""
    mean = np.average(found, weights=rows)
    spread = np.sqrt(np.average((found - mean) ** 2, weights=rows)) or 1.0
    x = np.stack(((found - mean) / spread, np.ones(len(found))), 1)
    toxic, clean = rows[labels == 1].sum(), rows[labels == 0].sum()
    # A prior of one row on either side keeps the fit finite when the two part cleanly
    goal = np.where(labels == 1, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    w = np.array([1.0, 0.0])

    def loss(w):
        p = np.clip(logistic(x @ w), 1e-12, 1 - 1e-12)
        return -(weights * (goal * np.log(p) + (1 - goal) * np.log(1 - p))).sum()

    for _ in range(50):
        p = logistic(x @ w)
        curve = (x * (weights * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (weights * (p - goal)))
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    net = net._replace(scale=float(w[0] / spread), offset=float(w[1] - w[0] * mean / spread))
    chances = net.probabilities(found)
    cuts: list[tuple[str | None, float]] = [(None, _threshold(chances, labels, weights))]
    for language in sorted({v for v in languages if v is not None}):
        own = languages == language
        if min(rows[own & (labels == 1)].sum(), rows[own & (labels == 0)].sum()) >= LEAST:
            cuts.append((language, _threshold(chances[own], labels[own], weights[own])))
    return net._replace(thresholds=tuple(cuts))


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts.pieces(batches):
        parts, firsts = word_parts(*texts.text_bytes(batch.column("text")))
        rows = [parts[a:b].astype("<i4").tobytes() for a, b in zip(firsts, firsts[1:])]
        names = ("label", "place", "lang")
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(rows, pa.binary())], [*names, "parts"])


def rated(labels: DataFrame) -> DataFrame:
    """doc_id and label of the documents that ``labels`` rates; toxic if any rating says so."""
    return labels.groupBy("doc_id").agg(F.max("toxic").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
    )


def held_out(key: Column) -> Column:
    """True for a fifth of the keys, by the CRC-32 of the key as text; true for null."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


#: Places are below this number.
SPAN = 1 << 31


def _place(key: Column) -> Column:
    """The place of a key in the order of the sample, by a hash."""
    return F.pmod(F.xxhash64(key, F.lit("toxicity")), F.lit(SPAN))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, language: str | None, sizes: tuple[int, int], most_bytes: int,
) -> tuple[Sample, np.ndarray]:
    """A sample of rated rows, and for each the rows of its label it stands for.

    At most ``sizes[label]`` rows of each label, those with the least hash of key and text,
    among texts of up to ``most_bytes``.
    """
    ratings = labels.select(
        F.col(key).alias("__key"), F.col("label").cast("int").alias("label"),
    )
    counts = {r.label: r["count"] for r in ratings.groupBy("label").count().collect()}
    # The shares leave a margin, as long texts are left out; the limit below cuts a few rows
    share = F.lit(0)
    for label, size in enumerate(sizes):
        bound = min(1.0, (2 * size + 100) / max(1, counts.get(label, 0)))
        share = F.when(F.col("label") == label, int(bound * SPAN)).otherwise(share)
    chosen = ratings.withColumn("place", _place(F.col("__key"))).where(F.col("place") < share)
    lang = F.col(f"`{language}`").cast("string") if language else F.lit(None).cast("string")
    rows = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("text"), lang.alias("lang"))
    short = F.octet_length(F.coalesce("text", F.lit(""))) <= most_bytes
    # The chosen keys are bounded by the sizes, so they may be sent to all tasks
    found = rows.where(short).join(F.broadcast(chosen), "__key").select("label", "place", "lang", "text")
    order = ["place", F.md5(F.coalesce("text", F.lit("")))]
    parts = [found.where(F.col("label") == label).orderBy(*order).limit(size) for label, size in enumerate(sizes)]
    table = parts[0].unionByName(parts[1]).mapInArrow(
        _parts, "label int, place bigint, lang string, parts binary"
    ).toArrow().sort_by([("place", "ascending"), ("parts", "ascending")])
    held = [np.frombuffer(b, "<i4").reshape(-1, PARTS) for b in table.column("parts").to_pylist()]
    label = np.array(table.column("label").to_pylist(), np.int64)
    firsts = np.cumsum([0, *map(len, held)])
    sample = Sample(
        np.concatenate([np.zeros((0, PARTS), np.int32), *held]), firsts, label,
        np.array(table.column("lang").to_pylist(), object),
    )
    stands = np.array([counts.get(v, 0) / max(1, (label == v).sum()) for v in (0, 1)])
    return sample, stands[label]


def _counted_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many rows of a task each bucket occurs."""
    counts = np.zeros(1 << BITS, np.int64)
    for batch in texts.pieces(batches):
        parts, firsts = word_parts(*texts.text_bytes(batch.column("text")))
        counts += _row_counts(Sample(parts, firsts, np.zeros(0), np.zeros(0)))
    buckets = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(counts[buckets])], ["place", "rows"])


def _common(rows: DataFrame, least_rows: int) -> np.ndarray:
    """Which buckets occur in so many rows of the whole frame."""
    counted = rows.select("text").mapInArrow(_counted_parts, "place bigint, rows bigint")
    found = counted.groupBy("place").agg(F.sum("rows").alias("rows")).where(F.col("rows") >= least_rows)
    common = np.zeros(1 << BITS, bool)
    common[found.select("place").toArrow().column(0).to_numpy()] = True
    return common


def _dense(net: Network) -> np.ndarray:
    """All numbers but the embedding, in rows as long as those of the embedding."""
    flat = np.concatenate([*(a.ravel() for a in (*net.filters, *net.shifts, net.output)), [net.bias]])
    return np.concatenate((flat, np.zeros(-len(flat) % SIZE))).reshape(-1, SIZE)


def _moved(net: Network, places: np.ndarray, change: np.ndarray) -> Network:
    """The network with changes of rows of the embedding and, behind it, of all other numbers."""
    embedding, dense = net.embedding.copy(), _dense(net)
    inside = places < len(embedding)
    embedding[places[inside]] += change[inside].astype(np.float32)
    dense[places[~inside] - len(embedding)] += change[~inside]
    flat, arrays, at = dense.ravel(), [], 0
    for array in (*net.filters, *net.shifts, net.output):
        arrays.append(flat[at : at + array.size].reshape(array.shape).astype(array.dtype))
        at += array.size
    k = len(WIDTHS)
    return net._replace(
        embedding=embedding, filters=tuple(arrays[:k]), shifts=tuple(arrays[k : 2 * k]), output=arrays[-1], bias=float(flat[at]),
    )


_CHANGES = [f"c{n}" for n in range(SIZE)]


def _learnt(shared, batch_rows: int = 32):
    """What a task's rows, learnt from once in their order, change of the shared network."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner: Learner = copy.deepcopy(shared.value)
        before, rng, met = learner.net._replace(embedding=learner.net.embedding.copy()), None, False
        for batch in texts.pieces(batches):
            parts, firsts = word_parts(*texts.text_bytes(batch.column("text")))
            labels = batch.column("label").to_numpy()
            sample = Sample(parts, firsts, labels, np.full(len(labels), None))
            rng = rng or np.random.default_rng(int(batch.column("place")[0].as_py()) if len(labels) else 0)
            for start in range(0, len(labels), batch_rows):
                learner.learn(sample.rows(np.arange(start, min(len(labels), start + batch_rows))), rng)
                met = True
        moved = learner.net.embedding - before.embedding
        buckets = np.flatnonzero(moved.any(1))
        dense = _dense(learner.net) - _dense(before)
        places = np.concatenate((buckets, (1 << BITS) + np.arange(len(dense)))) if met else buckets
        change = np.concatenate((moved[buckets], dense))[: len(places)]
        columns = [pa.array(places, pa.int64()), *(pa.array(change[:, n], pa.float64()) for n in range(SIZE))]
        yield pa.RecordBatch.from_arrays(columns, ["place", *_CHANGES])

    return run


def _taught(rows: DataFrame, learner: Learner) -> Network:
    """The learner's network after every row was learnt from once.

    Rows are dealt by their place to tasks of about ``PART_ROWS`` rows. Each goes on from the
    learner by itself; a part of words changes by the mean over the tasks that met it, all
    other numbers by the mean over all.
    """
    tasks = -(-rows.count() // PART_ROWS) or 1
    shared = rows.sparkSession.sparkContext.broadcast(learner)
    dealt = rows.select("place", "label", "text").repartition(tasks, "place")
    dealt = dealt.sortWithinPartitions("place", F.md5(F.coalesce("text", F.lit(""))), "label")
    changes = dealt.mapInArrow(_learnt(shared), "place bigint, " + ", ".join(f"{c} double" for c in _CHANGES))
    table = changes.groupBy("place").agg(*[F.avg(c).alias(c) for c in _CHANGES]).toArrow()
    shared.destroy()
    change = np.stack([table.column(c).to_numpy() for c in _CHANGES], 1)
    return _moved(learner.net, table.column("place").to_numpy(), change)


def _told(shared):
    """Label, language and rounded logit of held-out rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.pieces(batches):
            found = logits(shared.value, *word_parts(*texts.text_bytes(batch.column("text"))))
            steps = pa.array(np.rint(np.clip(found, -1000, 1000) * STEPS).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("lang"), steps], ["label", "lang", "step"])

    return run


def rated_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, language: str | None) -> DataFrame:
    """``place, label, lang, text`` of all rated rows.

    The texts stay where they are and are looked through once for every ``SENT`` ratings,
    which is cheaper than to shuffle all texts for the few that are rated.
    """
    ratings = labels.select(F.col(key).alias("__key"), F.col("label").cast("int").alias("label"), _place(F.col(key)).alias("place"))
    lang = F.col(f"`{language}`").cast("string") if language else F.lit(None).cast("string")
    rows = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("text"), lang.alias("lang"))
    slices = -(-ratings.count() // SENT) or 1
    # Places are hashes, so slices of them are even
    parts = [rows.join(F.broadcast(ratings.where(F.col("place") * slices / SPAN >= n).where(F.col("place") * slices / SPAN < n + 1)), "__key")
             for n in range(slices)]
    return reduce(DataFrame.unionByName, parts).select("place", "label", "lang", "text")


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", language: str | None = "lang",
    toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN, most_bytes: int = TRAIN_BYTES, least_rows: int = 4,
) -> Network | None:
    """A model from all rated rows, whole texts; None where one of the labels is lacking.

    ``labels`` has ``key`` and ``label`` (0 or 1), one row for a key. One in ``HELD`` rows, by
    a hash of the key, calibrates and gives the thresholds; all others fit the network. It
    begins on a bounded sample of them, on the driver; then all of them are learnt from in
    tasks, whose changes are averaged. ``language`` is looked at for the thresholds alone.
    """
    held = _place(F.col(key)) % HELD == 0
    sample, _ = labelled_sample(docs, labels.where(~held), key, text, language, (clean, toxic), most_bytes)
    if len(np.unique(sample.labels)) < 2:
        return None
    learner = begun(sample, least_rows=least_rows)
    rows = stored(rated_rows(docs, labels, key, text, language), "rated")
    fit, rest = rows.where(F.col("place") % HELD != 0), rows.where(F.col("place") % HELD == 0)
    learner.common = _common(fit, least_rows)
    net = _taught(fit, learner)
    shared = rows.sparkSession.sparkContext.broadcast(net)
    told = rest.select("label", "lang", "text").mapInArrow(_told(shared), "label int, lang string, step bigint")
    table = told.groupBy("label", "lang", "step").agg(F.count("*").alias("n")).toArrow()
    table = table.sort_by([(name, "ascending") for name in ("label", "lang", "step")])
    shared.destroy()
    dropped(rows)
    found, label, n = (table.column(c).to_numpy() for c in ("step", "label", "n"))
    if len(np.unique(label)) < 2:
        return None
    n = n.astype(float)
    return calibrated_on(net, found / STEPS, label, np.array(table.column("lang").to_pylist(), object), n, n)


def scored(docs: DataFrame, model: Network | None, text: str = "text", language: str | None = "lang") -> DataFrame:
    """All columns of ``docs``, and ``__score`` and ``__flagged``.

    ``__score`` is the probability of being toxic, from the whole text alone. ``__flagged``
    compares it with the threshold of the row's language, or the common one where the
    language is null, unknown or not a column. Null and empty texts have the score of no
    words; without a model every score is 0 and nothing is flagged. Columns of ``docs``
    that are called ``__score`` or ``__flagged`` are replaced; an empty table stays empty.
    A text of any length is read whole, in blocks of words.
    """
    columns = [F.col(f"`{n}`") for n in docs.columns if n not in ("__score", "__flagged")]
    if model is None:
        return docs.select(*columns, F.lit(0.0).alias("__score"), F.lit(False).alias("__flagged"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        net = shared.value
        out = [np.zeros(0)]
        for piece in texts.column_pieces(column):
            out.append(net.probabilities(logits(net, *word_parts(*texts.text_bytes(piece)))))
        return pa.array(np.concatenate(out), pa.float64())

    cut = F.lit(dict(model.thresholds)[None])
    if language:
        for name, value in model.thresholds:
            if name is not None:
                cut = F.when(F.col(f"`{language}`") == name, value).otherwise(cut)
    chance = score.asNondeterministic()(F.col(f"`{text}`"))
    # Kept together, so that the chance is worked out once
    rows = docs.select(*columns, F.struct(chance.alias("chance"), cut.alias("cut")).alias("__score"))
    return rows.select(
        *columns, F.col("__score.chance").alias("__score"),
        (F.col("__score.chance") >= F.col("__score.cut")).alias("__flagged"),
    )
