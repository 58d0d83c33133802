"""Hashed text features for linear models, and a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from semestra.llm import text as texts

#: Buckets that features are hashed into, as a power of two.
BITS = 18
_SALTS = [np.uint64(s) for s in (0, 0x1111, 0x2222, 0x3333)]


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word, and for each row the index of its first word.

    A word gives itself, its first 4 and 5 bytes and its last 3 (lower-cased), and whether
    it repeats the word before.
    """
    lower = texts.LOWER[data]
    starts, ends, firsts = texts.word_spans(data, offsets)
    sums = texts.prefix_sums(lower)
    whole = texts.span_hashes(sums, starts, ends)
    parts = [
        whole,
        texts.span_hashes(sums, starts, np.minimum(ends, starts + 4)),
        texts.span_hashes(sums, starts, np.minimum(ends, starts + 5)),
        texts.span_hashes(sums, np.maximum(starts, ends - 3), ends),
    ]
    out = np.empty((len(whole), 5), np.int32)
    for column, (part, salt) in enumerate(zip(parts, _SALTS)):
        out[:, column] = texts.mixed(part ^ salt) >> np.uint64(64 - BITS)
    out[:, 4] = 0
    out[1:, 4] = whole[1:] == whole[:-1]
    out[firsts[:-1][firsts[:-1] < len(whole)], 4] = 0
    return out, firsts


def counted(features: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of every different feature of a row."""
    rows = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    keys, counts = np.unique((rows[:, None] << BITS) | features, return_counts=True)
    return keys >> BITS, keys & ((1 << BITS) - 1), counts


class Sample(NamedTuple):
    """Feature counts of labelled rows."""

    rows: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    labels: np.ndarray


def values(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Square root of a feature's share of the words of its row."""
    return np.sqrt(counts / np.maximum(words, 1))


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts.pieces(batches):
        features, firsts = word_features(*texts.text_bytes(batch.column("text")))
        rows, buckets, counts = counted(features, firsts)
        cuts = np.searchsorted(rows, np.arange(1, batch.num_rows))
        weights = values(counts, np.diff(firsts)[rows]).astype("<f4")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("place"), batch.column("label"),
                pa.array([x.tobytes() for x in np.split(buckets.astype("<u4"), cuts)], pa.binary()),
                pa.array([x.tobytes() for x in np.split(weights, cuts)], pa.binary()),
            ],
            ["place", "label", "buckets", "weights"],
        )


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int, key: str, text: str) -> Sample:
    """Features of at most ``size`` labelled rows, chosen by a hash of their key.

    ``labels`` has ``key`` and ``label`` (0, 1, ...), one row for a key. The bound makes
    what comes to the driver independent of the corpus. The order is that of the hash, so
    the first rows are a random part.
    """
    span = 1 << 31
    there = labels.where(F.col("label").isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("id"), F.col("label").cast("int").alias("label"),
        F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(span)).alias("place"),
    )
    # The share leaves a margin; the limit then cuts a few rows, not the whole table
    share = min(1.0, (1.5 * size + 100) / max(1, there.count()))
    chosen = there.where(F.col("place") < int(share * span)).orderBy("place", "id").limit(size)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    found = rows.join(F.broadcast(chosen), "id").select("place", "label", "text")
    table = found.mapInArrow(_features, "place bigint, label int, buckets binary, weights binary").toArrow()
    table = table.sort_by([("place", "ascending"), ("label", "ascending"), ("buckets", "ascending")])
    labels = np.array(table.column("label").to_pylist(), np.int64)
    # Narrow numbers, as this is the largest thing that the driver holds
    buckets = [np.frombuffer(x, "<i4") for x in table.column("buckets").to_pylist()]
    weights = [np.frombuffer(x, "<f4") for x in table.column("weights").to_pylist()]
    del table
    number = np.repeat(np.arange(len(buckets), dtype=np.int32), [len(x) for x in buckets])
    return Sample(
        number, np.concatenate([np.zeros(0, "<i4"), *buckets]), np.concatenate([np.zeros(0, "<f4"), *weights]), labels
    )


def head(sample: Sample, size: int) -> tuple[Sample, Sample]:
    """The first rows of a sample and the others."""
    inside = sample.rows < size
    return (
        Sample(sample.rows[inside], sample.buckets[inside], sample.values[inside], sample.labels[:size]),
        Sample(sample.rows[~inside] - size, sample.buckets[~inside], sample.values[~inside], sample.labels[size:]),
    )


def telling_buckets(sample: Sample, splits: list[np.ndarray], least_z: float, least_rows: int) -> np.ndarray:
    """Buckets whose presence differs between the two sides of any split of the rows.

    The difference of the two shares is ``least_z`` standard errors or more, and the
    bucket is found in ``least_rows`` rows at least.
    """
    size = 1 << BITS
    keep = np.zeros(size, bool)
    for side in splits:
        inside, outside = side.sum(), (~side).sum()
        if not inside or not outside:
            continue
        a = np.bincount(sample.buckets[side[sample.rows]], minlength=size)
        b = np.bincount(sample.buckets[~side[sample.rows]], minlength=size)
        share = (a + b) / (inside + outside)
        error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / inside + 1 / outside))
        keep |= (np.abs(a / inside - b / outside) >= least_z * error) & (a + b >= least_rows)
    return np.flatnonzero(keep)


def row_scores(data: np.ndarray, offsets: np.ndarray, places: np.ndarray, weights: np.ndarray):
    """Scores of every row (one column for each of the weights' columns) and its words.

    ``places`` gives the row of ``weights`` for each bucket, -1 where there is none.
    """
    features, firsts = word_features(data, offsets)
    rows = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    found = places[features]
    word, column = np.nonzero(found >= 0)
    keys, counts = np.unique((rows[word] << BITS) | found[word, column], return_counts=True)
    row, place = keys >> BITS, keys & ((1 << BITS) - 1)
    words = np.diff(firsts)
    value = values(counts, words[row])
    scores = np.stack(
        [np.bincount(row, weights[place, c] * value, minlength=len(words)) for c in range(weights.shape[1])], 1
    )
    return scores, words


def bucket_places(buckets: np.ndarray) -> np.ndarray:
    places = np.full(1 << BITS, -1, np.int32)
    places[buckets] = np.arange(len(buckets))
    return places
