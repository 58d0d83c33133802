"""Quality rules: n-gram log-likelihood ratio between trusted text and the raw corpus.

Hashed 1- and 2-grams of words are counted over all trusted and over all documents. A
document's score is its mean log ratio of the two multinomials, so that long and short
texts compare; documents under a fixed quantile of the trusted scores fail.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from semestra.llm import text as texts
from semestra.llm.storage import released, stored

#: Buckets of n-grams, as a power of two.
BITS = 16
#: Pseudo-counts added to every bucket, in proportion to the corpus.
PRIOR = 20_000.0
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_BASE_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class Base(NamedTuple):
    """Counts the fixed rules are made of."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


def repeat_words(words: list[bytes]) -> int:
    """Words inside some window of three words that is found twice or more."""
    number: dict = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    n = len(ids)
    if n < 4:
        return 0
    a = np.array(ids, np.int64)
    pairs = np.unique(a[:-1] * len(number) + a[1:], return_inverse=True)[1]
    windows = pairs[:-1] * np.int64(len(number)) + a[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    begins = counts[which] >= 2
    covered = np.zeros(n, bool)
    covered[:-2] |= begins
    covered[1:-1] |= begins
    covered[2:] |= begins
    return int(covered.sum())


def base_counts(data: bytes) -> Base:
    words = data.split()
    raw = np.frombuffer(data, np.uint8)
    seen: set[bytes] = set()
    repeated = 0
    for line in data.split(b"\n"):
        if line and line.strip(texts.SPACES):
            if line in seen:
                repeated += 1
            seen.add(line)
    # Every code point has one byte that goes on from no other
    chars = int(np.count_nonzero((raw & 0xC0) != 0x80)) - int(np.count_nonzero(texts.IS_SPACE[raw]))
    return Base(len(words), chars, int(np.count_nonzero(_SYMBOLS[raw])), repeated, repeat_words(words))


def ngram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of every row in turn, and where each row begins.

    A word, lower-cased, gives itself, its last three bytes, its first five bytes and its
    pair with the word before it (a mark at the start of a row).
    """
    lower = texts.LOWER[data]
    starts, ends, firsts = texts.word_spans(data, offsets)
    sums = texts.prefix_sums(lower)
    whole = texts.span_hashes(sums, starts, ends)
    tails = texts.span_hashes(sums, np.maximum(starts, ends - 3), ends)
    heads = texts.span_hashes(sums, starts, np.minimum(ends, starts + 5))
    before = np.zeros(len(whole), np.uint64)
    before[1:] = whole[:-1]
    begins = firsts[:-1][firsts[:-1] < len(whole)]
    before[begins] = 0
    columns = (whole, tails ^ np.uint64(0x33), heads ^ np.uint64(0x55), whole + texts.mixed(before))
    out = np.stack([texts.mixed(c) >> np.uint64(64 - BITS) for c in columns], 1).astype(np.int64)
    return out, firsts


def _bucket_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all buckets, one row for each, for every partition."""
    counts = np.zeros(1 << BITS, np.int64)
    for batch in texts.pieces(batches):
        buckets, _ = ngram_buckets(*texts.text_bytes(batch.column("text")))
        counts += np.bincount(buckets.ravel(), minlength=1 << BITS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["bucket", "n"])


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of all buckets over all rows: 2^``BITS`` numbers whatever the corpus."""
    rows = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_bucket_sums, "bucket int, n bigint")
    table = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << BITS)
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return counts


def log_ratios(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Log ratio of trusted to raw share of every bucket.

    Buckets without trusted text are smoothed towards the corpus; without any trusted or
    raw text all ratios are zero.
    """
    if not raw.sum() or not good.sum():
        return np.zeros(1 << BITS)
    share = (raw + 1) / (raw + 1).sum()
    # The prior shrinks with small trusted corpora, so that they still say something
    prior = min(PRIOR, good.sum() / 10)
    return np.log((good + prior * share) / (good.sum() + prior)) - np.log(share)


def _scorer(ratios: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.pieces(batches):
            buckets, firsts = ngram_buckets(*texts.text_bytes(batch.column("text")))
            totals = texts.row_sums(ratios[buckets].sum(1), firsts)
            scores = totals / np.maximum(4 * np.diff(firsts), 1)
            base = [base_counts(data) for data in texts.raw_texts(batch.column("text"))]
            fields = [pa.array(list(c), pa.int64()) for c in zip(*base)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *fields, pa.array([b.failed for b in base], pa.bool_()), pa.array(np.round(scores, 9))],
                ["key", *_BASE_FIELDS, "base_failed", "score"],
            )

    return run


def judged(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the base counts, ``base_failed``, ``score`` and ``kept`` of every row.

    ``ratings`` has ``key`` and ``trusted``, true for documents of the target, false for
    bad ones; rows with a null in either are left out, and a key rated both ways is not
    trusted. All trusted documents make up the target, all documents the raw corpus, each
    over the whole of its text. The threshold is the score that best parts trusted from
    bad rows that pass the base rules, the middle between equally good ones; without bad
    rows it is the least trusted score, without trusted ones all pass. Null texts have no
    words and fail the base rules; repeated rows are judged alike; other columns are not
    looked at; an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rated = (
        ratings.where(F.col(key).isNotNull() & F.col("trusted").isNotNull())
        .groupBy(F.col(key).alias("key")).agg(F.min(F.col("trusted").cast("int")).alias("trusted"))
    )
    # Texts move once, to the ratings, in the same way at every size; the passes over all
    # documents stay where these are
    good = bucket_counts(rows.join(rated.where("trusted = 1").hint("merge"), "key", "left_semi"))
    released(docs.sparkSession)
    fields = ", ".join(f"{f} bigint" for f in _BASE_FIELDS)
    scored = stored(
        rows.mapInArrow(_scorer(log_ratios(bucket_counts(rows), good)), f"key {kind}, {fields}, base_failed boolean, score double"),
        "scores",
    )
    cut = threshold(scored.where("NOT base_failed").select("key", "score").join(rated, "key"))
    kept = ~F.col("base_failed") & (F.col("score") >= cut)
    return scored.select(F.col("key").alias(key), *_BASE_FIELDS, "base_failed", "score", kept.alias("kept"))


def threshold(scored: DataFrame, grid: int = 1000) -> float:
    """The score that keeps most trusted rows and fewest others, from counts on a grid.

    The grid spans the scores of the rated rows; what comes to the driver is one row for
    each of its cells.
    """
    low, high, n = scored.agg(F.min("score"), F.max("score"), F.countDistinct("trusted")).first()
    if n < 2:
        return low if low is not None and scored.where("trusted = 1").limit(1).count() else -float("inf")
    width = (high - low) / grid or 1.0
    cells = scored.groupBy(F.least(F.floor((F.col("score") - low) / width), F.lit(grid - 1)).alias("cell")).agg(
        F.sum("trusted").alias("good"), F.sum(1 - F.col("trusted")).alias("bad")
    ).collect()
    good, bad = np.zeros(grid), np.zeros(grid)
    for cell, g, b in cells:
        good[cell], bad[cell] = g, b
    lost = np.concatenate(([0], np.cumsum(good))) / good.sum()
    caught = np.concatenate(([0], np.cumsum(bad))) / bad.sum()
    gain = caught - lost
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(low + width * best.mean())
