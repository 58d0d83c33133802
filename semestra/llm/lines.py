"""Line dedup: repeated lines are found on sorted hashes and told as keep bitmaps.

Hashes of lines are cut into ranges and sorted by document and position, so that one very
frequent line spreads over as many ranges as it needs. Each range is read as a stream;
only lines at its two ends can go on in another range, and their totals are added first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from semestra.llm.storage import dropped, stored
from semestra.llm.text import SPACES, pieces, raw_texts

_LINES = "high bigint, low bigint, doc bigint, copy bigint, positions array<int>, n_lines int"
_ENDS = "part int, high bigint, low bigint, docs bigint"


def _hashed_lines(min_chars: int):
    """One row for each different line of a text, and one with null hashes for the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows: list[list] = [[] for _ in range(6)]
            docs, copies = batch.column("doc").to_pylist(), batch.column("copy").to_pylist()
            for data, doc, copy in zip(raw_texts(batch.column("text")), docs, copies):
                lines = data.split(b"\n")
                places: dict[bytes, list[int]] = {}
                for n, line in enumerate(lines):
                    key = line.strip(SPACES)
                    if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        places.setdefault(xxhash.xxh3_128_digest(key.lower()), []).append(n)
                for digest, positions in [(None, []), *places.items()]:
                    high, low = (None, None) if digest is None else (
                        int.from_bytes(digest[:8], "big", signed=True),
                        int.from_bytes(digest[8:], "big", signed=True),
                    )
                    for column, value in zip(rows, (high, low, doc, copy, positions, len(lines))):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32()), pa.int32()]
            names = [field.split()[0] for field in _LINES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    return run


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(hash, document, row) of a sorted range, without the rows of whole texts."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("high", "low", "doc", "copy", "positions", "n_lines")]
        for high, low, *row in zip(*columns):
            if high is not None:
                yield (high, low), row[0], row


def _range_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of the first and the last hash of a range."""
    part, first, last, docs, before = None, None, None, 0, object()
    counts: dict = {}

    def watched():
        nonlocal part
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            yield batch

    for key, doc, _ in _runs(watched()):
        if key != last:
            counts = {k: v for k, v in counts.items() if k == first}
            first, last, before = first or key, key, object()
        if doc != before:
            counts[key] = counts.get(key, 0) + 1
            before = doc
    rows = [(part, *k, n) for k, n in counts.items()]
    columns = zip(*rows) if rows else [[]] * 4
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "high", "low", "docs"]
    )


def _dropped_lines(ends: dict, min_docs: int, keep_first: bool):
    """Positions to drop, from sorted ranges and the totals of the hashes at their ends."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        held: list[list] = []
        last, before, docs, known, has_first = None, object(), 0, 0, False
        current = None

        def watched():
            nonlocal current
            for batch in batches:
                current = batch.column("part")[0].as_py() if batch.num_rows else current
                out.extend(
                    [d, c, [], n]
                    for h, d, c, n in zip(*(batch.column(x).to_pylist() for x in ("high", "doc", "copy", "n_lines")))
                    if h is None
                )
                yield batch

        for key, doc, row in _runs(watched()):
            if key != last:
                held, last, before, docs = [], key, object(), 0
                known, start = ends.get(key, (0, None))
                has_first = start is not None and start != current
            if doc != before:
                docs, before = docs + 1, doc
            row = [row[0], row[1], row[2], row[3]]
            if keep_first and not has_first:
                has_first = True
                row[2] = row[2][1:]
            if max(docs, known) >= min_docs:
                out.extend(held)
                out.append(row)
                held = []
            else:  # never more than the documents that are too few
                held.append(row)
            if len(out) >= 10_000:
                yield _drops(out)
                out.clear()
        yield _drops(out)

    return run


def _drops(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32()]
    columns = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "copy", "positions", "n_lines"]
    )


def pack(n_lines: int, dropped: list[int]) -> bytes:
    """Compressed bits of a text's lines in order, 1 for kept."""
    keep = np.ones(n_lines, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def _bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("n_lines").to_pylist()
        bits = [pack(n, d) for n, d in zip(sizes, batch.column("dropped").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("copy"), batch.column("n_lines"), pa.array(bits, pa.binary())],
            ["doc", "copy", "n_lines", "bitmap"],
        )


def _identified(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows with their document, and a hash of the text for documents given more than once."""
    return docs.withColumns({
        "__doc": F.col(f"`{key}`").cast("long"), "__copy": F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))),
    })


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 2, keep_first: bool = False, min_chars: int = 1,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """``doc, copy, n_lines, bitmap`` for every document: which of its lines stay.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at
    least ``min_chars`` code points found in ``min_docs`` documents or more go, all but
    the first by document and position with ``keep_first``. Null texts are one empty line.
    Rows with the same ``key`` count as one document, rows without ``key`` as one too;
    ``copy`` is a hash of the text, so that different texts with one key have their own
    bitmaps and repeated rows share one.
    """
    rows = _identified(docs, text, key).select(
        F.col("__doc").alias("doc"), F.col("__copy").alias("copy"), F.col(f"`{text}`").alias("text")
    )
    # Written first, as Spark makes the rows once to cut the ranges and once to deal them
    hashed = stored(rows.mapInArrow(_hashed_lines(min_chars), _LINES), "lines")
    ordered = (
        hashed.repartitionByRange("high", "low", "doc")
        .sortWithinPartitions("high", "low", "doc", "copy", "positions")
        .withColumn("part", F.spark_partition_id())
        .persist(StorageLevel.DISK_ONLY)
    )
    # At most two rows for each range, whatever the number of lines
    ends: dict[tuple[int, int], tuple[int, int]] = {}
    for part, high, low, count in sorted(map(tuple, ordered.mapInArrow(_range_ends, _ENDS).collect())):
        total, start = ends.get((high, low), (0, part))
        ends[high, low] = (total + count, start)
    drops = ordered.mapInArrow(
        _dropped_lines(ends, min_docs, keep_first), "doc bigint, copy bigint, positions array<int>, n_lines int"
    )
    bitmaps = stored(
        drops.groupBy("doc", "copy")
        .agg(F.max("n_lines").alias("n_lines"), F.array_distinct(F.flatten(F.collect_list("positions"))).alias("dropped"))
        .mapInArrow(_bitmaps, "doc bigint, copy bigint, n_lines int, bitmap binary"),
        "bitmaps",
    )
    ordered.unpersist()
    dropped(hashed)
    return bitmaps


def _kept_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        texts, dropped = [], []
        columns = (batch.column("__n_lines").to_pylist(), batch.column("__bitmap").to_pylist())
        for data, n, bitmap in zip(raw_texts(batch.column("text")), *columns):
            keep = unpack(bitmap, n)
            texts.append(data if keep.all() else b"\n".join(x for x, k in zip(data.split(b"\n"), keep) if k))
            dropped.append(int(n - keep.sum()))
        names = [n for n in batch.schema.names if n not in ("text", "__bitmap")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names] + [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(dropped, pa.int64())],
            [*names, "__kept", "__n_dropped"],
        )


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", **rules) -> DataFrame:
    """Every row with ``text`` freed of repeated lines, and ``__n_lines``, ``__n_dropped``.

    Other columns keep their names, values and order; an empty table gives no rows. See
    ``keep_bitmaps`` for the rules.
    """
    bitmaps = keep_bitmaps(docs, text=text, key=key, **rules).select(
        F.col("doc").alias("__doc"), F.col("copy").alias("__copy"),
        F.col("n_lines").cast("long").alias("__n_lines"), F.col("bitmap").alias("__bitmap"),
    )
    marked = _identified(docs, text, key)
    met = marked.join(
        bitmaps, marked["__doc"].eqNullSafe(bitmaps["__doc"]) & (marked["__copy"] == bitmaps["__copy"])
    )
    names = docs.columns
    inputs = met.select(
        *[marked[f"`{n}`"].alias(f"c{i}") for i, n in enumerate(names) if n != text],
        marked[f"`{text}`"].alias("text"), "__n_lines", "__bitmap",
    )
    kinds = [(f"c{i}", docs.schema[n].dataType.simpleString()) for i, n in enumerate(names) if n != text]
    schema = ", ".join(f"{n} {k}" for n, k in [*kinds, ("__n_lines", "bigint"), ("__kept", "string"), ("__n_dropped", "bigint")])
    out = inputs.mapInArrow(_kept_texts, schema)
    return out.select(
        *[F.col("__kept" if n == text else f"c{i}").alias(n) for i, n in enumerate(names)],
        "__n_lines", "__n_dropped",
    )


