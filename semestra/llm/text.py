"""Texts of Arrow batches as byte arrays, and hashes of the words in them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single text is handled alone.
PIECE = 1 << 19
#: Powers kept at hand; longer pieces, as of one long text, have theirs made anew.
PIECE_POWERS = 1 << 20

#: The white space of all word rules here: space, and tab to carriage return.
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(SPACES, np.uint8))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts take about ``limit`` bytes, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    # A worker lives on after its task; what it no longer needs goes back
    pa.default_memory_pool().release_unused()


def column_pieces(column: pa.Array) -> Iterator[pa.Array]:
    """A text column in slices as of ``pieces``."""
    for batch in pieces([pa.RecordBatch.from_arrays([column], ["text"])]):
        yield batch.column(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row begins (one more entry than rows).

    Null texts count as empty.
    """
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    rows = len(column)
    if not rows:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + rows + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(rows + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every row; null as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Start and end of every word, and for each row the index of its first word."""
    inside = ~IS_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~first[:-1] if len(data) else inside
    after = np.concatenate((inside[1:], [False])) & ~first[1:] if len(data) else inside
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, np.uint64)
    up = np.cumprod(np.concatenate((one, np.full(size, _BASE, np.uint64))))
    down = np.cumprod(np.concatenate((one, np.full(size, _INVERSE, np.uint64))))
    return up, down


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the hash of any span of the bytes follows in constant time."""
    up, down = _powers(max(PIECE_POWERS, 1 << int(len(data)).bit_length()))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (64-bit finaliser)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def span_hashes(sums, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes have equal hashes wherever they stand."""
    total, down = sums
    return mixed((total[ends] - total[starts]) * down[starts])


def row_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of consecutive values by row; rows without values give 0."""
    running = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return running[firsts[1:]] - running[firsts[:-1]]
