"""Near duplicates by the bit distance of SimHash fingerprints.

Links are found by hashing balls: a fingerprint is sent to every value within half the
allowed distance, so that two fingerprints meet at the values between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from semestra.llm.components import components
from semestra.llm.storage import stored
from semestra.llm.text import pieces, raw_texts

BITS = 64
SEED = 42
#: Bytes of one text that are split into words at once.
BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    start = 0
    while start < len(data):
        cut = _SPACE.search(data, start + BLOCK) if len(data) - start > BLOCK else None
        stop = cut.start() if cut else len(data)
        yield data[start:stop].split()
        start = stop


def shingle_hashes(data: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle of a lower-cased text, in blocks."""
    tail: list[bytes] = []
    found = False
    for block in _word_blocks(data.lower()):
        words = tail + block
        if len(words) >= size:
            found = True
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            starts = [0, *ends[:-1]]
            yield np.array(
                [
                    xxhash.xxh64_intdigest(joined[s : e - 1], SEED)
                    for s, e in zip(starts, ends[size - 1 :])
                ],
                np.uint64,
            )
        tail = words[max(0, len(words) - size + 1) :]
    if tail and not found:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)


def fingerprint(data: bytes, size: int) -> int:
    """A bit is set if it is set in over half of the shingle hashes; no word gives 0."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(data, size):
        total += len(hashes)
        for start in range(0, len(hashes), 8192):
            part = hashes[start : start + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``simhash`` (the 64 bits as long) and ``digest`` (another hash of the whole
    text) of every row; null text has no words."""
    kind = docs.schema[key].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            prints = [fingerprint(data, size) for data in raw_texts(batch.column("text"))]
            bits = np.array(prints, np.uint64).astype("<u8").view(np.int64)
            columns = [batch.column("key"), pa.array(bits), batch.column("digest")]
            yield pa.RecordBatch.from_arrays(columns, ["key", "simhash", "digest"])

    value = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").alias("key"), value.alias("text"), F.xxhash64(value).alias("digest"))
    out = rows.mapInArrow(run, f"key {kind.simpleString()}, simhash bigint, digest bigint")
    return out.select(F.col("key").alias(key), "simhash", "digest")


def ball(radius: int) -> list[tuple[int, int]]:
    """Every bit mask of up to ``radius`` bits, as signed longs, with its number of bits."""
    masks = []
    for n in range(radius + 1):
        for places in combinations(range(BITS), n):
            mask = sum(1 << p for p in places)
            masks.append((mask - (1 << BITS) if mask >> (BITS - 1) else mask, n))
    return masks


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Links between distinct fingerprints, enough to hold every component together.

    Every fingerprint emits all values within half the distance (rounded up). Those that
    meet at a value ``v`` and lie within half of it (rounded down), the inner ones, are
    within ``distance`` of all others there, so the least inner one is linked to each and
    the link is verified by its bit distance. A value is met by at most the size of the
    ball (65 for a distance of 2), however many documents share a fingerprint.
    """
    masks = F.array(
        *[F.struct(F.lit(m).alias("mask"), F.lit(n).alias("n")) for m, n in ball(-(-distance // 2))]
    )
    variants = (
        prints.select("simhash").distinct()
        .select("simhash", F.explode(masks).alias("b"))
        .select(
            "simhash", F.col("simhash").bitwiseXOR(F.col("b.mask")).alias("variant"),
            (F.col("b.n") <= distance // 2).alias("inner"),
        )
    )
    met = Window.partitionBy("variant")
    return (
        variants.withColumn("hub", F.min(F.when(F.col("inner"), F.col("simhash"))).over(met))
        .where("simhash <> hub").select("hub", F.col("simhash").alias("other")).distinct()
        .withColumn("bits", F.bit_count(F.col("hub").bitwiseXOR(F.col("other"))))
        .where(F.col("bits") <= distance)
    )


def _grouped(docs: DataFrame, size: int, distance: int, text: str, key: str) -> DataFrame:
    """Key, simhash and digest of every row, the ``root`` of its component, and the least
    key there as ``component_id``."""
    prints = stored(fingerprints(docs, size, text, key), "simhash")
    least = prints.groupBy("simhash").agg(F.min(key).alias("least"))
    roots = stored(components(links(prints, distance), "hub", "other"), "roots")
    rooted = least.join(roots, F.col("simhash") == F.col("node"), "left").select(
        "simhash", "least", F.coalesce("root", "simhash").alias("root")
    )
    named = rooted.join(
        rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root"
    ).select("simhash", "root", "component_id")
    return prints.join(named, "simhash")


def near_duplicates(
    docs: DataFrame, size: int = 3, distance: int = 2, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key``, ``fingerprint`` (hex) and ``component_id`` (least key reachable) of every row.

    Texts without words, null ones among them, have fingerprint zero and are linked like
    any other. Rows with a null key are returned and link others, but give no component id
    of their own: a component of null keys alone has a null id. Repeated rows stay. An
    empty table gives no rows; other columns of ``docs`` are not looked at.
    """
    return _grouped(docs, size, distance, text, key).select(
        key, F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, size: int = 3, distance: int = 2, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one row of its least key.

    Of several texts of that key in the component, the one of least fingerprint and digest
    stays; a text of the same key in another component is no copy and stays too. Rows with
    a null key all stay.
    """
    groups = _grouped(docs, size, distance, text, key)
    chosen = groups.where(F.col(key) == F.col("component_id")).groupBy("root").agg(
        F.min(F.struct("simhash", "digest", F.col(key).alias("key"))).alias("least")
    ).select(F.col("least.key").alias("__key"), F.col("least.digest").alias("__digest"))
    # Repeated rows: all but one of a key and text go before anything moves
    rows = docs.where(F.col(f"`{key}`").isNotNull()).select(
        F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"),
        F.col(f"`{key}`").alias("__key"), F.xxhash64(F.col(f"`{text}`")).alias("__digest"),
    )
    same = Window.partitionBy("__key", "__digest").orderBy(F.lit(0))
    first = rows.withColumn("__n", F.row_number().over(same)).where("__n = 1")
    kept = first.join(chosen, ["__key", "__digest"], "left_semi").select("row.*")
    return kept.unionByName(docs.where(F.col(f"`{key}`").isNull()))
