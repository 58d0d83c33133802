"""Ranked lexical search: documents are grouped by the set of an item's terms they hold.

The terms of some items make a vocabulary, and every document is reduced to its counts of
these terms. A task reads documents in chunks. Of an item, each document of a chunk gets a
mask with one bit for a term it holds, and documents of equal mask are one group, whose
score can be no more than the greatest contributions of its terms. Groups are scored from
the greatest such bound on, until the next one is below the last of the best documents so
far; no document left can then be among them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from semestra.llm.storage import dropped, stored
from semestra.llm.text import pieces, raw_texts

#: Letters and digits, and all beyond ASCII; of UTF-8 bytes just as of characters.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_OTHER = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Bytes of a long text that are cut into terms at once.
SLICE = 1 << 20
#: Items, and terms of items, that are searched at once; one larger item is searched alone.
BLOCK_ITEMS, BLOCK_TERMS = 512, 1 << 17
#: Documents and counts of terms that a task holds at once, and words of masks.
CHUNK_DOCS, CHUNK_COUNTS, MASK_WORDS = 1 << 14, 1 << 22, 1 << 22
#: Documents that are scored first; the number grows fourfold.
FIRST = 512
#: Groups of tasks whose best documents are ranked before those of all tasks.
SALTS = 32


def counted_terms(text: bytes) -> tuple[Counter, int]:
    """Occurrences of every term, lower-cased from A to Z alone, and their number."""
    lower, counts, total, start = text.lower(), Counter(), 0, 0
    while start < len(lower):
        stop = start + SLICE
        if stop < len(lower):
            gap = _OTHER.search(lower, stop)
            stop = gap.start() if gap else len(lower)
        found = TERM.findall(lower, start, stop)
        counts.update(found)
        total += len(found)
        start = stop
    return counts, total


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


# items --------------------------------------------------------------------------


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        terms = [sorted(counted_terms(data)[0]) for data in raw_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(terms, pa.list_(pa.binary()))], ["item", "terms"])


class Block(NamedTuple):
    """Some items: their ids and, for each, the numbers of its terms in the vocabulary."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def blocks(items: DataFrame, item: str, text: str) -> Iterator[Block]:
    """All items in blocks of bounded size; only one block is at the driver at a time.

    Rows of one id are one item with the terms of all of them.
    """
    kind = items.schema[item].dataType.simpleString()
    rows = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text")).mapInArrow(
        _item_terms, f"item {kind}, terms array<binary>"
    )
    ids: list = []
    terms: list[set] = []
    vocabulary: dict[bytes, int] = {}
    size = 0
    for row in rows.orderBy("item").toLocalIterator():
        if not ids or row.item != ids[-1]:
            if len(ids) == BLOCK_ITEMS or size + len(row.terms) > BLOCK_TERMS and ids:
                yield Block(ids, [np.array(sorted(t), np.int64) for t in terms], vocabulary)
                ids, terms, vocabulary, size = [], [], {}, 0
            ids.append(row.item)
            terms.append(set())
        size += len(row.terms)
        terms[-1].update(vocabulary.setdefault(bytes(t), len(vocabulary)) for t in row.terms)
    if ids:
        yield Block(ids, [np.array(sorted(t), np.int64) for t in terms], vocabulary)


# documents ------------------------------------------------------------------------


def _reduced(vocabulary):
    """The number of terms of every document, and its counts of the vocabulary's terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        names = known.keys()
        for batch in pieces(batches):
            totals, terms, counts, ends = [], [], [], [0]
            for data in raw_texts(batch.column("text")):
                found, total = counted_terms(data)
                mine = found.keys() & names
                totals.append(total)
                terms += [known[t] for t in mine]
                counts += [found[t] for t in mine]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), pa.array(totals, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                ["doc", "n", "terms", "counts"],
            )

    return run


def _frequencies(size: int):
    """How many documents hold each term, how many hold any (term -1), and all terms (-2)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
            totals = batch.column("n").to_numpy()
            documents += int((totals > 0).sum())
            length += int(totals.sum())
        there = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *there.tolist()], pa.int64()), pa.array([documents, length, *held[there].tolist()], pa.int64())],
            ["term", "number"],
        )

    return run


class Statistics(NamedTuple):
    documents: int
    length: int
    weights: np.ndarray


def statistics(reduced: DataFrame, size: int) -> Statistics:
    """Counts over all documents; a number for each term of the vocabulary comes to the driver."""
    rows = reduced.select("n", "terms").mapInArrow(_frequencies(size), "term bigint, number bigint")
    numbers = {r.term: r.number for r in rows.groupBy("term").agg(F.sum("number").alias("number")).collect()}
    documents, length = numbers.pop(-1, 0), numbers.pop(-2, 0)
    weights = np.zeros(size, np.int64)
    for term, holding in numbers.items():
        weights[term] = weight(documents, holding)
    return Statistics(documents, length, weights)


# scoring --------------------------------------------------------------------------


class Best:
    """The best documents of an item so far, equal scores by ascending key, null first."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.keys, self.real = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """The least score that may still come in."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, keys: np.ndarray, real: np.ndarray) -> None:
        scores = np.concatenate((self.scores, scores))
        keys, real = np.concatenate((self.keys, keys)), np.concatenate((self.real, real))
        order = np.lexsort((keys, real, -scores))[: self.top]
        self.scores, self.keys, self.real = scores[order], keys[order], real[order]


def masks(docs: list[np.ndarray], low: int, high: int) -> np.ndarray:
    """For each document from ``low`` to ``high`` one bit for every list that has it."""
    out = np.zeros((high - low, -(-len(docs) // 64)), np.uint64)
    for bit, there in enumerate(docs):
        a, b = np.searchsorted(there, (low, high))
        out[there[a:b] - low, bit // 64] |= np.uint64(1 << bit % 64)
    return out


def groups(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different masks, and the number of each row's mask among them."""
    if found.shape[1] == 1:
        different, number = np.unique(found[:, 0], return_inverse=True)
        return different[:, None], number
    joined = np.ascontiguousarray(found).view([("", np.uint64)] * found.shape[1])[:, 0]
    different, number = np.unique(joined, return_inverse=True)
    return different.view(np.uint64).reshape(-1, found.shape[1]), number


def bounds(different: np.ndarray, greatest: list[int]) -> np.ndarray:
    """The sum of the greatest contributions of the terms in each mask."""
    out = np.zeros(len(different), np.int64)
    for bit, value in enumerate(greatest):
        out += (different[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)).astype(np.int64) * value
    return out


def search(best: Best, docs: list[np.ndarray], gains: list[np.ndarray], keys: np.ndarray, real: np.ndarray) -> int:
    """Bring the best documents of a chunk into ``best``; gives how many were scored.

    ``docs`` and ``gains`` hold, for each term of the item that any document holds, the
    documents in ascending order and what the term adds to their scores (above 0).
    """
    greatest = [int(g.max()) for g in gains]
    if sum(greatest) < best.least():
        return 0
    scored = 0
    span = max(1, MASK_WORDS // max(1, -(-len(docs) // 64)))
    for low in range(0, len(keys), span):
        high = min(len(keys), low + span)
        found = masks(docs, low, high)
        holding = np.flatnonzero(found.any(1))
        if not len(holding):
            continue
        different, number = groups(found[holding])
        bound = bounds(different, greatest)[number]
        order = np.argsort(-bound, kind="stable")
        holding, bound = holding[order], bound[order]
        start, size = 0, FIRST
        while start < len(holding) and bound[start] >= best.least():
            # Groups whose bound is below the last of the best can't be reached any more
            stop = min(start + size, int(np.searchsorted(-bound, -best.least(), "right")))
            chosen = holding[start:stop]
            place = np.full(high - low, -1, np.int64)
            place[chosen] = np.arange(len(chosen))
            scores = np.zeros(len(chosen), np.int64)
            for there, gain in zip(docs, gains):
                a, b = np.searchsorted(there, (low, high))
                at = place[there[a:b] - low]
                scores[at[at >= 0]] += gain[a:b][at >= 0]
            best.add(scores, keys[low + chosen], real[low + chosen])
            scored += len(chosen)
            start, size = stop, size * 4
    return scored


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    rows = counts = 0
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK_DOCS // 8):
            part = batch.slice(start, CHUNK_DOCS // 8)
            held.append(part)
            rows += part.num_rows
            counts += len(part.column("terms").flatten())
            if rows >= CHUNK_DOCS or counts >= CHUNK_COUNTS:
                yield pa.Table.from_batches(held)
                held, rows, counts = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _ranked(items, numbers: Statistics, top: int):
    """The best documents of a task for every item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items.value]
        for chunk in _chunks(batches):
            chunk = chunk.combine_chunks()
            column = chunk.column("doc")
            real = np.logical_not(column.is_null().to_numpy())
            keys = column.fill_null(0).to_numpy()
            lists = chunk.column("terms").chunk(0) if chunk.column("terms").num_chunks else None
            if lists is None or not numbers.length:
                continue
            lengths = np.diff(lists.offsets.to_numpy())
            term = lists.flatten().to_numpy()
            times = chunk.column("counts").chunk(0).flatten().to_numpy().astype(np.int64)
            long = 50 + 50 * chunk.column("n").to_numpy() * numbers.documents // numbers.length
            gain = numbers.weights[term] * (1_000_000_000 * times // (1000 * times + 20 * np.repeat(long, lengths)))
            doc = np.repeat(np.arange(len(keys)), lengths)[gain > 0]
            term, gain = term[gain > 0], gain[gain > 0]
            order = np.argsort(term, kind="stable")
            term, doc, gain = term[order], doc[order], gain[order]
            starts = np.searchsorted(term, np.arange(len(numbers.weights) + 1))
            for holder, mine in zip(best, items.value):
                spans = [(starts[t], starts[t + 1]) for t in mine.tolist() if starts[t] < starts[t + 1]]
                if spans:
                    search(holder, [doc[a:b] for a, b in spans], [gain[a:b] for a, b in spans], keys, real)
        for number, holder in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(holder.keys), number), pa.int64()),
                    pa.array(holder.keys, pa.int64(), mask=~holder.real), pa.array(holder.scores, pa.int64()),
                ],
                ["item", "doc", "score"],
            )

    return run


def _searched(rows: DataFrame, block: Block, kind: str, top: int) -> DataFrame:
    spark = rows.sparkSession
    reduced = stored(
        rows.mapInArrow(
            _reduced(spark.sparkContext.broadcast(block.vocabulary)), "doc bigint, n bigint, terms array<int>, counts array<int>"
        ),
        "counts",
    )
    numbers = statistics(reduced, len(block.vocabulary))
    found = reduced.mapInArrow(
        _ranked(spark.sparkContext.broadcast(block.terms), numbers, top), "item bigint, doc bigint, score bigint"
    )
    # Every task gives so many rows of an item; they are ranked by groups of tasks first
    order = [F.desc("score"), F.asc_nulls_first("doc")]
    salted = found.withColumn("salt", F.spark_partition_id() % SALTS)
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    last = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    ids = F.from_json(F.lit("[]"), f"array<{kind}>") if not block.ids else F.array(*[F.lit(i).cast(kind) for i in block.ids])
    out = stored(last.select(ids[F.col("item").cast("int")].alias("item"), "rank", "doc", "score"), "ranking")
    dropped(reduced)
    return out


def ranked(
    docs: DataFrame, items: DataFrame, top: int = 50, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``top`` documents with a score for every item.

    Scores follow the contract's integer formula, with statistics over all documents.
    Equal scores go by ascending key, null first; repeated documents each have their rank.
    Rows of one item id are one item, null ids too; an item whose terms no document holds
    has no rows. Null and empty texts have no terms and count for nothing. Keys are whole
    numbers. Without documents or items there are no rows; other columns are not looked at.
    Texts of any length are cut into terms by slices.

    Items are searched in blocks, each against all documents, so that what is sent to the
    tasks (a block's terms) is bounded.
    """
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc"), F.col(f"`{text}`").alias("text"))
    kind = items.schema[item].dataType.simpleString()
    parts = [_searched(rows, block, kind, top) for block in blocks(items, item, item_text) if block.vocabulary]
    if not parts:
        return docs.sparkSession.createDataFrame([], f"{item} {kind}, rank int, {key} bigint, score bigint")
    return reduce(DataFrame.unionAll, parts).select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score")
