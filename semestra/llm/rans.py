"""Token ids in binary blocks, coded by a static range asymmetric numeral system.

Frequencies of all ids are counted once and shared by all blocks. A block holds the ids of
consecutive documents. Its symbols are dealt in turn to interleaved lanes, each an own
64-bit state, so that numpy codes one step of all lanes at a time. A block can be decoded
alone, and from each of its checkpoints on, which are eight in a block of usual size; the
reader deals the checkpoints of longer blocks, those of long documents, to several tasks.
Checksums cover the ids of a block.

File format: a folder of Parquet files, uncompressed, one row for each block.

=============  ==============================================================
``part``       rank of the block's range of keys
``block``      place of the block in its range; (part, block) is the order
``start``      ids of all documents in earlier blocks
``n_ids``      ids in the block, end marks included
``doc_ids``    documents in order; null where a document had no id
``lengths``    ids of each document
``crc32``      CRC-32 of the ids as little-endian unsigned 32-bit integers
``words``      renormalisation words, little-endian unsigned 32-bit, as read
``states``     states of the lanes at the checkpoints, little-endian unsigned 64-bit
``places``     of each checkpoint, the words read before it
=============  ==============================================================

Beside it, ``table`` has the columns ``id`` and ``frequency``, which add up to 2^20.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from semestra.llm.ordering import key_blocks
from semestra.llm.storage import dropped, stored
from semestra.llm.text import pieces, raw_texts

#: The frequencies of all ids add up to this power of two.
TABLE_BITS = 20
#: States stay in [2^31, 2^63), by 32 bits at a time.
LOW_BITS = 31
#: Interleaved states, steps between two checkpoints, and ids a block is closed at.
LANES, STEPS, BLOCK = 512, 32, 1 << 17
#: Checkpoints that one task decodes; the ids of a longer block are dealt to several.
SPAN = 128
#: Words, and runs of marks or other letters in them, whose ids a worker remembers.
REMEMBERED, REMEMBERED_PARTS = 500_000, 200_000

_U32, _U64 = np.dtype("<u4"), np.dtype("<u8")


class Table(NamedTuple):
    """Quantised frequencies of ids, their running sums, and the id at every slot."""

    frequencies: np.ndarray
    starts: np.ndarray
    slots: np.ndarray


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2^``TABLE_BITS``, at least one for every id that occurs."""
    total = 1 << TABLE_BITS
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return out
    if len(used) > total:
        raise ValueError("more different ids than slots")
    share = counts[used].astype(np.float64)
    out[used] = 1 + np.floor(share / share.sum() * (total - len(used))).astype(np.int64)
    out[used[np.argmax(counts[used])]] += total - out.sum()
    return out


@lru_cache(maxsize=2)
def _table(frequencies: bytes) -> Table:
    f = np.frombuffer(frequencies, "<i8")
    starts = np.concatenate(([0], np.cumsum(f)[:-1])).astype(np.uint64)
    return Table(f.astype(np.uint64), starts, np.repeat(np.arange(len(f), dtype=np.uint32), f))


def table_of(frequencies: np.ndarray) -> Table:
    return _table(frequencies.astype("<i8").tobytes())


class Coded(NamedTuple):
    words: bytes
    states: bytes
    places: list[int]


def encode(ids: np.ndarray, table: Table) -> Coded:
    """Code ids backwards, as the last coded is the first to be decoded.

    Ids go to lanes in turn. A lane of a last, unfilled step holds still. All states are
    saved before every ``STEPS`` steps, in the order of decoding.
    """
    n = len(ids)
    steps = -(-n // LANES)
    state = np.full(LANES, 1 << LOW_BITS, np.uint64)
    frequency, start = table.frequencies[ids], table.starts[ids]
    limit = frequency << np.uint64(LOW_BITS + 32 - TABLE_BITS)
    gap = np.uint64(1 << TABLE_BITS) - frequency
    out: list[np.ndarray] = []
    saved: list[np.ndarray] = []
    written = 0
    left: list[int] = []
    for step in range(steps - 1, -1, -1):
        a, b = step * LANES, min(n, (step + 1) * LANES)
        x = state[: b - a]
        full = np.flatnonzero(x >= limit[a:b])
        renormed = x[full]
        # The lower halves; lanes are read in rising order, so they are written in falling order
        out.append(renormed.astype(_U32)[::-1])
        written += len(full)
        x[full] = renormed >> np.uint64(32)
        # The quotient by the frequency moves up, the remainder stays: x + quotient * (2^20 - frequency)
        x += x // frequency[a:b] * gap[a:b]
        x += start[a:b]
        if step % STEPS == 0:
            saved.append(state.copy())
            left.append(written)
    words = np.concatenate([np.zeros(0, _U32), *out])[::-1]
    states = np.concatenate([np.zeros(0, np.uint64), *saved[::-1]]).astype(_U64)
    return Coded(words.tobytes(), states.tobytes(), [written - w for w in left[::-1]])


def _side_by_side(state: np.ndarray, at: np.ndarray, n: int, words: np.ndarray, table: Table) -> np.ndarray:
    """``n`` ids from each of several checkpoints: a row of states and a place in the words."""
    out = np.empty((len(state), n), np.uint32)
    mask, bound = np.uint64((1 << TABLE_BITS) - 1), np.uint64(1 << LOW_BITS)
    for a in range(0, n, LANES):
        b = min(n, a + LANES)
        x = state[:, : b - a]
        slot = x & mask
        ids = table.slots[slot]
        out[:, a:b] = ids
        x = table.frequencies[ids] * (x >> np.uint64(TABLE_BITS)) + slot - table.starts[ids]
        below = x < bound
        counts = np.count_nonzero(below, axis=1)
        # Every checkpoint reads on from its own place
        read = np.arange(counts.sum()) + np.repeat(at - np.cumsum(counts) + counts, counts)
        low, flat = np.flatnonzero(below), x.reshape(-1)
        flat[low] = (flat[low] << np.uint64(32)) | words[read]
        at = at + counts
        state[:, : b - a] = x
    return out


def decode(n: int, coded: Coded, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids between two checkpoints, by default all ``n`` ids of a block.

    All checkpoints are read from at once, but the last if fewer ids follow it.
    """
    words = np.frombuffer(coded.words, _U32)
    span = STEPS * LANES
    at = np.array(coded.places[first:last], np.int64)
    state = np.frombuffer(coded.states, _U64)[first * LANES : (first + len(at)) * LANES].astype(np.uint64).reshape(-1, LANES)
    size = min(n - first * span, len(at) * span)
    whole = size // span if len(at) else 0
    parts = [_side_by_side(state[:whole], at[:whole], span, words, table)] if whole else []
    if whole < len(at):
        parts.append(_side_by_side(state[whole:], at[whole:], size - whole * span, words, table))
    return np.concatenate([np.zeros(0, np.uint32), *[part.reshape(-1) for part in parts]])


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype(_U32).tobytes())


# --- Token ids of texts -------------------------------------------------------------------

#: Marks that the pre-tokenizer parts from a word before them, as one run.
_MARKS = b".,!?;:*&%$#"


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level merges: bytes that print as
    Latin-1 stand for themselves, the others for the letters from 256 on, in turn."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in own)
    return {b: 256 + n for n, b in enumerate(others)}


_LETTERS = "".join(chr(_byte_letters().get(b, b)) for b in range(256))


@lru_cache(maxsize=2)
def id_bytes(definition: str) -> int:
    """Bytes an id takes before it is coded: 2 if the vocabulary allows it, else 4."""
    return 2 if Tokenizer.from_str(definition).get_vocab_size() <= 1 << 16 else 4


class WordTokens(dict):
    """Token ids of words, which are worked out when they are first looked up.

    Only for a tokenizer that lower-cases, drops white space and has byte-level merges
    within words, where the ids of a text are those of its words in turn. A word of letters,
    with or without marks behind it, goes to the library's merges at once, as nothing else
    would be done to it; any other is asked for as a text.
    """

    def __init__(self, definition: str) -> None:
        super().__init__()
        self.library = Tokenizer.from_str(definition)
        self.code = "H" if id_bytes(definition) == 2 else "I"
        self.parts: dict[bytes, bytes] = {}
        self.merges = self.library.model.tokenize
        width = id_bytes(definition)
        self.numbers = [n.to_bytes(width, "little") for n in range(self.library.get_vocab_size())]

    def _merged(self, part: bytes) -> bytes:
        """Ids of a run of letters, or of marks, that is already in lower case."""
        # Letters and marks of ASCII print, so they stand for themselves
        letters = part.decode() if part.isascii() else charmap_decode(part, "strict", _LETTERS)[0]
        numbers = self.numbers
        return b"".join([numbers[token.id] for token in self.merges(letters)])

    def _part(self, part: bytes) -> bytes:
        """Ids of a run that is no word by itself, remembered apart."""
        found = self.parts.get(part)
        if found is None:
            found = self.parts[part] = self._merged(part)
        return found

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(_MARKS)
        if stem.isalpha():
            # Letters of ASCII in lower case are a word themselves, remembered as such alone
            lower = stem.lower()
            found = self[lower] if lower != word else self._merged(word)
            plain = True
        elif stem.isascii():
            plain = False
        else:
            # Letter by letter, as the library does: a last sigma is like any other
            text = unicodedata.normalize("NFC", stem.decode()).replace("\u03a3", "\u03c3").lower()
            plain = text.isalpha()
            if plain:
                found = self._part(text.encode())
        if not plain:
            ids = self.library.encode(word.decode(), add_special_tokens=False).ids
            found = array(self.code, ids).tobytes()
        elif len(stem) != len(word):
            found += self._part(word[len(stem) :])
        self[word] = found
        return found

    def encode(self, texts: list[bytes], end: int) -> list[bytes]:
        """Ids of every text and the end id, as unsigned integers of ``id_bytes``."""
        if len(self) > REMEMBERED:
            self.clear()
        if len(self.parts) > REMEMBERED_PARTS:
            self.parts.clear()
        mark = array(self.code, [end]).tobytes()
        return [b"".join([*map(self.__getitem__, text.split()), mark]) for text in texts]


@lru_cache(maxsize=2)
def tokens_of(definition: str) -> WordTokens:
    # Tasks are as many as there are cores; threads of the library would only get in their way
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokens(definition)


def token_ids(rows: DataFrame, definition: str, end: int) -> DataFrame:
    """``part, key, ids`` (binary) of rows ``part, key, text``: the ids of the whole text and
    the end id. ``definition`` is the content of a tokenizer file; it travels with the tasks.
    """
    shared = rows.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens_of(shared.value)
        for batch in pieces(batches):
            ids = coder.encode(raw_texts(batch.column("text")), end)
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("key"), pa.array(ids, pa.binary())], ["part", "key", "ids"]
            )
        # The worker goes on to other stages, which need the room
        coder.clear()
        coder.parts.clear()

    return rows.mapInArrow(run, "part int, key bigint, ids binary")


# --- Blocks -------------------------------------------------------------------------------

_RAW = "part int, block int, before bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, ids binary"
_FILE = (
    "part int, block int, start bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "crc32 bigint, words binary, states binary, places array<bigint>"
)
_IDS = "part int, block int, first int, ids binary"
_NUMBERS = pa.list_(pa.int64())


def _raw_blocks(size: int, width: int):
    """Whole documents in order, in blocks that are closed at ``size`` ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = None, 0, 0
        keys: list = []
        ids: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            lengths = [len(x) // width for x in ids]
            row = [[part], [block], [before], [sum(lengths)], [keys], [lengths], [b"".join(ids)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), _NUMBERS, _NUMBERS, pa.binary())
            return pa.RecordBatch.from_arrays(list(map(pa.array, row, kinds)), _names(_RAW))

        for batch in batches:
            for here, key, data in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "ids"))):
                if here != part:
                    if keys:
                        yield closed()
                    part, block, before = here, 0, 0
                    keys, ids, held = [], [], 0
                keys.append(key)
                ids.append(data)
                held += len(data) // width
                if held >= size:
                    yield closed()
                    block, before = block + 1, before + held
                    keys, ids, held = [], [], 0
        if keys:
            yield closed()

    return run


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _id_counts(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column("ids").to_pylist():
                found = np.bincount(np.frombuffer(data, f"<u{width}"), minlength=len(counts))
                found[: len(counts)] += counts
                counts = found
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    return run


def _coder(starts: dict[int, int], frequencies: np.ndarray, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(frequencies)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{width}")
                coded = encode(ids, table)
                values = [
                    row["part"], row["block"], starts[row["part"]] + row["before"], row["n_ids"],
                    row["doc_ids"], row["lengths"], checksum(ids), *coded,
                ]
                kinds = (
                    pa.int32(), pa.int32(), pa.int64(), pa.int64(), _NUMBERS, _NUMBERS, pa.int64(),
                    pa.binary(), pa.binary(), _NUMBERS,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(values, kinds)], _names(_FILE)
                )

    return run


def write(
    docs: DataFrame, path: str, definition: str, end: int, text: str = "text", key: str = "doc_id",
    block: int = BLOCK,
) -> None:
    """Write the ids of every text to ``path``, in ascending order of ``key``.

    Every row counts, repeated ones too; equal keys stand in the order of their ids; a
    null key comes first; null and empty texts have the end id alone. An empty table
    writes an empty file. ``key`` is an integer. Other columns are not looked at. Blocks of
    keys are sorted and packed side by side; only the number of ids of each block and of
    each token come to the driver. A text that is longer than a block gets one of its own.
    """
    width = id_bytes(definition)
    number = F.col(f"`{key}`").cast("long")
    block_of = key_blocks(docs, F.coalesce(number, F.lit(-(1 << 63))))
    ids = token_ids(
        docs.select(block_of.cast("int").alias("part"), number.alias("key"), F.col(f"`{text}`").alias("text")), definition, end
    )
    ordered = ids.repartition("part").sortWithinPartitions("part", "key", "ids")
    with few_rows_at_once(docs.sparkSession, 250):
        raw = stored(ordered.mapInArrow(_raw_blocks(block, width), _RAW), "blocks")
    sums = dict(map(tuple, raw.groupBy("part").agg(F.sum("n_ids")).collect()))
    starts, total = {}, 0
    for part in sorted(sums):
        starts[part] = total
        total += sums[part]
    with few_rows_at_once(docs.sparkSession):
        counts = (
            raw.select("ids").mapInArrow(_id_counts(width), "id bigint, n bigint")
            .groupBy("id").agg(F.sum("n").alias("n")).toArrow()
        )
    sizes = np.zeros(1 + max(counts.column("id").to_pylist(), default=0), np.int64)
    sizes[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    frequencies = quantised(sizes)
    spark = docs.sparkSession
    with few_rows_at_once(spark):
        raw.mapInArrow(_coder(starts, frequencies, width), _FILE).write.option("compression", "none").parquet(f"{path}/blocks")
    rows = [(int(i), int(frequencies[i])) for i in np.flatnonzero(frequencies)]
    spark.createDataFrame(rows, "id int, frequency int").coalesce(1).write.parquet(f"{path}/table")
    dropped(raw)


@contextmanager
def few_rows_at_once(spark: SparkSession, rows: int = 8) -> Iterator[None]:
    """Read texts or blocks, which are large rows, and send them to Python a few at a time."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(name) for name in names]
    for name in names:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    """Frequencies by id, as large as the vocabulary."""
    table = spark.read.parquet(f"{path}/table").toArrow()
    ids = table.column("id").to_numpy()
    out = np.zeros(1 + max(ids.tolist(), default=0), np.int64)
    out[ids] = table.column("frequency").to_numpy()
    return out


_SPAN_FIELDS = "part int, block int, first int, n_ids bigint, words binary, states binary, places array<bigint>"


def spans(blocks: DataFrame, size: int = SPAN) -> DataFrame:
    """Blocks cut at every ``size`` checkpoints: what is needed to decode ``n_ids`` ids from
    the checkpoint ``first`` on. Each row is as good as a block of its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), _NUMBERS)
        for batch in batches:
            for block in batch.to_pylist():
                places = [*block["places"], len(block["words"]) // _U32.itemsize]
                for first in range(0, len(places) - 1, size):
                    stop = min(first + size, len(places) - 1)
                    ids = min(block["n_ids"], stop * STEPS * LANES) - first * STEPS * LANES
                    row = [
                        block["part"], block["block"], first, ids,
                        block["words"][places[first] * _U32.itemsize : places[stop] * _U32.itemsize],
                        block["states"][first * LANES * _U64.itemsize : stop * LANES * _U64.itemsize],
                        [place - places[first] for place in places[first:stop]],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], _names(_SPAN_FIELDS))

    return blocks.select("part", "block", "n_ids", "words", "states", "places").mapInArrow(run, _SPAN_FIELDS)


def _decoded(frequencies: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(frequencies)
        for batch in batches:
            for span in batch.to_pylist():
                ids = decode(span["n_ids"], Coded(span["words"], span["states"], span["places"]), table)
                row = ([span["part"]], [span["block"]], [span["first"]], [ids.astype(_U32).tobytes()])
                yield pa.RecordBatch.from_arrays(
                    list(map(pa.array, row, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))), ["part", "block", "first", "ids"]
                )

    return run


def read(
    spark: SparkSession, path: str, fields: str, row: Callable[[np.ndarray], tuple], size: int = SPAN
) -> DataFrame:
    """``doc_id, start`` and what ``row`` makes of the ids, for every document of a file.

    ``fields`` names and types what ``row`` returns, which is written to the shared folder, as
    blocks are read a few at a time by settings of the session. A block of up to ``size`` checkpoints is
    decoded in one task. A longer one, as a long document has, is cut at every ``size``
    checkpoints, these spans are decoded in tasks of their own, and the ids put together by
    block. A block whose ids don't have its checksum raises an error.
    """
    frequencies = read_table(spark, path)
    schema = f"doc_id bigint, start bigint, {fields}"

    def documents(block: dict, ids: np.ndarray) -> pa.RecordBatch:
        if checksum(ids) != block["crc32"]:
            raise ValueError(f"block {block['part']}/{block['block']} is damaged")
        ends = np.cumsum([0, *block["lengths"]])
        rows = [row(ids[a:b]) for a, b in zip(ends, ends[1:])]
        columns = [block["doc_ids"], (block["start"] + ends[:-1]).tolist(), *map(list, zip(*rows))]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, None if i > 1 else pa.int64()) for i, c in enumerate(columns)], _names(schema)
        )

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(frequencies)
        for batch in batches:
            for n in range(batch.num_rows):
                block = batch.slice(n, 1).to_pylist()[0]
                coded = Coded(block["words"], block["states"], block["places"])
                yield documents(block, decode(block["n_ids"], coded, table))

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids = b"".join(span["ids"] for span in block["spans"])
                yield documents(block, np.frombuffer(ids, _U32))

    blocks = spark.read.schema(_FILE).parquet(f"{path}/blocks")
    long = F.col("n_ids") > size * STEPS * LANES
    out = blocks.where(~long).mapInArrow(whole, schema)
    # Only the numbers of ids are read for this; most files have no long block
    if not blocks.where(long).isEmpty():
        decoded = spans(blocks.where(long), size).repartition("part", "block", "first").mapInArrow(_decoded(frequencies), _IDS)
        put_together = decoded.groupBy("part", "block").agg(F.sort_array(F.collect_list(F.struct("first", "ids"))).alias("spans"))
        heads = blocks.where(long).select("part", "block", "start", "doc_ids", "lengths", "crc32")
        out = out.unionByName(heads.join(put_together, ["part", "block"]).mapInArrow(joined, schema))
    with few_rows_at_once(spark):
        return stored(out, "documents")
