"""SentencePiece encoding and decoding of merge-type models, with seeded merge-dropout.

Adjacent symbols are merged in the order of an agenda: the best scored piece first, the
leftmost of equal ones. With dropout a candidate merge is skipped by a hash of the seed,
the document's key, the number of its copy, the word's place in it and the candidate. So
every occurrence of a word has draws of its own, which can be repeated anywhere. Only
agendas without dropout are remembered: an occurrence that skips none of its candidates
has that segmentation, all others are merged anew, many at a time. The pieces always
decode to the text they came from.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, functions as F

from semestra.llm.text import mixed, pieces as text_pieces

SPACE = "▁"
_MASK = (1 << 64) - 1

#: Agendas that a worker remembers, and the longest word it remembers.
REMEMBERED, LONGEST = 250_000, 40
#: Words that are merged side by side.
BLOCK = 4096
_NONE = np.iinfo(np.int32).max
_GOLDEN = 0x9E3779B97F4A7C15
#: Nothing merges across the start of a run of spaces or a line feed.
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")


def draw(base: int, left: int, right: int, size: int) -> int:
    """A 64-bit hash of a candidate's place and size, keyed by the hash of its word."""
    x = base ^ (left * 0x9E3779B97F4A7C15 + right * 0xC2B2AE3D27D4EB4F + size * 0x165667B19E3779F9) & _MASK
    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & _MASK
    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & _MASK
    return x ^ x >> 32


def draws(bases: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """``draw`` for arrays; candidates are hashed by ``candidate``."""
    x = bases ^ candidates
    for _ in range(2):
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def candidate(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    parts = zip((left, right, size), (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    return sum(part.astype(np.uint64) * np.uint64(factor) for part, factor in parts)


class Agendas:
    """Candidates, hashed, that agendas without dropout take, and their piece ids, in two flat arrays."""

    def __init__(self, hashes=None, taken=None, ids=None, sizes=None) -> None:
        none = np.zeros(0, np.int64)
        self.hashes = np.zeros(0, np.uint64) if hashes is None else hashes
        self.ids = np.zeros(0, np.int32) if ids is None else ids
        self.taken, self.sizes = (none, none) if taken is None else (taken, sizes)
        self.first_hash = np.cumsum(self.taken) - self.taken
        self.first_id = np.cumsum(self.sizes) - self.sizes

    def rows(self, which: np.ndarray) -> Agendas:
        taken, sizes = self.taken[which], self.sizes[which]
        return Agendas(
            self.hashes[spans(self.first_hash[which], taken)], taken, self.ids[spans(self.first_id[which], sizes)], sizes
        )

    def __add__(self, other: Agendas) -> Agendas:
        both = [np.concatenate((getattr(self, f), getattr(other, f))) for f in ("hashes", "taken", "ids", "sizes")]
        return Agendas(*both)


def spans(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``firsts``, in a row."""
    return np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Memory:
    """Numbers of words among agendas; of two generations the older goes when the younger is full."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.young: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.agendas, self.older_agendas = Agendas(), Agendas()

    def remember(self, words: list[str], agendas: Agendas) -> None:
        if len(self.young) + len(words) > self.size:
            self.older, self.older_agendas = self.young, self.agendas
            self.young, self.agendas = {}, Agendas()
            words, agendas = words[: self.size], agendas.rows(np.arange(min(len(words), self.size)))
        self.young.update(zip(words, range(len(self.young), len(self.young) + len(words))))
        self.agendas = self.agendas + agendas


class MergeModel:
    """Pieces and scores of a merge-type model file with byte fallback."""

    def __init__(self, model: bytes) -> None:
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        numbers = range(library.vocab_size())
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.pieces: list[str | None] = []
        self.scores: list[float] = []
        for i in numbers:
            piece = library.id_to_piece(i)
            special = library.is_control(i) or library.is_unknown(i) or library.is_unused(i)
            if library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not special:
                self.ids[piece] = i
            self.pieces.append(None if special or library.is_byte(i) else piece)
            self.scores.append(library.get_score(i))
        byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.content = [
            byte_of.get(i) or (p or "").replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)
        ]
        if len(self.bytes) != 256:
            raise ValueError("the model needs byte fallback, else decoding loses characters")
        # Words can be merged one by one only if no piece goes on into the next
        if any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p) for p in self.ids):
            raise ValueError("pieces that go on after a word or a line are not supported")
        self.ranks = {p: -self.scores[i] for p, i in self.ids.items()}
        self.memory: dict[tuple, list[Memory]] = {}
        self._number_symbols()

    def _number_symbols(self) -> None:
        """Numbers of all symbols that merge, for merging many words side by side."""
        names = list(dict.fromkeys([*self.ids, *"".join(self.ids)]))
        number = {name: n for n, name in enumerate(names)}
        # The last number stands for every other character; nothing merges with it
        self.other = len(names)
        self.piece_of = np.array([*[self.ids.get(name, -1) for name in names], -1], np.int32)
        self.symbol_of = np.full(0x110000, self.other, np.int32)
        for name in names:
            if len(name) == 1:
                self.symbol_of[ord(name)] = number[name]
        pairs = sorted(
            (number[p[:k]] * len(names) + number[p[k:]], number[p])
            for p in self.ids for k in range(1, len(p)) if p[:k] in number and p[k:] in number
        )
        self.pairs = np.array([pair for pair, _ in pairs] or [-1], np.int64)
        self.joined = np.array([joined for _, joined in pairs] or [0], np.int32)
        order = np.unique([self.ranks.get(name, np.inf) for name in names], return_inverse=True)[1]
        self.order_of = order.astype(np.int32)

    def _looked_up(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and number of what two symbols join to; ``_NONE`` where they do not."""
        wanted = one.astype(np.int64) * self.other + two
        wanted[(one == self.other) | (two == self.other)] = -2
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        joined = self.joined[at]
        return np.where(self.pairs[at] == wanted, self.order_of[joined], _NONE).astype(np.int32), joined

    def merged_together(self, words: list[str], limit: int, bases: np.ndarray) -> Agendas:
        """Candidates taken (if no limit) and piece ids of many words; as ``agenda`` on each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        found = []
        for start in range(0, len(order), BLOCK):
            part = order[start : start + BLOCK]
            found.append(self._merged_block([words[i] for i in part.tolist()], lengths[part], limit, bases[part]))
        if not found:
            return Agendas()
        together = Agendas(*[np.concatenate([getattr(x, f) for x in found]) for f in ("hashes", "taken", "ids", "sizes")])
        return together.rows(np.argsort(order, kind="stable"))

    def _merged_block(self, words: list[str], lengths: np.ndarray, limit: int, bases: np.ndarray):
        n, wide = len(words), int(lengths.max()) + 1
        inside = np.arange(wide) < lengths[:, None]
        points = np.zeros((n, wide), np.uint32)
        points[inside] = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        symbols = np.where(inside, self.symbol_of[points], self.other)
        ranks, joins = np.full((n, wide), _NONE, np.int32), np.zeros((n, wide), np.int32)
        found = self._looked_up(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        ranks[:, :-1], joins[:, :-1] = found[0].reshape(n, -1), found[1].reshape(n, -1)
        # Flat places of the symbols after and before; the column past a word stands for its end
        after = np.arange(1, n * wide + 1)
        before = np.arange(-1, n * wide - 1)
        alive = inside.copy()
        rows = np.arange(n)
        symbol, rank, join, living = (x.reshape(-1) for x in (symbols, ranks, joins, alive))
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while len(rows):
            left = rows * wide + ranks[rows].argmin(1)
            going = rank[left] != _NONE
            rows, left = rows[going], left[going]
            right = after[left]
            end = after[right]
            starts = rows * wide
            hashed = candidate(left - starts, right - starts, end - left)
            rank[left] = _NONE
            merging = np.ones(len(rows), bool)
            if limit:
                merging = draws(bases[rows], hashed) > np.uint64(limit - 1)
            else:
                taken.append((rows, hashed))
            left, right, end, starts = left[merging], right[merging], end[merging], starts[merging]
            symbol[left] = join[left]
            living[right], rank[right] = False, _NONE
            after[left] = end
            # A word's end keeps no place before it
            inner = end < starts + wide
            before[end[inner]] = left[inner]
            met = np.concatenate((left[inner], before[left][left > starts]))
            follow = after[met]
            rank[met], join[met] = self._looked_up(symbol[met], symbol[follow])
        row, place = np.nonzero(alive)
        kept = symbols[row, place]
        ids = self.piece_of[kept]
        sizes = np.ones(len(ids), np.int64)
        unknown = np.flatnonzero(ids < 0)
        spelled = [[self.bytes[b] for b in chr(c).encode()] for c in points[row[unknown], place[unknown]].tolist()]
        sizes[unknown] = [len(x) for x in spelled]
        wholes = np.repeat(ids, sizes)
        firsts = np.cumsum(sizes) - sizes
        for at, numbers in zip(firsts[unknown].tolist(), spelled):
            wholes[at : at + len(numbers)] = numbers
        owners = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in taken]])
        hashes = np.concatenate([np.zeros(0, np.uint64), *[h for _, h in taken]])
        return Agendas(
            hashes[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=n), wholes,
            np.bincount(row, sizes, n).astype(np.int64),
        )

    def merged(self, word: str, dropout: float = 0.0, key: int = 0) -> list[int]:
        """Piece ids of one word by its agenda of merges.

        ``key`` keys the hash by which a candidate is skipped; a skipped pair of symbols
        becomes a candidate again only when one of the two has changed.
        """
        limit = int(dropout * (1 << 64))
        return self.agenda(word, limit, xxhash.xxh64_intdigest(word, key) if limit else 0)

    def agenda(self, word: str, limit: int, base: int) -> list[int]:
        """Piece ids of one word; a candidate is skipped if its ``draw`` is under ``limit``."""
        symbols: list[str | None] = list(word)
        size = len(symbols)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        ids, ranks = self.ids, self.ranks
        agenda = [
            (ranks[joined], place, place + 1, joined)
            for place in range(size - 1)
            if (joined := word[place : place + 2]) in ranks
        ]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            one, two = symbols[left], symbols[right]
            if one is None or two is None or after[left] != right or one + two != joined:
                continue
            if limit and draw(base, left, right, len(joined)) < limit:
                continue
            symbols[left], symbols[right] = joined, None
            follower, leader = after[right], before[left]
            after[left] = follower
            if follower < size:
                before[follower] = left
                longer = joined + symbols[follower]
                if longer in ranks:
                    heapq.heappush(agenda, (ranks[longer], left, follower, longer))
            if leader >= 0:
                longer = symbols[leader] + joined
                if longer in ranks:
                    heapq.heappush(agenda, (ranks[longer], leader, left, longer))
        out: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            piece = ids.get(symbol)
            if piece is not None:
                out.append(piece)
            else:
                out.extend(self.bytes[b] for b in symbol.encode())
        return out

    def encode(self, text: str, dropout: float = 0.0, seed: int = 0, key: str = "", copy: int = 0) -> np.ndarray:
        """Piece ids of a text; without dropout those of the library.

        A literal U+2581 becomes bytes, as it would else decode as a space.
        """
        return self.encode_all([text], dropout, seed, [key], [copy])[0]

    def encode_all(
        self, texts: list[str], dropout: float, seed: int, keys: list[str], copies: list[int]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of many texts in a row, and where each begins (one more entry)."""
        words: list[str] = []
        counts = []
        for text in texts:
            before = len(words)
            if text:
                words += self._guarded(text) if SPACE in text else _CHUNK.findall(SPACE + text.replace(" ", SPACE))
            counts.append(len(words) - before)
        limit = int(dropout * (1 << 64))
        ends = np.cumsum([0, *counts])
        started = [xxhash.xxh64_intdigest(f"{copy}:{key}", seed & _MASK) for key, copy in zip(keys, copies)]
        places = np.arange(len(words)) - np.repeat(ends[:-1], counts)
        bases = mixed(np.repeat(np.array(started, np.uint64), counts) + places.astype(np.uint64) * np.uint64(_GOLDEN))
        agendas, which, apart = self._agendas(words, dropout, seed)
        sizes, first = agendas.sizes[which], agendas.first_id[which]
        ids = agendas.ids
        changed = np.zeros(0, np.int64)
        if limit:
            taken = agendas.taken[which]
            hashes = agendas.hashes[spans(agendas.first_hash[which], taken)]
            skipped = draws(np.repeat(bases, taken), hashes) <= np.uint64(limit - 1)
            changed = np.unique(np.repeat(np.arange(len(words)), taken)[skipped])
        anew = self.merged_together([words[i] for i in changed.tolist()], limit, bases[changed])
        alone = [self._alone(words[i], limit, int(bases[i])) for i in apart]
        sizes[changed], first[changed] = anew.sizes, len(ids) + anew.first_id
        sizes[apart] = lengths = np.array([len(x) for x in alone], np.int64)
        first[apart] = len(ids) + len(anew.ids) + np.cumsum(lengths) - lengths
        ids = np.concatenate([ids, anew.ids, *[np.array(x, np.int32) for x in alone]])
        return ids[spans(first, sizes)], np.concatenate(([0], np.cumsum(sizes)))[ends]

    def _alone(self, word: str, limit: int, base: int) -> list[int]:
        if word[0] == "\x00" and SPACE in word:
            return [self.bytes[b] for b in word[1:].encode()]
        return self.agenda(word, limit, base)

    def _agendas(self, words: list[str], dropout: float, seed: int) -> tuple[Agendas, np.ndarray, list[int]]:
        """Agendas without dropout, the place of every word among them, and the words that have none.

        Those are long words and literal U+2581; their places are those of an empty agenda.
        """
        memory = self.memory.setdefault((dropout, seed), [Memory(REMEMBERED)])[0]
        which = [*map(memory.young.get, words)]
        missing = [i for i, n in enumerate(which) if n is None]
        distinct = dict.fromkeys([words[i] for i in missing])
        apart = {w for w in distinct if len(w) > LONGEST or w[0] == "\x00" and SPACE in w}
        known = [w for w in distinct if w in memory.older and w not in apart]
        plain = [w for w in distinct if w not in memory.older and w not in apart]
        fresh = memory.older_agendas.rows(np.array([memory.older[w] for w in known], np.int64))
        fresh = fresh + self.merged_together(plain, 0, np.zeros(len(plain), np.uint64))
        before = len(memory.young)
        empty = Agendas(taken=np.zeros(1, np.int64), sizes=np.zeros(1, np.int64))
        agendas = memory.agendas + fresh + empty
        numbers = dict(zip(known + plain, range(before, before + len(known) + len(plain))))
        for i in missing:
            which[i] = numbers.get(words[i], before + len(numbers))
        memory.remember(known + plain, fresh)
        return agendas, np.array(which, np.int64), [i for i in missing if words[i] in apart]

    def _guarded(self, text: str) -> list[str]:
        """Words of a text that holds literal U+2581; those stand alone behind a zero."""
        out: list[str] = []
        for n, part in enumerate(text.split(SPACE)):
            if n:
                out.append("\x00" + SPACE)
            joined = (SPACE if not n else "") + part.replace(" ", SPACE)
            out.extend(_CHUNK.findall(joined))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of piece ids, without the space that encoding puts before it."""
        out = b"".join(map(self.content.__getitem__, ids))
        return (out[1:] if out[:1] == b" " else out).decode()


@lru_cache(maxsize=2)
def model_of(proto: bytes) -> MergeModel:
    return MergeModel(proto)


def encoded(
    docs: DataFrame, model: bytes, dropout: float = 0.0, seed: int = 0,
    text: str = "text", key: str = "doc_id", copy: str | None = None,
) -> DataFrame:
    """``key`` and ``ids`` (array of int) of every row, over the whole text.

    ``model`` is the content of a model file; it travels with the tasks. ``copy`` names a
    column of numbers that keep the draws of rows of one key apart (0 for all if None).
    Null and empty texts have no ids. Rows of one key, text and copy have the same ids, as
    those of a null key have. Other columns are not looked at; an empty table gives no rows.
    """
    proto = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = model_of(proto.value)
        for batch in text_pieces(batches):
            texts, keys, copies = (batch.column(c).to_pylist() for c in ("text", "key", "copy"))
            flat, ends = coder.encode_all(texts, dropout, seed, list(map(str, keys)), copies)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), lists], ["key", "ids"])

    number = F.lit(0) if copy is None else F.col(f"`{copy}`")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), number.cast("bigint").alias("copy"))
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decoded(coded: DataFrame, model: bytes, key: str = "doc_id") -> DataFrame:
    """``key`` and ``text`` of every row of ``encoded``; null ids give a null text."""
    proto = coded.sparkSession.sparkContext.broadcast(model)
    kind = coded.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = model_of(proto.value)
        for batch in batches:
            texts = [None if ids is None else coder.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    rows = coded.select(F.col(f"`{key}`").alias("key"), "ids")
    return rows.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
