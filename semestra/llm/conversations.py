"""Conversation structure repair: the cheapest edits that make the roles alternate.

Rows are kept, given another role, deleted or inserted until the initials of the roles
read ``(s?(ua)+)?``. The edits are found by iterative-deepening A*: a depth-first search in
the order of the edits' letters under a bound of the cost, which rises until a path is
accepted. The first accepted path is then the cheapest, and the least in letters of those.
States that failed are remembered with the budget they failed with.

A long conversation is searched in segments. Costs between the four states at the ends of
every segment are found first; they tell each segment what is still to come, so that the
paths of the segments join into the path of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

# Costs of the edits, and what an undeleted truncated row adds
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after the system's, the user's and the assistant's row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
#: The state behind a row of the user's or of the assistant's, where one may come.
SPOKEN = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: What a conversation may end in costs nothing more.
ENDS = {EMPTY: 0, ASSISTANT: 0}
#: Neighbouring initials that are no fault.
LEGAL = ("su", "ua", "au")
#: Rows of a long conversation that are searched at once.
SEGMENT = 32

#: Codes of rows: a letter for the initial of the role, capital if the row is truncated,
#: ``x`` for any other initial and ``-`` for a row that has to go.
MUST_GO = "-"


def _kept(state: int, code: str) -> int | None:
    """The state behind a row that is kept as it is; None where it can't be."""
    letter = code.lower()
    if letter == "s":
        return SYSTEM if state == EMPTY else None
    return SPOKEN[state] if letter == "ua"[SPOKEN[state] == ASSISTANT] else None


def _least_rests(codes: str) -> list[int]:
    """For each place, what the rows from there on cost at least."""
    rests = [0]
    for code in reversed(codes):
        # A row to go costs its deletion, a truncated one no less, any other may be kept
        least = REROLE if code == "x" else KEEP
        if code == MUST_GO:
            least = DELETE
        elif code.isupper():
            least = min(DELETE, TRUNCATED + least)
        rests.append(rests[-1] + least)
    return rests[::-1]


def search(codes: str, entry: int = EMPTY, ends: dict[int, int] = ENDS) -> tuple[int, str, int]:
    """Cost, edits and last state of the best way through the rows from a state.

    ``ends`` gives the states it may end in and what each costs further.
    """
    size, rests = len(codes), _least_rests(codes)
    cheapest_end = min(ends.values())
    failed: dict[tuple[int, int], int] = {}

    def moves(place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Letter, cost, next place and state, in the order of the letters."""
        code = codes[place] if place < size else ""
        if code:
            yield "D", DELETE, place + 1, state
        yield "I", INSERT, place, SPOKEN[state]
        if code and code != MUST_GO:
            extra = TRUNCATED if code.isupper() else 0
            kept = _kept(state, code)
            if kept is not None:
                yield "K", KEEP + extra, place + 1, kept
            yield "R", REROLE + extra, place + 1, SPOKEN[state]

    bound = rests[0] + cheapest_end
    while True:
        above: list[int] = []
        # The path so far: place, state, cost and the moves not tried yet
        path = [(0, entry, 0, moves(0, entry))]
        letters: list[str] = []
        if size == 0 and entry in ends:
            if ends[entry] <= bound:
                return ends[entry], "", entry
            above.append(ends[entry])
        while path:
            place, state, cost, rest = path[-1]
            for letter, price, further, then in rest:
                spent = cost + price
                least = spent + rests[further] + cheapest_end
                if least > bound:
                    above.append(least)
                    continue
                if failed.get((further, then), -1) >= bound - spent:
                    # What failed with this budget costs at least one more
                    above.append(spent + failed[further, then] + 1)
                    continue
                letters.append(letter)
                if further == size and then in ends:
                    if spent + ends[then] <= bound:
                        return spent + ends[then], "".join(letters), then
                    above.append(spent + ends[then])
                path.append((further, then, spent, moves(further, then)))
                break
            else:
                failed[place, state] = max(failed.get((place, state), -1), bound - cost)
                path.pop()
                if letters:
                    letters.pop()
        bound = min(above)


def repaired(codes: str) -> tuple[int, str]:
    """Cost and edits of the whole conversation, segment by segment."""
    parts = [codes[i : i + SEGMENT] for i in range(0, len(codes), SEGMENT)] or [""]
    # What is still to come behind each segment, for each state there, from the last on
    rests = [ENDS]
    known: dict[tuple, dict[int, int]] = {}
    for part in reversed(parts[1:]):
        # Only differences matter, so that like segments are searched once
        base = min(rests[-1].values())
        key = (part, tuple(sorted((s, c - base) for s, c in rests[-1].items())))
        if key not in known:
            known[key] = {s: search(part, s, dict(key[1]))[0] for s in STATES}
        rests.append({s: c + base for s, c in known[key].items()})
    rests.reverse()
    state, edits, total = EMPTY, [], None
    for part, ends in zip(parts, rests):
        cost, letters, state = search(part, state, ends)
        total = cost if total is None else total
        edits.append(letters)
    return total, "".join(edits)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of every row as damage leaves it.

    The CRC-32 of ``conv_id:turn`` modulo 20 decides: 0 drops the row (no copies), 1 empties
    its text, 2 removes full stops, exclamation and question marks, 3 gives it twice, 4
    makes it the user's. Nulls in the key, the role and the text stand as one space.
    """
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *told).cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    drops, empties = kind == 0, kind.isin(0, 1)
    return rows.select(
        "conv_id", "turn",
        F.when(drops, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(empties, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(drops, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _judged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, initial, fault and copies in the order of the conversations.

    Texts are told by a digest of 128 bits; equal rows of a turn are put together, with
    their copies, before anything moves.
    """
    # The last character that is no white space; empty where there is none
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    own = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated")
    there = F.col("copies") > 0
    compact = rows.withColumns({"digest": F.unhex(F.md5("text")), "own": own}).groupBy(
        "conv_id", "turn", "role", "digest", there.alias("there")
    ).agg(F.sum("copies").alias("copies"), F.first("own").alias("own"))
    # Equal rows of other turns: the window is within the conversation, as the next order is
    before = Window.partitionBy("conv_id", "role", "digest", "there").orderBy(F.asc_nulls_first("turn"))
    repeated = F.row_number().over(before) > 1
    fault = F.when(F.col("own") == "blank", "blank").when(repeated, "duplicate").otherwise(F.col("own"))
    return (
        compact.repartition(F.col("conv_id")).withColumn("fault", fault)
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
        .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    )


def _streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _sent(rows: Iterator[tuple], schema: pa.Schema, letters: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some thousand, or of about so many letters in the last column but one."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1024 + len(row[-1])
        if size > letters:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _edits(conv, rows: Iterator[tuple]) -> tuple:
    """The counts and edits of one conversation, of which a letter for each row is held."""
    codes: list[str] = []
    first = last = before = None
    different = blank = duplicate = truncated = illegal = 0
    for _, turn, initial, fault, copies in rows:
        if not copies:
            continue
        if turn is not None:
            first = turn if first is None else first
            different += turn != last
            last = turn
        blank += copies * (fault == "blank")
        # Further copies of a row repeat its first one
        duplicate += copies if fault == "duplicate" else (copies - 1) * (fault != "blank")
        truncated += fault == "truncated"
        illegal += (before is not None and before + initial not in LEGAL) + copies - 1
        before = initial
        letter = initial if initial in ("s", "u", "a") else "x"
        if fault in ("blank", "duplicate"):
            letter = MUST_GO
        codes.append((letter.upper() if fault == "truncated" else letter) + MUST_GO * (copies - 1))
    gaps = last - first + 1 - different if first is not None else 0
    cost, edits = repaired("".join(codes))
    return conv, gaps, blank, duplicate, truncated, illegal, cost, edits


def _solve(kind: pa.DataType):
    schema = pa.schema([("conv_id", kind), *[(n, pa.int64()) for n in _COUNTS], ("audit", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = groupby(_streamed(batches), itemgetter(0))
        yield from _sent((_edits(conv, rows) for conv, rows in groups), schema)

    return run


def lines(edits: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired conversation from its edits and its rows."""
    state, rows = EMPTY, iter(rows)
    spoken = {USER: "user", ASSISTANT: "assistant"}
    for letter in edits:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            role = spoken[SPOKEN[state]]
        state = SYSTEM if role[:1] == "s" else SPOKEN[state]
        yield role, text


def _digests(kind: pa.DataType):
    fields = [("conv_id", kind), *[(n, pa.int64()) for n in _COUNTS], ("repaired_sha256", pa.string()), ("audit", pa.string())]
    schema = pa.schema(fields)

    def told(rows: Iterator[tuple]) -> tuple:
        """A conversation's edits come first, then its rows, which are hashed as they come."""
        *counts, audit = next(rows)[:8]
        digest, joint = hashlib.sha256(), ""
        copies = ((role, text) for *_, role, text, n in rows for _ in range(n))
        for role, text in lines(audit, copies):
            digest.update(f"{joint}{role}:{text}".encode())
            joint = "\n"
        # Deleted rows at the end
        for _ in rows:
            pass
        return (*counts, digest.hexdigest(), audit)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sent((told(rows) for _, rows in groupby(_streamed(batches), itemgetter(0))), schema)

    return run


def repairs(conversations: DataFrame, spoil: bool = True) -> DataFrame:
    """One row for each conversation: ``conv_id``, counts of its faults, cost and letters of
    its edits (``audit``), and the SHA-256 of the repaired conversation.

    ``conversations`` has conv_id, turn, role and text; other columns are not looked at. With
    ``spoil`` its rows are damaged first (``damaged``), else only copied. Rows go by turn,
    null first; rows of one turn by role and digest of the text, equal ones being copies.
    Null conv_ids are one conversation; null roles and texts stand as one space. An empty
    table gives no rows; a conversation that lost all its rows has zeros and no edits.

    Edits take a letter a row in one task, like the result itself. Texts move once: they
    follow their conversation's edits in a sorted stream and are hashed as they come, so
    that a conversation of any length holds no more than a batch of its texts.
    """
    kind = conversations.schema["conv_id"].dataType
    arrow = pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()
    rows = damaged(conversations) if spoil else conversations.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(1).alias("copies")
    )
    counts = ", ".join(f"{n} bigint" for n in _COUNTS)
    name = kind.simpleString()
    solved = _judged(rows).mapInArrow(_solve(arrow), f"conv_id {name}, {counts}, audit string")
    texts = rows.where("copies > 0").withColumn("digest", F.unhex(F.md5("text")))
    order = ["conv_id", F.asc_nulls_first("audit_last"), F.asc_nulls_first("turn"), "role", "digest"]
    stream = (
        solved.withColumn("audit_last", F.lit(0)).unionByName(texts.withColumn("audit_last", F.lit(1)), allowMissingColumns=True)
        .repartition(F.col("conv_id")).sortWithinPartitions(*order)
        .select("conv_id", *_COUNTS, "audit", "role", "text", "copies")
    )
    return stream.mapInArrow(_digests(arrow), f"conv_id {name}, {counts}, repaired_sha256 string, audit string").select(
        "conv_id", *_COUNTS, "audit", "repaired_sha256"
    )
