import hashlib
import heapq
import random
import zlib
from collections import defaultdict
from itertools import product

import pytest
from conftest import SF
from pyspark.sql import types as T

from semestra.llm import conversations as cv, registry

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])
SPACE = " \t\n\x0b\x0c\r"


def brute_edits(codes):
    """The cheapest edits, the least in letters, by taking states in order of cost and letters."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, letters, place, said = heapq.heappop(heap)
        state = said[-1:] if said else ""
        if place == len(codes) and state in ("", "a"):
            return cost, letters
        if (place, state) in seen:
            continue
        seen.add((place, state))
        then = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 5, letters + "I", place, then))
        if place == len(codes):
            continue
        code = codes[place]
        heapq.heappush(heap, (cost + 2, letters + "D", place + 1, said))
        if code == "-":
            continue
        more = 5 if code.isupper() else 0
        if code.lower() == then or (code.lower() == "s" and state == ""):
            heapq.heappush(heap, (cost + more, letters + "K", place + 1, code.lower()))
        heapq.heappush(heap, (cost + more + 1, letters + "R", place + 1, then))


def brute(rows, spoil=True):
    """All conversations, row by row from the contract."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        there = groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if spoil else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        there += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, there in groups.items():
        there.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in there:
            end = text.strip(SPACE)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(there, there[1:])]
        turns = [t for t, _, _ in there if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, edits = brute_edits(codes)
        told = "\n".join(f"{r}:{t}" for r, t in cv.lines(edits, [(r, t) for _, r, t in there]))
        out.append((
            conv, gaps, *faults.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, edits,
            hashlib.sha256(told.encode()).hexdigest(),
        ))
    return out


def plain(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("length", range(5))
def test_search_against_all_short_rows(length):
    for codes in map("".join, product("suax-UA", repeat=length)):
        assert cv.search(codes)[:2] == brute_edits(codes), codes


def test_segments_against_whole_search():
    rng = random.Random(3)
    for n in range(120):
        codes = "".join(rng.choice("uuuaaasx--UA" if n % 2 else "ua") for _ in range(rng.randrange(150)))
        assert cv.repaired(codes) == brute_edits(codes), codes


@pytest.mark.parametrize("codes", ["u" * 500, "a" * 500, "-" * 500, "S" * 300 + "ua" * 100, "x" * 400])
def test_long_uniform_rows(codes):
    assert cv.repaired(codes) == brute_edits(codes)


def test_lines_say_what_edits_mean():
    rows = [("system", "Be."), ("user", "a."), ("user", "b."), ("tool", "c.")]
    assert list(cv.lines("KKDR", rows)) == [("system", "Be."), ("user", "a."), ("assistant", "c.")]
    assert list(cv.lines("IKDDKI"[:1] + "D" * 4 + "I", rows)) == [("user", ""), ("assistant", "")]


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert plain(registry.QUERIES["op13_conversations"](spark, SF)) == sorted(brute(rows), key=str)


def made(n, seed):
    rng = random.Random(seed)
    return [
        (rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, *range(40)]),
         rng.choice(["user", "assistant", "system", "tool", "", None, "Umpire", "äh"]),
         rng.choice(["One.", "Two!", "three", " \t", "", None, "Four?\n", "fünf…", "One."]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_odd_rows(spark, seed):
    """Null ids, turns, roles and texts, ties, repeated rows, many rows of one conversation."""
    rows = made(400, seed)
    frame = spark.createDataFrame(rows, ROWS).repartition(5)
    for spoil in (True, False):
        assert plain(cv.repairs(frame, spoil)) == sorted(brute(rows, spoil), key=str)


def test_lost_conversation_empty_table_and_other_columns(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(lost, 0, "user", "Hello.")], ROWS)
    expected = [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert plain(cv.repairs(frame)) == expected
    assert plain(cv.repairs(frame.selectExpr("*", "1 AS copies", "'x' AS digest", "2 AS audit", "3 AS cost", "4 AS fault"))) == expected
    assert cv.repairs(frame.limit(0)).collect() == []


def test_one_long_conversation(spark):
    """Most rows belong to one conversation, with one very long text."""
    rng = random.Random(8)
    rows = [(7, n, rng.choice(["user", "assistant"]), rng.choice(["yes.", "no", f"it is {n}."])) for n in range(3000)]
    rows += [(8, 0, "user", "word " * 300_000 + "."), (8, 1, "assistant", "Fine.")]
    assert plain(cv.repairs(spark.createDataFrame(rows, ROWS).repartition(7))) == sorted(brute(rows), key=str)
