import re

import numpy as np
import pytest
import xxhash

from semestra.llm import simhash
from semestra.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance):
    """Least id of each component, by comparing all pairs."""
    names = list(range(len(prints)))
    while True:
        before = list(names)
        for a in range(len(prints)):
            for b in range(len(prints)):
                if (prints[a] ^ prints[b]).bit_count() <= distance:
                    names[a] = names[b] = min(names[a], names[b])
        if names == before:
            return names


def test_shingles_hash_like_spark(spark):
    frame = spark.createDataFrame([("Ab c é",)], "t string").selectExpr("xxhash64(t) AS h")
    assert frame.first().h & (2**64 - 1) == xxhash.xxh64_intdigest("Ab c é".encode(), 42)


def test_fingerprints(odd):
    rows = odd.collect()
    got = sorted((r.doc_id or 0, r.simhash & (2**64 - 1)) for r in simhash.fingerprints(odd).collect())
    assert got == sorted((r.doc_id or 0, brute_fingerprint(r.text)) for r in rows)


def test_blocks_of_a_long_text_make_no_difference(monkeypatch):
    text = " ".join(f"w{n * n % 101}" for n in range(500)).encode()
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text, 3) == whole
    assert simhash.fingerprint(b"one  two", 3) == brute_fingerprint("one two")


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_hold_components_together(spark, distance):
    rng = np.random.default_rng(distance)
    base = [int(x) for x in rng.integers(0, 2**63, 12)]
    prints = sorted({b ^ sum(1 << int(p) for p in rng.integers(0, 64, rng.integers(0, 5))) for b in base for _ in range(12)} | {0, 2**64 - 1})
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed + signed[:5]], "simhash bigint")
    links = simhash.links(frame, distance).collect()
    assert all(((r.hub ^ r.other) & (2**64 - 1)).bit_count() == r.bits <= distance for r in links)
    roots = {r.node: r.root for r in components(simhash.links(frame, distance), "hub", "other").collect()}
    order = sorted(signed)
    names = brute_groups([s & (2**64 - 1) for s in order], distance)
    assert {s: roots.get(s, s) for s in order} == {s: order[n] for s, n in zip(order, names)}


def test_near_duplicates(odd):
    rows = odd.collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    groups = brute_groups(prints, 2)
    least = {}
    for r, g in zip(rows, groups):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    expected = sorted((str(r.doc_id), f"{p:016x}", str(least.get(g))) for r, p, g in zip(rows, prints, groups))
    got = [tuple(map(str, r)) for r in simhash.near_duplicates(odd).collect()]
    assert sorted(got) == expected


def test_one_of_each(documents):
    docs = documents([(5, "a b c"), (3, "a b c"), (3, "a b c"), (None, "a b c"), (9, "quite another text"), (8, None), (7, "")])
    kept = sorted((str(r.doc_id), r.text) for r in simhash.one_of_each(docs).collect())
    assert kept == [("3", "a b c"), ("7", ""), ("9", "quite another text"), ("None", "a b c")]
    assert simhash.one_of_each(docs).columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_key_with_two_texts(documents):
    """A text is no copy of another one because they share a key."""
    docs = documents([
        (0, "a b c d e f"), (1, "a b c d e f"), (1, "zz a wholly other text"), (2, "zz a wholly other text"),
        (3, "first of three"), (3, "second text of it"), (3, "second text of it"), (3, "and the third one"), (4, "and the third one"),
    ])
    kept = sorted((r.doc_id, r.text) for r in simhash.one_of_each(docs.withColumn("root", docs.doc_id)).collect())
    assert kept == [
        (0, "a b c d e f"), (1, "zz a wholly other text"), (3, "and the third one"), (3, "first of three"), (3, "second text of it"),
    ]


def test_odd_rows_keep_every_different_text(odd):
    kept = {(r.doc_id, r.text) for r in simhash.one_of_each(odd).collect()}
    rows = odd.collect()
    groups = brute_groups([brute_fingerprint(r.text) for r in rows], 2)
    for group in set(groups):
        there = {(r.doc_id, r.text) for r, g in zip(rows, groups) if g == group}
        keys = sorted(k for k, _ in there if k is not None)
        stays = {x for x in there & kept if x[0] is not None}
        assert len(stays) == bool(keys) and all(k == keys[0] for k, _ in stays)
        assert {x for x in there if x[0] is None} <= kept


def test_components_of_a_chain(spark):
    pairs = [(n, n + 1) for n in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    edges = spark.createDataFrame(pairs, "a int, b int")
    got = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert got == {**{n: 0 for n in range(41)}, 100: 100, 101: 100}
    assert components(edges.limit(0), "a", "b").count() == 0
