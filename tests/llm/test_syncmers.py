import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from semestra.llm import registry, syncmers

MASK = 2**64 - 1


def chained(*values):
    """Spark's hash of several longs: each is hashed with the one before as seed."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v & MASK).to_bytes(8, "little"), seed)
    return seed


def signed(x):
    return x - 2**64 if x >> 63 else x


def brute_anchors(text):
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text or "") if w]
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words] or [xxhash.xxh64_intdigest(b"", 42)]
    pairs = [chained(a, b) for a, b in zip(hashes, hashes[1:])]
    out = []
    for i in range(len(pairs) - 3):
        inner = [signed(p) for p in pairs[i : i + 4]]
        if min(inner) in (inner[0], inner[3]):
            value = chained(pairs[i], pairs[i + 2], pairs[i + 3])
            out.append(signed(value & ~syncmers._PLACE & MASK | min(i, syncmers._PLACE)))
    alone = xxhash.xxh64_intdigest(" ".join(str(signed(h)) for h in hashes).encode(), 42)
    return out or [signed(alone & ~syncmers._PLACE & MASK)]


def brute_sketch(text):
    firsts = {}
    for a in sorted(brute_anchors(text)):
        firsts.setdefault(a >> syncmers.PLACE_BITS, a)
    return list(firsts.values())[: syncmers.SIZE]


def brute_likeness(one, other):
    a, b = ({x >> syncmers.PLACE_BITS for x in brute_sketch(t)} for t in (one, other))
    least = set(sorted(a | b)[: syncmers.SIZE])
    return len(least & a & b) / len(least)


def brute_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for n, (key, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        out.append((
            str(key), len(text), hashlib.sha256(changed.encode()).hexdigest(), brute_sketch(text), brute_sketch(changed),
            round(brute_likeness(text, changed), 9), round(brute_likeness(text, after), 9),
        ))
    return sorted(out)


def found(docs):
    return sorted(
        (str(r.doc_id), r.n_chars, hashlib.sha256(r.edited_text.encode()).hexdigest(), list(r.sketch), list(r.edited_sketch),
         round(r.near_edited, 9), round(r.near_next, 9))
        for r in syncmers.edited(docs).collect()
    )


def test_anchors(spark):
    texts = ["", "a", "a b c d", "a b c d e", " x\ty\nz  w v u t s r q ", "é ü " * 9, " ".join(f"w{n % 17}" for n in range(200)), None]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = syncmers.with_anchors(frame, "text", "a").collect()
    assert [(r.text, list(r.a)) for r in rows] == [(t, brute_anchors(t)) for t in texts]
    rows = syncmers.with_sketch(frame, "text", "s").collect()
    assert [list(r.s) for r in rows] == [brute_sketch(t) for t in texts]


def test_edits_of_many(documents):
    words = [f"{a}{b}" for a in "ab cd ef".split() for b in range(9)]
    texts = [(n * 7, " ".join(words[(n * k) % 27] for k in range(1, 3 + n % 90))) for n in range(150)]
    docs = documents(texts)
    assert found(docs) == brute_edits(texts)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd.withColumnRenamed("lang", "sketch").withColumnRenamed("source", "__order")) == brute_edits(rows)
    assert syncmers.edited(odd.limit(0)).count() == 0


def test_one_document(documents):
    assert found(documents(["one two three four five six"])) == brute_edits([(0, "one two three four five six")])


def test_moved_passage_keeps_its_anchors(spark):
    passage = " ".join(f"p{n}" for n in range(40))
    frame = spark.createDataFrame([(1, "x y z " + passage), (2, passage + " q r")], "key int, text string")
    rows = syncmers.with_anchors(frame, "text", "anchors")
    met = syncmers.matches(rows.where("key = 1"), rows.where("key = 2")).collect()
    assert len(met) > 5 and all(m.place - m.other_place == 3 for m in met)


def test_no_python_on_the_way(documents):
    docs = documents(["a b c d e f", "g h"])
    plan = syncmers.edited(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_fingerprint_text(spark):
    row = spark.range(1).select(syncmers.fingerprint(F.array(F.lit(-1), F.lit(10))).alias("f")).first()
    assert row.f == "f" * 16 + "000000000000000a"
    assert brute_likeness("a b c", "a b c") == 1 and brute_likeness("a", "b") == 0
    assert pytest.approx(0.33, abs=0.2) == brute_likeness(" ".join(map(str, range(60))), " ".join(map(str, range(30, 90))))


def test_likeness_is_over_all_anchors(spark, documents, tmp_path):
    """Two texts of 5,000 words share 60: the registered likeness is their exact share of anchors."""
    passage = [f"p{n}" for n in range(60)]
    one, other = ([f"{c}{n}" for n in range(5000)] for c in "ab")
    texts = [" ".join(one[:100] + passage + one[100:]), " ".join(other[:3000] + passage + other[3000:])]
    documents(list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    sets = [{a >> syncmers.PLACE_BITS for a in brute_anchors(t)} for t in texts]
    share = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    rows = registry.op9_syncmers(spark, str(tmp_path)).collect()
    assert share > 0 and [r.near_next for r in rows] == pytest.approx([share, share])


def hash_set(text):
    low = (1 << (64 - syncmers.PLACE_BITS)) - 1
    return {f"{(a >> syncmers.PLACE_BITS) & low:010x}" for a in brute_anchors(text)}


def share_of(one, other):
    return len(one & other) / len(one | other)


def test_returned_columns_of_many(spark, documents, tmp_path):
    """Fingerprints hold every anchor, and the likeness follows from them alone."""
    words = [f"{a}{b}" for a in "ab cd ef é".split() for b in range(9)]
    texts = [(n * 7, " ".join(words[(n * k) % 36] for k in range(1, 3 + n % 90))) for n in range(120)] + [(5, None), (6, "")]
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in registry.op9_syncmers(spark, str(tmp_path)).collect()}
    order = sorted((k, t or "") for k, t in texts)
    for n, (key, text) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        cut = lambda f: {f[i : i + 10] for i in range(0, len(f), 10)}
        assert cut(rows[key].fingerprint) == hash_set(text) and cut(rows[key].edited_fingerprint) == hash_set(changed)
        assert rows[key].near_edited == pytest.approx(share_of(cut(rows[key].fingerprint), cut(rows[key].edited_fingerprint)))
        assert rows[key].near_next == pytest.approx(share_of(hash_set(text), hash_set(after)))
