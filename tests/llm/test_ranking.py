import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import types as T

from semestra.llm import ranking, registry

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {n: n + 32 for n in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=50):
    """Every document scored for every item, as the contract tells."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, length = sum(s > 0 for s in sizes), sum(sizes)
    holding = Counter(t for _, c in counts for t in c)
    out = []
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    for item, mine in wanted.items():
        rows = []
        for (key, c), n in zip(counts, sizes):
            if not n:
                continue
            m = 50 + 50 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in mine if c[t]
            )
            if score > 0:
                rows.append((-score, key is not None, key or 0, key))
        rows.sort(key=lambda r: r[:3])
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(rows[:top], 1)]
    return sorted(out, key=str)


def plain(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_terms():
    text = "Ab-c  É9é\x00\x7fx_y İKK [z] 日本、ok`{~}@/:9"
    assert ranking.counted_terms(text.encode())[0] == Counter(t.encode() for t in terms(text))


def test_slices_do_not_cut_terms(monkeypatch):
    text = " ".join(f"word{n % 37}" for n in range(500)) + "x" * 300
    whole = ranking.counted_terms(text.encode())
    monkeypatch.setattr(ranking, "SLICE", 7)
    assert ranking.counted_terms(text.encode()) == whole


def test_query_against_brute_force(spark):
    read = lambda name, *columns: [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]
    frame = registry.QUERIES["op12_ranking"](spark, SF)
    assert [f.dataType.simpleString() for f in frame.schema] == ["bigint", "int", "bigint", "bigint"]
    assert plain(frame) == brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))


def texts(n, seed, words=60):
    rng = random.Random(seed)
    names = [f"w{int(rng.paretovariate(0.6)) % words}" for _ in range(4000)]
    return [(i, " ".join(rng.choices(names, k=rng.choice([0, 1, 3, 20, 90])))) for i in range(n)]


@pytest.mark.parametrize("settings", [{}, {"CHUNK_DOCS": 16, "FIRST": 2}, {"MASK_WORDS": 40, "FIRST": 1}, {"BLOCK_ITEMS": 3, "SALTS": 1}])
def test_many_terms_and_blocks(spark, documents, monkeypatch, settings):
    """Items of more than 64 terms, small chunks, spans and blocks, and many equal scores."""
    docs = texts(300, 1, words=200)
    items = [(n, " ".join(f"w{(n * 7 + j) % 200}" for j in range(90 if n % 2 else 5))) for n in range(8)]
    for name, value in settings.items():
        monkeypatch.setattr(ranking, name, value)
    frame = ranking.ranked(documents(docs).repartition(3), spark.createDataFrame(items, ITEMS), top=7)
    assert plain(frame) == brute(docs, items, 7)


def test_odd_rows(spark, odd):
    """Null and repeated keys, null and empty texts and items, ties, a long text, other columns."""
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "LINE a another é"), (1, "word3"), (2, None), (None, "id x"), (None, "of"), (3, "nothing else"), (4, " . "), (5, "a a")]
    frame = spark.createDataFrame(items, ITEMS)
    assert plain(ranking.ranked(odd.selectExpr("*", "1 AS n", "2 AS terms", "3 AS score", "4 AS item_id"), frame)) == brute(docs, items)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "word")], ITEMS)
    assert ranking.ranked(documents([]), items).collect() == []
    assert ranking.ranked(documents(["word"]), items.limit(0)).collect() == []
    assert ranking.ranked(documents(["", None]), items).collect() == []
    assert ranking.ranked(documents(["word", "other"]), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_groups_below_the_best_are_not_scored():
    """Documents of many small groups: only those whose bound reaches the best are scored."""
    rng = np.random.default_rng(4)
    size = 4000
    docs = [np.sort(rng.choice(size, size // 2, replace=False)) for _ in range(8)]
    gains = [np.full(len(d), 1 + 10 ** (n // 2)) for n, d in enumerate(docs)]
    best = ranking.Best(10)
    scored = ranking.search(best, docs, gains, np.arange(size), np.ones(size, bool))
    total = np.zeros(size, np.int64)
    for d, g in zip(docs, gains):
        total[d] += g
    assert best.scores.tolist() == sorted(total.tolist(), reverse=True)[:10]
    assert best.keys.tolist() == sorted(range(size), key=lambda i: (-total[i], i))[:10]
    assert scored < size // 2
