import random

import pytest

from semestra.llm import lines


def brute(rows, min_docs, keep_first=False, min_chars=1):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    where = {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in order:
        for line in (text or "").split("\n"):
            where.setdefault(key(line), []).append(doc)
    out = []
    seen = set()
    for doc, text in order:
        kept = []
        for line in (text or "").split("\n"):
            k = key(line)
            common = len(k) >= min_chars and len(set(where[k])) >= min_docs
            if not common or (keep_first and k not in seen):
                kept.append(line)
            seen.add(k)
        n = len((text or "").split("\n"))
        out.append((str(doc), n, n - len(kept), "\n".join(kept) if n > len(kept) else (text or "")))
    return sorted(out)


def result(docs, **rules):
    frame = lines.deduplicated(docs, **rules)
    assert frame.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    return sorted((str(r.doc_id), r["__n_lines"], r["__n_dropped"], r.text) for r in frame.collect())


@pytest.fixture
def shared(documents):
    rng = random.Random(3)
    common = ["Read more", " read MORE\t", "Licensed", "Ünder É", "x"]
    texts = []
    for n in range(80):
        body = [f"line {rng.randrange(60)}" for _ in range(rng.randrange(6))]
        texts.append((n, "\n".join(body + rng.sample(common, rng.randrange(4)) + ["", "  "][: rng.randrange(3)])))
    return documents(texts + [(200, None), (201, ""), (202, "\n\n")])


@pytest.mark.parametrize("min_docs", [1, 2, 10])
def test_common_lines_go(shared, min_docs):
    rows = [(r.doc_id, r.text) for r in shared.collect()]
    assert result(shared, min_docs=min_docs) == brute(rows, min_docs)
    assert result(shared, min_docs=min_docs, min_chars=5) == brute(rows, min_docs, min_chars=5)


def test_first_occurrence_stays(shared):
    rows = [(r.doc_id, r.text) for r in shared.collect()]
    assert result(shared, min_docs=2, keep_first=True) == brute(rows, 2, keep_first=True)


def test_hot_line_over_many_ranges(spark, documents):
    docs = documents([(n, f"own {n}\nthe same line\nthe same line") for n in range(3000)])
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = result(docs, min_docs=10)
        first = result(docs, min_docs=10, keep_first=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == sorted((str(n), 3, 2, f"own {n}") for n in range(3000))
    assert [r for r in first if r[2] != 2] == [("0", 3, 1, "own 0\nthe same line")]


def test_odd_rows(odd):
    got = result(odd, min_docs=2)
    assert len(got) == odd.count()
    assert ("2", 1, 0, "") in got and ("3", 1, 0, "") in got and ("4", 3, 0, "  \n\t\n ") in got
    # The three rows of id 1 are one document, so its repeated lines stay
    assert ("1", 3, 0, "One line\nanother line\nOne line") in got
    assert ("7", 1, 1, "") in got and ("8", 1, 1, "") in got
    assert result(odd.limit(0), min_docs=2) == []


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, 2, "a\nb", "x", "y")], "doc bigint, doc_id bigint, text string, lines string, copy string")
    frame = lines.deduplicated(docs, min_docs=1)
    assert [tuple(r) for r in frame.collect()] == [(1, 2, "", "x", "y", 2, 2)]


def test_bitmaps():
    for n, dropped in ((1, []), (1, [0]), (20, [0, 7, 8, 19])):
        keep = lines.unpack(lines.pack(n, dropped), n)
        assert [i for i in range(n) if not keep[i]] == dropped
    assert len(lines.pack(100_000, [5])) < 200
