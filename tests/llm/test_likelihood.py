import re

import numpy as np
import pytest

from semestra.llm import likelihood as lk


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:n] for n, x in enumerate(lines)), len(inside),
    )


TEXTS = [
    "", "a", "a b c", "a a a a", "a b c a b c", "x y x y x y", "é 日本 | # <b>\n\n  \nq\nq\nq ", "l1\nl1 \nl1\n",
    " ".join(f"w{n % 7}" for n in range(100)), " ".join(f"w{n}" for n in range(60)), "a a a b a a a c",
]


def test_base_counts():
    for text in TEXTS:
        assert tuple(lk.base_counts(text.encode())) == brute_base(text)
    assert lk.base_counts(TEXTS[8].encode()).failed and not lk.base_counts(TEXTS[9].encode()).failed


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [f"{chr(97 + rng.integers(0, 26))}word{rng.integers(0, 30)}" for _ in range(60 + rng.integers(0, 40))]
        good = bool(rng.integers(0, 4))
        rated = i % 2 == 0
        rows.append((i, " ".join(words if good else [w + "###" for w in words]), good and rated, rated and not good, good))
    return rows


SCHEMA = "doc_id bigint, text string, trusted boolean, untrusted boolean, good boolean"


def test_scores_and_verdicts(spark):
    rows = corpus(300)
    frame = spark.createDataFrame(rows, SCHEMA)
    ratings = frame.selectExpr("doc_id", "CASE WHEN trusted THEN true WHEN untrusted THEN false END AS trusted")
    got = {r.doc_id: r for r in lk.judged(frame, ratings).collect()}
    # Brute force: counts over all texts, in one go
    raw, good, each = np.zeros(1 << lk.BITS), np.zeros(1 << lk.BITS), {}
    for i, text, trusted, _, _ in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        buckets, _ = lk.ngram_buckets(data, np.array([0, len(data)]))
        each[i] = buckets.ravel()
        np.add.at(raw, each[i], 1)
        if trusted:
            np.add.at(good, each[i], 1)
    share = (raw + 1) / (raw + 1).sum()
    prior = min(lk.PRIOR, good.sum() / 10)
    ratio = np.log((good + prior * share) / (good.sum() + prior)) - np.log(share)
    for i, text, _, _, is_good in rows:
        assert got[i].score == pytest.approx(ratio[each[i]].mean(), abs=1e-6)
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == brute_base(text)
        assert got[i].kept == (is_good and not got[i].base_failed)


def test_threshold(spark):
    frame = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)], "score double, trusted int")
    assert 0.2 < lk.threshold(frame) <= 0.8
    assert lk.threshold(frame.where("trusted = 1")) == 0.8
    assert lk.threshold(frame.where("trusted = 0")) == -float("inf")
    assert lk.threshold(frame.limit(0)) == -float("inf")
    same = spark.createDataFrame([(0.5, 1), (0.5, 0)], "score double, trusted int")
    assert lk.threshold(same) >= 0.5


def test_odd_rows(spark, odd):
    flagged = odd.selectExpr("*", "1 AS score", "'k' AS key", "true AS trusted")
    ratings = spark.createDataFrame([(1, None), (None, True), (77, True)], "doc_id bigint, trusted boolean")
    rows = lk.judged(flagged, ratings).collect()
    assert len(rows) == odd.count()
    assert sorted((str(r.doc_id), r.n_words) for r in rows) == sorted((str(r.doc_id), brute_base(r.text)[0]) for r in odd.collect())
    assert all(r.kept != r.base_failed for r in rows)
    assert all(r.base_failed for r in rows if r.doc_id in (2, 3))
    assert lk.judged(flagged.limit(0), ratings).count() == 0
    both = spark.createDataFrame([(5, True), (6, True), (6, False)], "doc_id bigint, trusted boolean")
    assert len(lk.judged(odd, both).collect()) == odd.count()
