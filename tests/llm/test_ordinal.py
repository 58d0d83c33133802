import numpy as np
import pytest

from semestra.llm import features as ft, ordinal
from semestra.llm.optimise import minimum

WORDS = ["river", "stone", "cloud", "meadow", "candle", "window", "garden", "silver", "paper", "winter"]


def corpus(n, seed=0):
    """Texts of three grades: 0 holds a rude word, 1 is shouted, 2 is plain."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        grade = int(rng.integers(0, 3))
        words = [WORDS[k] + str(rng.integers(0, 40)) for k in rng.integers(0, len(WORDS), 30)]
        if grade == 0:
            words[3] = "idiot"
        if grade == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), grade))
    return rows


def test_gradient(monkeypatch):
    rng = np.random.default_rng(1)
    sample = ft.Sample(rng.integers(0, 40, 300), rng.integers(0, 50, 300), rng.random(300), rng.integers(0, 3, 40))
    caught = {}
    monkeypatch.setattr(ordinal, "minimum", lambda loss, start: caught.setdefault("loss", loss) and start)
    ordinal.fit(sample, 2, least_z=0.0)
    loss = caught["loss"]
    buckets = ft.telling_buckets(sample, [sample.labels >= 1, sample.labels >= 2], 0.0, 5)
    x = rng.normal(0, 0.3, len(buckets) + 2)
    _, slope = loss(x)
    for i in list(range(5)) + [len(x) - 2, len(x) - 1]:
        step = np.zeros(len(x))
        step[i] = 1e-6
        assert slope[i] == pytest.approx((loss(x + step)[0] - loss(x - step)[0]) / 2e-6, abs=1e-5)


def test_minimum():
    a = np.diag([1.0, 10.0, 100.0])
    found = minimum(lambda x: (x @ a @ x / 2 - x.sum(), a @ x - 1), np.zeros(3))
    assert found == pytest.approx([1, 0.1, 0.01], abs=1e-3)


def test_grades_of_held_out_texts(spark):
    seen, new = corpus(900), corpus(300, seed=1)
    docs = spark.createDataFrame(seen, "doc_id bigint, text string, grade int")
    ratings = docs.selectExpr("doc_id", "grade AS label")
    model = ordinal.train(docs, ratings, train_rows=600, held_rows=300)
    assert model.thresholds[0] < model.thresholds[1]
    frame = spark.createDataFrame(new, "doc_id bigint, text string, grade int")
    got = ordinal.graded(frame, model).collect()
    assert frame.columns + ["__words", "__grade", "__tail", "__kept"] == ordinal.graded(frame, model).columns
    assert np.mean([r["__kept"] == (r.grade == 2) for r in got]) > 0.97
    means = [np.mean([r["__grade"] for r in got if r.grade == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    assert all(0 <= r["__tail"] <= 1 and r["__words"] == 30 for r in got)
    # Brute force: the score from counted words, feature by feature
    for r in got[:5]:
        data = np.frombuffer(r.text.encode(), np.uint8)
        features, firsts = ft.word_features(data, np.array([0, len(data)]))
        weights = dict(zip(model.buckets.tolist(), model.weights))
        flat = features.ravel().tolist()
        score = sum(weights.get(b, 0) * np.sqrt(flat.count(b) / 30) for b in set(flat))
        assert r["__tail"] == pytest.approx(1 - 1 / (1 + np.exp(score - model.thresholds[1])), abs=1e-6)


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.createDataFrame(corpus(400), "doc_id bigint, text string, label int")
    one = ft.labelled_sample(docs, docs.select("doc_id", "label"), 50, "doc_id", "text")
    two = ft.labelled_sample(docs.repartition(7), docs.select("doc_id", "label"), 50, "doc_id", "text")
    assert len(one.labels) == 50 and set(one.rows) == set(range(50))
    assert all((a == b).all() for a, b in zip(one, two))


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert sorted((r.doc_id, r.label) for r in ordinal.ratings(labels).collect() if r.doc_id) == [(1, 1), (2, None)]
    model = ordinal.train(odd, ordinal.ratings(labels))
    assert model is None
    rows = ordinal.graded(odd, model).collect()
    assert len(rows) == odd.count() and all(r["__kept"] and r["__grade"] is None for r in rows)
    trained = ordinal.OrdinalModel(np.array([5, 9]), np.array([1.0, -1.0]), np.array([-1.0, 0.5]), 0.3)
    rows = ordinal.graded(odd.withColumnRenamed("lang", "new0"), trained).collect()
    empty = [r for r in rows if not (r.text or "").strip()]
    assert len(rows) == odd.count() and all(r["__words"] == 0 and r["__kept"] for r in empty)
    assert ordinal.graded(odd.limit(0), trained).count() == 0


def test_cut():
    tail = np.array([0.9, 0.8, 0.2, 0.1])
    assert 0.2 < ordinal.chosen_cut(tail, np.array([True, True, False, False])) < 0.8
    assert ordinal.chosen_cut(tail, np.ones(4, bool)) == 0.5
