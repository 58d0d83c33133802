import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from semestra.llm import registry, text as texts, toxicity as tx

PLAIN = ["river", "stone", "cloud", "meadow", "candle", "window", "garden", "silver", "paper", "winter"]


def corpus(n, seed=0):
    """Half of the texts hold one rude word, or two words that are rude together."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [PLAIN[k] + str(rng.integers(0, 40)) for k in rng.integers(0, len(PLAIN), 30)]
        at, kind = int(rng.integers(1, 28)), i % 4
        if kind == 0:
            words[at] = "Idiot" + str(rng.integers(0, 1000))
        if kind == 1:
            words[at : at + 2] = ["foul", "mouth"]
        if kind == 2:
            words[at], words[at - 1] = "foul", "mouth"
        rows.append((i, " ".join(words), int(kind < 2), "de" if i % 3 else "en"))
    return rows


def sample_of(rows):
    parts, firsts = tx.word_parts(*texts.text_bytes(pa.array([r[1] for r in rows])))
    return tx.Sample(parts, firsts, np.array([r[2] for r in rows]), np.array([r[3] for r in rows], object))


@pytest.fixture(scope="module")
def net():
    return tx.fitted(sample_of(corpus(1600)))


def test_learns_words_by_their_start_and_pairs_by_their_order(net):
    held = sample_of(corpus(400, seed=1))
    told = tx.logits(net, held.parts, held.firsts) > 0
    assert (told == (held.labels == 1)).mean() > 0.95


def test_parts_of_words():
    parts, firsts = tx.word_parts(*texts.text_bytes(pa.array(["Ab, ab! abcdefghi abcdefghj", None, "", "été ab"])))
    assert firsts.tolist() == [0, 4, 4, 4, 6]
    assert (parts[0] == parts[1]).all() and (parts[1] == parts[5]).all()
    assert parts[2][0] != parts[3][0] and (parts[2][1:] == parts[3][1:]).all()
    # A word is not the start of a longer one
    short, _ = tx.word_parts(*texts.text_bytes(pa.array(["abcd abcde"])))
    assert short[0][1] != short[1][1]


def test_slices_do_not_change_parts(monkeypatch):
    data = texts.text_bytes(pa.array(["some words here", "x" * 60, None, "more of them, at last"]))
    whole = tx.word_parts(*data)
    for size in (1, 5, 17):
        cuts = tx._cuts
        monkeypatch.setattr(tx, "_cuts", lambda d, size=size, cuts=cuts: cuts(d, size))
        pieces = tx.word_parts(*data)
        monkeypatch.setattr(tx, "_cuts", cuts)
        assert (pieces[0] == whole[0]).all() and (pieces[1] == whole[1]).all()


def brute_answers(net, parts):
    """The two greatest answers of every filter over the words of one row, and nothing behind."""
    words = np.concatenate((net.embedding[parts].sum(1), np.zeros((6, tx.SIZE), np.float32)))
    places = len(parts) + tx.TOPS
    columns = []
    for taps, shift in zip(net.filters, net.shifts):
        answers = np.array([sum(words[i + j] @ taps[j] for j in range(len(taps))) + shift for i in range(places)])
        columns.append(-np.sort(-answers, 0)[: tx.TOPS])
    return np.concatenate(columns, 1)


@pytest.mark.parametrize("block", [1, 7, 1 << 15])
def test_answers_against_brute_force(net, monkeypatch, block):
    monkeypatch.setattr(tx, "BLOCK", block)
    held = sample_of(corpus(12, seed=2) + [(0, "", 0, None), (0, "foul", 0, None), (0, "mouth mouth foul", 0, None)])
    best = tx.pooled(net, held.parts, held.firsts)[0]
    for row in range(len(held.labels)):
        expected = brute_answers(net, held.parts[held.firsts[row] : held.firsts[row + 1]])
        assert np.allclose(best[row], expected, atol=1e-5)


def test_slopes(net):
    """Against differences of the loss for small changes of single numbers."""
    sample = sample_of(corpus(16, seed=3))
    # Larger numbers, so that differences are well above rounding
    net = net._replace(**{n: tuple(a.astype(np.float64) for a in getattr(net, n)) for n in ("filters", "shifts")})
    by_array, by_bias, buckets, change = tx.slopes(net, sample)

    def loss(**changed):
        p = tx.logistic(tx.logits(net._replace(**changed), sample.parts, sample.firsts))
        return -np.log(np.where(sample.labels == 1, p, 1 - p)).mean()

    def difference(array, place, put):
        sides = []
        for step in (1e-2, -1e-2):
            moved = array.copy()
            moved[place] += step
            sides.append(loss(**put(moved)))
        return (sides[0] - sides[1]) / 2e-2

    assert np.isclose((loss(bias=net.bias + 1e-3) - loss(bias=net.bias - 1e-3)) / 2e-3, by_bias, atol=1e-4)
    told, expected = [], []
    for n in range(len(tx.WIDTHS)):
        for place in [(0, 1, 2), (n, 5, 7)]:
            put = lambda moved, n=n: {"filters": (*net.filters[:n], moved, *net.filters[n + 1 :])}
            told.append(by_array[n][place])
            expected.append(difference(net.filters[n], place, put))
        put = lambda moved, n=n: {"shifts": (*net.shifts[:n], moved, *net.shifts[n + 1 :])}
        told.append(by_array[len(tx.WIDTHS) + n][3])
        expected.append(difference(net.shifts[n], 3, put))
    told.append(by_array[-1][1, 4])
    expected.append(difference(net.output, (1, 4), lambda moved: {"output": moved}))
    for row in np.argsort(-np.abs(change).sum(1))[:5]:
        told.append(change[row, 2])
        expected.append(difference(net.embedding, (buckets[row], 2), lambda moved: {"embedding": moved}))
    assert np.allclose(told, expected, atol=2e-3, rtol=0.1)
    assert np.abs(expected).max() > 5e-3


def test_thresholds_by_language(net):
    rows = corpus(300, seed=4)
    held = sample_of([r[:3] + ((r[3],) if i % 50 else ("xx",)) for i, r in enumerate(rows)])
    made = tx.calibrated(net, held, np.ones(len(held.labels)))
    # Too few ratings of one language, so it has the common threshold
    assert [n for n, _ in made.thresholds] == [None, "de", "en"]
    chances = made.probabilities(tx.logits(made, held.parts, held.firsts))
    assert abs(chances.mean() - held.labels.mean()) < 0.05


def test_held_out_accuracy_on_documents(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    frame = registry.QUERIES["op11_toxicity"](spark, sf)
    labels = tx.rated(spark.read.parquet(f"{sf}/labels.parquet"))
    rows = frame.where("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r.score for r in rows if r.label == 1], [r.score for r in rows if r.label == 0]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean(np.array(toxic) >= 0.5) > 0.85 and np.mean(np.array(clean) >= 0.5) < 0.01
    assert np.mean(np.array(toxic)[:, None] > np.array(clean)) > 0.95


def test_sample_is_bounded_and_leaves_long_texts_out(spark, documents):
    rows = corpus(400)
    docs = documents([(i, t + " long" * (2000 * (i == 7))) for i, t, _, _ in rows])
    labels = spark.createDataFrame([(i, v) for i, _, v, _ in rows], "doc_id bigint, toxic int")
    sample, weights = tx.labelled_sample(docs, tx.rated(labels), "doc_id", "text", "lang", (50, 20), 1000)
    assert np.bincount(sample.labels).tolist() == [50, 20]
    assert weights[sample.labels == 1].tolist() == [10.0] * 20 and np.diff(sample.firsts).max() < 40


def test_odd_rows(spark, odd):
    rows = corpus(200)
    docs = spark.createDataFrame([(i, t, g) for i, t, _, g in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, v) for i, _, v, _ in rows] + [(3, 1), (None, 1), (9999, 0), (5, None)], "doc_id bigint, toxic int")
    model = tx.train(docs, tx.rated(labels))
    out = tx.scored(odd.withColumn("__score", F.lit(5)).withColumn("__cut", F.lit("mine")), model).collect()
    assert len(out) == odd.count() and all(0 <= r["__score"] <= 1 and r["__cut"] == "mine" for r in out)
    assert len({r["__score"] for r in out if not (r.text or "").strip()}) == 1
    by_text = {}
    for r in out:
        by_text.setdefault(r.text, set()).add(r["__score"])
    assert all(len(v) == 1 for v in by_text.values())
    assert tx.scored(odd.limit(0), model).collect() == []
    assert tx.scored(docs.select("text"), model, language=None).count() == 200


def test_without_one_of_the_labels(spark, odd):
    labels = spark.createDataFrame([(1, 0), (3, 0)], "doc_id bigint, toxic int")
    assert tx.train(odd, tx.rated(labels)) is None
    assert tx.train(odd.limit(0), tx.rated(labels.limit(0))) is None
    assert {r["__score"] for r in tx.scored(odd, None).collect()} == {0.0}


def test_all_rated_rows_are_learnt_from(spark, documents, monkeypatch):
    """A word of long texts alone, which the sample leaves out, is known after the tasks' pass."""
    monkeypatch.setattr(tx, "PART_ROWS", 512)
    rng = np.random.default_rng(5)
    rude, long = ["nasty", "vulgar", "", ""], " long" * 300
    rows = [(i, " ".join([f"{w}{rng.integers(40)}" for w in PLAIN] * 3 + [rude[i % 4]]) + long * (i % 2), int(i % 4 < 2)) for i in range(1600)]
    labels = spark.createDataFrame([(i, v) for i, _, v in rows], "doc_id bigint, toxic int")
    docs = documents([(i, t) for i, t, _ in rows])
    model = tx.train(docs, tx.rated(labels), most_bytes=1000)
    asked = documents([(0, f"river1 stone2 vulgar cloud4{long}"), (1, f"river1 stone2 unheard cloud4{long}")])
    chances = [r["__score"] for r in tx.scored(asked, model).orderBy("doc_id").collect()]
    assert chances[0] > chances[1] + 0.05


def test_changes_come_back_to_their_places(net):
    rng = np.random.default_rng(0)
    other = tx.fitted(sample_of(corpus(200, seed=9)), rounds=1)
    moved = other.embedding - net.embedding
    dense = tx._dense(other) - tx._dense(net)
    places = rng.permutation(np.arange(len(moved) + len(dense)))
    found = tx._moved(net, places, np.concatenate((moved, dense))[places])
    for a, b in zip(found[:4], other[:4]):
        assert all(np.allclose(x, y, atol=1e-5) for x, y in zip(a, b))
    assert np.isclose(found.bias, other.bias)


def test_rated_rows_in_slices(spark, documents, monkeypatch):
    rows = corpus(60)
    docs = documents([(i, t) for i, t, _, _ in rows + rows[:5]])
    labels = spark.createDataFrame([(i, v) for i, _, v, _ in rows[:40]] + [(9999, 1)], "doc_id bigint, toxic int")
    found = []
    for sent in (1 << 20, 7):
        monkeypatch.setattr(tx, "SENT", sent)
        found.append(sorted((r.place, r.label, r.text) for r in tx.rated_rows(docs, tx.rated(labels), "doc_id", "text", "lang").collect()))
    assert len(found[0]) == 45 and found[0] == found[1]
    assert sorted((v, t) for _, v, t in found[0]) == sorted((v, t) for _, t, v, _ in rows[:40] + rows[:5])
