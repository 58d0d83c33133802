import numpy as np
import pytest

from semestra.llm import mixing

VOCABULARY = {"en": "the and of house river", "de": "der und das haus fluss", "fr": "le et la maison fleuve"}


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = ["en", "en", "en", "de", "fr"][rng.integers(0, 5)]
        words = rng.choice(VOCABULARY[lang].split(), rng.integers(5, 60))
        if i % 10 == 0:  # half of another language
            words = [*words, *rng.choice(VOCABULARY["de"].split(), len(words))]
        rows.append((i, " ".join(words), lang))
    return rows


@pytest.fixture
def tables(spark):
    docs = spark.createDataFrame(corpus(600), "doc_id bigint, text string, lang string")
    return docs, docs.where("doc_id % 2 = 0").select("doc_id")


def test_expected_tokens_match_the_targets(tables):
    docs, labels = tables
    targets = {"en": 2.0, "de": 1.0, "fr": 1.0}
    rows = mixing.mixed(docs, labels, targets).collect()
    assert len(rows) == 600 and all(r["__rate"] >= 0 for r in rows)
    tokens = np.array([r["__tokens"] for r in rows], float)
    shares, rates = np.array([r["__shares"] for r in rows]), np.array([r["__rate"] for r in rows])
    assert np.abs(shares.sum(1) - 1).max() < 1e-9
    mixture = (tokens * rates) @ shares / tokens.sum()
    assert mixture == pytest.approx([0.5, 0.25, 0.25], abs=2e-4)
    best = np.array(["en", "de", "fr"])[shares.argmax(1)]
    pure = np.array([r.doc_id % 10 != 0 for r in rows])
    assert np.mean(best[pure] == np.array([r.lang for r in rows])[pure]) > 0.98
    copies = np.array([r["__copies"] for r in rows])
    assert np.all((copies == np.floor(rates)) | (copies == np.floor(rates) + 1))
    assert abs(copies.mean() - rates.mean()) < 0.1


def test_rates_by_plain_descent(spark):
    """The distributed fit against the same steps on arrays."""
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 50, 80)
    shares = np.round(rng.dirichlet([0.3] * 3, 80) * mixing.STEPS) / mixing.STEPS
    targets = [0.7, 0.25, 0.05]
    frame = spark.createDataFrame([(int(t), s.tolist()) for t, s in zip(tokens, shares)], "__tokens bigint, __shares array<double>")
    rates = mixing.fitted_rates(frame, targets, rounds=15, close=0)
    weight = tokens / tokens.sum()
    size = 1 / np.linalg.eigvalsh((shares * weight[:, None]).T @ shares).max()
    rate = ahead = np.ones(80)
    for n in range(15):
        new = np.maximum(0, ahead - shares @ (size * ((weight * ahead) @ shares - targets)))
        ahead, rate = new + n / (n + 3) * (new - rate), new
    got = [r.rate for r in frame.select(rates.column(frame["__shares"]).alias("rate")).collect()]
    assert got == pytest.approx(rate.tolist(), abs=1e-9)
    assert len(rates.pulls) == 15 and (rate >= 0).all()


def test_realised(tables):
    docs, labels = tables
    targets = {"en": 1.0, "de": 2.0, "fr": 1.0}
    copies = {r.doc_id: r["__copies"] for r in mixing.mixed(docs, labels, targets).collect()}
    frame = mixing.realised(docs, labels, targets)
    assert frame.columns == docs.columns
    found = [r.doc_id for r in frame.collect()]
    assert {i: found.count(i) for i in copies} == copies and max(copies.values()) > 1


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1,), (1,), (None,), (77,)], "doc_id bigint")
    rows = mixing.mixed(odd, labels, {"en": 1.0, "de": 1.0}).collect()
    assert len(rows) == odd.count()
    assert all(r["__tokens"] == 0 for r in rows if not (r.text or "").strip())
    none = mixing.mixed(odd, labels.limit(0), {"en": 3.0, "de": 1.0}).collect()
    assert all(r["__shares"] == [0.5, 0.5] for r in none)
    clash = odd.withColumnRenamed("source", "tokens").withColumnRenamed("n_chars", "shares")
    assert mixing.realised(clash, labels, {"en": 1.0}).columns == clash.columns
    assert mixing.mixed(odd.limit(0), labels, {"en": 1.0}).count() == 0


def test_rare_domains_meet_their_targets(spark):
    words, targets = [8500, 800, 690, 10], [0.60, 0.15, 0.15, 0.10]
    frame = spark.createDataFrame([(w, s.tolist()) for w, s in zip(words, np.eye(4))], "__tokens bigint, __shares array<double>")
    rates = mixing.fitted_rates(frame, targets)
    found = [r.rate for r in frame.select(rates.column(frame["__shares"]).alias("rate")).collect()]
    assert min(found) >= 0 and np.array(found) * words / sum(words) == pytest.approx(targets, abs=1.01e-4)


def test_targets_out_of_reach_are_told(spark):
    """Shares of a half each: the best rates give both domains a half of what is least wrong."""
    frame = spark.createDataFrame([(10, [0.5, 0.5]), (30, [0.5, 0.5])], "__tokens bigint, __shares array<double>")
    with pytest.warns(UserWarning, match="miss a target by 0.25"):
        rates = mixing.fitted_rates(frame, [0.75, 0.25], rounds=45)
    assert np.array(rates.totals) / 40 == pytest.approx([0.5, 0.5], abs=1e-6)
