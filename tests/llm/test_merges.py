import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from semestra.llm import merges, mixing

TEXTS = [
    "", " ", "  two  spaces ", "The river and the house.\nAnother\n\n line\t", "naïve Ünïcode 日本語 😀", "▁", "a▁b ▁ c", "\x00▁",
    "\x00", "<s> <0x41> </s>", "password=abcdef0123456789", "x" * 300, "thnting ndere onhaes thingre " * 40,
]


@pytest.fixture(scope="module")
def proto():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def model(proto):
    return merges.MergeModel(proto)


def test_without_dropout_as_the_library(proto, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    for text in TEXTS:
        if merges.SPACE not in text:
            assert model.encode(text).tolist() == library.encode(text)


def plain_merges(model, word, dropout, key):
    """Merge-dropout by looking over all pairs again after every merge."""
    import xxhash

    parts = [(i, c) for i, c in enumerate(word)]
    skipped = set()
    while True:
        pairs = [
            (-model.scores[model.ids[a[1] + b[1]]], a[0], b[0], a[1] + b[1])
            for a, b in zip(parts, parts[1:]) if a[1] + b[1] in model.ids
        ]
        pairs = [p for p in pairs if p not in skipped]
        if not pairs:
            break
        best = min(pairs)
        _, left, right, joined = best
        if dropout and merges.draw(xxhash.xxh64_intdigest(word, key), left, right, len(joined)) < int(dropout * 2**64):
            skipped.add(best)
            continue
        n = next(i for i, p in enumerate(parts) if p[0] == left)
        parts[n : n + 2] = [(left, joined)]
    return [i for _, p in parts for i in ([model.ids[p]] if p in model.ids else [model.bytes[b] for b in p.encode()])]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_agenda_against_plain_merges(model, dropout):
    for word in ["▁internationalisation", "▁thndere", "▁▁▁x", "\n", "▁日本語é", "▁aaaaaaaaaaaa"]:
        for key in range(5):
            assert model.merged(word, dropout, key) == plain_merges(model, word, dropout, key)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.9])
def test_round_trip(model, dropout):
    for text in TEXTS:
        ids = model.encode(text, dropout, 3, "k")
        assert model.decode(ids.tolist()) == text


def test_seeds_and_keys_vary(model):
    text = TEXTS[-1]
    one = model.encode(text, 0.3, 1, "a").tolist()
    assert one == model.encode(text, 0.3, 1, "a").tolist()
    assert one != model.encode(text, 0.3, 2, "a").tolist()
    assert one != model.encode(text, 0.3, 1, "b").tolist()
    assert len(one) > len(model.encode(text))


def test_memory_is_bounded(model, monkeypatch):
    monkeypatch.setattr(merges, "REMEMBERED", 20)
    fresh = merges.MergeModel.__new__(merges.MergeModel)
    fresh.__dict__ = {**model.__dict__, "memory": {}}
    text = " ".join(f"w{n % 90}" for n in range(500))
    assert fresh.decode(fresh.encode(text, 0.2, 1, "k").tolist()) == text
    assert all(len(m.young) <= 20 and len(m.older) <= 20 for m in fresh.memory[0.2, 1])


def test_rows(proto, odd):
    coded = merges.encoded(odd, proto, 0.2, 9)
    rows = sorted((str(r.doc_id), r.text) for r in merges.decoded(coded, proto).collect())
    assert rows == sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    again = merges.encoded(odd.repartition(5), proto, 0.2, 9)
    assert sorted(map(str, coded.collect())) == sorted(map(str, again.collect()))
    assert merges.encoded(odd.limit(0), proto).count() == 0


def test_draws_are_even():
    draws = [merges.draw(b * 0x9E3779B97F4A7C15 % 2**64, i, i + 1, n) / 2**64 for b in range(20) for i in range(30) for n in range(2, 8)]
    assert len(set(draws)) == len(draws)
    assert all(abs(sum(x < t for x in draws) / len(draws) - t) < 0.03 for t in (0.1, 0.5, 0.9))


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_many_words_as_one_by_one(model, dropout):
    words = ["▁internationalisation", "▁thndere", "▁▁▁x", "\n", "▁日本語é", "▁aaaaaaaaaaaa", "▁😀x", "a", "▁the", "▁river"] * 30
    bases = np.random.default_rng(1).integers(0, 2**64, len(words), np.uint64)
    limit = int(dropout * 2**64)
    got = model.merged_together(words, limit, bases)
    found = [got.ids[a : a + n].tolist() for a, n in zip(got.first_id, got.sizes)]
    assert found == [model.agenda(w, limit, int(b)) for w, b in zip(words, bases)]


def test_every_occurrence_has_draws_of_its_own(model):
    """One word at 400 places: it varies as often, and in as many ways, as its agenda does."""
    word, size = "▁international", 400
    text = " ".join(["international"] * size)
    plain = model.agenda(word, 0, 0)
    seen = {}
    for key in "abcdef":
        ids = model.encode(text, 0.1, 3, key).tolist()
        ends = [n for n, i in enumerate(ids) if model.pieces[i].startswith("▁")] + [len(ids)]
        for a, b in zip(ends, ends[1:]):
            seen[tuple(ids[a:b])] = seen.get(tuple(ids[a:b]), 0) + 1
    rng = np.random.default_rng(4)
    free = [model.agenda(word, int(0.1 * 2**64), int(b)) for b in rng.integers(0, 2**64, 4000, np.uint64)]
    assert len(seen) > 5 and sum(seen.values()) == 6 * size
    assert abs(seen[tuple(plain)] / (6 * size) - sum(x == plain for x in free) / 4000) < 0.05


def test_copies_differ(spark, proto, documents):
    docs = documents([(1, "thnting ndere onhaes thingre " * 20)] * 3)
    ids = [tuple(r.ids) for r in merges.encoded(mixing.numbered(docs, "n"), proto, 0.1, 20, copy="n").collect()]
    assert len(set(ids)) == 3
    assert len({tuple(r.ids) for r in corpus_pipeline.encode(spark, docs, "").collect()}) == 3
    assert len({tuple(r.ids) for r in merges.encoded(docs, proto, 0.1, 20).collect()}) == 1
