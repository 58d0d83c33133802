import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from semestra.llm import rans
from semestra.llm.storage import new_path


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 300_000])
def test_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.uint32)
    table = rans.table_of(rans.quantised(np.bincount(ids, minlength=49_408)))
    coded = rans.encode(ids, table)
    assert (rans.decode(n, coded, table) == ids).all()
    span = rans.STEPS * rans.LANES
    assert len(coded.places) == -(-n // span)
    for k in range(len(coded.places)):
        assert (rans.decode(n, coded, table, k, k + 1) == ids[k * span : (k + 1) * span]).all()
    if n == 300_000:
        share = np.bincount(ids) / n
        entropy = -(share[share > 0] * np.log2(share[share > 0])).sum() * n / 8
        assert len(coded.words) < 1.01 * entropy + 8 * rans.LANES


def test_one_symbol_and_many():
    only = np.full(5000, 7, np.uint32)
    table = rans.table_of(rans.quantised(np.bincount(only)))
    assert table.frequencies[7] == 1 << rans.TABLE_BITS
    assert (rans.decode(5000, rans.encode(only, table), table) == only).all()
    counts = np.ones(70_000, np.int64)
    counts[3] = 10**12
    assert rans.quantised(counts).sum() == 1 << rans.TABLE_BITS and rans.quantised(counts).min() == 1
    with pytest.raises(ValueError):
        rans.quantised(np.ones((1 << rans.TABLE_BITS) + 1, np.int64))


@pytest.fixture(scope="module")
def definition():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


TRICKY = [
    "", " ", "Hello, World!!", "it's we'll 'tis", "ab%%% cd*** &&& x.y,z", "İstanbul ΣΑΣ ς", "é à,", "\x1c\x1d a\x1eb",
    "<|startoftext|> a<|endoftext|>b", "non breaking space", "123abc 4.5 x1!", "Ünïté, ÉCOLE!! straße… ǅ ŉ ﬀ ª ñandú; Ǆungla *** %%%", "日本語。テスト", "ﬁ ½ ①", "A.\nB\tC\x0bD",
]


def test_words_as_the_library(definition):
    library = Tokenizer.from_str(definition)
    coder = rans.WordTokens(definition)
    for texts in (TRICKY, TRICKY[::-1]):
        found = coder.encode([t.encode() for t in texts], 2)
        for text, data in zip(texts, found):
            assert np.frombuffer(data, "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_words_are_remembered_once(definition):
    library = Tokenizer.from_str(definition)
    coder = rans.WordTokens(definition)
    texts = ["plain Plain PLAIN, plain. école École!", "École plain, Other"]
    found = coder.encode([t.encode() for t in texts], 2)
    for text, data in zip(texts, found):
        assert np.frombuffer(data, "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
    assert {b"plain", b"Plain", b"PLAIN,", b"other"} <= set(coder)
    # Apart from the words there are only marks and words in other letters
    assert set(coder.parts) == {b",", b".", b"!", "école".encode()}


def expected(rows, library):
    """Rows in file order, with what a reader should find."""
    coded = [(k, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for k, t in rows]
    out, start = [], 0
    order = lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes())
    for key, ids in sorted(coded, key=order):
        out.append((str(key), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out)


def test_file(spark, odd, definition):
    path = new_path(spark, "rans")
    rans.write(odd.withColumnRenamed("lang", "ids"), path, definition, 2, block=2000)
    got = rans.read(spark, path, "n_tokens bigint, crc bigint", lambda ids: (len(ids), rans.checksum(ids)))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.crc) for r in got.collect()) == expected(rows, Tokenizer.from_str(definition))
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    assert len(blocks) > 2 and sum(b.n_ids for b in blocks) == sum(b.n_tokens for b in got.collect())


def test_long_documents_are_decoded_in_spans(spark, definition):
    """A document of many checkpoints, between short ones, through rows of one checkpoint each."""
    texts = {1: "a few words", 2: "one two, three. four " * 60_000, 3: None, 4: "the last"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    path = new_path(spark, "rans")
    rans.write(docs, path, definition, 2, block=100_000)
    blocks = spark.read.parquet(f"{path}/blocks")
    span = rans.STEPS * rans.LANES
    longest = blocks.orderBy("n_ids", ascending=False).first()
    assert longest.n_ids > 4 * span and len(longest.places) == -(-longest.n_ids // span)
    cut = rans.spans(blocks.where(f"n_ids = {longest.n_ids}"), 1).collect()
    assert [row.first for row in cut] == list(range(len(longest.places)))
    assert sum(row.n_ids for row in cut) == longest.n_ids and max(row.n_ids for row in cut) == span
    assert b"".join(row.words for row in cut) == longest.words and b"".join(row.states for row in cut) == longest.states
    wanted = expected(list(texts.items()), Tokenizer.from_str(definition))
    for size in (1, 3, rans.SPAN):
        got = rans.read(spark, path, "n_tokens bigint, crc bigint", lambda ids: (len(ids), rans.checksum(ids)), size)
        assert sorted((str(r.doc_id), r.start, r.n_tokens, r.crc) for r in got.collect()) == wanted


def test_a_block_of_usual_size_has_eight_checkpoints():
    assert rans.BLOCK == 8 * rans.STEPS * rans.LANES


def test_damage_is_noticed(spark, odd, definition):
    path, other = new_path(spark, "rans"), new_path(spark, "rans")
    rans.write(odd, path, definition, 2)
    spark.read.parquet(f"{path}/blocks").selectExpr(
        "part", "block", "start", "n_ids", "doc_ids", "lengths", "crc32 + 1 AS crc32", "words", "states", "places"
    ).write.parquet(f"{other}/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{other}/table")
    with pytest.raises(Exception, match="damaged"):
        rans.read(spark, other, "n bigint", lambda ids: (len(ids),)).collect()


def test_empty_table(spark, odd, definition):
    path = new_path(spark, "rans")
    rans.write(odd.limit(0), path, definition, 2)
    assert rans.read(spark, path, "n bigint", lambda ids: (len(ids),)).count() == 0


def test_blocks_are_read_a_few_at_a_time(spark, odd, definition, monkeypatch):
    """When they are coded and when they are read back; the settings of the session stay."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before, seen, kept = [spark.conf.get(name) for name in names], {}, rans.stored

    def stored(frame, label):
        seen[label] = [int(spark.conf.get(name)) for name in names]
        return kept(frame, label)

    monkeypatch.setattr(rans, "stored", stored)
    path = new_path(spark, "rans")
    rans.write(odd, path, definition, 2, block=2000)
    rans.read(spark, path, "n bigint", lambda ids: (len(ids),))
    assert seen["documents"] == [8, 8] and max(seen["blocks"]) <= 1000
    assert [spark.conf.get(name) for name in names] == before
