"""The registered queries and the pipeline, stage by stage, over a small table."""

import os
from glob import glob

import duckdb
import pytest
import sentencepiece
from conftest import SF
from test_lines import brute as brute_lines
from test_simhash import brute_fingerprint, brute_groups

import corpus_pipeline
from check import _rows
from semestra.llm import mixing, ordinal, registry

COLUMNS = {
    "op1_mixing": ["doc_id", "n_words", "share_en", "share_de", "share_fr", "share_es", "rate", "copies"],
    "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_likelihood": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"],
    "op4_rans": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_lines": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op6_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "chances"],
    "op7_ordinal": ["doc_id", "n_words", "expected_grade", "tail_probability", "kept"],
    "op8_merge_dropout": ["doc_id", "n_pieces", "ids_sha256", "decoded_sha256"],
    "op9_syncmers": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_suffixes": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op11_toxicity": ["doc_id", "held_out", "score", "predicted", "flagged"],
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", COLUMNS)
def test_query_returns_every_document(spark, docs, name):
    frame = registry.QUERIES[name](spark, SF)
    assert frame.columns == COLUMNS[name]
    found = sorted(r.doc_id for r in frame.select("doc_id").collect())
    assert found == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_queries_with_sql(spark):
    db = duckdb.connect()
    for path in glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    for name, sql in registry.ORACLES.items():
        frame = registry.QUERIES[name](spark, SF)
        result = db.execute(sql)
        assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) == _rows([d[0] for d in result.description], result.fetchall())


def test_stages(spark, docs):
    """Every stage against a plain version of it on what the stage before kept."""
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "simhash near-dedup", "mixing to target weights", "sentencepiece encoding",
    ]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = held.collect()
        made = stage(spark, held, SF)
        after = made.collect()
        if number < 4:
            assert made.columns == docs.columns
        if number == 0:
            model = ordinal.train(held, ordinal.ratings(labels))
            kept = {r.doc_id for r in ordinal.graded(held, model).collect() if r["__kept"]}
            assert sorted(map(str, after)) == sorted(str(r) for r in before if r.doc_id in kept)
        if number == 1:
            expected = brute_lines([(r.doc_id, r.text) for r in before], corpus_pipeline.COMMON_LINE)
            assert sorted((str(r.doc_id), r.text) for r in after) == [(k, t) for k, _, _, t in expected]
            assert all(r.n_chars == len(r.text) for r in after)
        if number == 2:
            order = sorted(before, key=lambda r: r.doc_id)
            groups = brute_groups([brute_fingerprint(r.text) for r in order], corpus_pipeline.DISTANCE)
            assert sorted(map(str, after)) == sorted(str(r) for n, r in enumerate(order) if groups[n] == n)
        if number == 3:
            copies = {r.doc_id: r["__copies"] for r in mixing.mixed(held, labels, corpus_pipeline.TARGETS).collect()}
            found = [r.doc_id for r in after]
            assert {i: found.count(i) for i in copies} == copies
        if number == 4:
            library = sentencepiece.SentencePieceProcessor(model_proto=corpus_pipeline.model_bytes())
            texts = {r.doc_id: r.text for r in before}
            assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
            assert all(library.decode(list(r.ids)) == texts[r.doc_id] for r in after if not texts[r.doc_id].startswith(" "))
        held = spark.createDataFrame(after, made.schema)


def test_run(spark):
    frame = corpus_pipeline.run(spark, SF)
    assert frame.columns == ["doc_id", "ids"] and frame.count() > 50
