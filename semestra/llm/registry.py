"""One query for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from semestra.llm import (
    conversations, likelihood, lines, merges, mixing, ordinal, ranking, rans, secrets, settings, simhash, suffixes, syncmers,
    toxicity,
)
from semestra.llm.storage import new_path


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents for a mixture of languages."""
    targets = settings.TARGETS
    out = mixing.mixed(
        _table(spark, sf_dir), _table(spark, sf_dir, "labels"), targets, keep=["doc_id"]
    )
    shares = [F.col("__shares")[i].alias(f"share_{name}") for i, name in enumerate(targets)]
    return out.select(
        "doc_id", F.col("__tokens").alias("n_words"), *shares,
        F.col("__rate").alias("rate"), F.col("__copies").alias("copies"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(
        _table(spark, sf_dir), settings.SHINGLE, settings.DISTANCE
    )


def op3_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good documents by their labels are trusted, those of low quality are bad."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    labels = _table(spark, sf_dir, "labels").select(
        "doc_id", F.when(good, True).when(F.col("quality") == 0, False).alias("trusted")
    )
    return likelihood.judged(_table(spark, sf_dir).select("doc_id", "text"), labels)


def op4_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in coded blocks and read back."""
    path = new_path(spark, "rans")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    rans.write(_table(spark, sf_dir).select("doc_id", "text"), path, definition, end=2)
    return rans.read(
        spark, path, "n_tokens bigint, ids_crc32 bigint", lambda ids: (len(ids), rans.checksum(ids))
    )


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir).select("doc_id", "text")
    kept = lines.deduplicated(docs, min_docs=settings.COMMON_LINE, min_chars=1)
    return kept.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scanned(_table(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "chances"
    )


def op7_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir).select("doc_id", "text")
    model = ordinal.train(docs, ordinal.ratings(_table(spark, sf_dir, "labels")))
    return ordinal.graded(docs, model).select(
        "doc_id", F.col("__words").alias("n_words"), F.col("__grade").alias("expected_grade"),
        F.col("__tail").alias("tail_probability"), F.col("__kept").alias("kept"),
    )


def _coded_digests(proto):
    """Digests of ids and of the text they decode to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = merges.model_of(proto.value)
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.values.to_numpy().astype("<i4"), ids.offsets.to_numpy()
            rows = [flat[a:b] for a, b in zip(ends, ends[1:])]
            columns = [
                [len(row) for row in rows], [hashlib.sha256(row.tobytes()).hexdigest() for row in rows],
                [hashlib.sha256(coder.decode(row.tolist()).encode()).hexdigest() for row in rows],
            ]
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns, kinds)],
                ["doc_id", "n_pieces", "ids_sha256", "decoded_sha256"],
            )

    return run


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text with dropout, decoded again; both told as digests."""
    model = settings.model_bytes()
    docs = _table(spark, sf_dir).select("doc_id", "text")
    coded = merges.encoded(docs, model, settings.DROPOUT, settings.SEED)
    return coded.mapInArrow(
        _coded_digests(spark.sparkContext.broadcast(model)),
        "doc_id bigint, n_pieces bigint, ids_sha256 string, decoded_sha256 string",
    )


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = syncmers.edited(_table(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        syncmers.whole_fingerprint(F.col("hashes")).alias("fingerprint"),
        syncmers.whole_fingerprint(F.col("edited_hashes")).alias("edited_fingerprint"),
        F.col("all_edited").alias("near_edited"), F.col("all_next").alias("near_next"),
    )


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_repeats(_table(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model learns from four fifths of the rated documents; the others are held out."""
    docs, held = _table(spark, sf_dir).select("doc_id", "text", "lang"), toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs, toxicity.rated(_table(spark, sf_dir, "labels")).where(~held))
    return toxicity.scored(docs, model).select(
        "doc_id", held.alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"), F.col("__flagged").alias("flagged"),
    )


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return ranking.ranked(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"), top=50)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repairs(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_simhash": op2_simhash,
    "op3_likelihood": op3_likelihood,
    "op4_rans": op4_rans,
    "op5_lines": op5_lines,
    "op6_secrets": op6_secrets,
    "op7_ordinal": op7_ordinal,
    "op8_merge_dropout": op8_merge_dropout,
    "op9_syncmers": op9_syncmers,
    "op10_suffixes": op10_suffixes,
    "op11_toxicity": op11_toxicity,
    "op12_ranking": op12_ranking,
    "op13_conversations": op13_conversations,
    "pipeline": corpus_pipeline.run,
}
_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

_OP5 = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
    SELECT row, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM texts
),
keyed AS (
    SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
kept AS (
    SELECT row, count(*) AS n_lines, count(common.key) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
    FROM keyed LEFT JOIN common ON keyed.key = common.key GROUP BY row
)
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM texts JOIN kept USING (row)
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP12 = f"""
WITH words AS (SELECT row, doc_id, unnest({_TERMS}) AS term FROM (SELECT *, row_number() OVER () AS row FROM documents)),
counts AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY row),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, total GROUP BY term
),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
scores AS (
    SELECT item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (row), total GROUP BY ALL
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES = {"op5_lines": _OP5, "op12_ranking": _OP12}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
