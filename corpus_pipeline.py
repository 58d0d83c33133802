"""The stages a corpus goes through, from raw documents to token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from semestra.llm import lines, merges, mixing, ordinal, simhash
from semestra.llm.settings import COMMON_LINE, DISTANCE, DROPOUT, SEED, SHINGLE, TARGETS, model_bytes
from semestra.llm.storage import new_path

def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted chance of a good grade reaches the model's cut."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ordinal.train(docs, ordinal.ratings(labels))
    return ordinal.graded(docs, model).where("__kept").select(docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many documents share; n_chars follows the text."""
    return lines.deduplicated(docs, min_docs=COMMON_LINE).selectExpr(
        *["CAST(char_length(text) AS bigint) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one of least id."""
    return simhash.one_of_each(docs, SHINGLE, DISTANCE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of languages wants them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.realised(docs, labels, TARGETS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and ids: the piece ids of every text, with seeded merge-dropout of its own for each copy."""
    numbered = mixing.numbered(docs.select("doc_id", "text"), "copy")
    return merges.encoded(numbered, model_bytes(), DROPOUT, SEED, copy="copy")


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_common_lines),
    ("simhash near-dedup", drop_near_copies),
    ("mixing to target weights", mix),
    ("sentencepiece encoding", encode),
]

#: A fitted classifier and seeded hashes can't be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
