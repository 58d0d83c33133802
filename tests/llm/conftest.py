from __future__ import annotations

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def documents(spark):
    """Documents from texts or (id, text) pairs."""
    def make(texts):
        pairs = [x if isinstance(x, tuple) else (n, x) for n, x in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs], DOCS
        )
    return make


@pytest.fixture
def odd(documents):
    """Null and empty values, repeated rows and keys, ties and a long text."""
    long_text = " ".join(f"word{n % 977} of.\nline {n % 53}" for n in range(20_000))
    return documents([
        (1, "One line\nanother line\nOne line"), (1, "One line\nanother line\nOne line"), (1, "other text of the same id"),
        (2, None), (3, ""), (None, "no id at all"), (None, None), (4, "  \n\t\n "), (5, long_text), (6, long_text + " end"),
        (7, "a"), (8, "a"), (9, "\x00\x01 ▁ é 日本 😀 <|endoftext|>"), (-3, "x y z"),
    ])
