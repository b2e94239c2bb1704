from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture()
def make(spark):
    """Documents from (doc_id, text[, lang, source]) rows."""

    def build(rows, *extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return build


@pytest.fixture()
def scratch(folder):
    return f"file://{folder}/scratch"
