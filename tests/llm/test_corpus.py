from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from check import TABLES, plain
from llm_fixtures import make  # noqa: F401  (fixture)
from tideline.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(v) for v in row) for row in df.select(*columns).collect())
    result = con.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert ours == Counter(tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall())


def test_stages_follow_one_another(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{number}")
        kept = spark.read.parquet(f"{folder}/{number}")
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        assert rows and all(before[r["doc_id"]] == r for r in rows), name
        if name != "source mix":
            assert len({r["doc_id"] for r in rows}) == len(rows) > 0.7 * docs.count()
        docs = kept
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).orderBy("start").collect()
    assert len(tokens) == docs.count()
    assert [t["start"] for t in tokens][1:] == [t["start"] + t["n_tokens"] for t in tokens][:-1]


def test_empty_documents_pass_every_stage(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < -1")
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF_DIR)
        assert kept.count() == 0


def test_stages_take_odd_rows(spark, folder, make):
    """Null ids and texts, repeated rows, ties and a very long text go through every stage."""
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("length(text) > 60").first()["text"]
    clean = [(k, f"word{k} " + " ".join(f"w{k}_{j}" for j in range(40))) for k in range(30)]
    rows = [*clean, clean[3], clean[3], (None, "no id " + " ".join(f"n{j}" for j in range(30))), (None, None), (50, None), (51, ""), (52, "x " + item + " y"), (53, "long " * 60_000)]
    rows += [(60, clean[5][1]), (5, " ".join(f"other{j}" for j in range(40)))]  # a copy, and an id with two texts
    docs = make(rows)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        texts = [r["text"] for r in docs.collect()]
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name == "near duplicates":
            assert Counter(texts)[clean[3][1]] == Counter(texts)[clean[5][1]] == 1
            assert sum(t.startswith("other") for t in texts if t) == 1
        if name == "benchmark decontamination":
            assert not any(item in (t or "") for t in texts)
        assert {t for _, t in clean} <= set(texts), name
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert len(tokens) == docs.count()
    assert sorted(t["start"] for t in tokens)[0] == 0 and sum(t["n_tokens"] for t in tokens) == max(t["start"] + t["n_tokens"] for t in tokens)
