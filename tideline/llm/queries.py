"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import chats, decontamination, hard_negatives, language, mixing, near_duplicates, prefix_tokens, quality, secrets, substrings, token_files, toxicity, whitening
from tideline.llm.folds import held_out
from tideline.llm.words import documents
from tideline.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 2048
END_ID = 2


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


@query("op1_prefix_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prefix_tokens.with_prefix_tokens(documents(spark, sf_dir, "doc_id", "text"), vocabulary(TOKENIZER))
    prefix = F.col("prefix_tokens")
    n = prefix_tokens.tokens_of(prefix)
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        n.alias("n_tokens"),
        (n > TOKEN_LIMIT).alias("over_limit"),
        prefix_tokens.fitting_characters(prefix, TOKEN_LIMIT).alias("fitting_chars"),
    )


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir, "doc_id", "text"), folder, vocabulary(TOKENIZER), END_ID)
    return token_files.read_checksums(spark, folder)


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_toxicity(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.Settings().threshold).cast("int").alias("predicted"),
    )


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    ratios = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.with_quality(docs, ratios).drop("text")


@query("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    pieces = vocabulary(PIECES)
    model = language.train(docs, pieces, shared_folder(spark, "language-words"))
    predicted = language.with_language(docs.select("doc_id", "text"), model, pieces)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op7_source_mix", mixing.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decisions(documents(spark, sf_dir, "doc_id", "text", "source"), shared_folder(spark, "mix"))


@query("op8_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), shared_folder(spark, "near-duplicates"))
    return found.drop("_group")


@query("op4_benchmark_matches")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    found = decontamination.with_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where(F.size("matches") > 0)
    shown = F.transform("matches", lambda m: F.concat(m["item_id"], F.lit(":"), m["distance"].cast("string")))
    return found.select("doc_id", F.array_join(shown, ",").alias("items_and_distances"))


@query("op3_secrets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir, "doc_id", "text"), shared_folder(spark, "secrets"))


@query("op5_chat_format", chats.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"), shared_folder(spark, "chats"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), shared_folder(spark, "whitening"))


@query("op12_hard_negatives", hard_negatives.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), shared_folder(spark, "hard-negatives"))


@query("op11_substring_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(documents(spark, sf_dir, "doc_id", "text"), shared_folder(spark, "substrings"))
    return found.drop("spans")
