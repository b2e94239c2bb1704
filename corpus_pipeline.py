"""A corpus from raw documents to token files, in five stages.

Each stage takes the documents that the one before kept, and all but the last return the columns of
`documents`. Between stages, documents are written as Parquet on shared storage and read again, so a
lost executor costs no earlier stage.
"""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontamination, mixing, near_duplicates, token_files, toxicity
from tideline.llm.queries import END_ID, TOKENIZER
from tideline.session import shared_folder


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold.

    Null, empty and wordless texts score like the share of toxic documents in the training sample; rows without id are scored and never trained on;
    repeated rows get equal scores and stay together or go together. Without labels nothing is toxic.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_toxicity(docs, model)
    return scored.where(F.col("toxicity") < toxicity.Settings().threshold).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    The one with the smallest id stays, before those without an id; of rows with equal id and text, one. Equal ids alone link nothing. Texts without a word all stay.
    """
    return near_duplicates.one_of_each(docs, shared_folder(spark, "distinct"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain none and stay, repeated rows stay together; very long texts are searched whole. An empty benchmark removes nothing.
    """
    found = decontamination.with_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("matches") == 0).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one that it takes in part stays whole.

    Documents without words have no size and are never taken. A null source is a source of its own, the last by rank.
    Repeated rows count each; ties of the sampling keys are broken by hash and id, so reruns agree.
    """
    taken = mixing.mix(docs, shared_folder(spark, "mixed"))
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    return taken.where("taken > 0").withColumn("_time", F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in id order, and what they hold: doc_id, start, n_tokens, ids_crc32.

    Null texts count as empty and give the end id alone; rows without id come first; repeated rows are each written, by a hash of their text
    where ids are equal. Columns other than doc_id and text are left out.
    """
    folder = shared_folder(spark, "token-files")
    token_files.write_token_files(docs, folder, vocabulary(TOKENIZER), END_ID)
    return token_files.read_checksums(spark, folder)


STAGES = [
    ("toxicity", harmless),
    ("near duplicates", distinct_documents),
    ("benchmark decontamination", decontaminated),
    ("source mix", mixed),
    ("token files", tokens),
]
# Scores of a trained model decide the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents one after another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return kept
        kept.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
