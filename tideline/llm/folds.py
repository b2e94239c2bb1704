"""Labelled rows and their folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of the documents with a label of 0 or 1, the greatest of repeated ones."""
    return labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(column).alias("label"))


def bounded_sample(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """(doc_id, label) of at most `rows` documents: those with the smallest hash of doc_id, so that reruns agree."""
    return one_label(labels, column).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
