"""Quality rules (operator 9): counts of a text, and a hashed n-gram likelihood ratio between trusted and raw text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.words import narrow_batches, split_words, text_batches

_SYMBOLS = "#*$%&|<>"
_STEP = np.uint64(0x100000001B3)
_ODD = np.uint64(0x9E3779B97F4A7C15)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Settings:
    bits: int = 16  # n-grams are hashed to 2 ** bits places
    size: int = 4  # bytes of an n-gram
    prior: float = 1_000_000.0  # n-grams of raw text that are added to the target's counts
    least_ratio: float = -0.1  # mean log ratio a kept document has at least
    least_words: int = 50
    most_repeats: int = 50  # percent of words in repeated windows, at most


def _grams(texts: list[str | None], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places of the byte n-grams of every text one after another, and the text of each."""
    coded = [(t or "").encode() for t in texts]
    raw = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    if len(raw) < s.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(raw) - s.size + 1
    h = np.zeros(n, np.uint64)
    for k in range(s.size):
        h = h * _STEP + raw[k : k + n] + np.uint64(1)
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[:n] == owner[s.size - 1 :]
    return ((h[inside] * _ODD) >> np.uint64(64 - s.bits)).astype(np.int64), owner[:n][inside]


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Log ratio of target and raw probability by place: 2 ** bits numbers.

    Raw counts are of all documents; the target's are of all documents
    labelled 1, smoothed by the raw distribution (so without any, all ratios are 0).
    """
    s = settings
    spark = docs.sparkSession
    narrow_batches(spark)
    trusted = labels.where(F.col("quality") == 1).select("doc_id").hint("shuffle_merge")  # as many as trusted documents: never broadcast
    # Raw text is counted where it is read. Only trusted text is shuffled: the ids' Bloom filter keeps the rest from the exchange
    # (Spark makes one where a plain filter of a table is joined, so repeated labels stay: a semi join does not mind them).
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    chosen = docs.select("doc_id", "text").where("doc_id is not null").join(trusted, "doc_id", "left_semi").select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << s.bits, np.int64)
        for _, texts in text_batches(batches):
            found += np.bincount(_grams(texts, s)[0], minlength=1 << s.bits)
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(found[seen])], names=["place", "n"])

    def counted(texts: DataFrame) -> np.ndarray:
        counts = texts.mapInArrow(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros(1 << s.bits)
        out[counts.column("place").to_numpy()] = counts.column("n").to_numpy()
        return out

    raw, target = counted(docs.select("text")), counted(chosen)
    places = np.flatnonzero(raw)
    ratio = np.zeros(1 << s.bits)
    share = raw[places] / max(raw.sum(), 1.0)
    ratio[places] = np.log((target[places] + s.prior * share) / (target.sum() + s.prior)) - np.log(share)
    return ratio


def _repeats(ids: np.ndarray, words: int) -> int:
    """Words in 3-word windows that stand in the text twice or more."""
    if len(ids) < 4:
        return 0
    if words < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        _, which, often = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        _, which, often = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1), axis=0, return_inverse=True, return_counts=True)
    again = often[which.reshape(-1)] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def _counts(text: str | None, index: dict[str, int]) -> tuple[int, int, int, int, int]:
    words = split_words(text)
    if not words:
        return 0, 0, sum(map((text or "").count, _SYMBOLS)), 0, 0
    lines = [line for line in text.split("\n") if split_words(line)] if "\n" in text else [text]
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    return len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), _repeats(ids, len(index))


def with_quality(docs: DataFrame, ratios: np.ndarray, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, log_ratio, base_failed and kept.

    `log_ratio` is the mean over all n-grams of the text (0 without any). Kept is a document that
    passes the word rules and has at least `least_ratio`. Null texts count as empty and fail.
    Other columns stay; columns of these names are replaced. Rows never leave their partition.
    """
    s = settings
    spark = docs.sparkSession
    narrow_batches(spark)
    shared = spark.sparkContext.broadcast(ratios)
    added = [*COUNTS, "log_ratio"]
    keep = [c for c in docs.columns if c not in (*added, "base_failed", "kept")]
    names = [f"c{k}" for k in range(len(keep))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch, texts in text_batches(batches):
            index: dict[str, int] = {}
            counts = np.array([_counts(t, index) for t in texts], np.int64)
            places, owner = _grams(texts, s)
            total = np.bincount(owner, weights=table[places], minlength=len(texts))
            mean = total / np.maximum(np.bincount(owner, minlength=len(texts)), 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, counts.T), pa.array(mean)], names=[*names, *added])

    shape = ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, keep, strict=True)), *(f"`{c}` long" for c in COUNTS), "log_ratio double"])
    judged = given.mapInArrow(judge, shape).toDF(*keep, *added)
    failed = (F.col("n_words") < s.least_words) | (100 * F.col("n_repeat_words") > s.most_repeats * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("log_ratio") >= s.least_ratio))
