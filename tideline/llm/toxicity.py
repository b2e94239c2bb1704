"""Toxicity (operator 6): FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.folds import bounded_sample, held_out
from tideline.llm.words import WordTable, narrow_batches, split_words, sums, text_batches

_EDGE = re.compile(r"^\W+|\W+$")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and parameters of the model."""

    sample_docs: int = 16_000  # labelled documents the model is fitted on, at most
    shard_docs: int = 4_000  # documents that one task trains on in turn
    bits: int = 20  # features are hashed to 2 ** bits places
    epochs: int = 4
    alpha: float = 0.6
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    threshold: float = 0.3


def _word_hashes(words: list[str]) -> list[list[int]]:
    """A hash of the word in lower case without signs at its ends; nothing where nothing is left."""
    bare = [_EDGE.sub("", w.lower()) for w in words]
    return [[xxhash.xxh3_64_intdigest(b)] if b else [] for b in bare]


@lru_cache(maxsize=1)
def _table() -> WordTable:
    return WordTable("toxicity", _word_hashes, np.uint64)


def _features(texts: list[str | None], bits: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of 1-, 2-, 3-grams and of pairs one and two words apart, each once per text; their numbers per text; words per text.

    Of all places, only those that `wanted` marks are returned where it is given.
    """
    table = _table()
    words = [split_words(t) for t in texts]
    hashes, lengths = table.gather(table.rows([w for one in words for w in one]))
    per_text = sums(lengths, np.fromiter(map(len, words), np.int64, len(words)))
    doc = np.repeat(np.arange(len(texts)), per_text)

    def joined(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
        z = (a * _MIX + b) * _ODD + np.uint64(kind)
        return (z ^ (z >> np.uint64(32))) * _ODD

    def apart(n: int) -> np.ndarray:  # whether the word n further on is of the same text
        return doc[:-n] == doc[n:]

    found, owner = [hashes], [doc]
    if len(hashes) > 1:
        pair = joined(hashes[:-1], hashes[1:], 1)
        found.append(pair[apart(1)])
        owner.append(doc[:-1][apart(1)])
        if len(hashes) > 2:
            same = apart(2)
            found += [joined(pair[:-1], hashes[2:], 2)[same], joined(hashes[:-2], hashes[2:], 3)[same]]
            owner += [doc[:-2][same]] * 2
        if len(hashes) > 3:
            same = apart(3)
            found.append(joined(hashes[:-3], hashes[3:], 4)[same])
            owner.append(doc[:-3][same])
    place, whose = (np.concatenate(found) * _ODD) >> np.uint64(64 - bits), np.concatenate(owner)
    if wanted is not None:
        there = np.flatnonzero(wanted[place.view(np.int64)])
        place, whose = place[there], whose[there]
    keys = np.unique((whose.astype(np.uint64) << np.uint64(bits)) | place)
    counts = np.bincount((keys >> np.uint64(bits)).astype(np.int64), minlength=len(texts))
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int32), counts, per_text


def _packed(places: np.ndarray, bits: int) -> bytes:
    """Sorted places as numbers, or as one bit of each of all places where that is shorter."""
    if 32 * len(places) < 1 << bits:
        return places.astype("<i4").tobytes()
    there = np.zeros(1 << bits, bool)
    there[places] = True
    return np.packbits(there).tobytes()


def _unpacked(packed: bytes, bits: int) -> np.ndarray:
    if 8 * len(packed) < 1 << bits:
        return np.frombuffer(packed, "<i4")
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8))).astype(np.int32)


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """Weights from the sums of gradients; the last one, the constant, is not held to zero by L1."""
    least = np.full(len(z), s.l1)
    least[-1] = 0.0
    shrunk = np.sign(z) * least - z
    return np.where(np.abs(z) <= least, 0.0, shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def _fit(packed: list[bytes], labels: np.ndarray, s: Settings) -> np.ndarray:
    """Weights by place, the last one the constant; one pass after another in a fixed random order."""
    z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)
    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for k in order.permutation(len(packed)):
            x = np.append(_unpacked(packed[k], s.bits), 1 << s.bits)
            zx, nx = z[x], n[x]
            w = _weights(zx, nx, s)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            z[x] = zx + g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / s.alpha * w
            n[x] = nx + g * g
    return _weights(z, n, s)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), column: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """(places, weights, share of label 1) learned from at most `sample_docs` labelled documents outside the held-out fold.

    The sample is dealt to shards of about `shard_docs` documents, however long; each trains a model
    and the weights are averaged. A shard holds no texts but their features, at most 2 ** bits bits of each. L1 keeps few of them, so that they fit a broadcast:
    at most 2 ** bits + 1 numbers. Without labelled documents nothing counts as toxic.
    """
    s = settings
    spark = docs.sparkSession
    narrow_batches(spark)
    sample = bounded_sample(labels.select("doc_id", column).where(~held_out(F.col("doc_id"))), column, s.sample_docs)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found_docs = docs.select("doc_id").join(F.broadcast(sample), "doc_id")
    size = found_docs.agg(F.count("*").alias("docs"), F.avg("label").alias("share")).first()
    if not size["docs"]:
        return np.array([1 << s.bits]), np.array([-35.0]), 0.0
    shards = -(-size["docs"] // s.shard_docs)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            found, counts, _ = _features(texts, s.bits)
            packed = [_packed(p, s.bits) for p in np.split(found, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], names=["shard", "doc_id", "label", "packed"])

    def fit(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table.select(["doc_id", "packed"]), sort_keys=[("doc_id", "ascending"), ("packed", "ascending")]).to_numpy()
        packed = table.column("packed").to_pylist()
        w = _fit([packed[k] for k in order], table.column("label").to_numpy()[order], s)
        kept = np.flatnonzero(w)
        return pa.table({"place": pa.array(kept, pa.int32()), "weight": w[kept]})

    # One task for each shard, by its number: hashes of a few numbers would share tasks.
    shard = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(shards)).cast("int").alias("shard")
    shape = f"shard int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, packed binary"
    dealt = rows.select(shard, "doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(hashed, shape)
    found = dealt.repartitionById(shards, F.col("shard")).groupBy("shard").applyInArrow(fit, "place int, weight double").groupBy("place").agg((F.sum("weight") / shards).alias("weight")).toArrow()
    order = np.argsort(found.column("place").to_numpy())
    return found.column("place").to_numpy()[order].astype(np.int64), found.column("weight").to_numpy()[order], size["share"]


def with_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], settings: Settings = Settings(), text: str = "text", out: str = "toxicity") -> DataFrame:
    """Add `out`, the probability that the text is toxic (0 to 1). Texts without a word get the share of toxic documents in the sample.

    All other columns stay; a column named `out` is replaced. Rows never leave their partition.
    """
    spark = docs.sparkSession
    narrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != out]
    names = [f"c{k}" for k in range(len(keep))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("text"))
    bits = settings.bits

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values, share = shared.value
        weights = np.zeros((1 << bits) + 1)
        weights[places] = values
        weighty = weights[:-1] != 0
        for batch, texts in text_batches(batches):
            found, counts, words = _features(texts, bits, weighty)
            total = sums(weights[found], counts) + weights[-1]
            scores = np.where(words > 0, 1 / (1 + np.exp(-np.clip(total, -35, 35))), share)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*names, out])

    shape = ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, keep, strict=True)), f"`{out}` double"])
    return given.mapInArrow(score, shape).toDF(*keep, out)
