"""Hard negatives (operator 12): inner products bounded by segment summaries before they are computed.

A vector is cut into segments, and each segment's mean m and deviation s are stored. For two vectors a
segment of length L adds L * m * m' to the score, give or take at most L * s * s'. Sums over segments
bound the score from both sides. Pairs start from one segment, the whole vector; those that the bounds leave open
go on to halves, quarters and so on, and what is open at the smallest segments is scored exactly.

Anchors are the queries: they come in blocks of at most `Settings.block` rows, each broadcast to a
pass over all rows. A task keeps the best few rows for each anchor, whose scores narrow the search further.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.vectors import integers, usable
from tideline.llm.words import ship_package

SCALE = 256
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 5
    least_percent: int = 80  # of the positive's score, that a negative has at least
    block: int = 2_048  # anchors that are broadcast at once, at most
    smallest: int = 4  # entries of a segment, at least
    rows: int = 512  # rows that meet a block of anchors at once


def bounds_of(width: int, smallest: int = Settings.smallest) -> list[np.ndarray]:
    """Ends of the segments (with the leading 0) by level: 1, 2, 4, ... segments of about equal length."""
    levels, parts = [], 1
    while parts == 1 or width // parts >= smallest:
        levels.append(np.arange(parts + 1) * width // parts)
        parts *= 2
    return levels


def summaries(x: np.ndarray, smallest: int = Settings.smallest) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the smallest segments of every row."""
    ends = bounds_of(x.shape[1], smallest)[-1]
    lengths = np.diff(ends)
    means = np.add.reduceat(x, ends[:-1], axis=1) / lengths
    apart = x - np.repeat(means, lengths, axis=1)
    return means, np.sqrt(np.add.reduceat(apart * apart, ends[:-1], axis=1) / lengths)


def scaled(means: np.ndarray, deviations: np.ndarray, width: int, smallest: int = Settings.smallest) -> list[tuple[np.ndarray, np.ndarray]]:
    """By level: means and deviations of its segments, times the root of the segment's length, from the smallest segments' ones."""
    levels = bounds_of(width, smallest)
    out = []
    while True:
        lengths = np.diff(levels[len(levels) - 1 - len(out)])
        out.append((means * np.sqrt(lengths), deviations * np.sqrt(lengths)))
        if len(lengths) == 1:
            return out[::-1]
        left, right = lengths[0::2], lengths[1::2]
        pooled = (means[:, 0::2] * left + means[:, 1::2] * right) / (left + right)
        spread = left * (deviations[:, 0::2] ** 2 + (means[:, 0::2] - pooled) ** 2) + right * (deviations[:, 1::2] ** 2 + (means[:, 1::2] - pooled) ** 2)
        means, deviations = pooled, np.sqrt(spread / (left + right))


def best(owner: np.ndarray, score: np.ndarray, number: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` of each owner: higher scores first, then smaller numbers."""
    order = np.lexsort((number, -score, owner))
    ranked = owner[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(order) else np.zeros(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < most]


class _Kept:
    """The best rows so far of every owner."""

    def __init__(self, owners: int, most: int):
        self.most = most
        self.owner, self.score, self.number = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(owners, -np.inf)  # the last kept score of owners that have all they need

    def add(self, owner: np.ndarray, score: np.ndarray, number: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score, number = (np.concatenate(pair) for pair in ((self.owner, owner), (self.score, score), (self.number, number)))
        kept = best(owner, score, number, self.most)
        self.owner, self.score, self.number = owner[kept], score[kept], number[kept]
        full = np.flatnonzero(np.bincount(self.owner, minlength=len(self.least)) == self.most)
        last = np.searchsorted(self.owner, full, side="right") - 1
        self.least[full] = self.score[last]


class Block:
    """Vectors of one width with all levels of their summaries."""

    def __init__(self, x: np.ndarray, means: np.ndarray, deviations: np.ndarray, smallest: int):
        self.x, self.levels = x, scaled(means, deviations, x.shape[1], smallest)
        self.norms = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        self.largest = int(np.abs(x).max()) if x.size else 0

    def exact(self, other: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Inner products of the pairs; beyond 64 bits they count as the last number within."""
        if self.largest * other.largest * self.x.shape[1] < 1 << 62:
            return np.einsum("ij,ij->i", self.x[i], other.x[j])
        products = (self.x[i].astype(object) * other.x[j].astype(object)).sum(axis=1)
        return np.array([max(-_LONG, min(_LONG, v)) for v in products], np.int64)

    def open_pairs(self, other: Block, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i of self, j of other) of the mask `wanted` whose bounds meet [low, high] of i, at every level."""
        # Room for rounding; scores are integers.
        slack = 0.25 + 1e-9 * self.norms[:, None] * other.norms[None, :]
        i = j = None
        for (mine, my_spread), (its, its_spread) in zip(self.levels, other.levels, strict=True):
            if i is None:
                middle, spread = mine @ its.T, my_spread @ its_spread.T + slack
                i, j = np.nonzero(wanted & (middle + spread >= low[:, None]) & (middle - spread <= high[:, None]))
            else:
                middle = np.einsum("ij,ij->i", mine[i], its[j])
                spread = np.einsum("ij,ij->i", my_spread[i], its_spread[j]) + slack[i, j]
                open_ = (middle + spread >= low[i]) & (middle - spread <= high[i])
                i, j = i[open_], j[open_]
        return i, j


def _blocks(batch: pa.RecordBatch, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, Block]]:
    """(places in the batch, labels, block) for each width of the batch's rows: vec_id, label, x, means, deviations."""
    widths = batch.column(2).value_lengths().to_numpy()
    for width in np.unique(widths):
        places = np.flatnonzero(widths == width)
        part = batch.take(pa.array(places))
        x, means, deviations = (part.column(k).flatten().to_numpy().reshape(len(places), -1) for k in (2, 3, 4))
        for start in range(0, len(places), s.rows):
            cut = slice(start, start + s.rows)
            yield places[cut], part.column(1).to_numpy()[cut], Block(x[cut], means[cut], deviations[cut], s.smallest)


def stored(vectors: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """vec_id, label, x, means and deviations of the rows that take part, once written to `folder` on shared storage.

    Rows that repeat id, label and vector count once.
    """
    s = settings
    ship_package(vectors.sparkSession)
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10))).otherwise(F.col("label").cast("long"))
    there = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    rows = vectors.where(there).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), integers(F.col("embedding"), SCALE).alias("x")).distinct()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(2).value_lengths().to_numpy()
            for width in np.unique(widths):
                part = batch.take(pa.array(np.flatnonzero(widths == width)))
                found = summaries(part.column(2).flatten().to_numpy().reshape(-1, width).astype(float), s.smallest)
                offsets = pa.array(np.arange(part.num_rows + 1) * found[0].shape[1], pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(f.ravel())) for f in found]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=["vec_id", "label", "x", "means", "deviations"])

    rows.mapInArrow(summarise, "vec_id long, label long, x array<long>, means array<double>, deviations array<double>").write.parquet(folder)
    return vectors.sparkSession.read.parquet(folder)


def nearest_alike(rows: DataFrame, anchors: pa.Table, settings: Settings = Settings()) -> DataFrame:
    """(anchor, score, number): the first rows of the same label for every row of `anchors`, whose number is its place."""
    s = settings
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.combine_chunks().to_batches()[0]
        ids, kept = table.column(0).to_numpy(), _Kept(table.num_rows, s.positives)
        queries = list(_blocks(table, s))
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for places, labels, block in _blocks(batch, s):
                for owners, wanted, query in queries:
                    if query.x.shape[1] != block.x.shape[1]:
                        continue
                    alike = (wanted[:, None] == labels[None, :]) & (ids[owners][:, None] != numbers[places][None, :])
                    i, j = query.open_pairs(block, alike, kept.least[owners], np.full(len(owners), np.inf))
                    kept.add(owners[i], query.exact(block, i, j), numbers[places[j]])
        yield pa.RecordBatch.from_arrays([pa.array(kept.owner, pa.int64()), pa.array(kept.score), pa.array(kept.number)], names=["anchor", "score", "number"])

    found = rows.mapInArrow(search, "anchor long, score long, number long")
    return _first(found, ["anchor"], s.positives)


def nearest_unlike(rows: DataFrame, anchors: pa.Table, positives: pa.Table, settings: Settings = Settings()) -> DataFrame:
    """(pair, score, number, rank): the first rows of other labels in the range that each of `positives` (anchor, score) allows; pair is its place."""
    s = settings
    shared = rows.sparkSession.sparkContext.broadcast((anchors, positives))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, pairs = shared.value
        table = given.combine_chunks().to_batches()[0]
        owner, top = pairs.column("anchor").to_numpy(), pairs.column("score").to_numpy()
        # The least score allowed; above the highest where the positive's score is negative, so nothing is.
        least = np.array([-((-s.least_percent * int(p)) // 100) for p in top], np.int64)
        kept = _Kept(len(owner), s.negatives)
        ids, queries = table.column(0).to_numpy(), list(_blocks(table, s))
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for places, labels, block in _blocks(batch, s):
                for owners, own, query in queries:
                    if query.x.shape[1] != block.x.shape[1]:
                        continue
                    low, high = np.full(len(ids), np.inf), np.full(len(ids), -np.inf)
                    fair = least <= top
                    np.minimum.at(low, owner[fair], np.maximum(least, kept.least)[fair])
                    np.maximum.at(high, owner[fair], top[fair])
                    unlike = (own[:, None] != labels[None, :]) & (ids[owners][:, None] != numbers[places][None, :])
                    i, j = query.open_pairs(block, unlike, low[owners], high[owners])
                    score, number, which = query.exact(block, i, j), numbers[places[j]], owners[i]
                    first, last = np.searchsorted(owner, which), np.searchsorted(owner, which, side="right")
                    for slot in range(s.positives):
                        at = first + slot
                        there = np.flatnonzero(at < last)
                        there = there[(score[there] >= least[at[there]]) & (score[there] <= top[at[there]]) & (score[there] >= kept.least[at[there]])]
                        kept.add(at[there], score[there], number[there])
        yield pa.RecordBatch.from_arrays([pa.array(kept.owner, pa.int64()), pa.array(kept.score), pa.array(kept.number)], names=["pair", "score", "number"])

    found = rows.mapInArrow(search, "pair long, score long, number long")
    return _first(found, ["pair"], s.negatives)


def _first(found: DataFrame, key: list[str], most: int) -> DataFrame:
    """The first rows of each key over what all tasks found, ranked; a task brings only a few a key."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "number")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, scratch: str, settings: Settings = Settings(), every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of `vectors` (vec_id, embedding, label).

    Anchors are the rows whose vec_id is divisible by `every`. Rows with a null vec_id, label or vector, without entries, or with a null or
    non-finite entry take no part. Rows that repeat id, label and vector count once; rows that share an id but
    differ are never each other's positives or negatives, and each answers for itself as an anchor. Vectors meet only those of
    their own length. Ties go to the smaller vec_id. Without rows or anchors nothing is returned. Entries beyond +-2 ** 50 after
    scaling count as that bound, scores beyond 64 bits as the last number within. Other columns play no part.
    Intermediate tables lie below `scratch`, on shared storage.
    """
    spark, s = vectors.sparkSession, settings
    rows = stored(vectors.select("vec_id", "label", "embedding"), f"{scratch}/rows", s)
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-anchors.count() // s.block))
    # Numbers count up within a partition, so no block exceeds its size, however rows fall.
    number = F.monotonically_increasing_id()
    anchors.repartition(blocks).withColumn("number", number).withColumn("block", F.floor(F.col("number") / s.block)).drop("number").write.parquet(f"{scratch}/anchors")
    anchors = spark.read.parquet(f"{scratch}/anchors")
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], shape).write.parquet(f"{scratch}/found")
    for block in sorted(r["block"] for r in anchors.select("block").distinct().collect()):
        part = anchors.where(F.col("block") == block).drop("block").orderBy("vec_id").toArrow()
        alike = nearest_alike(rows, part, s).orderBy("anchor", "rank").toArrow()
        pairs = pa.table({"pair": np.arange(alike.num_rows), "anchor_id": part.column("vec_id").take(alike.column("anchor")), "positive_id": alike.column("number"), "positive_score": alike.column("score")})
        unlike = nearest_unlike(rows, part, alike, s)
        named = unlike.join(spark.createDataFrame(pairs.to_pandas(), "pair long, anchor_id long, positive_id long, positive_score long"), "pair")
        shown = named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("number").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        shown.write.mode("append").parquet(f"{scratch}/found")
    return spark.read.schema(shape).parquet(f"{scratch}/found")


SQL = """
WITH given AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * c::DOUBLE) for c in embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0
), numbered AS (SELECT *, row_number() OVER () AS k FROM given),
scored AS (
  SELECT a.k, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM numbered a JOIN numbered b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
), positives AS (
  SELECT k, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE alike QUALIFY place <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.k, p.place ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
         n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON p.k = n.k AND NOT n.alike AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
)
SELECT * FROM ranked WHERE rank <= 5
"""
