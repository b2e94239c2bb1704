"""Anomalies among embedded chunks of recordings, and the events they form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import acoustic as ac
from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.operators import gaps
from tideline.operators import sequence as seq
from tideline.session import materialize

# Detector settings.
CHUNK_SECONDS = 3.0
DBSCAN_EPS = 2.5
DBSCAN_MIN_SAMPLES = 4
GROUPING_SECONDS = 15.0
MIN_GROUP = 2
LOUDNESS_RATIO = 2.5
PING_TOLERANCE_HZ = 250.0
PING_PEAK_RATIO = 8.0
PING_ENERGY_SHARE = 0.30
SAMPLE_RATE = 32_000.0
INSTRUMENT_TONES_HZ = [38_000.0, 75_000.0, 80_000.0]
AVOID_LABELS = ["Stream", "Water", "Pour", "Frying (food)", "Drip", "Boiling", "Raindrop"]

_BLOCK = 256  # points of a block, at least
_LARGEST_BLOCK = 4_096
_BLOCKS = 64  # blocks of a recording, about, before they reach the largest size
_SLAB = 16  # blocks of a slab, about
_PIVOTS = 3
_UNIT = 2**-20  # distances are ordered in these steps


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x))


def _with_pivots(points: DataFrame, keys: list[str]) -> DataFrame:
    """Points with their distances `_d` to a few points of their key that lie far apart.

    The first pivot is the point of least number; each further one is the point farthest from those before it. One row a
    key is found in each pass, and meets the points in many tasks.
    """
    spots = points.withColumn("_d", F.array().cast("array<double>"))
    for number in range(_PIVOTS):
        rank = -F.array_min("_d") if number else F.lit(0.0)
        pivot = spots.groupBy(*keys).agg(F.min_by("_vector", F.struct(rank, F.col("_point"))).alias("_pivot"))
        met = seq.join_summary(spots, pivot, keys, F.col("_point"))
        spots = met.withColumn("_d", F.concat("_d", F.array(_distance(F.col("_vector"), F.col("_pivot"))))).drop("_pivot")
    return spots


def block_size(points: int, recordings: int, least: int = _BLOCK) -> int:
    """Points of a block, so that a recording of average size has about `_BLOCKS` blocks.

    Each block travels to all that it may meet: with as many blocks, what travels grows with the points and not with their square.
    """
    return max(least, min(_LARGEST_BLOCK, -(-points // (max(recordings, 1) * _BLOCKS))))


def _blocks(points: DataFrame, keys: list[str], block: int, vector: str = "array<double>") -> DataFrame:
    """Blocks of at most `block` points: slabs of equal count along the distance to the first pivot, cut along that to the second.

    A block knows the range of its distances to every pivot (`_low`, `_high`). `vector` is the type its vectors travel in.
    """
    place = (F.col("_d")[0] / _UNIT).cast("long")
    slabbed = seq.with_equal_chunks(points, keys, place, block * _SLAB, "_slab", width=int(0.25 / _UNIT))
    order = Window.partitionBy(*keys, "_slab").orderBy(F.col("_d")[1], F.col("_d")[2], "_point")
    cut = slabbed.withColumn("_part", F.floor((F.row_number().over(order) - 1) / block))
    ranges = [pick(F.col("_d")[k]) for pick in (F.min, F.max) for k in range(_PIVOTS)]
    return cut.groupBy(*keys, "_slab", "_part").agg(
        F.array(*ranges[:_PIVOTS]).alias("_low"),
        F.array(*ranges[_PIVOTS:]).alias("_high"),
        F.collect_list(F.struct("_point", F.col("_vector").cast(vector).alias("_vector"), "_weight")).alias("_members"),
        F.min("_point").alias("_block"),
    )


def block_pairs(left: DataFrame, right: DataFrame, keys: list[str], eps: float) -> DataFrame:
    """(left_block, right_block) of all pairs of blocks that can hold points within eps.

    By the triangle inequality such points differ by at most eps in their distance to any pivot. Blocks meet in steps of eps along the
    distance to the first pivot, each pair in the first step both reach into; only their ranges travel.
    """

    def reaching(blocks: DataFrame, side: str, reach: float) -> DataFrame:
        low, high = F.floor((F.col("_low")[0] - reach) / eps), F.floor((F.col("_high")[0] + reach) / eps)
        return blocks.select(
            *keys, F.col("_block").alias(f"{side}_block"), F.col("_low").alias(f"_low_{side}"), F.col("_high").alias(f"_high_{side}"),
            low.alias(f"_first_{side}"), F.explode(F.sequence(low, high)).alias("_step"),
        )

    slack = eps * (1 + 1e-9) + 1e-9
    met = reaching(left, "left", slack).join(reaching(right, "right", 0.0), [*keys, "_step"])
    near = F.col("_step") == F.greatest("_first_left", "_first_right")
    for k in range(_PIVOTS):
        near = near & (F.col("_low_left")[k] <= F.col("_high_right")[k] + slack) & (F.col("_low_right")[k] <= F.col("_high_left")[k] + slack)
    return met.where(near).select("left_block", "right_block")


def _near_counter(eps: float):
    """Task function: for each pair of blocks, the weight of the right members within eps of each left member.

    It is built here, and uses nothing else of the package, so that workers
    need not have the package installed.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, left, right, weight in zip(batch["ids"], batch["left"], batch["right"], batch["weight"]):
                a, b, w = np.stack(left).astype(float), np.stack(right).astype(float), np.asarray(weight)
                near = []
                for row in range(0, len(a), 32):
                    found = np.zeros(len(a[row : row + 32]), np.int64)
                    for column in range(0, len(b), 256):
                        gap = a[row : row + 32, None, :] - b[None, column : column + 256, :]
                        found += (np.einsum("ijk,ijk->ij", gap, gap) <= eps * eps) @ w[column : column + 256]
                    near.append(found)
                yield pd.DataFrame({"_point": np.asarray(ids), "_near": np.concatenate(near).astype("int64")})

    return count


def _near_weight(left: DataFrame, right: DataFrame, keys: list[str], eps: float) -> DataFrame:
    """(point, weight within eps) over all pairs of blocks that can hold near points; a pair of blocks is a row, dealt by both."""
    a = left.select(F.col("_block").alias("left_block"), F.col("_members").alias("_a"))
    b = right.select(F.col("_block").alias("right_block"), F.col("_members").alias("_b"))
    met = block_pairs(left, right, keys, eps).join(a, "left_block").join(b, "right_block")
    pairs = met.select(
        F.col("_a._point").alias("ids"), F.col("_a._vector").alias("left"),
        F.col("_b._vector").alias("right"), F.col("_b._weight").alias("weight"),
    )
    counted = pairs.mapInPandas(_near_counter(eps), "_point long, _near long")
    return counted.groupBy("_point").agg(F.sum("_near").alias("_near"))


def indexed(df: DataFrame, keys: list[str], point: str, vector: str) -> DataFrame:
    """Distinct vectors of each recording with their weight and their distances to its pivots, written once."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    merged = df.groupBy(*keys, values.alias("_vector")).agg(
        F.min(point).alias("_point"), F.count(F.lit(1)).alias("_weight")
    )
    return materialize(_with_pivots(merged, keys), "indexed")


def noise_points(
    df: DataFrame, keys: list[str], point: str, vector: str, eps: float = DBSCAN_EPS,
    min_samples: int = DBSCAN_MIN_SAMPLES, block: int = _BLOCK,
) -> DataFrame:
    """Points density clustering would leave as noise, within each recording.

    Noise is a point with fewer than `min_samples` points (itself included)
    within eps, and none of those a core point; cluster numbers are not
    needed. Equal vectors are first merged into one with a weight. The rest
    meet block by block, where the distances to pivots allow it, and a pair of blocks yields one count per point, never
    the pairs. `point` is unique over the table.
    """
    points = indexed(df, keys, point, vector)
    # Floats travel as floats, which loses nothing.
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))).first()
    block = block_size(*sizes, least=block)
    blocks = materialize(_blocks(points, keys, block, kind), "blocks")
    counted = materialize(points.join(_near_weight(blocks, blocks, keys, eps), "_point"), "counted")
    core = counted.where(F.col("_near") >= min_samples).drop("_near")
    sparse = counted.where(F.col("_near") < min_samples).drop("_near")
    touched = _near_weight(_blocks(sparse, keys, block, kind), _blocks(core, keys, block, kind), keys, eps).where(F.col("_near") > 0)
    noise = sparse.join(touched, "_point", "left_anti").select(*keys, "_vector")
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    return df.withColumn("_vector", values).join(noise, [*keys, "_vector"], "left_semi").select(*df.columns)


def top_labels(labels: Column, k: int = 3) -> Column:
    """The k most probable (label, prob) of an array; equal probabilities by label."""
    ranked = F.array_sort(F.transform(labels, lambda x: F.struct((-x["prob"]).alias("n"), x["label"].alias("label"))))
    best = F.slice(ranked, 1, k)
    return F.transform(best, lambda x: F.struct(x["label"].alias("label"), (-x["n"]).alias("prob")))


def is_ping(
    bins: Column, tones: list[float], tolerance: float = PING_TOLERANCE_HZ, share: float = PING_ENERGY_SHARE,
    ratio: float = PING_PEAK_RATIO,
) -> Column:
    """Whether a spectrum is a ping by the energy near the tones or by their peaks."""
    return ac.is_ping_by_energy(bins, tones, tolerance, share) | ac.is_ping_by_peak(
        bins, tones, tolerance, ratio
    )


def classify_candidates(
    candidates: DataFrame, keys: list[str], stem: str, ping: Column, top_label: Column, loudness: Column,
    avoid: list[str], grouping_seconds: float = GROUPING_SECONDS, min_group: int = MIN_GROUP,
    loud_ratio: float = LOUDNESS_RATIO, offset: str = "chunk_offset_s",
) -> DataFrame:
    """Add status, reason, event_id and high_quality to candidate chunks of recordings.

    A ping is judged before the label. What passes both is grouped by its
    offset; small groups are isolated. Columns of the last two are NULL unless
    the chunk was kept. The judged candidates are written once: they are few,
    and finding them is the expensive part.
    """
    judged = materialize(candidates.withColumns(
        {
            "_reason": F.when(ping, F.lit("Instrument Ping")).when(
                F.coalesce(top_label.isin(*avoid), F.lit(False)), F.lit("Failed Validation")
            ),
            "_loud": loudness >= loud_ratio,
            "_at": F.timestamp_micros(F.round(F.col(offset) * float(tm.SECOND)).cast("long")),
        }
    ))
    passed = judged.where(F.col("_reason").isNull())
    grouped = gaps.with_segment(passed, keys, "_at", tm.seconds_us(grouping_seconds))
    sizes = grouped.groupBy(*keys, "segment_start").agg(
        F.count(F.lit(1)).alias("_size"), F.bool_or("_loud").alias("_any_loud")
    )
    sized = grouped.join(sizes, [*keys, "segment_start"])
    in_event = F.col("_size") >= min_group
    start = F.unix_micros("segment_start") / float(tm.SECOND)
    events = sized.select(
        *candidates.columns,
        F.when(in_event, F.lit("KEPT")).otherwise(F.lit("DISCARDED")).alias("status"),
        F.when(in_event, F.lit("Part of Event Group")).otherwise(F.lit("Isolated Anomaly")).alias("reason"),
        F.when(in_event, F.concat(F.col(stem), F.lit("_"), tx.fixed(start, 0), F.lit("s"))).alias("event_id"),
        F.when(in_event, F.col("_any_loud")).alias("high_quality"),
    )
    dropped = judged.where(F.col("_reason").isNotNull()).select(
        *candidates.columns,
        F.lit("DISCARDED").alias("status"),
        F.col("_reason").alias("reason"),
        F.lit(None).cast("string").alias("event_id"),
        F.lit(None).cast("boolean").alias("high_quality"),
    )
    return events.unionByName(dropped)


def event_table(
    log: DataFrame, keys: list[str], chunk_seconds: float = CHUNK_SECONDS, time: str = "time", tie: str = "chunk_offset_s"
) -> DataFrame:
    """One row per event of the kept candidates.

    `top_prediction` is the label of the most confident row; `labels` lists
    each label with its best confidence, best first.
    """
    kept = log.where(F.col("status") == "KEPT")
    per_label = kept.groupBy(*keys, "event_id", "top_prediction").agg(
        F.min(time).alias("_a"),
        F.max(time).alias("_b"),
        F.count(F.lit(1)).alias("_n"),
        F.bool_or("high_quality").alias("_hq"),
        F.max("loudness_ratio").alias("_loud"),
        F.max("confidence").alias("_conf"),
        F.min(F.struct((-F.col("confidence")).alias("c"), F.col(tie).alias("t"))).alias("_best"),
    )
    listed = F.array_sort(F.collect_list(F.struct((-F.col("_conf")).alias("c"), F.col("top_prediction").alias("l"))))
    events = per_label.groupBy(*keys, "event_id").agg(
        F.min("_a").alias("time"),
        F.max("_b").alias("_last"),
        F.sum("_n").alias("n_anomalies"),
        F.bool_or("_hq").alias("high_quality"),
        F.max("_loud").alias("max_loudness_ratio"),
        F.min_by("top_prediction", "_best").alias("top_prediction"),
        listed.alias("_labels"),
    )
    text = F.transform("_labels", lambda x: F.concat(x["l"], F.lit(":"), tx.fixed(-x["c"], 2)))
    end = tm.micros("_last") + tm.seconds_us(chunk_seconds)
    return events.select(
        *keys,
        "event_id",
        "time",
        F.timestamp_micros(end).alias("end_time"),
        ((end - tm.micros("time")) / float(tm.SECOND)).alias("duration_s"),
        "n_anomalies",
        "high_quality",
        "max_loudness_ratio",
        "top_prediction",
        F.array_join(text, "; ").alias("labels"),
    )


def loudness(df: DataFrame, keys: list[str], chunk: str, samples: str) -> DataFrame:
    """RMS of each chunk and of its recording, and their ratio."""
    squares = F.aggregate(
        F.transform(F.col(samples), lambda x: x.cast("double")), F.lit(0.0), lambda acc, x: acc + x * x
    )
    sized = df.select(*keys, chunk, squares.alias("_sq"), F.size(samples).alias("_n"))
    whole = sized.groupBy(*keys).agg(F.sqrt(F.sum("_sq") / F.sum("_n")).alias("file_rms"))
    return (
        seq.join_summary(sized.withColumn("chunk_rms", F.sqrt(F.col("_sq") / F.col("_n"))), whole, keys, F.col(chunk))
        .select(
            *keys, chunk, "chunk_rms", "file_rms",
            (F.col("chunk_rms") / (F.col("file_rms") + 1e-9)).alias("loudness_ratio"),
        )
    )
