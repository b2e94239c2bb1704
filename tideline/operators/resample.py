"""Fixed time bins: arithmetic, energetic and dominant-category means.

Rows are summed once, with map-side combine, to states per base bin: the greatest length that divides all
intervals. States add up: to the bins of every interval, and to states of earlier runs, so neither needs the rows again.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import acoustic as ac
from tideline.functions import time as tm

_BINS_PER_CHUNK = 1024


def base_step(freqs: list[str]) -> int:
    """The greatest number of microseconds that divides all intervals."""
    return gcd(*map(tm.duration, freqs))


def _state_columns(columns: list[str]) -> list[str]:
    return ["_n", *[f"{kind}_{k}" for k in range(len(columns)) for kind in ("_sum", "_count")]]


def partial_states(
    df: DataFrame, keys: list[str], step: int, columns: list[str], level_columns: list[str] = (), code: str | None = None,
    time: str = "time",
) -> DataFrame:
    """Sums and counts per base bin of `step` microseconds, and per value of `code` where that is given.

    keys, _us (start of the bin), _code, _n (rows), and for the k-th column _sum_k (of its power, if it is a dB column) and _count_k.
    States of several runs may be united as they are; `merge_states` makes them one row a bin again. Rows without time are left out.
    """
    us = tm.micros(time)
    value = {c: ac.to_power(F.col(c)) if c in level_columns else F.col(c) for c in columns}
    parts = [p for k, c in enumerate(columns) for p in (F.sum(value[c]).alias(f"_sum_{k}"), F.count(c).alias(f"_count_{k}"))]
    group = [*keys, (us - F.pmod(us, F.lit(step))).alias("_us"), (F.col(code) if code else F.lit(None).cast("int")).alias("_code")]
    return df.where(F.col(time).isNotNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *parts)


def merge_states(states: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One state for each key, bin and code."""
    return states.groupBy(*keys, "_us", "_code").agg(*[F.sum(c).alias(c) for c in _state_columns(columns)])


def roll_up(
    states: DataFrame, keys: list[str], freqs: list[str], columns: list[str], level_columns: list[str] = (), code: str | None = None,
    time: str = "time",
) -> DataFrame:
    """keys, interval, _step, time and the means of the columns, from states whose base divides all intervals.

    With `code`, the most frequent value of a bin (ties: the higher one) and the means over the rows that carry it.
    """
    steps = F.array(*[F.struct(F.lit(f).alias("interval"), F.lit(tm.duration(f)).cast("long").alias("step")) for f in freqs])
    spread = states.withColumn("_i", F.explode(steps))
    start = F.timestamp_micros(F.col("_us") - F.pmod(F.col("_us"), F.col("_i.step")))
    group = [*keys, F.col("_i.interval").alias("interval"), F.col("_i.step").alias("_step"), start.alias(time)]
    added = spread.groupBy(*group, "_code").agg(*[F.sum(c).alias(c) for c in _state_columns(columns)])
    means = []
    for k, c in enumerate(columns):
        mean = F.when(F.col(f"_count_{k}") > 0, F.col(f"_sum_{k}") / F.col(f"_count_{k}"))
        means.append((ac.to_level(mean) if c in level_columns else mean).alias(c))
    if code is None:
        return added.select(*keys, "interval", "_step", time, *means)
    rank = F.struct(F.col("_code").isNotNull(), F.col("_n"), F.col("_code"))
    best = added.groupBy(*keys, "interval", "_step", time).agg(F.max_by(F.struct(F.col("_code").alias(code), *means), rank).alias("_best"))
    return best.select(*keys, "interval", "_step", time, "_best.*")


def fill_bins(binned: DataFrame, keys: list[str], step: Column, time: str = "time") -> DataFrame:
    """Add the empty bins between the first and last bin of each key, as NULL rows.

    Each bin emits the empty ones up to the bin after it. Bins are packed in
    groups of at most 1024, so what is ordered per key is one row per group.
    """
    values = [c for c in binned.columns if c not in (*keys, time)]
    packed = (
        binned.select(*keys, tm.micros(time).alias("_us"), step.alias("_step"), F.struct(*values).alias("_v"))
        .groupBy(*keys, "_step", tm.bucket(F.col("_us"), F.col("_step") * _BINS_PER_CHUNK).alias("_chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("_us", "_v"))).alias("_bins"))
    )
    following = F.lead(F.col("_bins")[0]["_us"]).over(Window.partitionBy(*keys).orderBy("_chunk"))
    runs = packed.withColumn("_next", following).select(
        *keys, "_step", "_next", "_bins", F.posexplode("_bins").alias("_at", "_bin")
    )
    after = F.coalesce(
        F.try_element_at("_bins", F.col("_at") + 2)["_us"], F.col("_next"), F.col("_bin._us") + F.col("_step")
    )
    # Packs of bins first, then the bins of a pack: a stray early row makes many rows, never one long array.
    pack = F.col("_step") * _BINS_PER_CHUNK
    packs = runs.select(
        *keys, "_bin", "_step", (after - F.col("_step")).alias("_until"),
        F.explode(F.sequence(F.col("_bin._us"), after - F.col("_step"), pack)).alias("_from"),
    )
    to = F.least(F.col("_until"), F.col("_from") + pack - F.col("_step"))
    filled = packs.select(*keys, "_bin", F.explode(F.sequence(F.col("_from"), to, F.col("_step"))).alias("_us"))
    own = F.col("_us") == F.col("_bin._us")
    return filled.select(
        *keys, F.timestamp_micros("_us").alias(time), *[F.when(own, F.col(f"_bin._v.{c}")).alias(c) for c in values]
    )


def resample_all(
    df: DataFrame, keys: list[str], freqs: list[str], columns: list[str], level_columns: list[str] = (),
    code: str | None = None, time: str = "time", dense: bool = True,
) -> DataFrame:
    """All intervals in one table with an `interval` column, ready for a partitioned write.

    Means of the columns per bin, dB columns averaged as power. With `code`,
    that column gets its most frequent value (ties: the higher code) and the
    others the mean over the rows that carry it: means are taken per (bin,
    code) and the winner's are kept; a bin without any code falls back to all
    of its rows. Rows without time are left out. Rows are aggregated once; what is spread over the intervals are their states.
    """
    states = partial_states(df, keys, base_step(freqs), columns, level_columns, code, time)
    binned = roll_up(states, keys, freqs, columns, level_columns, code, time)
    if not dense:
        return binned.drop("_step")
    return fill_bins(binned, [*keys, "interval"], F.col("_step"), time).drop("_step")


def resample_mean(
    df: DataFrame, keys: list[str], freq: str, columns: list[str], level_columns: list[str] = (),
    time: str = "time", dense: bool = True,
) -> DataFrame:
    """Mean of each column per bin of one interval."""
    return resample_all(df, keys, [freq], columns, level_columns, None, time, dense).drop("interval")


def resample_dominant(
    df: DataFrame, keys: list[str], freq: str, code: str, columns: list[str], level_columns: list[str] = (),
    time: str = "time", dense: bool = True,
) -> DataFrame:
    """Dominant code per bin of one interval and means over the rows that carry it."""
    return resample_all(df, keys, [freq], columns, level_columns, code, time, dense).drop("interval")
