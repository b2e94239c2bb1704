"""Distributions, category shares and wind roses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators import sequence as seq

_RANK_CHUNKS = 128

# Wind speed classes in m/s (lower edge inclusive), calm limit, number of sectors.
SPEED_EDGES = [0.5, 3.0, 6.0, 9.0, 12.0, 15.0]
CALM_BELOW = 0.5
N_SECTORS = 16


def _position(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin of a value in [low, high]; the last bin is closed."""
    width = (high - low) / bins
    return F.when(width > 0, F.least(F.floor((value - low) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("long")


def _counted(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, _v, _n): how often each value occurs."""
    return df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def exact_percentiles(df: DataFrame, keys: list[str], column: str, points: dict[str, float]) -> DataFrame:
    """Exact percentiles with linear interpolation, without one task holding a key's values."""
    return _percentiles(_counted(df, keys, column), keys, points)


def _percentiles(values: DataFrame, keys: list[str], points: dict[str, float]) -> DataFrame:
    """Percentiles of counted values.

    Their running count, in chunks between approximate quantiles, gives each value the ranks
    it covers; only values at a wanted rank go on. The quantiles only deal values to tasks, evenly however
    far the extremes lie.
    """
    cuts = [k / _RANK_CHUNKS for k in range(1, _RANK_CHUNKS)]
    ends = values.groupBy(*keys).agg(F.percentile_approx("_v", cuts, 1_000).alias("_cuts"), F.sum("_n").alias("_all"))
    placed = seq.join_summary(values, ends, keys, F.col("_v"))
    chunk = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_v")))
    counted = seq.with_running(
        placed.withColumn("_place", chunk).drop("_cuts"), keys, ["_v"], F.col("_place"), {"_upto": ("sum", F.col("_n"))}
    )
    picks = []
    for name, p in points.items():
        rank = (F.col("_all") - 1) * p
        lower, upper = F.floor(rank), F.ceil(rank)

        def at(r: Column) -> Column:
            return (F.col("_upto") - F.col("_n") <= r) & (r < F.col("_upto"))

        low, high = F.max(F.when(at(lower), F.col("_v"))), F.max(F.when(at(upper), F.col("_v")))
        weight = F.max(rank - lower)
        # Equal neighbours need no step between them, which infinities could not make.
        picks.append(F.when(low == high, low).otherwise(low + (high - low) * weight).alias(name))
    return counted.groupBy(*keys).agg(*picks)


def distribution(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """n, quartiles and box whiskers (farthest values within 1.5 IQR of the box).

    Everything is worked out from counted values, so rows are only aggregated.
    """
    values = _counted(df, keys, column)
    box = _percentiles(values, keys, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return (
        seq.join_summary(values, box, keys, F.col("_v"))
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.sum("_n").alias("n"),
            F.min(F.when(F.col("_v") >= F.col("q1") - reach, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(F.col("_v") <= F.col("q3") + reach, F.col("_v"))).alias("whisker_high"),
        )
        .select(*keys, "n", "q1", "median", "q3", "whisker_low", "whisker_high")
    )


def histogram(df: DataFrame, keys: list[str], column: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins from the least to the greatest value, empty bins included."""
    values = _counted(df.select(*keys, F.col(column).cast("double").alias(column)), keys, column)
    ends = values.groupBy(*keys).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    # A single value is shown in bins over half a unit to either side of it.
    flat = F.col("_low") == F.col("_high")
    ends = ends.select(
        *keys,
        F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("_low"),
        F.when(flat, F.col("_high") + 0.5).otherwise(F.col("_high")).alias("_high"),
    )
    counts = (
        seq.join_summary(values, ends, keys, F.col("_v"))
        .groupBy(*keys, _position(F.col("_v"), F.col("_low"), F.col("_high"), bins).alias("bin"))
        .agg(F.sum("_n").alias("n"))
    )
    grid = ends.select(
        *keys, "_low", "_high", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin")
    )
    width = (F.col("_high") - F.col("_low")) / bins
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def category_shares(df: DataFrame, keys: list[str], code: str) -> DataFrame:
    """Count and percent of each rounded code."""
    counted = (
        df.where(F.col(code).isNotNull())
        .groupBy(*keys, F.round(code).cast("int").alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counted.withColumn("pct", F.col("n") / total * 100)


def wind_rose(df: DataFrame, keys: list[str], direction: str, speed: str) -> DataFrame:
    """Share of rows per direction sector and speed class, and of calm; zero shares included.

    Shares are of all rows with direction and speed. Calm rows have sector and
    class -1.
    """
    sector_width = 360.0 / N_SECTORS
    sector = F.floor(F.pmod(F.col(direction) + sector_width / 2, F.lit(360.0)) / sector_width)
    speed_class = F.lit(-1)
    for edge in SPEED_EDGES:
        speed_class = speed_class + F.when(F.col(speed) >= edge, 1).otherwise(0)
    calm = F.col(speed) < CALM_BELOW
    counted = (
        df.where(F.col(direction).isNotNull() & F.col(speed).isNotNull())
        .groupBy(
            *keys,
            F.when(calm, -1).otherwise(sector).cast("int").alias("sector"),
            F.when(calm, -1).otherwise(speed_class).cast("int").alias("speed_class"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("_all"))
    cells = [(-1, -1)] + [(s, k) for s in range(N_SECTORS) for k in range(len(SPEED_EDGES))]
    grid = totals.select(
        *keys,
        "_all",
        F.explode(
            F.array(*[F.struct(F.lit(s).alias("sector"), F.lit(k).alias("speed_class")) for s, k in cells])
        ).alias("_cell"),
    ).select(*keys, "_all", "_cell.*")
    return grid.join(counted, [*keys, "sector", "speed_class"], "left").select(
        *keys,
        "sector",
        "speed_class",
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        (F.coalesce("n", F.lit(0)) / F.col("_all") * 100).alias("pct"),
    )
