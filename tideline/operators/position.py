"""One position table out of several sources, and how well it covers a leg."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import schema
from tideline.functions import geo
from tideline.functions import time as tm
from tideline.operators import ranges
from tideline.session import materialize

_FIX = ["time", "latitude_deg", "longitude_deg", "source"]


def tagged(df: DataFrame, keys: list[str], source: str, time: str, lat: str, lon: str) -> DataFrame:
    """Complete fixes of one source in the common layout."""
    fixes = df.select(
        *keys,
        F.col(time).alias("time"),
        F.col(lat).cast("double").alias("latitude_deg"),
        F.col(lon).cast("double").alias("longitude_deg"),
        F.lit(source).alias("source"),
    )
    return fixes.dropna(subset=["time", "latitude_deg", "longitude_deg"])


def drop_null_island(df: DataFrame, lat: str = "latitude_deg", lon: str = "longitude_deg") -> DataFrame:
    """Leave out 0/0 positions, which mean no fix."""
    return df.where(~F.coalesce(geo.is_null_island(F.col(lat), F.col(lon)), F.lit(False)))


def mru_positions(decoded: DataFrame, keys: list[str]) -> DataFrame:
    """Fixes of the secondary motion-unit feed in decoded echosounder rows."""
    feed = decoded.where(F.col("time_source") == "time3")
    return tagged(feed, keys, "EK80_gps", "timestamp", "latitude_mru1", "longitude_mru1")


def ferrybox_positions(df: DataFrame, keys: list[str]) -> DataFrame:
    """The water sampler's own fixes, without its 0/0 placeholders."""
    return drop_null_island(tagged(df, keys, "Ferrybox", "time", "latitude", "longitude"))


def merge_positions(primary: DataFrame, *fills: DataFrame) -> DataFrame:
    """Primary fixes and the in-gap fixes of the other sources as one table."""
    merged = primary
    for fill in fills:
        merged = merged.unionByName(fill.select(*primary.columns))
    return merged.dropna(subset=["time", "latitude_deg", "longitude_deg"])


def keep_earlier_fills(merged: DataFrame, stored: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Do not lose fill fixes that an earlier build had.

    Per source other than the primary, where the stored table holds more fixes
    inside the current gaps than the rebuild, the stored ones are added; of
    two fixes of one source at one time the rebuilt one stays. `windows` are
    gaps, so they share no more than end points. What is added is read twice
    and small, so it is written once.
    """
    old = ranges.in_any_window(stored.where(F.col("source") != "GGA"), windows, keys, disjoint=True)
    new = ranges.in_any_window(merged.where(F.col("source") != "GGA"), windows, keys, disjoint=True)
    counted = (
        old.select(*keys, "source", F.lit(1).alias("_side"))
        .unionByName(new.select(*keys, "source", F.lit(-1).alias("_side")))
        .groupBy(*keys, "source")
        .agg(F.sum("_side").alias("_lost"))
        .where(F.col("_lost") > 0)
    )
    kept = materialize(old.join(counted.select(*keys, "source"), [*keys, "source"], "left_semi"))
    # Repeats go only where something was added; elsewhere the rebuild stays whole.
    added = kept.select(*keys).distinct()
    untouched = merged.join(added, keys, "left_anti")
    touched = merged.join(added, keys, "left_semi").withColumn("_age", F.lit(0))
    both = touched.unionByName(kept.select(*merged.columns).withColumn("_age", F.lit(1)))
    rest = [c for c in merged.columns if c not in [*keys, "time", "source"]]
    distinct = (
        both.groupBy(*keys, "time", "source")
        .agg(F.min(F.struct("_age", *rest)).alias("_row"))
        .select(*keys, "time", "source", "_row.*")
    )
    return untouched.unionByName(distinct.select(*merged.columns))


def _rank(source: Column) -> Column:
    rank = F.lit(None).cast("int")
    for number, name in enumerate(schema.POSITION_SOURCES):
        rank = F.when(source == name, F.lit(number)).otherwise(rank)
    return rank


def source_seconds(df: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Whole seconds with a fix per source; a second counts once, for the best source in it."""
    best = (
        df.select(*keys, tm.bucket(tm.micros(time), tm.SECOND).alias("_second"), _rank(F.col("source")).alias("_rank"))
        .where(F.col("_second").isNotNull() & F.col("_rank").isNotNull())
        .groupBy(*keys, "_second")
        .agg(F.min("_rank").alias("_rank"))
    )
    per_source = [
        F.struct(F.lit(name).alias("source"), F.count_if(F.col("_rank") == number).alias("seconds"))
        for number, name in enumerate(schema.POSITION_SOURCES)
    ]
    return best.groupBy(*keys).agg(F.array(*per_source).alias("_s")).select(*keys, F.inline("_s"))


def source_share(seconds: DataFrame, windows: DataFrame, keys: list[str] = ("leg",)) -> DataFrame:
    """Per leg: percent of its window and hours each source covers, and seconds without a fix."""
    lengths = windows.select(
        *keys, ((tm.micros("end") - tm.micros("start")) / float(tm.SECOND)).alias("window_seconds")
    )
    wide = (
        seconds.groupBy(*keys)
        .pivot("source", schema.POSITION_SOURCES)
        .agg(F.sum("seconds"))
        .join(lengths, list(keys))
    )
    total = F.lit(0)
    for name in schema.POSITION_SOURCES:
        total = total + F.coalesce(F.col(name), F.lit(0))
    out = [*keys, "window_seconds"]
    for name in schema.POSITION_SOURCES:
        held = F.coalesce(F.col(name), F.lit(0))
        out.append((held / F.col("window_seconds") * 100).alias(f"{name.lower()}_pct"))
        if name != schema.POSITION_SOURCES[0]:
            out.append((held / 3600.0).alias(f"{name.lower()}_hours"))
    out.append(F.greatest(F.col("window_seconds") - total, F.lit(0.0)).alias("seconds_without_fix"))
    out.append(F.greatest(F.lit(100.0) - total / F.col("window_seconds") * 100, F.lit(0.0)).alias("no_fix_pct"))
    return wide.select(*out)
