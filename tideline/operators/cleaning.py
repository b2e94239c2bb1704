"""Removal of bad stretches and spikes, and what that removal did."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import schema
from tideline.functions import time as tm
from tideline.operators import gaps, ranges

_CHUNK_WINDOWS = 64


def blank_nonpositive(df: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """Blank values that are not above zero, cell by cell; columns that are not there are ignored."""
    gate = F.lit(True) if where is None else where
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.when(~gate | (F.col(c) > 0), F.col(c)) for c in present})


def pressure_exclusions(
    df: DataFrame, rules: DataFrame, keys: list[str], pressure: str, time: str, buffer_us: int
) -> DataFrame:
    """Stretches to leave out: each row under its leg's threshold and the buffer after it.

    Rows at most a buffer apart merge into one stretch, so what is joined back
    is a handful of intervals per key, not the bad rows.
    """
    low = df.join(rules.select("leg", "pressure_under"), "leg").where(F.col(pressure) < F.col("pressure_under"))
    stretches = gaps.segments(low, keys, time, buffer_us)
    return stretches.select(
        *keys,
        F.col("segment_start").alias("start"),
        F.timestamp_micros(tm.micros("segment_end") + buffer_us).alias("end"),
    )


def remove_low_pressure(
    df: DataFrame, rules: DataFrame, keys: list[str], pressure: str = "ts_pressure", time: str = "time",
    buffer_minutes: float = schema.PRESSURE_BUFFER_MINUTES, strict: bool = True,
) -> DataFrame:
    """Drop rows below the leg's pressure threshold and the buffer after the latest of them.

    Rows without pressure or time go too. A leg without a rule is an error
    when `strict`, otherwise it is left as it is.
    """
    width = tm.minutes_us(buffer_minutes)
    has_rule = rules.select("leg").distinct().withColumn("_ruled", F.lit(True))
    judged = df.join(has_rule, "leg", "left")
    if strict:
        missing = F.concat(F.lit("no pressure removal rule for leg "), F.col("leg").cast("string"))
        judged = judged.withColumn("_ruled", F.when(F.col("_ruled").isNull(), F.raise_error(missing)).otherwise(True))
        judged = judged.where("_ruled")
    usable = F.col(pressure).isNotNull() & F.col(time).isNotNull()
    kept = judged.where(usable | F.col("_ruled").isNull()).select(*df.columns)
    out = pressure_exclusions(kept.where(usable), rules, keys, pressure, time, width)
    # Stretches are more than a buffer apart before the buffer is added, so they do not overlap.
    return ranges.in_any_window(kept, out, keys, time, anti=True, disjoint=True)


def spike_columns(df: DataFrame, time: str, skip: list[str] = ()) -> list[str]:
    """Numeric columns whose name holds none of the excluded parts."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    return [
        name
        for name, kind in df.dtypes
        if kind in numeric
        and name != time
        and name not in skip
        and not any(part in name.lower() for part in schema.SPIKE_EXCLUDED_NAMES)
    ]


def _spike_blanker(columns: list[str], kept: list[str], window_us: int, limit: float):
    """Task function: one chunk with its margins in, the chunk's own rows with spikes blanked out.

    Only the judged columns leave Arrow. It is built here and uses nothing
    else of the package, so that workers need not have the package installed.
    """

    def blank(chunk: pa.Table) -> pa.Table:
        us = chunk.column("_us").to_numpy()
        order = np.argsort(us, kind="stable")
        index = pd.to_datetime(us[order], unit="us")
        window = pd.Timedelta(window_us, unit="us")
        own = pc.equal(chunk.column("_home"), chunk.column("_chunk"))
        out = chunk.select(kept)
        for name in columns:
            values = pd.Series(chunk.column(name).to_numpy().astype("float64")[order], index=index)
            deviation = (values - values.rolling(window, center=True, min_periods=3).median()).abs()
            spread = deviation.rolling(window, center=True, min_periods=3).median()
            spike = np.empty(len(us), dtype=bool)
            spike[order] = (deviation > limit * spread).to_numpy()
            column = out.column(name)
            clean = pc.if_else(pa.array(spike), pa.scalar(None, column.type), column)
            out = out.set_column(out.schema.get_field_index(name), name, clean)
        return out.filter(own)

    return blank


def blank_spikes(
    df: DataFrame, keys: list[str], columns: list[str], time: str = "time",
    window_minutes: float = schema.HAMPEL_WINDOW_MINUTES, sigmas: float = schema.HAMPEL_SIGMAS, untimed: bool = True,
) -> DataFrame:
    """Blank values far from the median around them, measured by the median absolute deviation.

    The frame is (t - w/2, t + w/2], and fewer than three values judge
    nothing. The deviation of a row is compared with deviations up to half a
    window away, and those rest on medians half a window further. So a series
    is cut into chunks of 64 windows, each with a margin of one whole window
    copied from its neighbours, and chunks run independently. A task holds one
    chunk, whose size is the sampling rate times 64 windows (exact copies are
    dropped before). A framed percentile of the SQL engine builds every frame
    anew, which takes frame size times longer than the rolling median used in
    the tasks. Rows without time are kept and never blanked; `untimed` says
    that there may be any.
    """
    width = tm.minutes_us(window_minutes)
    chunk = _CHUNK_WINDOWS * width
    us = tm.micros(time)
    home = tm.bucket(F.col("_us"), chunk)
    reach = F.array_distinct(
        F.array(home, tm.bucket(F.col("_us") - width, chunk), tm.bucket(F.col("_us") + width, chunk))
    )
    timed = df.where(F.col(time).isNotNull()).withColumn("_us", us)
    copies = timed.withColumn("_home", home).withColumn("_chunk", F.explode(reach))
    blank = _spike_blanker(columns, df.columns, width, sigmas * schema.MAD_TO_SIGMA)
    judged = copies.groupBy(*keys, "_chunk").applyInArrow(blank, df.schema)
    return judged.unionByName(df.where(F.col(time).isNull())) if untimed else judged


def removed_rows(raw: DataFrame, cleaned: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Raw rows whose time does not occur among the cleaned rows."""
    return raw.join(cleaned.select(*keys, time).distinct(), [*keys, time], "left_anti")


def raw_and_clean(
    raw: DataFrame, cleaned: DataFrame, keys: list[str], columns: list[str], tie: list[str] = (), time: str = "time"
) -> DataFrame:
    """Raw and cleaned value side by side, one row per time on each side."""

    def first_per_time(df: DataFrame, suffix: str) -> DataFrame:
        values = F.struct(*[F.col(c).alias(f"{c}_{suffix}") for c in columns])
        order = [c for c in tie if c in df.columns]
        best = F.min_by(values, F.struct(*order)) if order else F.min(values)
        return df.groupBy(*keys, time).agg(best.alias("_v")).select(*keys, time, "_v.*")

    return first_per_time(raw, "raw").join(first_per_time(cleaned, "clean"), [*keys, time])


def cleaning_diagnostics(
    raw: DataFrame, cleaned: DataFrame, keys: list[str], columns: list[str], optical: list[str],
    tie: list[str] = (), time: str = "time",
) -> DataFrame:
    """Per key and variable: raw rows, rows removed (and percent), cells blanked as zero and as spike."""
    kept = cleaned.select(*keys, time).distinct().withColumn("_kept", F.lit(True))
    removed = (
        raw.join(kept, [*keys, time], "left")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_raw"), F.count_if(F.col("_kept").isNull()).alias("n_removed"))
        .withColumn("pct_removed", F.bround(F.col("n_removed") / F.col("n_raw") * 100, 1))
    )
    pairs = raw_and_clean(raw, cleaned, keys, columns, tie, time)
    counts = []
    for c in columns:
        blanked = F.col(f"{c}_raw").isNotNull() & F.col(f"{c}_clean").isNull()
        zero = blanked & (F.col(f"{c}_raw") <= 0) if c in optical else F.lit(False)
        counts.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.count_if(zero).alias("n_zero"),
                F.count_if(blanked & ~zero).alias("n_spike"),
            )
        )
    per_variable = pairs.groupBy(*keys).agg(F.array(*counts).alias("_v")).select(*keys, F.inline("_v"))
    return removed.join(per_variable, keys)
