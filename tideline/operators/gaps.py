"""Gaps, segments and sessions of time series.

All of them rest on one fact: two times in the same bucket of width T are less
than T apart. So per (key, bucket) the first and last time say everything
there is to know about breaks longer than T. That is an aggregation with
map-side combine, and what is left to sort is one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.operators import sequence as seq

# Buckets per chunk: breaks inside a chunk and breaks between chunks are found separately.
_BUCKETS_PER_CHUNK = 4096

GAP_COLUMNS = ["gap_type", "previous_time", "current_time", "gap_minutes", "gap_hours"]
_SIZES = ["total", "max", "mean", "median", "min"]


def _threshold_us(threshold_minutes: float | Column) -> Column:
    if isinstance(threshold_minutes, Column):
        return F.round(threshold_minutes * float(tm.MINUTE)).cast("long")
    return F.lit(tm.minutes_us(threshold_minutes)).cast("long")


def occupied_buckets(df: DataFrame, keys: list[str], time: str, width: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    """First and last time (µs), and row count, per key and bucket of `width`."""
    extra = extra or {}
    us = tm.micros(time)
    rows = df.where(F.col(time).isNotNull()).select(
        *keys, us.alias("_us"), width.alias("_width"), *[c.alias(n) for n, c in extra.items()]
    )
    buckets = rows.withColumn("_bucket", tm.bucket(F.col("_us"), F.col("_width")))
    return (
        buckets.groupBy(*keys, "_width", "_bucket")
        .agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"), F.count(F.lit(1)).alias("_n"),
             *[F.max(n).alias(n) for n in extra])
        .withColumn("_chunk", tm.bucket(F.col("_bucket"), _BUCKETS_PER_CHUNK))
    )


def _steps(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """Every step from one occupied bucket to the next, as (_from, _to)."""
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_bucket")
    near = buckets.select(*keys, "_width", F.lag("_hi").over(inside).alias("_from"), F.col("_lo").alias("_to"))
    chunks = buckets.groupBy(*keys, "_width", "_chunk").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    far = chunks.select(*keys, "_width", F.lag("_hi").over(across).alias("_from"), F.col("_lo").alias("_to"))
    return near.unionByName(far).where(F.col("_from").isNotNull())


def gap_row(keys: list[str], gap_type: str | Column, from_us: Column, to_us: Column) -> list[Column]:
    size = to_us - from_us
    kind = F.lit(gap_type) if isinstance(gap_type, str) else gap_type
    return [
        *[F.col(k) for k in keys],
        kind.alias("gap_type"),
        F.timestamp_micros(from_us).alias("previous_time"),
        F.timestamp_micros(to_us).alias("current_time"),
        F.bround(size / float(tm.MINUTE), 3).alias("gap_minutes"),
        F.bround(size / float(tm.HOUR), 3).alias("gap_hours"),
    ]


def _internal(buckets: DataFrame, keys: list[str]) -> DataFrame:
    steps = _steps(buckets, keys).where(F.col("_to") - F.col("_from") > F.col("_width"))
    return steps.select(*gap_row(keys, "internal", F.col("_from"), F.col("_to")))


def internal_gaps(df: DataFrame, keys: list[str], time: str, threshold_minutes: float | Column) -> DataFrame:
    """Consecutive times more than the threshold apart. The threshold is constant within a key."""
    return _internal(occupied_buckets(df, keys, time, _threshold_us(threshold_minutes)), keys)


def first_and_last(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """First and last time (µs) per key, out of its occupied buckets."""
    return buckets.groupBy(*keys, "_width").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))


def _edges(ends: DataFrame, keys: list[str], windows: DataFrame) -> DataFrame:
    bounds = windows.select("leg", tm.micros("start").alias("_start"), tm.micros("end").alias("_end"))
    both = ends.join(bounds, "leg").withColumn(
        "_edge",
        F.explode(
            F.array(
                F.struct(F.lit("start").alias("kind"), F.col("_start").alias("a"), F.col("_lo").alias("b")),
                F.struct(F.lit("end").alias("kind"), F.col("_hi").alias("a"), F.col("_end").alias("b")),
            )
        ),
    )
    kept = both.where(F.col("_edge.b") - F.col("_edge.a") > F.col("_width"))
    return kept.select(*gap_row(keys, F.col("_edge.kind"), F.col("_edge.a"), F.col("_edge.b")))


def edge_gaps(
    df: DataFrame, keys: list[str], time: str, windows: DataFrame, threshold_minutes: float | Column
) -> DataFrame:
    """Gaps between the leg window and the first and last time inside it. Keys without data have none."""
    buckets = occupied_buckets(df, keys, time, _threshold_us(threshold_minutes))
    return _edges(first_and_last(buckets, keys), keys, windows)


def gaps_and_ends(
    df: DataFrame, keys: list[str], time: str, windows: DataFrame, threshold_minutes: float | Column
) -> tuple[DataFrame, DataFrame]:
    """Internal, start and end gaps, and the first and last time per key. Rows outside their leg window do not count."""
    from tideline.operators.ranges import clip_to_leg

    inside = clip_to_leg(df, windows, time, optional=True)
    buckets = occupied_buckets(inside, keys, time, _threshold_us(threshold_minutes))
    ends = first_and_last(buckets, keys)
    return _internal(buckets, keys).unionByName(_edges(ends, keys, windows)), ends


def find_gaps(
    df: DataFrame, keys: list[str], time: str, windows: DataFrame | None, threshold_minutes: float | Column
) -> DataFrame:
    """All gaps; without windows the internal ones only."""
    if windows is None:
        return internal_gaps(df, keys, time, threshold_minutes)
    return gaps_and_ends(df, keys, time, windows, threshold_minutes)[0]


def without_future_end(gaps: DataFrame, as_of: Column) -> DataFrame:
    """Drop end gaps that reach beyond `as_of`: that leg is not over yet."""
    return gaps.where(~((F.col("gap_type") == "end") & (F.col("current_time") > as_of)))


def gap_statistics(gaps: DataFrame, coverage: DataFrame, keys: list[str], windows: DataFrame) -> DataFrame:
    """One row per expected combination: gap count and sizes, and share of the leg spent in gaps.

    `coverage` has the keys and a boolean `has_data`. A combination with data
    and no gap is OK with zero; one without data is "No data" with NULL
    numbers. A key's gaps are at most its leg length over the threshold, so
    the exact median is taken per key.
    """
    minutes = F.col("gap_minutes")
    sizes = gaps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_gaps"),
        F.bround(F.sum(minutes), 3).alias("total_gap_minutes"),
        F.max(minutes).alias("max_gap_minutes"),
        F.avg(minutes).alias("mean_gap_minutes"),
        F.median(minutes).alias("median_gap_minutes"),
        F.min(minutes).alias("min_gap_minutes"),
    )
    lengths = windows.select(
        "leg", ((tm.micros("end") - tm.micros("start")) / float(tm.MINUTE)).alias("_leg_minutes")
    )
    joined = coverage.join(sizes, keys, "left").join(lengths, "leg", "left")
    ok = F.col("has_data")
    zeroed = joined.withColumns(
        {
            "n_gaps": F.when(ok, F.coalesce("n_gaps", F.lit(0))).cast("long"),
            "total_gap_minutes": F.when(ok, F.coalesce("total_gap_minutes", F.lit(0.0))),
        }
    )
    share = F.when(
        ok & (F.col("_leg_minutes") > 0), F.bround(F.col("total_gap_minutes") / F.col("_leg_minutes") * 100, 2)
    )
    measures = []
    for size in _SIZES:
        in_minutes = F.when(ok, F.col(f"{size}_gap_minutes"))
        measures += [
            in_minutes.alias(f"{size}_gap_minutes"),
            F.bround(in_minutes / 60.0, 3).alias(f"{size}_gap_hours"),
        ]
    return zeroed.select(
        *keys,
        F.when(ok, F.lit("OK")).otherwise(F.lit("No data")).alias("status"),
        "n_gaps",
        *measures,
        share.alias("pct_of_leg_gap"),
    )


def no_data_gaps(coverage: DataFrame, keys: list[str], windows: DataFrame) -> DataFrame:
    """The whole leg window as one gap for combinations without data; NULL times without a window."""
    bounds = windows.select("leg", tm.micros("start").alias("_a"), tm.micros("end").alias("_b"))
    missing = coverage.where(~F.col("has_data")).join(bounds, "leg", "left")
    return missing.select(*gap_row(keys, "No data", F.col("_a"), F.col("_b")))


def covered_intervals(gaps: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """The parts of each window outside its gaps, as (start, end).

    `windows` has the keys, start and end; `gaps` the keys, previous_time and
    current_time. Gaps may touch or overlap: the running latest gap end is the
    point from which time is covered again.
    """
    bounds = windows.select(*keys, tm.micros("start").alias("_start"), tm.micros("end").alias("_end"))
    clipped = (
        gaps.join(bounds, keys)
        .select(
            *keys,
            F.greatest(tm.micros("previous_time"), F.col("_start")).alias("_a"),
            F.least(tm.micros("current_time"), F.col("_end")).alias("_b"),
        )
        .where(F.col("_b") > F.col("_a"))
    )
    # A gap of no length at both window ends makes the first and last stretch ordinary ones.
    ends = bounds.select(
        *keys,
        F.explode(F.array(F.struct(F.col("_start").alias("_a"), F.col("_start").alias("_b")),
                          F.struct(F.col("_end").alias("_a"), F.col("_end").alias("_b")))).alias("_e"),
    ).select(*keys, "_e.*")
    points = clipped.unionByName(ends)
    swept = seq.with_running(
        points, keys, ["_a", "_b"], tm.bucket(F.col("_a"), 30 * tm.DAY), {"_cursor": ("max", F.col("_b"))},
        include_current=False,
    )
    return swept.where(F.col("_a") > F.col("_cursor")).select(
        *keys, F.timestamp_micros("_cursor").alias("start"), F.timestamp_micros("_a").alias("end")
    )


def remaining_gaps(windows: DataFrame, fixes: DataFrame, keys: list[str], threshold_minutes: float) -> DataFrame:
    """Stretches of gap windows (start, end) still longer than the threshold once fixes are counted in."""
    from tideline.operators.ranges import in_window_pairs

    width = _threshold_us(threshold_minutes)
    held = windows.select(*keys, tm.micros("start").alias("_w0"), tm.micros("end").alias("_w1")).distinct()
    inside = in_window_pairs(fixes.select(*keys, tm.micros("time").alias("_us")), held, keys)
    edges = held.select(*keys, "_w0", "_w1", F.explode(F.array("_w0", "_w1")).alias("_us"))
    window_keys = [*keys, "_w0", "_w1"]
    points = edges.unionByName(inside.select(*window_keys, "_us")).withColumn("_t", F.timestamp_micros("_us"))
    steps = _steps(occupied_buckets(points, window_keys, "_t", width), window_keys)
    open_steps = steps.where(F.col("_to") - F.col("_from") > F.col("_width"))
    return open_steps.select(*keys, F.timestamp_micros("_from").alias("start"), F.timestamp_micros("_to").alias("end"))


def _segment_starts(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """Occupied buckets with `_segment`, the time (µs) their segment starts, and `_ordinal`, its number from 0.

    Breaks inside a chunk are seen by a window. The chunk summary tells
    whether a chunk's first bucket starts a segment, and otherwise which
    segment of an earlier chunk it continues.
    """
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_bucket")
    # Said here, the filter the join below would add to one side only; so both sides share one shuffle.
    buckets = buckets.where(F.col("_chunk").isNotNull())
    local = (
        buckets.withColumn("_before", F.lag("_hi").over(inside))
        .withColumn("_starts", F.when(F.col("_lo") - F.col("_before") > F.col("_width"), F.col("_lo")))
        .withColumns({"_local": F.max("_starts").over(inside), "_count": F.count("_starts").over(inside)})
    )
    chunks = local.groupBy(*keys, "_width", "_chunk").agg(
        F.min("_lo").alias("_first"),
        F.max("_hi").alias("_last"),
        F.max("_starts").alias("_latest"),
        F.count("_starts").alias("_n_starts"),
    )
    in_order = Window.partitionBy(*keys).orderBy("_chunk")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    gap_before = F.col("_first") - F.lag("_last").over(in_order)
    heads = (
        chunks.withColumn("_opens", F.when(gap_before.isNull() | (gap_before > F.col("_width")), F.col("_first")))
        .withColumn("_head", F.coalesce(F.col("_opens"), F.max(F.coalesce("_latest", "_opens")).over(earlier)))
        .withColumn(
            "_head_no", F.count("_opens").over(so_far) + F.coalesce(F.sum("_n_starts").over(earlier), F.lit(0)) - 1
        )
        .select(*keys, "_chunk", "_head", "_head_no")
    )
    return local.join(heads, [*keys, "_chunk"]).select(
        *buckets.columns,
        F.coalesce("_local", "_head").alias("_segment"),
        (F.col("_head_no") + F.col("_count")).alias("_ordinal"),
    )


def segments(df: DataFrame, keys: list[str], time: str, max_gap_us: int) -> DataFrame:
    """Stretches without a step longer than `max_gap_us`, as (segment_start, segment_end, n_rows)."""
    found = _segment_starts(occupied_buckets(df, keys, time, F.lit(max_gap_us).cast("long")), keys)
    return (
        found.groupBy(*keys, "_segment")
        .agg(F.max("_hi").alias("_end"), F.sum("_n").alias("n_rows"))
        .select(
            *keys,
            F.timestamp_micros("_segment").alias("segment_start"),
            F.timestamp_micros("_end").alias("segment_end"),
            "n_rows",
        )
    )


def with_segment(df: DataFrame, keys: list[str], time: str, max_gap_us: int) -> DataFrame:
    """Add to each row the start of its segment and the segment's number (from 0) in its key.

    All rows of a bucket are in one segment, so rows join their bucket.
    """
    width = F.lit(max_gap_us).cast("long")
    per_bucket = _segment_starts(occupied_buckets(df, keys, time, width), keys).select(
        *keys, "_bucket", F.timestamp_micros("_segment").alias("segment_start"), F.col("_ordinal").alias("segment_no")
    )
    rows = df.withColumn("_bucket", tm.bucket(tm.micros(time), width))
    return rows.join(per_bucket, [*keys, "_bucket"], "left").select(*df.columns, "segment_start", "segment_no")
