"""Joins of times with intervals, and the algebra of intervals.

Intervals are spread over the time buckets they touch and joined on (key,
bucket), so no nested-loop join is planned. Membership tests first merge
overlapping windows, so a row meets only disjoint windows of its own bucket.
Nothing is broadcast by hint: the runtime does so where the measured size of a
side allows it.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.operators import sequence as seq
from tideline.session import materialize

_ROWS_AT_ONCE = 50_000  # intervals or ends of one key that a task orders, about
_SWEPT_AT_ONCE = 5_000  # intervals of one key that a task sweeps, about, besides those open all along


def clip_to_leg(df: DataFrame, windows: DataFrame, time: str, optional: bool = False) -> DataFrame:
    """Rows inside their leg's window, ends included. With `optional`, legs without a window stay whole."""
    bounds = windows.select("leg", F.col("start").alias("_start"), F.col("end").alias("_end"))
    joined = df.where(F.col(time).isNotNull()).join(bounds, "leg", "left" if optional else "inner")
    inside = F.col(time).between(F.col("_start"), F.col("_end"))
    if optional:
        inside = F.col("_start").isNull() | inside
    return joined.where(inside).select(*df.columns)


def interval_union(
    intervals: DataFrame, keys: list[str], start: str = "start", end: str = "end", rows_at_once: int = _ROWS_AT_ONCE
) -> DataFrame:
    """Merge overlapping and touching intervals per key.

    Intervals of equal start become one before anything is shuffled whole. The rest are merged inside chunks of about
    `rows_at_once` starts, however crowded a day is. How far the
    earlier chunks reach then decides which of a chunk's merged intervals
    continue the last one before it.
    """
    rows = intervals.select(
        *keys, tm.micros(start).alias("_a"), tm.micros(end).alias("_b")
    ).where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    longest = rows.groupBy(*keys, "_a").agg(F.max("_b").alias("_b"))
    chunked = seq.with_equal_chunks(longest, keys, F.col("_a"), rows_at_once)
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_a", "_b")
    before = F.max("_b").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    local = (
        chunked.withColumn("_opens", F.when(before.isNull() | (F.col("_a") > before), F.col("_a")))
        .withColumn("_local", F.max("_opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_chunk", "_local")
        .agg(F.max("_b").alias("_b"))
    )
    chunks = local.groupBy(*keys, "_chunk").agg(F.max("_b").alias("_last"), F.max("_local").alias("_latest"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        chunks.withColumn("_reach", F.max("_last").over(earlier))
        .withColumn("_free", F.when(F.col("_reach").isNull() | (F.col("_latest") > F.col("_reach")), F.col("_latest")))
        .select(*keys, "_chunk", "_reach", F.max("_free").over(earlier).alias("_open"))
    )
    free = F.col("_reach").isNull() | (F.col("_local") > F.col("_reach"))
    return (
        local.join(carried, [*keys, "_chunk"])
        .groupBy(*keys, F.when(free, F.col("_local")).otherwise(F.col("_open")).alias("_island"))
        .agg(F.max("_b").alias("_b"))
        .select(*keys, F.timestamp_micros("_island").alias(start), F.timestamp_micros("_b").alias(end))
    )


def _touched(start_us: Column, end_us: Column, width: int) -> Column:
    return F.explode(F.sequence(tm.bucket(start_us, width), tm.bucket(end_us, width)))


def in_any_window(
    df: DataFrame, windows: DataFrame, keys: list[str], time: str = "time", width: int = tm.HOUR, anti: bool = False,
    disjoint: bool = False,
) -> DataFrame:
    """Rows whose time lies in any window of their key, ends included (or in none, with `anti`).

    `disjoint` says that windows share no more than end points, which saves merging them.
    """
    merged = windows if disjoint else interval_union(windows, keys)
    pieces = merged.select(
        *keys,
        tm.micros("start").alias("_a"),
        tm.micros("end").alias("_b"),
        _touched(tm.micros("start"), tm.micros("end"), width).alias("_bucket"),
    )
    left = df.withColumn("_us", tm.micros(time)).withColumn("_bucket", tm.bucket(F.col("_us"), width)).alias("l")
    right = pieces.alias("r")
    match = (F.col("l._bucket") == F.col("r._bucket")) & F.col("l._us").between(F.col("r._a"), F.col("r._b"))
    for k in keys:
        match = match & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    return left.join(right, match, "left_anti" if anti else "left_semi").select(*df.columns)


def in_window_pairs(times: DataFrame, windows: DataFrame, keys: list[str], width: int = tm.HOUR) -> DataFrame:
    """(key, _w0, _w1, _us) for every time `_us` in every window [_w0, _w1] of its key that holds it."""
    pieces = windows.select(*keys, "_w0", "_w1", _touched(F.col("_w0"), F.col("_w1"), width).alias("_bucket"))
    rows = times.withColumn("_bucket", tm.bucket(F.col("_us"), width))
    joined = rows.join(pieces, [*keys, "_bucket"])
    return joined.where(F.col("_us").between(F.col("_w0"), F.col("_w1"))).select(*keys, "_w0", "_w1", "_us")


def assign_window(
    df: DataFrame, windows: DataFrame, columns: list[str], time: str = "time", width: int = tm.DAY
) -> DataFrame:
    """Inner join of rows with the windows that hold their time, adding `columns` of the window."""
    pieces = windows.select(
        *columns,
        tm.micros("start").alias("_a"),
        tm.micros("end").alias("_b"),
        _touched(tm.micros("start"), tm.micros("end"), width).alias("_bucket"),
    )
    us = tm.micros(time)
    rows = df.withColumn("_bucket", tm.bucket(us, width))
    joined = rows.join(pieces, "_bucket").where(us.between(F.col("_a"), F.col("_b")))
    return joined.select(*df.columns, *columns)


def interval_intersection(
    first: DataFrame, second: DataFrame, keys: list[str], start: str = "start", end: str = "end", rows_at_once: int = _ROWS_AT_ONCE
) -> DataFrame:
    """Where the merged intervals of both sides overlap, pieces of positive length only.

    A sweep over interval ends: between two neighbouring ends the number of
    open intervals of either side is constant, so no pairs are formed.
    """

    def ends(df: DataFrame, side: str) -> DataFrame:
        merged = interval_union(df, keys, start, end, rows_at_once)
        zero = F.lit(0).cast("long")
        one = F.lit(1).cast("long")
        step = [(one if side == s else zero) for s in ("a", "b")]
        return merged.select(
            *keys,
            F.explode(
                F.array(
                    F.struct(tm.micros(start).alias("_us"), step[0].alias("_da"), step[1].alias("_db")),
                    F.struct(tm.micros(end).alias("_us"), (-step[0]).alias("_da"), (-step[1]).alias("_db")),
                )
            ).alias("_e"),
        ).select(*keys, "_e.*")

    points = (
        ends(first, "a")
        .unionByName(ends(second, "b"))
        .groupBy(*keys, "_us")
        .agg(F.sum("_da").alias("_da"), F.sum("_db").alias("_db"))
    )
    # The state a point ends is that of all points before it.
    swept = seq.with_running(
        seq.with_equal_chunks(points, keys, F.col("_us"), rows_at_once, "_part"),
        keys,
        ["_us"],
        F.col("_part"),
        {"_from": ("max", F.col("_us")), "_open_a": ("sum", F.col("_da")), "_open_b": ("sum", F.col("_db"))},
        include_current=False,
    )
    both = swept.where((F.col("_open_a") > 0) & (F.col("_open_b") > 0))
    return both.select(*keys, F.timestamp_micros("_from").alias(start), F.timestamp_micros("_us").alias(end))



def _open_pairs() -> Callable:
    """Task function: seconds shared, first and last shared time of each pair of names that are open at once in a chunk.

    Intervals are taken by rising start; those still open when one starts are the active set, so a pair of intervals is looked at only
    if it overlaps. It is built here, so that workers need not have the package installed.
    """

    def sweep(table: pa.Table) -> pa.Table:
        import numpy as np

        s, e = table.column("_s").to_numpy(), table.column("_e").to_numpy()
        codes = table.column("_name").combine_chunks().dictionary_encode()
        names, code = codes.dictionary, codes.indices.to_numpy()
        order = np.lexsort((e, s))
        # Places of names in their own order, so that the smaller name of a pair is known by number.
        by_name = np.argsort(np.array(names.to_pylist(), dtype=object), kind="stable")
        rank = np.empty(len(by_name), np.int64)
        rank[by_name] = np.arange(len(by_name))
        active = np.zeros(0, np.int64)
        left, right, low, high = [], [], [], []
        for k in order:
            active = active[e[active] > s[k]]
            if e[k] > s[k]:
                if len(active):
                    left.append(rank[code[active]])
                    right.append(np.full(len(active), rank[code[k]]))
                    low.append(np.full(len(active), s[k]))
                    high.append(np.minimum(e[active], e[k]))
                active = np.append(active, k)
        if not left:
            left = right = low = high = [np.zeros(0, np.int64)]
        a, b, low, high = (np.concatenate(x) for x in (left, right, low, high))
        a, b = np.minimum(a, b), np.maximum(a, b)
        pair, which = np.unique(a * len(names) + b, return_inverse=True)
        total, least, most = np.zeros(len(pair), np.int64), np.full(len(pair), np.iinfo(np.int64).max), np.full(len(pair), np.iinfo(np.int64).min)
        np.add.at(total, which, high - low)
        np.minimum.at(least, which, low)
        np.maximum.at(most, which, high)
        named = [names.take(pa.array(by_name[x])) for x in (pair // max(len(names), 1), pair % max(len(names), 1))]
        keyed = [table.column(c).combine_chunks().take(pa.array(np.zeros(len(pair), np.int64))) for c in table.column_names if c.startswith("_key")]
        columns = [*keyed, *named, pa.array(total), pa.array(least), pa.array(most)]
        return pa.table(columns, names=[*(c for c in table.column_names if c.startswith("_key")), "_a", "_b", "_shared", "_low", "_high"])

    return sweep


def pairwise_overlaps(
    intervals: DataFrame, keys: list[str], name: str, start: str = "start", end: str = "end", rows_at_once: int = _SWEPT_AT_ONCE
) -> DataFrame:
    """For names a < b of one key: the time both cover. Intervals of one name are merged first.

    A sweep along time: intervals are cut at the edges of chunks of about `rows_at_once` starts, which carries open names over the
    edges, and each chunk adds up what its pairs share. No two intervals meet that do not overlap.
    """
    merged = interval_union(intervals.where(F.col(name).isNotNull()), [*keys, name], start, end).select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(name).alias("_name"), tm.micros(start).alias("_s"), tm.micros(end).alias("_e")
    )
    merged = materialize(merged, "merged")
    named = [f"_key{i}" for i in range(len(keys))]
    edges = seq.chunk_edges(merged, named, F.col("_s"), rows_at_once)
    met = seq.join_summary(merged, edges, named, F.col("_s"))
    first, last = (seq.chunk_of(F.col(c), F.col("_halvings"), F.col("_edges")) for c in ("_s", "_e"))
    parted = met.withColumn("_chunk", F.explode(F.sequence(first, last)))
    low, high = seq.chunk_bounds(F.col("_chunk"), F.col("_halvings"), F.col("_edges"))
    cut = parted.select(*named, "_chunk", "_name", F.greatest("_s", low).alias("_s"), F.least("_e", high).alias("_e"))
    kinds = {f.name: f.dataType.simpleString() for f in merged.schema}
    shape = ", ".join([*(f"{k} {kinds[k]}" for k in named), f"_a {kinds['_name']}", f"_b {kinds['_name']}", "_shared long, _low long, _high long"])
    found = cut.groupBy(*named, "_chunk").applyInArrow(_open_pairs(), shape)
    return (
        found.groupBy(*named, "_a", "_b")
        .agg(F.sum("_shared").alias("_shared"), F.min("_low").alias("_low"), F.max("_high").alias("_high"))
        .select(
            *[F.col(n).alias(k) for n, k in zip(named, keys, strict=True)],
            F.col("_a").alias(f"{name}_a"),
            F.col("_b").alias(f"{name}_b"),
            F.bround(F.col("_shared") / float(tm.HOUR), 2).alias("overlap_hours"),
            F.timestamp_micros("_low").alias("overlap_start"),
            F.timestamp_micros("_high").alias("overlap_end"),
        )
    )


def prune_by_start(files: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Files that may hold data of a window when only their start is known.

    Per window: the last file starting at or before it, and every file
    starting inside it. A file counts as lasting until the next one starts.
    Files that start together are ordered by name.
    """
    starts = files.where(F.col("start").isNotNull()).withColumn("_us", tm.micros("start"))
    # The same walk backwards: negate the order to look at the following file.
    backwards = starts.withColumns({"_neg": -F.col("_us"), "_last": F.col("file_name")})
    grouped = backwards.groupBy(*keys, "_us", "_neg").agg(F.max("file_name").alias("_last_name"))
    nexts = seq.with_previous(
        grouped, keys, ["_neg"], tm.bucket(F.col("_neg"), 30 * tm.DAY), {"_next": F.col("_us")}
    )
    spans = nexts.select(*keys, "_us", "_last_name", F.coalesce("_next", F.lit(2**62)).alias("_next"))
    known = starts.select(*keys, "file_name", "_us").join(spans, [*keys, "_us"])
    # Only the last of the files that share a start runs on until the next start.
    until = F.when(F.col("file_name") == F.col("_last_name"), F.col("_next") - 1).otherwise(F.col("_us"))
    held = windows.select(*keys, tm.micros("start").alias("_w0"), tm.micros("end").alias("_w1"))
    first_window = held.groupBy(*keys).agg(F.min("_w0").alias("_min"), F.max("_w1").alias("_max"))
    bounded = (
        known.join(first_window, keys)
        .withColumn("_until", F.least(until, F.col("_max")))
        .where((F.col("_us") <= F.col("_max")) & (F.col("_until") >= F.col("_us")))
        .withColumn("_lo", F.greatest("_us", "_min"))
        .where(F.col("_until") >= F.col("_lo"))
    )
    hit = _overlapping(
        bounded.select(*keys, "file_name", F.col("_lo").alias("_a"), F.col("_until").alias("_b")), held, keys
    )
    return hit.select(*keys, "file_name")


def prune_by_range(files: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Files whose [start, end] meets a window, ends included.

    Where a relevant file of a key has no time range in its name nothing can
    be ruled out, and all files of that key are kept.
    """
    readable = files.groupBy(*keys).agg(F.bool_and(F.col("start").isNotNull() & F.col("end").isNotNull()).alias("_named"))
    judged = seq.join_summary(files, readable, keys, F.col("file_name"))
    held = windows.select(*keys, tm.micros("start").alias("_w0"), tm.micros("end").alias("_w1"))
    # A span is cut to the time that windows cover at all, so that a far end in a name costs nothing.
    covered = held.groupBy(*keys).agg(F.min("_w0").alias("_min"), F.max("_w1").alias("_max"))
    timed = (
        seq.join_summary(judged.where("_named"), covered, keys, F.col("file_name"))
        .select(
            *keys, "file_name",
            F.greatest(tm.micros("start"), F.col("_min")).alias("_a"), F.least(tm.micros("end"), F.col("_max")).alias("_b"),
        )
        .where("_a <= _b")
    )
    return (
        _overlapping(timed, held, keys)
        .select(*keys, "file_name")
        .unionByName(judged.where(~F.col("_named")).select(*keys, "file_name"))
    )


def _overlapping(spans: DataFrame, held: DataFrame, keys: list[str], width: int = tm.DAY) -> DataFrame:
    """Distinct spans [_a, _b] that meet a window [_w0, _w1]."""
    left = spans.withColumn("_bucket", _touched(F.col("_a"), F.col("_b"), width)).alias("l")
    right = held.withColumn("_bucket", _touched(F.col("_w0"), F.col("_w1"), width)).alias("r")
    match = (
        (F.col("l._bucket") == F.col("r._bucket"))
        & (F.col("l._a") <= F.col("r._w1"))
        & (F.col("l._b") >= F.col("r._w0"))
    )
    for k in keys:
        match = match & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    return left.join(right, match, "left_semi").select(*spans.columns).distinct()


def stale_files(files: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Raw files whose output is missing or older, matched by file stem."""
    return (
        files.join(outputs.select(*keys, "stem", "processed_mtime"), [*keys, "stem"], "left")
        .where(F.col("processed_mtime").isNull() | (F.col("raw_mtime") > F.col("processed_mtime")))
        .select(*files.columns)
    )
