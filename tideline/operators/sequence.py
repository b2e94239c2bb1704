"""Row-order operations that never put a whole series into one task.

A series is cut into chunks that follow its order. Windows run inside (key,
chunk); what has to cross a chunk edge is carried by a summary of one row per
chunk. So one long or busy instrument spreads over as many tasks as it has
chunks. Key columns must not be NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.session import materialize

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def _merge(kind: str, before: Column, here: Column) -> Column:
    if kind == "sum":
        return F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0))
    pick = F.greatest if kind == "max" else F.least
    return pick(before, here)


_CUTS = 11  # halvings of a key's rows, at most


def chunk_edges(df: DataFrame, keys: list[str], value: Column, rows: int) -> DataFrame:
    """(keys, _halvings, _edges): where to cut each key's values so that a chunk holds about `rows` of them, at most 2 ** 11 chunks a key.

    The edges come from a quantile sketch, so they follow the values and not the clock. They are written once, so that all
    steps cut alike. A key has one edge between two chunks and no more, so edges are as many as its rows need; keys with few rows have none.
    """
    shares = F.array(*[F.lit(k / 2**_CUTS) for k in range(1, 2**_CUTS)])
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.percentile_approx(value, shares, 20_000).alias("_edges"))
    halvings = F.least(F.ceil(F.log2(F.greatest(F.col("_rows") / float(rows), F.lit(1.0)))), F.lit(_CUTS)).cast("int")
    halved = found.select(*keys, "_edges", halvings.alias("_halvings"))
    step = (F.lit(1 << _CUTS) / _chunks(F.col("_halvings"))).cast("int")
    needed = F.transform(F.sequence(F.lit(1), _chunks(F.col("_halvings")) - 1), lambda k: F.element_at("_edges", k * step))
    return materialize(halved.select(*keys, "_halvings", F.when(F.col("_halvings") > 0, needed).alias("_edges")), "edges")


def _chunks(halvings: Column) -> Column:
    return F.pow(F.lit(2.0), halvings).cast("int")


def chunk_of(value: Column, halvings: Column, edges: Column) -> Column:
    """Number of the chunk that holds a value: how many edges are not above it, found by as many halvings; numbers rise with values."""

    def half(place: Column, k: Column) -> Column:
        further = (place + F.pow(F.lit(2.0), halvings - k)).cast("int")
        return F.when(F.element_at(edges, further) <= value, further).otherwise(place)

    found = F.aggregate(F.sequence(F.lit(1), halvings), F.lit(0), half)
    # Never NULL, so that no filter on it is derived: Spark would push one that looks into a lambda to the wrong side of a join.
    return F.coalesce(F.when(halvings > 0, found), F.lit(0))


def chunk_bounds(chunk: Column, halvings: Column, edges: Column) -> tuple[Column, Column]:
    """Values at which a chunk begins and the next one does; NULL at the ends of all."""
    after = chunk + 1
    inner = after < _chunks(halvings)
    return F.when(chunk > 0, F.element_at(edges, F.greatest(chunk, F.lit(1)))), F.when(inner, F.element_at(edges, F.when(inner, after)))


def with_equal_chunks(df: DataFrame, keys: list[str], value: Column, rows: int, name: str = "_chunk", width: int = tm.HOUR) -> DataFrame:
    """Add the number of the chunk of about `rows` rows, by rising value, that each row is in; equal values share one.

    Rows are counted per bucket of `width`; neighbouring buckets make up a chunk, and a bucket of more rows is cut into
    equal parts. Only exact counts decide, so a repeated task cuts as before.
    """
    held = df.withColumn("_value", value).withColumn("_bucket", tm.bucket(F.col("_value"), width))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = held.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    first = F.floor(F.coalesce(F.sum("_rows").over(before), F.lit(0)) / F.lit(rows))
    cuts = counts.select(*keys, "_bucket", first.alias("_first"), F.ceil(F.col("_rows") / F.lit(rows)).alias("_parts"))
    inside = F.floor((F.col("_value") - F.col("_bucket") * F.lit(width)) * F.col("_parts") / F.lit(width))
    # Never NULL, so that no filter on it is derived for one side only and joins by it share their shuffle.
    chunk = F.coalesce(F.col("_first") + inside, F.lit(0))
    return held.join(cuts, [*keys, "_bucket"]).withColumn(name, chunk).select(*df.columns, name)


def time_chunk(time: str, width: int = tm.DAY) -> Column:
    return tm.bucket(tm.micros(time), width)


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], chunk: Column, columns: dict[str, Column]
) -> DataFrame:
    """Add, under each name, that expression's value on the row before (NULL on the first row)."""
    rows = df.withColumn("_chunk", chunk).withColumn("_now", F.struct(*[c.alias(n) for n, c in columns.items()]))
    position = F.struct(*order)
    last = rows.groupBy(*keys, "_chunk").agg(F.max_by("_now", position).alias("_last"))
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    carried = last.select(*keys, "_chunk", F.lag("_last").over(by_chunk).alias("_carried"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    previous = F.when(F.row_number().over(inside) == 1, F.col("_carried")).otherwise(F.lag("_now").over(inside))
    joined = rows.join(carried, [*keys, "_chunk"], "left").withColumn("_before", previous)
    return joined.select(*df.columns, *[F.col("_before")[name].alias(name) for name in columns])


def with_running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    chunk: Column,
    aggregates: dict[str, tuple[str, Column]],
    include_current: bool = True,
) -> DataFrame:
    """Add running aggregates ("sum", "max" or "min") over all rows of the key up to each row.

    Rows with equal order values are taken one after the other, so `order`
    should be unique within a key where that matters. A running "last" value is
    a "max" over a struct that starts with the order columns.
    """
    names = list(aggregates)
    inputs = {f"_in_{n}": column for n, (_, column) in aggregates.items()}
    rows = df.withColumn("_chunk", chunk).withColumns(inputs)
    totals = rows.groupBy(*keys, "_chunk").agg(
        *[_AGGREGATES[aggregates[n][0]](f"_in_{n}").alias(f"_all_{n}") for n in names]
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        "_chunk",
        *[_AGGREGATES[aggregates[n][0]](f"_all_{n}").over(before).alias(f"_carry_{n}") for n in names],
    )
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    local = {f"_here_{n}": _AGGREGATES[aggregates[n][0]](f"_in_{n}").over(inside) for n in names}
    joined = rows.join(carried, [*keys, "_chunk"], "left").withColumns(local)
    return joined.select(
        *df.columns,
        *[_merge(aggregates[n][0], F.col(f"_carry_{n}"), F.col(f"_here_{n}")).alias(n) for n in names],
    )


def join_summary(rows: DataFrame, summary: DataFrame, keys: list[str], by: Column, parts: int = 64) -> DataFrame:
    """Rows with the columns of a summary that has one row per key.

    The summary is repeated for `parts` shares and each row goes to the share that `by` hashes to, so that
    the rows of one busy key meet it in many tasks.
    """
    shares = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_share")
    dealt = rows.withColumn("_share", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    return dealt.join(summary.select("*", shares), [*keys, "_share"]).drop("_share")


def with_row_number(df: DataFrame, keys: list[str], order: list[str], chunk: Column, name: str) -> DataFrame:
    """Number the rows of each key from 1 in order."""
    return with_running(df, keys, order, chunk, {name: ("sum", F.lit(1).cast("long"))})


def day_rollover(df: DataFrame, keys: list[str], order: list[str], chunk: Column, clock_us: Column) -> DataFrame:
    """Add `day_offset`: how often the time of day has gone backwards so far (midnight passed)."""
    stepped = with_previous(df.withColumn("_clock", clock_us), keys, order, chunk, {"_clock_before": F.col("_clock")})
    wrapped = F.when(F.col("_clock") < F.col("_clock_before"), 1).otherwise(0).cast("long")
    counted = with_running(stepped, keys, order, chunk, {"day_offset": ("sum", wrapped)})
    return counted.drop("_clock", "_clock_before")


def thin_to_step(df: DataFrame, keys: list[str], time: str, step: int = tm.SECOND, tie: list[str] = ()) -> DataFrame:
    """First row of every time step per key; an aggregation, so nothing is sorted."""
    step_no = tm.bucket(tm.micros(time), step)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(tm.micros(time), *tie)).alias("_row")
    picked = df.where(F.col(time).isNotNull()).groupBy(*keys, step_no.alias("_step")).agg(first)
    return picked.select(*keys, "_row.*").select(*df.columns)


def pick_by_precedence(df: DataFrame, keys: list[str], rank: list[str]) -> DataFrame:
    """One row per key: the one with the lowest rank (a recording held in two folders)."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*rank)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def thin_every_nth(
    df: DataFrame, keys: list[str], order: list[str], chunk: Column, target: int
) -> DataFrame:
    """Every n-th row per key, n = rows // target + 1 where there are more than `target` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    step = F.when(F.col("_rows") > target, F.expr(f"_rows div {target}") + 1).otherwise(F.lit(1))
    numbered = with_row_number(df, keys, order, chunk, "_no")
    stepped = join_summary(numbered, counts.select(*keys, step.alias("_step")), keys, F.col("_no"))
    kept = stepped.where((F.col("_no") - 1) % F.col("_step") == 0)
    return kept.select(*df.columns)


def flagged_runs(
    df: DataFrame, keys: list[str], time: str, flag: Column, chunk: Column | None = None
) -> DataFrame:
    """Runs of consecutive flagged rows as (first_time, last_time, n_rows).

    Rows of one run share the last unflagged time before them, so a run is a
    group and needs no row numbers.
    """
    us = tm.micros(time)
    rows = df.where(F.col(time).isNotNull()).select(*keys, us.alias("_us"), flag.alias("_flag"))
    marked = with_running(
        rows,
        keys,
        ["_us"],
        tm.bucket(F.col("_us"), tm.DAY) if chunk is None else chunk,
        {"_since": ("max", F.when(~F.col("_flag"), F.col("_us")))},
    )
    # Without any unflagged row before, the run starts at the beginning of the series.
    since = F.coalesce(F.col("_since"), F.lit(-(2**62)))
    return (
        marked.where("_flag")
        .groupBy(*keys, since.alias("_since"))
        .agg(F.min("_us").alias("_a"), F.max("_us").alias("_b"), F.count(F.lit(1)).alias("n_rows"))
        .select(
            *keys,
            F.timestamp_micros("_a").alias("first_time"),
            F.timestamp_micros("_b").alias("last_time"),
            "n_rows",
        )
    )
