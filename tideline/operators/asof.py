"""Nearest-in-time joins with a tolerance.

Left rows as they are and right rows of a few columns are laid on one grid of
buckets several tolerances wide; a right row also goes to the neighbouring
bucket it can reach. Inside (key, bucket) one sort finds the last right row at
or before and the first right row after every left row. So left rows are shuffled once, and no pairs of rows
are formed however dense the two sides are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import time as tm

_BUCKET_TOLERANCES = 16


@dataclass
class Source:
    """A right side: `columns` maps output names to right-side expressions.

    Rows where any of them is NULL take no part, so they cannot hide a usable
    neighbour. Of several rows at one time the one with the lowest `prefer`
    values wins, then the lowest column values. `shift_us` moves the time that
    is looked up: -30 s looks for the fix nearest to 30 s before the left row.
    """

    df: DataFrame
    columns: dict[str, Column | str]
    tolerance_us: int
    time: str = "time"
    prefer: list[Column | str] = field(default_factory=list)
    shift_us: int = 0
    match_time: str | None = None

    def outputs(self) -> list[str]:
        return [*self.columns, *([self.match_time] if self.match_time else [])]


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _laid_out(source: Source, keys: list[str], side: int, width: int) -> DataFrame:
    """Usable right rows on the grid, exact copies removed before the shuffle. Keys are called _k0, _k1, ..."""
    named = {f"_v{side}_{i}": _column(c) for i, c in enumerate(source.columns.values())}
    prefer = {f"_o{side}_{i}": _column(p) for i, p in enumerate(source.prefer)}
    places = {f"_k{i}": F.col(k) for i, k in enumerate(keys)}
    fixes = source.df.select(
        *[c.alias(n) for n, c in places.items()],
        tm.micros(source.time).alias("_right"),
        *[c.alias(n) for n, c in {**prefer, **named}.items()],
    ).dropna(subset=[*places, "_right", *named]).distinct()
    us = F.col("_right") - source.shift_us
    reach = F.array_distinct(
        F.array(tm.bucket(us - source.tolerance_us, width), tm.bucket(us + source.tolerance_us, width))
    )
    return fixes.select(
        *places,
        F.explode(reach).alias("_bucket"),
        us.alias("_us"),
        F.lit(side).alias("_side"),
        F.struct(*prefer, *named).alias(f"_rank{side}"),
        F.struct(us.alias("us"), F.col("_right").alias("at"), *named).alias(f"_r{side}"),
    )


def nearest_asof(left: DataFrame, sources: list[Source], keys: list[str], time: str = "time") -> DataFrame:
    """Left rows with each source's nearest row within its tolerance, NULL where there is none.

    The tolerance is inclusive and of two rows equally near the earlier wins. Rows without time or with a NULL key stay and match nothing.
    All sources share one grid and one sort.
    """
    width = _BUCKET_TOLERANCES * max(s.tolerance_us for s in sources)
    last_side = len(sources)
    outputs = [n for s in sources for n in s.outputs()]
    kept = [c for c in left.columns if c not in outputs]
    # Rows without time are dealt by a hash, to buckets that no right row is in.
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c, kind in left.dtypes if c in kept and "map<" not in kind and "variant" not in kind])
    untimed = F.lit(-(1 << 62)) - F.pmod(hashed, F.lit(1 << 40))
    us = F.coalesce(tm.micros(time), untimed)
    grid = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        tm.bucket(us, width).alias("_bucket"),
        us.alias("_us"),
        F.lit(last_side).alias("_side"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_left"),
    )
    for side, source in enumerate(sources):
        grid = grid.unionByName(_laid_out(source, keys, side, width), allowMissingColumns=True)

    partition = ", ".join([*(f"_k{i}" for i in range(len(keys))), "_bucket"])
    ranks = ", ".join(f"_rank{i}" for i in range(last_side))
    over = f"OVER (PARTITION BY {partition} ORDER BY _us, _side, {ranks}"
    matched = []
    # Of right rows of one source at one time only the first in order stays.
    repeats = F.expr(f"lag(struct(_us, _side)) {over})") == F.struct("_us", "_side")
    grid = grid.withColumn("_repeats", F.coalesce(repeats, F.lit(False)))
    grid = grid.withColumns({f"_r{i}": F.when(~F.col("_repeats"), F.col(f"_r{i}")) for i in range(last_side)})
    found = grid.select(
        "*",
        *[
            F.expr(f"last(_r{i}) IGNORE NULLS {over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)").alias(f"_p{i}")
            for i in range(last_side)
        ],
        *[F.expr(f"lead(_r{i}) IGNORE NULLS {over})").alias(f"_n{i}") for i in range(last_side)],
    ).where(F.col("_side") == last_side)
    for i, source in enumerate(sources):
        before = F.col("_us") - F.col(f"_p{i}.us")
        after = F.col(f"_n{i}.us") - F.col("_us")
        use_before = (before <= source.tolerance_us) & (after.isNull() | (before <= after))
        near = F.when(use_before, F.col(f"_p{i}")).when(after <= source.tolerance_us, F.col(f"_n{i}"))
        found = found.withColumn(f"_m{i}", near)
        matched += [F.col(f"_m{i}._v{i}_{j}").alias(n) for j, n in enumerate(source.columns)]
        if source.match_time:
            matched.append(F.timestamp_micros(f"_m{i}.at").alias(source.match_time))
    return found.select(*[F.col(f"_left.`{c}`").alias(c) for c in kept], *matched)


def geotag(df: DataFrame, positions: DataFrame, keys: list[str], tolerance_us: int, time: str = "time") -> DataFrame:
    """Attach latitude_deg and longitude_deg of the nearest fix; stale values are replaced."""
    source = Source(
        positions, {"latitude_deg": "latitude_deg", "longitude_deg": "longitude_deg"}, tolerance_us
    )
    return nearest_asof(df, [source], keys, time)
