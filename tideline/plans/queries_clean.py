"""Queries over cleaning, positions and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import schema
from tideline.functions import time as tm
from tideline.operators import cleaning, position, sequence, stats
from tideline.plans import products, roles
from tideline.plans.queries_series import _FILL_SQL, _GAP_WINDOWS_SQL, _GGA_SQL, _gap_windows, _remaining_sql, _AS_OF
from tideline.plans.registry import query
from tideline.plans.roles import shown
from tideline.session import materialize

_LEG = ["leg"]
_BUFFER = 15

# Leg 2 has a higher threshold than the others.
_RULES = [(leg, 0.5 if leg == 2 else 0.3) for leg in range(1, 8)]
_RULES_SQL = "(VALUES " + ", ".join(f"({leg}, {limit}::DOUBLE)" for leg, limit in _RULES) + ") AS r(leg, pressure_under)"


def _rules(spark):
    rows = ", ".join(f"({leg}, {limit}D)" for leg, limit in _RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS r(leg, pressure_under)")


def _kept_sql() -> str:
    return f"""(SELECT leg, event_id, instrument, ts, value, user_id FROM (
        SELECT l.*, max(CASE WHEN value < pressure_under THEN ts END) OVER (PARTITION BY l.leg ORDER BY ts
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bad
        FROM {roles.LEGGED_SQL} l JOIN {_RULES_SQL} ON r.leg = l.leg)
        WHERE bad IS NULL OR ts - bad > INTERVAL '{_BUFFER} minutes')"""


@query("pressure_removal", f"SELECT leg, event_id, ts AS time, value FROM {_kept_sql()}")
def pressure_removal(spark, sf_dir):
    rows = roles.legged(spark, sf_dir).select("leg", "event_id", "time", "value")
    return shown(cleaning.remove_low_pressure(rows, _rules(spark), _LEG, "value"))


def _hampel_sql(rows: str, keys: str, column: str, half_us: int, out: str) -> str:
    """`rows` with `out`: the column with spikes blanked."""
    frame = f"OVER (PARTITION BY {keys} ORDER BY epoch_us(ts) RANGE BETWEEN {half_us - 1} PRECEDING AND {half_us} FOLLOWING)"
    return f"""(SELECT * EXCLUDE (med, dev, mad), CASE WHEN dev > 3.0 * 1.4826 * mad THEN NULL ELSE {column} END AS {out}
      FROM (SELECT *, CASE WHEN count(dev) {frame} >= 3 THEN quantile_cont(dev, 0.5) {frame} END AS mad
        FROM (SELECT *, abs({column} - med) AS dev
          FROM (SELECT *, CASE WHEN count({column}) {frame} >= 3 THEN quantile_cont({column}, 0.5) {frame} END AS med
                FROM {rows}))))"""


_EVENT_ROWS = "(SELECT event_type AS instrument, event_id, ts, value FROM events)"


@query(
    "hampel_blank",
    "SELECT instrument, event_id, ts AS time, clean AS value FROM "
    + _hampel_sql(_EVENT_ROWS, "instrument", "value", 60 * tm.MINUTE, "clean"),
)
def hampel_blank(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select("instrument", "event_id", "time", "value")
    return shown(cleaning.blank_spikes(rows, ["instrument"], ["value"], window_minutes=120))


_CHAIN_SQL = _hampel_sql(
    f"(SELECT leg, event_id, instrument, ts, value, CASE WHEN value - 3 > 0 THEN value - 3 END AS optic FROM {_kept_sql()})",
    "leg", "optic", 30 * tm.MINUTE, "clean",
)


def _chain_input(spark, sf_dir):
    return roles.legged(spark, sf_dir).select(
        "leg", "event_id", "time", F.col("value").alias("ts_pressure"), (F.col("value") - 3).alias("trilux_turbidity")
    )


def _chain(spark, sf_dir):
    return products.clean(
        _chain_input(spark, sf_dir), *schema.FERRYBOX, _LEG, _rules(spark), window_minutes=60,
        spikes_in=["trilux_turbidity"],
    )


@query(
    "clean_chain",
    f"SELECT leg, event_id, ts AS time, value AS ts_pressure, round(clean, 6) AS trilux_turbidity FROM {_CHAIN_SQL}",
)
def clean_chain(spark, sf_dir):
    return shown(_chain(spark, sf_dir))


@query(
    "removed_rows",
    f"""SELECT leg, event_id, ts AS time FROM {roles.LEGGED_SQL} l
        WHERE event_id NOT IN (SELECT event_id FROM {_kept_sql()})""",
)
def removed_rows(spark, sf_dir):
    rows = _chain_input(spark, sf_dir)
    kept = cleaning.remove_low_pressure(rows, _rules(spark), _LEG)
    return shown(cleaning.removed_rows(rows.select("leg", "event_id", "time"), kept, _LEG))


@query(
    "removed_runs",
    f"""
    WITH f AS (SELECT l.leg, l.ts, k.event_id IS NULL AS gone FROM {roles.LEGGED_SQL} l
               LEFT JOIN {_kept_sql()} k ON k.event_id = l.event_id),
         n AS (SELECT *, row_number() OVER (PARTITION BY leg ORDER BY ts)
                       - row_number() OVER (PARTITION BY leg, gone ORDER BY ts) AS island FROM f)
    SELECT leg, min(ts) AS first_time, max(ts) AS last_time, count(*) AS n_rows FROM n WHERE gone GROUP BY leg, island
    """,
)
def removed_runs(spark, sf_dir):
    rows = _chain_input(spark, sf_dir).select("leg", "time", "ts_pressure")
    kept = cleaning.remove_low_pressure(rows, _rules(spark), _LEG).select("leg", "time").distinct()
    flagged = rows.join(kept.withColumn("_kept", F.lit(True)), ["leg", "time"], "left")
    return shown(sequence.flagged_runs(flagged, _LEG, "time", F.col("_kept").isNull()))


@query(
    "raw_vs_clean",
    f"""SELECT leg, ts AS time, round(value - 3, 6) AS trilux_turbidity_raw, round(clean, 6) AS trilux_turbidity_clean
        FROM {_CHAIN_SQL}""",
)
def raw_vs_clean(spark, sf_dir):
    raw, clean = _chain_input(spark, sf_dir), _chain(spark, sf_dir)
    return shown(cleaning.raw_and_clean(raw, clean, _LEG, ["trilux_turbidity"], ["event_id"]))


@query(
    "cleaning_diagnostics",
    f"""
    WITH c AS (SELECT leg, value - 3 AS raw, clean FROM {_CHAIN_SQL}),
         v AS (SELECT leg, count(*) FILTER (raw IS NOT NULL AND clean IS NULL AND raw <= 0) AS n_zero,
                      count(*) FILTER (raw IS NOT NULL AND clean IS NULL AND raw > 0) AS n_spike FROM c GROUP BY leg),
         r AS (SELECT leg, count(*) AS n_raw FROM {roles.LEGGED_SQL} GROUP BY leg),
         k AS (SELECT leg, count(*) AS n_kept FROM {_kept_sql()} GROUP BY leg)
    SELECT r.leg, n_raw, n_raw - n_kept AS n_removed, round_even((n_raw - n_kept)::DOUBLE / n_raw * 100, 1) AS pct_removed,
           'trilux_turbidity' AS variable, n_zero, n_spike
    FROM r JOIN k USING (leg) JOIN v USING (leg)
    """,
)
def cleaning_diagnostics(spark, sf_dir):
    return shown(
        cleaning.cleaning_diagnostics(
            _chain_input(spark, sf_dir), materialize(_chain(spark, sf_dir)), _LEG, ["trilux_turbidity"], schema.OPTICAL_COLUMNS,
            ["event_id"],
        )
    )


# --- positions ----------------------------------------------------------------------------------


def _fix_sql(rows: str, source: str, instrument: str) -> str:
    return f"""SELECT leg, ts AS time, {roles.LAT_SQL} AS latitude_deg, {roles.LON_SQL} AS longitude_deg, '{source}' AS source
               FROM {rows} f WHERE instrument = '{instrument}'"""


def _in_sql(windows: str, alias: str = "f") -> str:
    return f"EXISTS (SELECT 1 FROM {windows} w WHERE w.leg = {alias}.leg AND {alias}.ts BETWEEN w.{{0}} AND w.{{1}})"


_BRIDGE_WINDOWS_SQL = _remaining_sql(_GAP_WINDOWS_SQL, _FILL_SQL.replace(
    roles.LEGGED_SQL, f"(SELECT * FROM {roles.LEGGED_SQL} f WHERE {_in_sql(_GAP_WINDOWS_SQL).format('w0', 'w1')})"), 20)
_MERGED_SQL = f"""
    {_fix_sql(roles.LEGGED_SQL, 'GGA', 'view')}
    UNION ALL {_fix_sql(roles.LEGGED_SQL, 'EK80_gps', 'click')} AND {_in_sql(_GAP_WINDOWS_SQL).format('w0', 'w1')}
    UNION ALL {_fix_sql(roles.LEGGED_SQL, 'Ferrybox', 'signup')} AND {_in_sql(_GAP_WINDOWS_SQL).format('w0', 'w1')}
    UNION ALL {_fix_sql(roles.LEGGED_SQL, 'Bridge', 'error')} AND {_in_sql(_BRIDGE_WINDOWS_SQL).format('r0', 'r1')}
"""


def _fixes(spark, sf_dir):
    """The four sources in their own layouts, through their own readers."""
    rows = roles.legged(spark, sf_dir).withColumns({"lat": roles.latitude(), "lon": roles.longitude()})
    gga = position.tagged(rows.where(F.col("instrument") == "view"), _LEG, "GGA", "time", "lat", "lon")
    decoded = rows.where(F.col("instrument") == "click").select(
        "leg", F.lit("time3").alias("time_source"), F.col("time").alias("timestamp"),
        F.col("lat").alias("latitude_mru1"), F.col("lon").alias("longitude_mru1"),
    )
    sampler = rows.where(F.col("instrument") == "signup").select(
        "leg", "time", F.col("lat").alias("latitude"), F.col("lon").alias("longitude")
    )
    bridge = position.tagged(rows.where(F.col("instrument") == "error"), _LEG, "Bridge", "time", "lat", "lon")
    return gga, position.mru_positions(decoded, _LEG), position.ferrybox_positions(sampler, _LEG), bridge


def _merged(spark, sf_dir, stored=None):
    gga, ek80, sampler, bridge = _fixes(spark, sf_dir)
    return products.position_product(
        gga, ek80, sampler, bridge, roles.windows(spark), _LEG, F.expr(f"TIMESTAMP_LTZ'{_AS_OF} UTC'"), 30.0, 20.0, stored
    )


@query("position_merge", _MERGED_SQL)
def position_merge(spark, sf_dir):
    return _merged(spark, sf_dir).withColumn("time", roles.naive("time"))


# The stored table had every bridge fix inside the gaps and half of the sampler's.
@query(
    "keep_earlier_fills",
    f"""
    SELECT leg, time, latitude_deg, longitude_deg, source FROM ({_MERGED_SQL}) WHERE source <> 'Bridge'
    UNION ALL SELECT leg, time, latitude_deg, longitude_deg, source FROM
      ({_fix_sql(roles.LEGGED_SQL, 'Bridge', 'error')} AND {_in_sql(_GAP_WINDOWS_SQL).format('w0', 'w1')})
    """,
)
def keep_earlier_fills(spark, sf_dir):
    _, _, sampler, bridge = _fixes(spark, sf_dir)
    stored = bridge.unionByName(sampler.where(F.col("latitude_deg") < -85))
    return _merged(spark, sf_dir, stored).withColumn("time", roles.naive("time"))


_SECONDS_SQL = f"""(SELECT leg, source, count(*) AS seconds FROM (
    SELECT leg, epoch_us(ts) // 3600000000 AS s, min(CASE instrument WHEN 'view' THEN 0 WHEN 'click' THEN 1
             WHEN 'signup' THEN 2 ELSE 3 END) AS rank
    FROM {roles.LEGGED_SQL} WHERE instrument <> 'purchase' GROUP BY 1, 2)
    JOIN (VALUES (0, 'GGA'), (1, 'EK80_gps'), (2, 'Ferrybox'), (3, 'Bridge')) AS n(rank, source) USING (rank)
    GROUP BY 1, 2)"""


def _coarse_positions(spark, sf_dir):
    """Fixes on a grid of whole hours, so that sources meet in one second."""
    return roles.positions(spark, sf_dir).withColumn("time", tm.floor_time("time", tm.HOUR))


@query(
    "source_seconds",
    f"""
    SELECT k.leg, n.source, coalesce(s.seconds, 0) AS seconds
    FROM (SELECT DISTINCT leg FROM {roles.LEGGED_SQL}) k
    CROSS JOIN (VALUES ('GGA'), ('EK80_gps'), ('Ferrybox'), ('Bridge')) AS n(source)
    LEFT JOIN {_SECONDS_SQL} s ON s.leg = k.leg AND s.source = n.source
    """,
)
def source_seconds(spark, sf_dir):
    return position.source_seconds(_coarse_positions(spark, sf_dir), _LEG)


@query(
    "source_share",
    f"""
    WITH p AS (SELECT leg, coalesce(max(seconds) FILTER (source = 'GGA'), 0) AS a,
                      coalesce(max(seconds) FILTER (source = 'EK80_gps'), 0) AS b,
                      coalesce(max(seconds) FILTER (source = 'Ferrybox'), 0) AS c,
                      coalesce(max(seconds) FILTER (source = 'Bridge'), 0) AS d FROM {_SECONDS_SQL} GROUP BY leg),
         w AS (SELECT p.*, date_diff('second', w_start, w_end)::DOUBLE AS n FROM p JOIN {roles.WINDOWS_SQL} USING (leg))
    SELECT leg, n AS window_seconds, round(a / n * 100, 6) AS gga_pct, round(b / n * 100, 6) AS ek80_gps_pct,
           round(b / 3600.0, 6)::DOUBLE AS ek80_gps_hours, round(c / n * 100, 6) AS ferrybox_pct,
           round(c / 3600.0, 6)::DOUBLE AS ferrybox_hours, round(d / n * 100, 6) AS bridge_pct,
           round(d / 3600.0, 6)::DOUBLE AS bridge_hours, greatest(n - (a + b + c + d), 0) AS seconds_without_fix,
           round(greatest(100 - (a + b + c + d) / n * 100, 0), 6) AS no_fix_pct
    FROM w
    """,
)
def source_share(spark, sf_dir):
    seconds = position.source_seconds(_coarse_positions(spark, sf_dir), _LEG)
    return shown(position.source_share(seconds, roles.windows(spark)))


# --- distributions ------------------------------------------------------------------------------


@query(
    "wind_rose",
    """
    WITH v AS (SELECT event_type AS instrument, CASE WHEN value / 10 < 0.5 THEN -1 ELSE
                 CAST(floor(fmod((event_id * 37) % 360 + 11.25, 360) / 22.5) AS INTEGER) END AS sector,
               CASE WHEN value / 10 < 0.5 THEN -1 WHEN value / 10 < 3 THEN 0 WHEN value / 10 < 6 THEN 1
                    WHEN value / 10 < 9 THEN 2 WHEN value / 10 < 12 THEN 3 WHEN value / 10 < 15 THEN 4 ELSE 5 END
                 AS speed_class FROM events),
         n AS (SELECT instrument, sector, speed_class, count(*) AS n FROM v GROUP BY 1, 2, 3),
         t AS (SELECT instrument, count(*) AS total FROM v GROUP BY 1),
         g AS (SELECT instrument, total, CAST(s AS INTEGER) AS sector, CAST(k AS INTEGER) AS speed_class
               FROM t, range(16) a(s), range(6) b(k) UNION ALL SELECT instrument, total, -1, -1 FROM t)
    SELECT g.instrument, g.sector, g.speed_class, coalesce(n.n, 0) AS n, round(coalesce(n.n, 0) * 100.0 / total, 6) AS pct
    FROM g LEFT JOIN n USING (instrument, sector, speed_class)
    """,
)
def wind_rose(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select(
        "instrument", (F.col("event_id") * 37 % 360).cast("double").alias("direction"), (F.col("value") / 10).alias("speed")
    )
    return shown(stats.wind_rose(rows, ["instrument"], "direction", "speed"))


def _percentile_sql(p: float) -> str:
    """A percentile between the two values next to its rank, in the steps of `stats.exact_percentiles`; equal values need none."""
    low, high = (f"max(value) FILTER (rn = {f}((n - 1) * {p}::DOUBLE))" for f in ("floor", "ceil"))
    weight = f"max((n - 1) * {p}::DOUBLE - floor((n - 1) * {p}::DOUBLE))"
    return f"CASE WHEN {low} = {high} THEN {low} ELSE {low} + ({high} - {low}) * {weight} END"


@query(
    "distribution",
    f"""
    WITH r AS (SELECT event_type AS instrument, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS rn,
                      count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL),
         q AS (SELECT instrument, {_percentile_sql(0.25)} AS q1, {_percentile_sql(0.5)} AS med, {_percentile_sql(0.75)} AS q3 FROM r GROUP BY 1)
    SELECT instrument, count(*) AS n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
           min(value) FILTER (value >= q1 - (q3 - q1) * 1.5) AS whisker_low,
           max(value) FILTER (value <= q3 + (q3 - q1) * 1.5) AS whisker_high
    FROM r JOIN q USING (instrument) GROUP BY instrument, q1, med, q3
    """,
)
def distribution(spark, sf_dir):
    return shown(stats.distribution(roles.events(spark, sf_dir), ["instrument"], "value"))


@query(
    "histogram",
    """
    WITH e AS (SELECT event_type AS instrument, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
         n AS (SELECT instrument, CAST(least(floor((value - lo) / ((hi - lo) / 30)), 29) AS BIGINT) AS bin, count(*) AS n
               FROM events JOIN e ON e.instrument = event_type GROUP BY 1, 2)
    SELECT e.instrument, g.bin, round(lo + g.bin * ((hi - lo) / 30), 6) AS bin_start, coalesce(n.n, 0) AS n
    FROM e CROSS JOIN range(30) g(bin) LEFT JOIN n ON n.instrument = e.instrument AND n.bin = g.bin
    """,
)
def histogram(spark, sf_dir):
    return shown(stats.histogram(roles.events(spark, sf_dir), ["instrument"], "value"))
