"""Queries over time series: as-of joins, resampling, gaps, segments, order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.operators import asof, gaps, projection, ranges, resample, sequence
from tideline.plans import products, roles
from tideline.plans.registry import query
from tideline.plans.roles import nearest_sql, shown

_TOLERANCE_S = 300
_HALF_WINDOW_S = 1800


def _of(instrument: str, columns: str = "ts, event_id, value") -> str:
    return f"(SELECT {columns} FROM events WHERE event_type = '{instrument}')"


@query(
    "asof_nearest",
    "SELECT event_id, ts AS time, n_value AS latitude_deg, n_ts AS matched_time FROM "
    + nearest_sql(_of("purchase"), _of("view"), ["value"], _TOLERANCE_S, "n"),
)
def asof_nearest(spark, sf_dir):
    left = roles.stream(spark, sf_dir, "purchase").select("event_id", "time")
    right = asof.Source(
        roles.stream(spark, sf_dir, "view"), {"latitude_deg": "value"}, tm.seconds_us(_TOLERANCE_S),
        prefer=["event_id"], match_time="matched_time",
    )
    return shown(asof.nearest_asof(left, [right], []))


@query(
    "geotag_events",
    "SELECT leg, event_id, ts AS time, round(g_lat, 6) AS latitude_deg, round(g_lon, 6) AS longitude_deg FROM "
    + nearest_sql(
        roles.LEGGED_SQL,
        f"(SELECT leg, ts, {roles.LAT_SQL} AS lat, {roles.LON_SQL} AS lon FROM {roles.LEGGED_SQL} "
        "WHERE instrument = 'view')",
        ["lat", "lon"], _TOLERANCE_S, "g", keys=["leg"],
    ),
)
def geotag_events(spark, sf_dir):
    rows = roles.legged(spark, sf_dir)
    fixes = roles.positions(spark, sf_dir).where(F.col("source") == "GGA")
    tagged = asof.geotag(rows.select("leg", "event_id", "time"), fixes, ["leg"], tm.seconds_us(_TOLERANCE_S))
    return shown(tagged)


@query(
    "asof_fallback",
    """
    SELECT event_id, ts AS time, coalesce(v_value, c_value) AS heading_deg_true,
           CASE WHEN v_value IS NOT NULL THEN 'HDT' WHEN c_value IS NOT NULL THEN 'SXN23' END AS heading_source
    FROM """
    + nearest_sql(nearest_sql(_of("purchase"), _of("view"), ["value"], _TOLERANCE_S, "v"),
                  _of("click"), ["value"], _TOLERANCE_S, "c"),
)
def asof_fallback(spark, sf_dir):
    left = roles.stream(spark, sf_dir, "purchase").select("event_id", "time")
    width = tm.seconds_us(_TOLERANCE_S)
    sources = [
        asof.Source(roles.stream(spark, sf_dir, "view"), {"_hdt": "value"}, width),
        asof.Source(roles.stream(spark, sf_dir, "click"), {"_sxn": "value"}, width),
    ]
    matched = asof.nearest_asof(left, sources, [])
    source = F.when(F.col("_hdt").isNotNull(), "HDT").when(F.col("_sxn").isNotNull(), "SXN23")
    return shown(
        matched.select(
            "event_id", "time", F.coalesce("_hdt", "_sxn").alias("heading_deg_true"), source.alias("heading_source")
        )
    )


_FIXES_SQL = (
    f"(SELECT ts, {roles.LAT_SQL} AS lat, {roles.LON_SQL} AS lon, {roles.source_sql()} AS src FROM events "
    "WHERE event_type <> 'purchase')"
)


# Of fixes at one time the one of lowest latitude, longitude and source, as `asof.Source` has it.
_SINGLE_FIXES_SQL = f"(SELECT * FROM {_FIXES_SQL} QUALIFY row_number() OVER (PARTITION BY ts ORDER BY lat, lon, src) = 1)"


def _pair_sql(left: str, fixes: str) -> str:
    """`left` with the fixes half a window before (a_) and after (b_)."""
    first = nearest_sql(left, fixes, ["lat", "lon", "src"], _TOLERANCE_S, "fa", -_HALF_WINDOW_S)
    return nearest_sql(first, fixes, ["lat", "lon", "src"], _TOLERANCE_S, "fb", _HALF_WINDOW_S)


def _velocity_sql(left: str, fixes: str = _FIXES_SQL) -> str:
    return f"""
    (SELECT * EXCLUDE (ve, vn), CASE WHEN ok THEN sqrt(ve * ve + vn * vn) / (1852.0::DOUBLE / 3600.0) END AS sog,
            CASE WHEN ok THEN CASE WHEN degrees(atan2(ve, vn)) < 0 THEN degrees(atan2(ve, vn)) + 360
                                   ELSE degrees(atan2(ve, vn)) END END AS cog
     FROM (SELECT *, 6371000.0::DOUBLE * cos(radians((fa_lat + fb_lat) / 2))
                       * radians(fmod(fmod(fb_lon - fa_lon + 180, 360) + 360, 360) - 180) / dt AS ve,
                  6371000.0::DOUBLE * radians(fb_lat - fa_lat) / dt AS vn
           FROM (SELECT *, (epoch_us(fb_ts) - epoch_us(fa_ts)) / 1e6 AS dt,
                        coalesce(fa_src = fb_src AND epoch_us(fb_ts) - epoch_us(fa_ts) >= {_HALF_WINDOW_S}000000, false)
                          AS ok
                 FROM {_pair_sql(left, fixes)})))
    """


@query(
    "ship_velocity",
    f"""
    SELECT event_id, ts AS time, round(cog, 6) AS course_over_ground_deg_true, round(sog, 6) AS speed_over_ground_kt
    FROM {_velocity_sql(_of("purchase"), _SINGLE_FIXES_SQL)}
    """,
)
def ship_velocity(spark, sf_dir):
    left = roles.stream(spark, sf_dir, "purchase").select("event_id", "time")
    return shown(products.ship_velocity(left, _navigation(spark, sf_dir), []))


def _navigation(spark, sf_dir):
    fixes = (
        roles.events(spark, sf_dir)
        .withColumns({"latitude_deg": roles.latitude(), "longitude_deg": roles.longitude(), "source": roles.source()})
        .where(F.col("source").isNotNull())
    )
    return products.Navigation(
        hdt=roles.stream(spark, sf_dir, "view").select("time", F.col("value").alias("heading_deg_true")),
        sxn23=roles.stream(spark, sf_dir, "click").select("time", F.col("value").alias("heading")),
        vtg=roles.stream(spark, sf_dir, "signup").select(
            "time",
            (F.col("user_id") * 11 % 360).cast("double").alias("course_over_ground_deg_true"),
            F.col("value").alias("speed_over_ground_kt"),
        ),
        positions=fixes,
        tolerance_s=_TOLERANCE_S,
        half_window_s=_HALF_WINDOW_S,
    )


_WIND_LEFT = _of("purchase", "ts, event_id, value, (event_id * 37) % 360 AS rel")
_NAV_SQL = nearest_sql(
    nearest_sql(
        nearest_sql(_WIND_LEFT, _of("view"), ["value"], _TOLERANCE_S, "h"),
        _of("click"), ["value"], _TOLERANCE_S, "x",
    ),
    _of("signup", "ts, (user_id * 11) % 360 AS c, value AS s"), ["c", "s"], _TOLERANCE_S, "v",
)


@query(
    "true_wind_provenance",
    f"""
    WITH m AS (SELECT *, coalesce(h_value, x_value) AS heading,
                      CASE WHEN v_c IS NOT NULL THEN v_c ELSE cog END AS course,
                      CASE WHEN v_c IS NOT NULL THEN v_s ELSE sog END * (1852.0::DOUBLE / 3600.0) AS ship
               FROM {_velocity_sql(_NAV_SQL)}),
         a AS (SELECT *, radians(rel + heading) AS app, radians(course) AS cr FROM m),
         b AS (SELECT *, ship * sin(cr) - value * sin(app) AS u, ship * cos(cr) - value * cos(app) AS w FROM a),
         c AS (SELECT *, degrees(atan2(-u, -w)) AS d, sqrt(u * u + w * w) AS sp FROM b)
    SELECT event_id, ts AS time, round(CASE WHEN d < 0 THEN d + 360 ELSE d END, 6) AS true_wind_direction_deg,
           round(sp, 6) AS true_wind_speed_m_s,
           CASE WHEN sp IS NOT NULL THEN CASE WHEN v_c IS NOT NULL THEN 'VTG' ELSE 'GPS' END END AS ship_velocity_source,
           CASE WHEN sp IS NOT NULL THEN CASE WHEN h_value IS NOT NULL THEN 'HDT' ELSE 'SXN23' END END AS heading_source
    FROM c
    """,
)
def true_wind_provenance(spark, sf_dir):
    left = roles.stream(spark, sf_dir, "purchase").select(
        "event_id", "time", (F.col("event_id") * 37 % 360).cast("double").alias("wind_angle_deg"),
        F.col("value").alias("wind_speed_m_s"),
    )
    out = products.true_wind(left, _navigation(spark, sf_dir), [])
    return shown(out.drop("wind_angle_deg", "wind_speed_m_s"))


# --- resampling ---------------------------------------------------------------------------------


def _dense_sql(binned: str, step: str, columns: list[str], keys: str = "instrument") -> str:
    """`binned` (keys, time, columns) with its empty bins."""
    shown_columns = ", ".join(f"b.{c}" for c in columns)
    return f"""
    WITH b AS ({binned}), g AS (SELECT {keys}, unnest(generate_series(min(time), max(time), INTERVAL '{step}')) AS time
                                 FROM b GROUP BY {keys})
    SELECT {', '.join('g.' + k for k in keys.split(', '))}, g.time, {shown_columns}
    FROM g LEFT JOIN b ON {' AND '.join(f'g.{k} = b.{k}' for k in keys.split(', '))} AND g.time = b.time
    """


_MEAN_SQL = """SELECT event_type AS instrument, time_bucket(INTERVAL '{step}', ts) AS time,
                      round(avg(value), 6) AS value, round(avg(user_id), 6) AS user_id FROM events GROUP BY 1, 2"""


@query("resample_mean_dense", _dense_sql(_MEAN_SQL.format(step="5 minutes"), "5 minutes", ["value", "user_id"]))
def resample_mean_dense(spark, sf_dir):
    return shown(resample.resample_mean(roles.events(spark, sf_dir), ["instrument"], "5min", ["value", "user_id"]))


@query("resample_mean_sparse", _MEAN_SQL.format(step="1 hour"))
def resample_mean_sparse(spark, sf_dir):
    rows = roles.events(spark, sf_dir)
    return shown(resample.resample_mean(rows, ["instrument"], "1h", ["value", "user_id"], dense=False))


@query(
    "resample_energetic",
    """
    SELECT event_type AS instrument, date_trunc('hour', ts) AS time, round(10 * log10(avg(pow(10, value / 100))), 6)
             AS level_broadband, round(avg(user_id), 6) AS user_id FROM events GROUP BY 1, 2
    """,
)
def resample_energetic(spark, sf_dir):
    rows = roles.events(spark, sf_dir).withColumn("level_broadband", F.col("value") / 10)
    levels = projection.level_columns(rows.columns)
    return shown(
        resample.resample_mean(rows, ["instrument"], "1h", ["level_broadband", "user_id"], levels, dense=False)
    )


@query(
    "resample_dominant",
    _dense_sql(
        """
        SELECT instrument, time, code, value FROM (
          SELECT instrument, time, code, avg_value AS value,
                 row_number() OVER (PARTITION BY instrument, time ORDER BY (code IS NOT NULL) DESC, n DESC, code DESC) AS rn
          FROM (SELECT event_type AS instrument, date_trunc('hour', ts) AS time,
                       CASE WHEN event_id % 3 > 0 THEN CAST(user_id % 5 AS DOUBLE) END AS code,
                       count(*) AS n, round(avg(value), 6) AS avg_value FROM events GROUP BY 1, 2, 3)) WHERE rn = 1
        """,
        "1 hour",
        ["code", "value"],
    ),
)
def resample_dominant(spark, sf_dir):
    code = F.when(F.col("event_id") % 3 > 0, (F.col("user_id") % 5).cast("double"))
    rows = roles.events(spark, sf_dir).withColumn("code", code)
    return shown(resample.resample_dominant(rows, ["instrument"], "1h", "code", ["value"]))


@query(
    "resample_intervals",
    " UNION ALL ".join(
        f"SELECT *, '{name}' AS interval FROM ({_dense_sql(_MEAN_SQL.format(step=step), step, ['value', 'user_id'])})"
        for name, step in (("1D", "1 day"), ("1h", "1 hour"), ("5min", "5 minutes"))
    ),
)
def resample_intervals(spark, sf_dir):
    rows = roles.events(spark, sf_dir)
    return shown(resample.resample_all(rows, ["instrument"], ["1D", "1h", "5min"], ["value", "user_id"]))


# --- gaps ---------------------------------------------------------------------------------------

_KEYS = ["leg", "instrument"]


def _gap_columns(a: str, b: str) -> str:
    size = f"(epoch_us({b}) - epoch_us({a}))"
    return (
        f"{a} AS previous_time, {b} AS current_time, round_even({size} / 6e7, 3) AS gap_minutes, "
        f"round_even({size} / 3.6e9, 3) AS gap_hours"
    )


def _internal_sql(minutes: int, rows: str = roles.LEGGED_SQL, keys: str = "leg, instrument") -> str:
    return f"""
    SELECT {keys}, 'internal' AS gap_type, {_gap_columns('prev', 'ts')}
    FROM (SELECT *, lag(ts) OVER (PARTITION BY {keys} ORDER BY ts) AS prev FROM {rows})
    WHERE ts - prev > INTERVAL '{minutes} minutes'
    """


def _edges_sql(minutes: int, rows: str = roles.LEGGED_SQL, keys: str = "leg, instrument") -> str:
    ends = f"(SELECT {keys}, w_start, w_end, min(ts) AS a, max(ts) AS b FROM {rows} GROUP BY {keys}, w_start, w_end)"
    return f"""
    SELECT {keys}, 'start' AS gap_type, {_gap_columns('w_start', 'a')} FROM {ends}
    WHERE a - w_start > INTERVAL '{minutes} minutes'
    UNION ALL
    SELECT {keys}, 'end' AS gap_type, {_gap_columns('b', 'w_end')} FROM {ends}
    WHERE w_end - b > INTERVAL '{minutes} minutes'
    """


def _all_gaps_sql(minutes: int) -> str:
    return f"({_internal_sql(minutes)} UNION ALL {_edges_sql(minutes)})"


@query("gaps_internal", _internal_sql(60))
def gaps_internal(spark, sf_dir):
    return shown(gaps.internal_gaps(roles.legged(spark, sf_dir), _KEYS, "time", 60.0))


@query("gaps_edges", _edges_sql(15))
def gaps_edges(spark, sf_dir):
    return shown(gaps.edge_gaps(roles.legged(spark, sf_dir), _KEYS, "time", roles.windows(spark), 15.0))


@query(
    "gaps_by_instrument_threshold",
    f"""
    SELECT leg, instrument, 'internal' AS gap_type, {_gap_columns('prev', 'ts')}
    FROM (SELECT *, lag(ts) OVER (PARTITION BY leg, instrument ORDER BY ts) AS prev FROM {roles.LEGGED_SQL})
    WHERE ts - prev > CASE instrument WHEN 'view' THEN INTERVAL '90 minutes' ELSE INTERVAL '45 minutes' END
    """,
)
def gaps_by_instrument_threshold(spark, sf_dir):
    threshold = F.when(F.col("instrument") == "view", 90.0).otherwise(45.0)
    return shown(gaps.internal_gaps(roles.legged(spark, sf_dir), _KEYS, "time", threshold))


def _statistics_sql(minutes: int) -> str:
    sizes = ["total", "max", "mean", "median", "min"]
    hours = ", ".join(
        f"round({s}_gap_minutes, 6) AS {s}_gap_minutes, round_even({s}_gap_minutes / 60.0, 3) AS {s}_gap_hours"
        for s in sizes
    )
    return f"""
    WITH st AS (SELECT leg, instrument, count(*) AS n_gaps, round_even(sum(gap_minutes), 3) AS total_gap_minutes,
                       max(gap_minutes) AS max_gap_minutes, avg(gap_minutes) AS mean_gap_minutes,
                       median(gap_minutes) AS median_gap_minutes, min(gap_minutes) AS min_gap_minutes
                FROM {_all_gaps_sql(minutes)} GROUP BY 1, 2),
         seen AS (SELECT DISTINCT leg, instrument FROM {roles.LEGGED_SQL}),
         j AS (SELECT w.leg, i.instrument, CASE WHEN s.leg IS NULL THEN 'No data' ELSE 'OK' END AS status,
                      CASE WHEN s.leg IS NOT NULL THEN coalesce(st.n_gaps, 0) END AS n_gaps,
                      CASE WHEN s.leg IS NOT NULL THEN coalesce(st.total_gap_minutes, 0) END AS total_gap_minutes,
                      max_gap_minutes, mean_gap_minutes, median_gap_minutes, min_gap_minutes,
                      date_diff('second', w.w_start, w.w_end) / 60.0 AS leg_minutes
               FROM {roles.WINDOWS_SQL}, {roles.INSTRUMENTS_SQL}
               LEFT JOIN seen s ON s.leg = w.leg AND s.instrument = i.instrument
               LEFT JOIN st ON st.leg = w.leg AND st.instrument = i.instrument)
    SELECT leg, instrument, status, n_gaps, {hours},
           round_even(total_gap_minutes / leg_minutes * 100, 2) AS pct_of_leg_gap
    FROM j
    """


@query("gap_statistics", _statistics_sql(60))
def gap_statistics(spark, sf_dir):
    held = roles.windows(spark)
    expected = products.expected_combos(held, [(i,) for i in roles.INSTRUMENTS], ["instrument"])
    tables = products.gap_analysis(roles.legged(spark, sf_dir), expected, held, _KEYS, 60.0)
    return shown(tables["statistics"])


@query(
    "gap_table",
    f"""
    SELECT leg, instrument, gap_type, previous_time, current_time, gap_minutes, gap_hours FROM {_all_gaps_sql(60)}
    UNION ALL
    SELECT w.leg, i.instrument, 'No data', {_gap_columns('w.w_start', 'w.w_end')}
    FROM {roles.WINDOWS_SQL}, {roles.INSTRUMENTS_SQL}
    WHERE NOT EXISTS (SELECT 1 FROM {roles.LEGGED_SQL} s WHERE s.leg = w.leg AND s.instrument = i.instrument)
    """,
)
def gap_table(spark, sf_dir):
    held = roles.windows(spark)
    expected = products.expected_combos(held, [(i,) for i in roles.INSTRUMENTS], ["instrument"])
    return shown(products.gap_analysis(roles.legged(spark, sf_dir), expected, held, _KEYS, 60.0)["gaps"])


_AS_OF = "2024-01-31 00:00:00"
_GGA_SQL = f"(SELECT * FROM {roles.LEGGED_SQL} WHERE instrument = 'view')"
_GAP_WINDOWS_SQL = f"""(SELECT leg, previous_time AS w0, current_time AS w1 FROM (
    {_internal_sql(30, _GGA_SQL, 'leg')} UNION ALL {_edges_sql(30, _GGA_SQL, 'leg')})
    WHERE NOT (gap_type = 'end' AND current_time > TIMESTAMP '{_AS_OF}'))"""


@query("gap_windows", f'SELECT leg, w0 AS start, w1 AS "end" FROM {_GAP_WINDOWS_SQL}')
def gap_windows(spark, sf_dir):
    return shown(_gap_windows(spark, sf_dir))


def _gap_windows(spark, sf_dir):
    gga = roles.legged(spark, sf_dir).where(F.col("instrument") == "view")
    found = gaps.find_gaps(gga, ["leg"], "time", roles.windows(spark), 30.0)
    open_gaps = gaps.without_future_end(found, F.expr(f"TIMESTAMP_LTZ'{_AS_OF} UTC'"))
    return open_gaps.select("leg", F.col("previous_time").alias("start"), F.col("current_time").alias("end"))


def _remaining_sql(windows: str, fixes: str, minutes: int) -> str:
    """Stretches of `windows` (leg, w0, w1) longer than `minutes` between edges and `fixes` (leg, ts)."""
    return f"""(SELECT leg, a AS r0, b AS r1 FROM (
      SELECT leg, w0, w1, ts AS a, lead(ts) OVER (PARTITION BY leg, w0, w1 ORDER BY ts) AS b FROM (
        SELECT leg, w0, w1, w0 AS ts FROM {windows} UNION ALL SELECT leg, w0, w1, w1 FROM {windows}
        UNION ALL SELECT w.leg, w.w0, w.w1, f.ts FROM {windows} w JOIN {fixes} f ON f.leg = w.leg
          AND f.ts BETWEEN w.w0 AND w.w1))
      WHERE b - a > INTERVAL '{minutes} minutes')"""


_FILL_SQL = f"(SELECT leg, ts FROM {roles.LEGGED_SQL} WHERE instrument IN ('click', 'signup'))"


@query(
    "remaining_gaps",
    f'SELECT leg, r0 AS start, r1 AS "end" FROM {_remaining_sql(_GAP_WINDOWS_SQL, _FILL_SQL, 20)}',
)
def remaining_gaps(spark, sf_dir):
    fills = roles.legged(spark, sf_dir).where(F.col("instrument").isin("click", "signup"))
    return shown(gaps.remaining_gaps(_gap_windows(spark, sf_dir), fills.select("leg", "time"), ["leg"], 20.0))


@query(
    "covered_intervals",
    f"""
    WITH k AS (SELECT DISTINCT leg, instrument, w_start, w_end FROM {roles.LEGGED_SQL}),
         p AS (SELECT leg, instrument, previous_time AS a, current_time AS b FROM {_all_gaps_sql(60)}
               UNION ALL SELECT leg, instrument, w_start, w_start FROM k
               UNION ALL SELECT leg, instrument, w_end, w_end FROM k),
         s AS (SELECT leg, instrument, a, max(b) OVER (PARTITION BY leg, instrument ORDER BY a, b
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p)
    SELECT leg, instrument, reach AS start, a AS "end" FROM s WHERE a > reach
    """,
)
def covered_intervals(spark, sf_dir):
    rows = roles.legged(spark, sf_dir)
    held = roles.windows(spark)
    found = gaps.find_gaps(rows, _KEYS, "time", held, 60.0)
    spans = rows.select(*_KEYS).distinct().join(held, "leg")
    return shown(gaps.covered_intervals(found, spans, _KEYS))


# --- segments and order -------------------------------------------------------------------------


@query(
    "segment_ids",
    """
    WITH s AS (SELECT event_type AS instrument, event_id, ts,
                      CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) > INTERVAL '30 minutes'
                           THEN 1 ELSE 0 END AS fresh FROM events),
         n AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY instrument ORDER BY ts) AS BIGINT) AS segment_no FROM s)
    SELECT instrument, event_id, segment_no, min(ts) OVER (PARTITION BY instrument, segment_no) AS segment_start FROM n
    """,
)
def segment_ids(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select("instrument", "event_id", "time")
    found = gaps.with_segment(rows, ["instrument"], "time", tm.minutes_us(30))
    return shown(found.drop("time"))


@query(
    "day_rollover",
    """
    WITH c AS (SELECT event_type AS instrument, event_id, ts, (epoch_us(ts) // 1000000) % 86400 AS clock FROM events),
         s AS (SELECT *, CASE WHEN clock < lag(clock) OVER (PARTITION BY instrument ORDER BY ts) THEN 1 ELSE 0 END AS w
               FROM c)
    SELECT instrument, event_id, CAST(sum(w) OVER (PARTITION BY instrument ORDER BY ts) AS BIGINT) AS day_offset FROM s
    """,
)
def day_rollover(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select("instrument", "event_id", "time")
    clock = F.pmod(F.unix_seconds("time"), F.lit(86_400))
    out = sequence.day_rollover(rows, ["instrument"], ["time"], sequence.time_chunk("time"), clock)
    return out.drop("time")


@query(
    "sessions",
    """
    WITH s AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                      <= INTERVAL '2 hours' THEN 0 ELSE 1 END AS fresh FROM events),
         n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM s)
    SELECT user_id, min(ts) AS segment_start, max(ts) AS segment_end, count(*) AS n_rows
    FROM n GROUP BY user_id, no HAVING count(*) >= 2
    """,
)
def sessions(spark, sf_dir):
    found = gaps.segments(roles.events(spark, sf_dir), ["user_id"], "time", tm.minutes_us(120))
    return shown(found.where(F.col("n_rows") >= 2))


@query(
    "thin_1hz",
    """
    SELECT instrument, event_id, time FROM (
      SELECT event_type AS instrument, event_id, ts AS time, row_number() OVER (
        PARTITION BY event_type, time_bucket(INTERVAL '10 minutes', ts) ORDER BY ts) AS rn FROM events) WHERE rn = 1
    """,
)
def thin_1hz(spark, sf_dir):
    # The events are sparse, so the step is 10 minutes instead of a second.
    rows = roles.events(spark, sf_dir).select("instrument", "event_id", "time")
    return shown(sequence.thin_to_step(rows, ["instrument"], "time", 10 * tm.MINUTE, ["event_id"]))


@query(
    "precedence_pick",
    """
    SELECT instrument, start, folder, event_id FROM (
      SELECT event_type AS instrument, date_trunc('hour', ts) AS start, user_id % 3 AS folder, event_id,
             row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY user_id % 3, event_id) AS rn
      FROM events) WHERE rn = 1
    """,
)
def precedence_pick(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select(
        "instrument", tm.floor_time("time", tm.HOUR).alias("start"), (F.col("user_id") % 3).alias("folder"), "event_id"
    )
    return shown(sequence.pick_by_precedence(rows, ["instrument", "start"], ["folder", "event_id"]))


@query(
    "thin_every_n",
    """
    SELECT instrument, event_id, time FROM (
      SELECT event_type AS instrument, event_id, ts AS time, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS no,
             count(*) OVER (PARTITION BY event_type) AS n FROM events)
    WHERE (no - 1) % (CASE WHEN n > 300 THEN n // 300 + 1 ELSE 1 END) = 0
    """,
)
def thin_every_n(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select("instrument", "event_id", "time")
    return shown(
        sequence.thin_every_nth(rows, ["instrument"], ["time", "event_id"], sequence.time_chunk("time"), 300)
    )


@query(
    "chronological_order",
    """
    SELECT event_id, row_number() OVER (ORDER BY t NULLS LAST, event_id) AS position FROM (
      SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS t FROM events)
    """,
)
def chronological_order(spark, sf_dir):
    time = F.when(F.col("event_id") % 50 != 0, F.col("time"))
    rows = roles.events(spark, sf_dir).select("event_id", time.alias("time"))
    rows = rows.withColumn("_late", F.col("time").isNull())
    # A position is a running count; rows without a time form the last chunk.
    chunk = F.coalesce(sequence.time_chunk("time"), F.lit(2**40))
    numbered = sequence.with_row_number(rows, [], ["_late", "time", "event_id"], chunk, "position")
    return projection.chronological(numbered, tie=["event_id"]).select("event_id", "position")


@query(
    "union_layouts",
    """
    SELECT event_id, ts AS time, CASE WHEN event_type = 'click' THEN value END AS heading,
           CASE WHEN event_type = 'view' THEN value END AS pitch,
           CASE WHEN event_type NOT IN ('click', 'view') THEN value END AS roll, event_type AS layout
    FROM events
    """,
)
def union_layouts(spark, sf_dir):
    rows = roles.events(spark, sf_dir)
    base = ["event_id", "time", F.col("instrument").alias("layout")]
    parts = [
        rows.where(F.col("instrument") == "click").select(*base, F.col("value").alias("heading")),
        rows.where(F.col("instrument") == "view").select(*base, F.col("value").alias("pitch")),
        rows.where(~F.col("instrument").isin("click", "view")).select(*base, F.col("value").alias("roll")),
    ]
    return shown(projection.union_by_name(parts))


@query(
    "union_legs",
    f"""
    SELECT ts AS time, value, CASE WHEN leg % 2 = 0 THEN user_id END AS user_id, leg AS __leg,
           'LEG' || leg || '_' || instrument || '.csv' AS __source_file
    FROM {roles.LEGGED_SQL}
    """,
)
def union_legs(spark, sf_dir):
    rows = roles.legged(spark, sf_dir)
    name = F.concat(F.lit("LEG"), F.col("leg").cast("string"), F.lit("_"), "instrument", F.lit(".csv"))
    lineage = projection.with_lineage(rows, F.col("leg"), name)
    even, odd = lineage.where(F.col("leg") % 2 == 0), lineage.where(F.col("leg") % 2 == 1)
    keep = ["time", "value", "__leg", "__source_file"]
    return shown(projection.union_by_name([even.select(*keep, "user_id"), odd.select(*keep)]))


@query("drop_empty_columns", "SELECT event_id, value FROM events")
def drop_empty_columns(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select(
        "event_id", "value", F.when(F.col("value") < -1e9, F.col("value")).alias("never"),
        F.lit(None).cast("string").alias("blank"),
    )
    return projection.drop_empty_columns(rows, keep=["event_id"])


@query(
    "dedup_records",
    "SELECT event_id, ts AS time, event_type AS instrument, value FROM events",
)
def dedup_records(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select("event_id", "time", "instrument", "value")
    first = rows.withColumn("Timestamp", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    second = rows.where(F.col("value") > 5).withColumn("Timestamp", F.date_format("time", "d/M/yyyy HH:mm"))
    return shown(projection.drop_duplicate_records(first.unionByName(second)).drop("Timestamp"))


@query(
    "stacked_streams",
    """
    SELECT user_id % 50 AS file_no, ts AS timestamp, 'time1' AS time_source, value AS latitude, NULL::DOUBLE AS pitch,
           NULL::DOUBLE AS heave, CAST(20 + user_id % 50 AS DOUBLE) AS env_temperature FROM events WHERE event_type = 'click'
    UNION ALL
    SELECT user_id % 50, ts, 'time2', NULL, value, NULL, CAST(20 + user_id % 50 AS DOUBLE) FROM events WHERE event_type = 'view'
    UNION ALL
    SELECT user_id % 50, ts, 'time3', NULL, NULL, value, CAST(20 + user_id % 50 AS DOUBLE) FROM events WHERE event_type NOT IN ('click', 'view')
    """,
)
def stacked_streams(spark, sf_dir):
    rows = roles.events(spark, sf_dir).withColumn("file_no", F.col("user_id") % 50)
    base = ["file_no", F.col("time").alias("timestamp")]
    parts = {
        "time1": rows.where(F.col("instrument") == "click").select(*base, F.col("value").alias("latitude")),
        "time2": rows.where(F.col("instrument") == "view").select(*base, F.col("value").alias("pitch")),
        "time3": rows.where(~F.col("instrument").isin("click", "view")).select(*base, F.col("value").alias("heave")),
    }
    constants = rows.select("file_no").distinct().withColumn("env_temperature", F.col("file_no") + 20.0)
    return shown(projection.stack_streams(parts, constants, "file_no"))


# --- intervals ----------------------------------------------------------------------------------

_SPANS = """(SELECT o_orderpriority AS instrument, o_orderstatus AS layout, o_orderdate AS a,
                    o_orderdate + to_hours((o_orderkey % 10) * 3) AS b, o_orderkey FROM orders)"""


def _spans(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("timestamp")
    length = (F.col("o_orderkey") % 10) * 3 * tm.HOUR
    return orders.select(
        F.col("o_orderpriority").alias("instrument"),
        F.col("o_orderstatus").alias("layout"),
        start.alias("start"),
        F.timestamp_micros(tm.micros(start) + length).alias("end"),
        "o_orderkey",
    )


def _union_sql(keys: str, rows: str = _SPANS, frame: str = "ROWS") -> str:
    return f"""(SELECT {keys}, min(a) AS a, max(b) AS b FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY a, b {frame} UNBOUNDED PRECEDING) AS island FROM (
          SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY {keys} ORDER BY a, b
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM {rows}))
        GROUP BY {keys}, island)"""


# Equal intervals are counted together: the two windows of the SQL may put them in different orders.
@query("interval_union", f'SELECT instrument, layout, a AS start, b AS "end" FROM {_union_sql("instrument, layout", frame="RANGE")}')
def interval_union(spark, sf_dir):
    return shown(ranges.interval_union(_spans(spark, sf_dir), ["instrument", "layout"]))


def _side_sql(layout: str) -> str:
    return _union_sql("instrument", f"(SELECT * FROM {_SPANS} WHERE layout = '{layout}')")


@query(
    "interval_intersection",
    f"""
    SELECT x.instrument, greatest(x.a, y.a) AS start, least(x.b, y.b) AS "end"
    FROM {_side_sql('F')} x JOIN {_side_sql('P')} y ON x.instrument = y.instrument AND x.a < y.b AND y.a < x.b
    WHERE greatest(x.a, y.a) < least(x.b, y.b)
    """,
)
def interval_intersection(spark, sf_dir):
    spans = _spans(spark, sf_dir)
    first, second = (spans.where(F.col("layout") == status) for status in ("F", "P"))
    return shown(ranges.interval_intersection(first, second, ["instrument"]))


@query(
    "layout_overlaps",
    f"""
    WITH u AS (SELECT * FROM {_union_sql("instrument, layout")})
    SELECT x.instrument, x.layout AS layout_a, y.layout AS layout_b,
           round_even(sum(epoch_us(least(x.b, y.b)) - epoch_us(greatest(x.a, y.a)))::DOUBLE / 3.6e9, 2) AS overlap_hours,
           min(greatest(x.a, y.a)) AS overlap_start, max(least(x.b, y.b)) AS overlap_end
    FROM u x JOIN u y ON x.instrument = y.instrument AND x.layout < y.layout AND x.a < y.b AND y.a < x.b
    WHERE greatest(x.a, y.a) < least(x.b, y.b) GROUP BY 1, 2, 3
    """,
)
def layout_overlaps(spark, sf_dir):
    return shown(ranges.pairwise_overlaps(_spans(spark, sf_dir), ["instrument"], "layout"))


_GAPS_ORDERS = [("1996-03-01 00:00:00", "1996-03-04 00:00:00"), ("1997-06-10 12:00:00", "1997-06-10 18:00:00"),
                ("1998-01-01 00:00:00", "1998-01-20 00:00:00")]
_GAPS_SQL = "(VALUES " + ", ".join(f"(TIMESTAMP '{a}', TIMESTAMP '{b}')" for a, b in _GAPS_ORDERS) + ") AS g(w0, w1)"


def _order_gaps(spark, instrument_from):
    rows = ", ".join(f"(TIMESTAMP_LTZ'{a} UTC', TIMESTAMP_LTZ'{b} UTC')" for a, b in _GAPS_ORDERS)
    held = spark.sql(f"SELECT * FROM VALUES {rows} AS g(start, end)")
    names = F.array(*[F.lit(n) for n in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    return held.select(F.explode(names).alias("instrument"), "start", "end")


def _files(spark, sf_dir):
    return _spans(spark, sf_dir).withColumn("file_name", F.format_string("file_%08d", "o_orderkey"))


@query(
    "file_prune_start_only",
    f"""
    WITH f AS (SELECT instrument, printf('file_%08d', o_orderkey) AS file_name, a FROM {_SPANS}),
         n AS (SELECT *, lead(a) OVER (PARTITION BY instrument ORDER BY a, file_name) AS nxt FROM f)
    SELECT DISTINCT instrument, file_name FROM n JOIN {_GAPS_SQL}
      ON (a BETWEEN w0 AND w1) OR (a <= w0 AND (nxt IS NULL OR nxt > w0))
    """,
)
def file_prune_start_only(spark, sf_dir):
    files = _files(spark, sf_dir)
    return ranges.prune_by_start(files, _order_gaps(spark, files), ["instrument"])


@query(
    "file_prune_range",
    f"""
    SELECT DISTINCT instrument, printf('file_%08d', o_orderkey) AS file_name
    FROM {_SPANS} LEFT JOIN {_GAPS_SQL} ON a <= w1 AND b >= w0
    WHERE w0 IS NOT NULL OR instrument = '5-LOW'
    """,
)
def file_prune_range(spark, sf_dir):
    # One instrument has a file whose name tells no end, so all of its files are kept.
    files = _files(spark, sf_dir)
    unnamed = (F.col("instrument") == "5-LOW") & (F.col("o_orderkey") % 7 == 0)
    files = files.withColumn("end", F.when(~unnamed, F.col("end")))
    return ranges.prune_by_range(files, _order_gaps(spark, files), ["instrument"])


@query(
    "stale_files",
    """
    SELECT o_orderpriority AS instrument, o_orderkey AS stem FROM orders
    WHERE o_orderkey % 4 = 0 OR o_orderkey % 5 = 0
    """,
)
def stale_files(spark, sf_dir):
    spans = _spans(spark, sf_dir)
    files = spans.select("instrument", F.col("o_orderkey").alias("stem"), F.col("start").alias("raw_mtime"))
    # Every fourth output is missing; every fifth is older than its raw file.
    age = F.when(F.col("stem") % 5 == 0, -tm.HOUR).otherwise(F.when(F.col("stem") % 2 == 0, 0).otherwise(tm.HOUR))
    outputs = files.where(F.col("stem") % 4 != 0).select(
        "instrument", "stem", F.timestamp_micros(tm.micros("raw_mtime") + age).alias("processed_mtime")
    )
    return ranges.stale_files(files, outputs, ["instrument"]).select("instrument", "stem")
