"""Queries over single rows: names, numbers, times, positions, labels, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import schema
from tideline.functions import acoustic as ac
from tideline.functions import geo, wind
from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.operators import position, projection, ranges, sequence, stats
from tideline.plans import products, roles
from tideline.plans.registry import query
from tideline.plans.roles import naive, r6, shown
from tideline.sources import lines



@query(
    "rename_coalesce",
    """
    SELECT event_id, ts AS time,
           round(coalesce(CASE WHEN event_id % 2 = 0 THEN value END, CASE WHEN event_id % 3 = 0 THEN value + 1 END), 6)
             AS heading_deg_true,
           user_id
    FROM events
    """,
)
def rename_coalesce(spark, sf_dir):
    raw = roles.events(spark, sf_dir).select(
        "event_id",
        F.col("time").alias("Timestamp"),
        F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("Heading, degrees true"),
        F.when(F.col("event_id") % 3 == 0, F.col("value") + 1).alias("Heading,_degrees_true"),
        "user_id",
        "props",
    )
    mapping = {
        "Timestamp": "time",
        "Heading, degrees true": "heading_deg_true",
        "Heading,_degrees_true": "heading_deg_true",
        "Heading": "heading_deg_true",
        "event_id": "event_id",
    }
    return shown(projection.keep_and_rename(raw, mapping, extra=["user_id"]))


_MAPPING_ROWS = [("c0", "heading"), ("c1", "heading"), ("c2", "pitch"), ("c3", "roll")]
_MAPPING_SQL = "(VALUES " + ", ".join(f"('{r}', '{c}')" for r, c in _MAPPING_ROWS) + ") AS m(raw, canonical)"


@query(
    "missing_canonical",
    f"""
    WITH present AS (SELECT DISTINCT event_type AS instrument,
                            'c' || ((length(event_type) + user_id % 2) % 4) AS raw FROM events),
         mapping AS (SELECT i.instrument, m.raw, m.canonical FROM {_MAPPING_SQL},
                     (SELECT DISTINCT event_type AS instrument FROM events) i),
         found AS (SELECT DISTINCT instrument, canonical FROM mapping JOIN present USING (instrument, raw))
    SELECT DISTINCT instrument, canonical FROM mapping
    WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.instrument = mapping.instrument
                      AND f.canonical = mapping.canonical)
    """,
)
def missing_canonical(spark, sf_dir):
    rows = roles.events(spark, sf_dir)
    raw = F.concat(F.lit("c"), ((F.length("instrument") + F.col("user_id") % 2) % 4).cast("string"))
    present = rows.select("instrument", raw.alias("raw")).distinct()
    pairs = F.array(*[F.struct(F.lit(r).alias("raw"), F.lit(c).alias("canonical")) for r, c in _MAPPING_ROWS])
    mapping = rows.select("instrument").distinct().select("instrument", F.inline(pairs))
    return projection.missing_canonical_rows(mapping, present, ["instrument"])


@query(
    "numeric_coercion",
    r"""
    SELECT event_id, ts AS time, props,
           TRY_CAST(CASE event_id % 4 WHEN 0 THEN regexp_extract(props, '\d+') WHEN 1 THEN props
                    WHEN 2 THEN CAST(value AS VARCHAR) ELSE NULL END AS DOUBLE) AS reading
    FROM events
    """,
)
def numeric_coercion(spark, sf_dir):
    kind = F.col("event_id") % 4
    raw = roles.events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        "time",
        "props",
        F.when(kind == 0, F.regexp_extract("props", r"(\d+)", 1))
        .when(kind == 1, F.col("props"))
        .when(kind == 2, F.col("value").cast("string"))
        .otherwise(F.lit("NaN"))
        .alias("reading"),
    )
    out = projection.coerce_numeric(raw, exclude=["props"])
    return shown(out.withColumn("event_id", F.col("event_id").cast("long")))


# Text forms of a time: (Spark pattern, what it keeps of the time).
_TIME_FORMS = [
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "microsecond"), ("yyyyMMddHHmmss", "second"), ("ddMMyyyyHHmm", "minute"), ("", "second"),
    ("d/M/yyyy H:mm:ss", "second"), ("d/M/yyyy H:mm:ss.SSS", "millisecond"), ("yyyy/MM/dd HH:mm:ss", "second"), ("MMM d, yyyy H:mm", "minute"),
    ("d MMMM yyyy H:mm", "minute"), ("d/M/yyyy h:mm:ss a", "second"), ("yyyy-M-d H:mm", "minute"), ("d/M/yy H:mm", "minute"),
    ("d.M.yyyy H:mm:ss", "second"), ("d-MMM-yyyy HH:mm:ss", "second"), ("yyyy-MM-dd'T'HH:mm:ss'+00:00'", "second"), ("dd/MM/yyyy", "day"),
]


def _time_texts():
    time, kind = F.col("time"), F.col("event_id") % len(_TIME_FORMS)
    text = F.lit(None).cast("string")
    for number, (pattern, _) in enumerate(_TIME_FORMS):
        shown_ = F.date_format(time, pattern) if pattern else F.unix_seconds(time).cast("string")
        text = F.when(kind == number, shown_).otherwise(text)
    return text


@query(
    "time_parse_mixed",
    f"""
    WITH t AS (SELECT event_id, CASE event_id % {len(_TIME_FORMS)} """
    + " ".join(f"WHEN {n} THEN date_trunc('{kept}', ts)" for n, (_, kept) in enumerate(_TIME_FORMS))
    + """ END AS time FROM events)
    SELECT event_id, time, strftime(time, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' AS time_text, true AS canonical FROM t
    """,
)
def time_parse_mixed(spark, sf_dir):
    raw = roles.events(spark, sf_dir).select("event_id", _time_texts().alias("System Date and Time"))
    parsed = projection.add_canonical_time(raw).withColumn("time_text", tm.format_time("time"))
    return shown(parsed.select("event_id", "time", "time_text", tm.is_canonical("time_text").alias("canonical")))


@query(
    "time_padded_numbers",
    """
    WITH t AS (SELECT event_id, date_trunc('minute', ts) AS time FROM events)
    SELECT event_id, time FROM t
    """,
)
def time_padded_numbers(spark, sf_dir):
    """Compact day-first times in a numeric column, where days before the tenth have lost their zero."""
    number = F.date_format("time", "ddMMyyyyHHmm").cast("long")
    raw = roles.events(spark, sf_dir).select("event_id", number.alias("System Date and Time"))
    return shown(projection.add_canonical_time(raw).select("event_id", "time"))


@query(
    "time_from_name",
    """
    WITH f AS (SELECT event_id, ts, date_trunc('hour', ts) AS start FROM events)
    SELECT event_id, 'LOG_' || strftime(start, '%d%m%Y%H%M') || '_a.csv' AS file_name,
           row_number() OVER (PARTITION BY start ORDER BY ts, event_id) AS row_no,
           start + to_seconds(row_number() OVER (PARTITION BY start ORDER BY ts, event_id) - 1) AS time
    FROM f
    """,
)
def time_from_name(spark, sf_dir):
    name = F.concat(F.lit("LOG_"), F.date_format(F.date_trunc("hour", "time"), "ddMMyyyyHHmm"), F.lit("_a.csv"))
    raw = roles.events(spark, sf_dir).select("event_id", F.col("time").alias("_at"), name.alias("file_name"))
    numbered = sequence.with_row_number(
        raw, ["file_name"], ["_at", "event_id"], sequence.time_chunk("_at", 10 * tm.MINUTE), "row_no"
    )
    timed = lines.ensure_time(numbered, name="file_name")
    return shown(timed.select("event_id", "file_name", "row_no", "time"))


@query(
    "name_times",
    """
    SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END AS recording_start,
           CASE WHEN event_id % 5 <> 0 THEN date_trunc('hour', ts) END AS range_start,
           CASE WHEN event_id % 5 <> 0 THEN date_trunc('hour', ts) + INTERVAL '1 hour' END AS range_end
    FROM events
    """,
)
def name_times(spark, sf_dir):
    stamp = F.date_format("time", "'ship-D'yyyyMMdd'-T'HHmmss'.raw'")
    hour = F.date_trunc("hour", "time")
    span = F.concat(
        F.date_format(hour, "yyyyMMdd'T'HHmmss"),
        F.lit("-"),
        F.date_format(hour + F.expr("INTERVAL '1' HOUR"), "yyyyMMdd'T'HHmmss"),
        F.lit(".zip"),
    )
    named = roles.events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.lit("notes.raw")).otherwise(stamp).alias("recording"),
        F.when(F.col("event_id") % 5 == 0, F.lit("export.zip")).otherwise(span).alias("archive"),
    )
    start, end = tm.range_in_name("archive")
    return shown(
        named.select(
            "event_id",
            tm.recording_start("recording").alias("recording_start"),
            start.alias("range_start"),
            end.alias("range_end"),
        )
    )


@query(
    "select_combos",
    """
    SELECT event_type AS instrument, user_id % 4 AS leg, value AS level_a, value * 2 AS "spec_500Hz" FROM events
    WHERE event_type IN ('click', 'view') AND user_id % 4 IN (1, 2)
    """,
)
def select_combos(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select(
        "instrument",
        (F.col("user_id") % 4).alias("leg"),
        F.col("value").alias("level_a"),
        (F.col("value") * 2).alias("spec_500Hz"),
        "value",
        "time",
    )
    levels = projection.level_columns(rows.columns)
    return projection.select_combos(rows, levels, instrument=["click", "view"], leg=[1, 2], experiment=None)


_CODES_SQL = "(VALUES " + ", ".join(
    "({}, '{}')".format(code, name.replace("'", "''")) for code, name in schema.WEATHER_CODES.items()
) + ") AS c(code, name)"


@query(
    "code_lookup",
    f"""
    SELECT e.event_id, e.user_id % 100 AS code,
           coalesce(c.name, 'Code ' || CAST(e.user_id % 100 AS VARCHAR)) AS code_name
    FROM events e LEFT JOIN {_CODES_SQL} ON c.code = e.user_id % 100
    """,
)
def code_lookup(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select("event_id", (F.col("user_id") % 100).alias("code"))
    return projection.with_category_name(rows, "code", schema.WEATHER_CODES, "code_name")


@query(
    "category_shares",
    f"""
    WITH n AS (SELECT event_type AS instrument, CAST(user_id % 100 AS INTEGER) AS code, count(*) AS n
               FROM events GROUP BY 1, 2)
    SELECT instrument, n.code, n, round(n * 100.0 / sum(n) OVER (PARTITION BY instrument), 6) AS pct,
           coalesce(c.name, 'Code ' || CAST(n.code AS VARCHAR)) AS code_name
    FROM n LEFT JOIN {_CODES_SQL} ON c.code = n.code
    """,
)
def category_shares(spark, sf_dir):
    rows = roles.events(spark, sf_dir).withColumn("weather", (F.col("user_id") % 100).cast("double"))
    shares = stats.category_shares(rows, ["instrument"], "weather")
    return shown(projection.with_category_name(shares, "code", schema.WEATHER_CODES, "code_name"))




@query(
    "true_wind",
    """
    WITH a AS (SELECT event_id, radians((event_id * 37) % 360 + (user_id * 11) % 360) AS app,
                      radians((event_id * 53) % 360) AS cog, value AS speed, value / 10 AS sog FROM events),
         b AS (SELECT event_id, sog * sin(cog) - speed * sin(app) AS u, sog * cos(cog) - speed * cos(app) AS v FROM a),
         c AS (SELECT event_id, CASE WHEN u = 0 AND v = 0 THEN 0 ELSE degrees(atan2(-u, -v)) END AS d, sqrt(u * u + v * v) AS s FROM b)
    SELECT event_id, fmod(round(CASE WHEN d < 0 THEN d + 360 ELSE d END, 6), 360) AS true_wind_direction_deg,
           round(s, 6) AS true_wind_speed_m_s FROM c
    """,
)
def true_wind(spark, sf_dir):
    """True wind, its direction from 0 to below 360 degrees also where rounding reaches 360; calm comes from 0."""
    direction, speed = wind.true_wind(
        (F.col("event_id") * 37 % 360).cast("double"),
        F.col("value"),
        (F.col("user_id") * 11 % 360).cast("double"),
        (F.col("event_id") * 53 % 360).cast("double"),
        F.col("value") / 10,
    )
    return shown(
        roles.events(spark, sf_dir).select(
            "event_id", F.pmod(roles.r6(direction), F.lit(360.0)).alias("true_wind_direction_deg"), speed.alias("true_wind_speed_m_s")
        )
    )


@query(
    "dms_parse",
    """
    SELECT event_id,
           CASE WHEN event_id % 9 = 0 THEN NULL
                ELSE round((CASE WHEN user_id % 2 = 0 THEN -1 ELSE 1 END) * (user_id % 90 + (event_id % 60) / 60.0), 6)
           END AS latitude_deg
    FROM events
    """,
)
def dms_parse(spark, sf_dir):
    text = F.concat(
        (F.col("user_id") % 90).cast("string"),
        F.lit("° "),
        (F.col("event_id") % 60).cast("string"),
        F.lit(".0' "),
        F.when(F.col("user_id") % 2 == 0, "S").otherwise("N"),
    )
    text = F.when(F.col("event_id") % 9 == 0, F.col("props")).otherwise(text)
    return shown(roles.events(spark, sf_dir).select("event_id", geo.parse_dms(text).alias("latitude_deg")))


@query(
    "alias_frequency",
    """
    WITH f AS (SELECT event_id, CAST(event_id * 137 AS DOUBLE) AS f FROM events)
    SELECT event_id, round(CASE WHEN f <= 16000 THEN f ELSE least(fmod(f, 32000), 32000 - fmod(f, 32000)) END, 6)
             AS aliased_hz FROM f
    """,
)
def alias_frequency(spark, sf_dir):
    freq = (F.col("event_id") * 137).cast("double")
    return shown(
        roles.events(spark, sf_dir).select(
            "event_id", ac.aliased_frequency(freq, F.lit(32_000.0)).alias("aliased_hz")
        )
    )


@query(
    "null_island",
    f"""
    SELECT event_id, lat AS latitude_deg, lon AS longitude_deg
    FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 0 ELSE {roles.LAT_SQL} END AS lat,
                 CASE WHEN event_id % 20 = 0 THEN 0 ELSE {roles.LON_SQL} END AS lon FROM events)
    WHERE NOT (lat = 0 AND lon = 0)
    """,
)
def null_island(spark, sf_dir):
    rows = roles.events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, 0.0).otherwise(roles.latitude()).alias("latitude_deg"),
        F.when(F.col("event_id") % 20 == 0, 0.0).otherwise(roles.longitude()).alias("longitude_deg"),
    )
    return position.drop_null_island(rows)


@query(
    "zero_blank",
    """
    SELECT event_id, CASE WHEN value - 3 > 0 THEN value - 3 END AS trilux_chlorophyll,
           CASE WHEN value - 10 > 0 THEN value - 10 END AS trilux_turbidity
    FROM events
    """,
)
def zero_blank(spark, sf_dir):
    from tideline.operators import cleaning

    rows = roles.events(spark, sf_dir).select(
        "event_id",
        (F.col("value") - 3).alias("trilux_chlorophyll"),
        (F.col("value") - 10).alias("trilux_turbidity"),
    )
    return cleaning.blank_nonpositive(rows, schema.OPTICAL_COLUMNS)


@query(
    "leg_clip",
    f"SELECT leg, instrument, event_id, ts AS time FROM {roles.LEGGED_SQL}",
)
def leg_clip(spark, sf_dir):
    # Rows say which leg they belong to (by whole days); the window cuts off the last hours of each.
    day = F.datediff(F.col("time"), F.lit("2024-01-01").cast("date"))
    rows = roles.events(spark, sf_dir).withColumn("leg", F.least(F.floor(day / 5) + 1, F.lit(6)).cast("int"))
    return shown(ranges.clip_to_leg(rows, roles.windows(spark), "time").select("leg", "instrument", "event_id", "time"))


_OVERLAPPING = [("2024-01-02 06:00:00", "2024-01-03 12:00:00"), ("2024-01-03 00:00:00", "2024-01-04 00:00:00"),
                ("2024-01-10 10:10:10", "2024-01-10 10:40:00"), ("2024-01-20 00:00:00", "2024-01-25 00:00:00")]


@query(
    "in_any_window",
    "SELECT event_id, event_type AS instrument, ts AS time FROM events WHERE "
    + " OR ".join(f"ts BETWEEN TIMESTAMP '{a}' AND TIMESTAMP '{b}'" for a, b in _OVERLAPPING),
)
def in_any_window(spark, sf_dir):
    rows = ", ".join(f"(TIMESTAMP_LTZ'{a} UTC', TIMESTAMP_LTZ'{b} UTC')" for a, b in _OVERLAPPING)
    events = roles.events(spark, sf_dir).select("event_id", "instrument", "time")
    held = spark.sql(f"SELECT * FROM VALUES {rows} AS w(start, end)")
    return shown(ranges.in_any_window(events, held, []))


@query(
    "expected_combos",
    f"""
    WITH seen AS (SELECT DISTINCT leg, instrument FROM {roles.LEGGED_SQL})
    SELECT w.leg, i.instrument, s.leg IS NOT NULL AS has_data,
           CASE WHEN s.leg IS NULL THEN w.w_start END AS previous_time,
           CASE WHEN s.leg IS NULL THEN w.w_end END AS current_time,
           CASE WHEN s.leg IS NULL THEN round_even(date_diff('second', w.w_start, w.w_end) / 60.0, 3)::DOUBLE END
             AS gap_minutes
    FROM {roles.WINDOWS_SQL}, {roles.INSTRUMENTS_SQL}
    LEFT JOIN seen s ON s.leg = w.leg AND s.instrument = i.instrument
    """,
)
def expected_combos(spark, sf_dir):
    from tideline.operators import gaps

    keys = ["leg", "instrument"]
    held = roles.windows(spark)
    expected = products.expected_combos(held, [(i,) for i in roles.INSTRUMENTS], ["instrument"])
    found = products.gap_analysis(roles.legged(spark, sf_dir), expected, held, keys, 60.0)["coverage"]
    whole = gaps.no_data_gaps(found, keys, held).select(*keys, "previous_time", "current_time", "gap_minutes")
    return shown(found.join(whole, keys, "left"))


@query(
    "station_parse",
    r"""
    WITH n AS (SELECT p_partkey, CASE p_partkey % 4
                 WHEN 0 THEN 'Leg3_St' || p_size || '-' || (p_partkey % 3 + 1) || '_St99_1.cnv'
                 WHEN 1 THEN 'L002_ST' || p_size WHEN 2 THEN 'St' || p_size || '_' || (p_partkey % 5)
                 ELSE 'testcast_' || p_size END AS name FROM part)
    SELECT p_partkey, name,
           CAST(CASE WHEN p_partkey % 4 < 3 THEN regexp_extract(name, '(?i)St(\d+)', 1) END AS INTEGER) AS station,
           CAST(CASE p_partkey % 4 WHEN 0 THEN p_partkey % 3 + 1 WHEN 1 THEN 1 WHEN 2 THEN p_partkey % 5 END AS INTEGER)
             AS cast_no
    FROM n
    """,
)
def station_parse(spark, sf_dir):
    part = roles.table(spark, sf_dir, "part")
    kind, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    name = (
        F.when(kind == 0, F.concat(F.lit("Leg3_St"), size, F.lit("-"), (F.col("p_partkey") % 3 + 1).cast("string"), F.lit("_St99_1.cnv")))
        .when(kind == 1, F.concat(F.lit("L002_ST"), size))
        .when(kind == 2, F.concat(F.lit("St"), size, F.lit("_"), (F.col("p_partkey") % 5).cast("string")))
        .otherwise(F.concat(F.lit("testcast_"), size))
    )
    station, number = tx.station_and_cast(F.col("name"))
    return part.select("p_partkey", name.alias("name")).select(
        "p_partkey", "name", station.alias("station"), number.alias("cast_no")
    )


@query(
    "metadata_entries",
    r"""
    SELECT p_partkey,
           CASE p_partkey % 4 WHEN 0 THEN 'System_UTC' WHEN 1 THEN 'Ship_' || p_brand WHEN 2 THEN 'a' END AS key,
           CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN 'b=' || p_size END AS value
    FROM part
    """,
)
def metadata_entries(spark, sf_dir):
    kind = F.col("p_partkey") % 4
    line = (
        F.when(kind == 0, F.concat(F.lit("* System UTC = "), "p_name"))
        .when(kind == 1, F.concat(F.lit("** Ship "), "p_brand", F.lit(": "), "p_name"))
        .when(kind == 2, F.concat(F.lit("*a=b="), F.col("p_size").cast("string")))
        .otherwise(F.lit("* plain remark"))
    )
    entry = tx.metadata_entry(line)
    return roles.table(spark, sf_dir, "part").select(
        "p_partkey", entry["key"].alias("key"), entry["value"].alias("value")
    )


@query(
    "measurement_names",
    """
    SELECT p_partkey, 'TS_' || list_aggregate(list_transform(string_split(p_name, ' '),
             lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '') AS column_name
    FROM part
    """,
)
def measurement_names(spark, sf_dir):
    name = F.concat(F.lit("TS_"), tx.camel_name(F.lower(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")))))
    return roles.table(spark, sf_dir, "part").select("p_partkey", name.alias("column_name"))
