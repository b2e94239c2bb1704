"""Queries over profiles, spectra, detections and column layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import schema
from tideline.functions import acoustic as ac
from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.operators import audit, detect, profile, sequence
from tideline.plans import products, roles
from tideline.plans.queries_clean import _RULES_SQL, _hampel_sql, _rules
from tideline.plans.queries_series import _dense_sql
from tideline.plans.registry import query
from tideline.plans.roles import nearest_sql, shown

# --- profiles: an order is a cast, its lines are the scans -----------------------------------------

_SCANS_SQL = """(SELECT CAST(l_orderkey % 6 + 1 AS INTEGER) AS leg,
    CASE WHEN l_orderkey % 10 < 8 THEN 'O' || l_orderkey || '_St' || (l_orderkey % 97) || '-' || (l_orderkey % 9 + 1)
         ELSE 'test_' || l_orderkey END AS "cast",
    CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 1000 + l_suppkey AS scan_no, l_shipdate AS time,
    CASE WHEN l_suppkey % 3 > 0 THEN CAST(l_suppkey % 180 - 90 AS DOUBLE) END AS latitude_deg,
    CASE WHEN l_suppkey % 3 > 0 THEN CAST(l_partkey % 360 - 180 AS DOUBLE) END AS longitude_deg,
    l_quantity AS pressure_dbar, l_orderkey FROM lineitem)"""


def _scans(spark, sf_dir):
    order = F.col("l_orderkey")
    station = F.concat(
        F.lit("O"), order.cast("string"), F.lit("_St"), (order % 97).cast("string"), F.lit("-"), (order % 9 + 1).cast("string")
    )
    placed = F.col("l_suppkey") % 3 > 0
    return roles.table(spark, sf_dir, "lineitem").select(
        (order % 6 + 1).cast("int").alias("leg"),
        F.when(order % 10 < 8, station).otherwise(F.concat(F.lit("test_"), order.cast("string"))).alias("cast"),
        (F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("scan_no"),
        F.col("l_shipdate").cast("timestamp").alias("time"),
        F.when(placed, (F.col("l_suppkey") % 180 - 90).cast("double")).alias("latitude_deg"),
        F.when(placed, (F.col("l_partkey") % 360 - 180).cast("double")).alias("longitude_deg"),
        F.col("l_quantity").alias("pressure_dbar"),
        "l_orderkey",
    )


_CASTS_SQL = f"""(SELECT leg, "cast", min(time) AS start, count(*) AS n_scans, max(pressure_dbar) AS max_depth,
      arg_min(latitude_deg, scan_no) FILTER (latitude_deg IS NOT NULL) AS lat,
      arg_min(longitude_deg, scan_no) FILTER (longitude_deg IS NOT NULL) AS lon,
      CAST(min(l_orderkey) % 97 AS INTEGER) AS station, CAST(min(l_orderkey) % 9 + 1 AS INTEGER) AS cast_no
    FROM {_SCANS_SQL} WHERE "cast" LIKE 'O%' GROUP BY 1, 2)"""
_LABELS_SQL = f"""(SELECT * EXCLUDE (l1, l2), CASE WHEN count(*) OVER (PARTITION BY leg, l2) > 1
        THEN l2 || ' [' || "cast" || ']' ELSE l2 END AS label FROM (
      SELECT *, CASE WHEN count(*) OVER (PARTITION BY leg, l1) > 1 THEN l1 || strftime(start, ' (%d %b)') ELSE l1 END AS l2
      FROM (SELECT *, printf('St%02d-%d', station, cast_no) AS l1 FROM {_CASTS_SQL})))"""


@query("cast_table", f'SELECT leg, "cast", start, n_scans, max_depth, lat, lon, station, cast_no, label FROM {_LABELS_SQL}')
def cast_table(spark, sf_dir):
    return shown(profile.cast_table(_scans(spark, sf_dir), ["leg"]))


@query(
    "cast_labels",
    f"""
    SELECT leg, "cast", label, label || ' · ' || strftime(start, '%Y-%m-%d %H:%M UTC') || CASE WHEN lat IS NULL THEN '' ELSE
           ' · ' || printf('%.2f', abs(lat)) || '°' || CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END || ' ' ||
           printf('%.2f', abs(lon)) || '°' || CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END END
           || ' · max ' || printf('%.0f', max_depth) || ' dbar' AS description
    FROM {_LABELS_SQL}
    """,
)
def cast_labels(spark, sf_dir):
    casts = profile.cast_description(profile.cast_table(_scans(spark, sf_dir), ["leg"]))
    return casts.select("leg", "cast", "label", "description")


_SIGNED_SQL = f'(SELECT leg, "cast", count(*) AS n_rows, list_sort(list(pressure_dbar)) AS sig FROM {_SCANS_SQL} GROUP BY 1, 2)'


@query(
    "cast_duplicates",
    f"""
    SELECT leg, "cast", n_rows, same_as, n_casts FROM (
      SELECT *, min("cast") OVER (PARTITION BY leg, sig) AS same_as, count(*) OVER (PARTITION BY leg, sig) AS n_casts
      FROM {_SIGNED_SQL}) WHERE n_casts > 1
    """,
)
def cast_duplicates(spark, sf_dir):
    return profile.identical_casts(_scans(spark, sf_dir), ["leg"], ["pressure_dbar"])


@query(
    "cross_leg_casts",
    f"""
    SELECT leg, "cast", n_rows FROM (SELECT *, min(leg) OVER (PARTITION BY sig) AS first_leg FROM {_SIGNED_SQL})
    WHERE leg = first_leg
    """,
)
def cross_leg_casts(spark, sf_dir):
    kept = profile.drop_cross_leg_copies(_scans(spark, sf_dir), "leg", ["pressure_dbar"])
    return kept.groupBy("leg", "cast").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "casts_without_position",
    f'SELECT leg, "cast" FROM {_SCANS_SQL} GROUP BY 1, 2 HAVING count(latitude_deg) = 0',
)
def casts_without_position(spark, sf_dir):
    return profile.casts_without_position(_scans(spark, sf_dir), ["leg"])


@query(
    "cast_order",
    f"""
    SELECT leg, "cast", scan_no, row_number() OVER (PARTITION BY leg ORDER BY start, "cast", scan_no) AS position
    FROM (SELECT *, min(time) OVER (PARTITION BY leg, "cast") AS start FROM {_SCANS_SQL})
    """,
)
def cast_order(spark, sf_dir):
    scans = _scans(spark, sf_dir).select("leg", "cast", "scan_no", "time")
    starts = scans.groupBy("leg", "cast").agg(F.min("time").alias("start"))
    rows = scans.drop("time").join(starts, ["leg", "cast"])
    chunk = sequence.time_chunk("start", 10 * tm.DAY)
    numbered = sequence.with_row_number(rows, ["leg"], ["start", "cast", "scan_no"], chunk, "position")
    return profile.profile_order(numbered.withColumnRenamed("start", "time")).drop("time")


@query(
    "profile_depths",
    "SELECT l_orderkey, l_linenumber, l_quantity AS pressure_dbar FROM lineitem WHERE l_returnflag <> 'R'",
)
def profile_depths(spark, sf_dir):
    # The depth arrives as text and is unreadable in some rows.
    text = F.when(F.col("l_returnflag") == "R", F.lit("bad depth")).otherwise(F.col("l_quantity").cast("string"))
    rows = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("pressure_dbar"))
    return profile.depth_valid(rows)


@query(
    "cast_name_sources",
    r"""
    SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'St' || p_size || '_1.v2' WHEN 1 THEN 'hex' || p_size ELSE 'unknown' END
             AS "cast" FROM part
    """,
)
def cast_name_sources(spark, sf_dir):
    kind, size = F.col("p_partkey") % 3, F.col("p_size").cast("string")
    source_file = F.when(kind == 0, F.concat(F.lit("St"), size, F.lit("_1.v2.cnv")))
    header_name = F.when(kind == 1, F.concat(F.lit("C:\\Data\\CAST\\hex"), size, F.lit(".hex")))
    return roles.table(spark, sf_dir, "part").select("p_partkey", tx.cast_label(source_file, header_name).alias("cast"))


# --- spectra: an embedding is a spectrum in steps of 1 kHz, level = 100 x value ---------------------

_BINS_SQL = """(SELECT vec_id, label, (p - 1) * 1000.0::DOUBLE AS f, 100.0 * embedding[p]::DOUBLE AS level,
                       abs(embedding[p]::DOUBLE) AS mag, embedding[p]::DOUBLE AS x, p
                FROM embeddings, range(1, 65) r(p))"""


def _spectra(spark, sf_dir):
    vectors = roles.table(spark, sf_dir, "embeddings")
    values = F.transform("embedding", lambda x: x.cast("double"))
    spec = F.transform(
        values, lambda x, i: F.struct((i * 1000.0).alias("freq_hz"), (x * 100.0).alias("level_db"))
    )
    bins = F.transform(values, lambda x, i: F.struct((i * 1000.0).alias("freq_hz"), F.abs(x).alias("magnitude")))
    return vectors.select("vec_id", "label", values.alias("values"), spec.alias("spec"), bins.alias("bins"))


def _level_sql(low: float, high: float | None) -> str:
    upper = f" AND f < {high}" if high is not None else ""
    return f"round(10 * log10(sum(pow(10, level / 10)) FILTER (f >= {low}{upper} AND f > 0)), 6)"


@query(
    "spectrum_bands",
    f"""
    SELECT vec_id, {_level_sql(0, None)} AS level_broadband, {_level_sql(500, 2000)} AS level_0_5_2khz,
           {_level_sql(2000, 10000)} AS level_2_10khz, {_level_sql(10000, 50000)} AS level_10_50khz,
           {_level_sql(50000, None)} AS level_50_256khz
    FROM {_BINS_SQL} GROUP BY vec_id
    """,
)
def spectrum_bands(spark, sf_dir):
    spec = F.col("spec")
    bands = [ac.energetic_sum(spec, low, high).alias(name) for name, (low, high) in ac.BANDS.items()]
    return shown(_spectra(spark, sf_dir).select("vec_id", ac.energetic_sum(spec).alias("level_broadband"), *bands))


@query(
    "spectrum_peak",
    f"""
    SELECT vec_id, arg_max(f, level) FILTER (f > 0) AS peak_freq_hz, CAST(count(*) AS INTEGER) AS n_bins,
           min(f) AS f_min_hz, max(f) AS f_max_hz,
           'spec_' || CAST(CAST(arg_max(f, level) FILTER (f > 0) AS BIGINT) AS VARCHAR) || 'Hz' AS peak_name
    FROM {_BINS_SQL} GROUP BY vec_id
    """,
)
def spectrum_peak(spark, sf_dir):
    ordered = ac.ordered_bins(F.reverse("spec"))
    freqs = F.transform(ordered, lambda b: b["freq_hz"])
    named = _spectra(spark, sf_dir).select(
        "vec_id",
        ac.peak_frequency(ordered).alias("peak_freq_hz"),
        F.size(ordered).alias("n_bins"),
        F.array_min(freqs).alias("f_min_hz"),
        F.array_max(freqs).alias("f_max_hz"),
    )
    out = named.withColumn("peak_name", ac.bin_name(F.col("peak_freq_hz")))
    return out.withColumn("peak_freq_hz", ac.bin_frequency(F.col("peak_name")))


# The instrument tones folded at a sample rate of 32 kHz.
_TONES = [6_000.0, 11_000.0, 16_000.0]


def _near_sql(tone: float) -> str:
    return f"sum(mag * mag) FILTER (f BETWEEN {tone - 250} AND {tone + 250})"


@query(
    "ping_energy",
    f"""
    SELECT vec_id, round(({' + '.join(_near_sql(t) for t in _TONES)}) / sum(mag * mag), 6) AS share,
           ({' + '.join(_near_sql(t) for t in _TONES)}) / sum(mag * mag) > 0.08 AS is_ping
    FROM {_BINS_SQL} GROUP BY vec_id
    """,
)
def ping_energy(spark, sf_dir):
    bins = F.col("bins")
    return shown(
        _spectra(spark, sf_dir).select(
            "vec_id",
            ac.ping_energy_share(bins, _TONES, 250.0).alias("share"),
            ac.is_ping_by_energy(bins, _TONES, 250.0, 0.08).alias("is_ping"),
        )
    )


_PEAK_SQL = f"max(mag) FILTER (f IN ({', '.join(str(t) for t in _TONES)})) > avg(mag) * 2.2"


@query("ping_peak", f"SELECT vec_id, {_PEAK_SQL} AS is_ping FROM {_BINS_SQL} GROUP BY vec_id")
def ping_peak(spark, sf_dir):
    return _spectra(spark, sf_dir).select("vec_id", ac.is_ping_by_peak(F.col("bins"), _TONES, 250.0, 2.2).alias("is_ping"))


_LOUD_SQL = f"""(SELECT label, vec_id, chunk_rms, sqrt(sum(sq) OVER (PARTITION BY label) / sum(n) OVER (PARTITION BY label))
    AS file_rms FROM (SELECT label, vec_id, sum(x * x) AS sq, count(*) AS n, sqrt(avg(x * x)) AS chunk_rms
                      FROM {_BINS_SQL} GROUP BY 1, 2))"""


@query(
    "rms_loudness",
    f"""SELECT label, vec_id, round(chunk_rms, 6) AS chunk_rms, round(file_rms, 6) AS file_rms,
               round(chunk_rms / (file_rms + 1e-9), 6) AS loudness_ratio FROM {_LOUD_SQL}""",
)
def rms_loudness(spark, sf_dir):
    return shown(detect.loudness(_spectra(spark, sf_dir), ["label"], "vec_id", "values"))


_EPS, _MIN_SAMPLES = 1.2, 4
_NOISE_SQL = f"""(WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    p AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label
          AND list_distance(a.v, b.v) <= {_EPS}),
    core AS (SELECT a FROM p GROUP BY a HAVING count(*) >= {_MIN_SAMPLES})
    SELECT label, vec_id FROM embeddings WHERE vec_id NOT IN (SELECT a FROM p WHERE b IN (SELECT a FROM core)))"""


@query("dbscan_noise", f"SELECT label, vec_id FROM {_NOISE_SQL}")
def dbscan_noise(spark, sf_dir):
    vectors = roles.table(spark, sf_dir, "embeddings")
    return detect.noise_points(vectors, ["label"], "vec_id", "embedding", _EPS, _MIN_SAMPLES).select("label", "vec_id")


_TOP_SQL = f"""(SELECT vec_id, list(name ORDER BY x DESC, name)[1] AS best, max(x) AS prob,
                  array_to_string(list(name || ':' || printf('%.2f', x) ORDER BY x DESC, name)[1:3], '; ') AS top_3
                FROM (SELECT vec_id, 'L' || p AS name, x FROM {_BINS_SQL}) GROUP BY vec_id)"""


def _labelled(df):
    """Add labels out of the vector values: the n-th value is the probability of label Ln."""
    labels = F.transform(
        "values", lambda x, i: F.struct(F.concat(F.lit("L"), (i + 1).cast("string")).alias("label"), x.alias("prob"))
    )
    return df.withColumn("top", detect.top_labels(labels))


@query("top3_labels", f"SELECT vec_id, best AS top_prediction, round(prob, 3) AS confidence, top_3 FROM {_TOP_SQL}")
def top3_labels(spark, sf_dir):
    top = F.transform("top", lambda t: F.concat(t["label"], F.lit(":"), tx.fixed(t["prob"], 2)))
    return _labelled(_spectra(spark, sf_dir)).select(
        "vec_id",
        F.col("top")[0]["label"].alias("top_prediction"),
        F.round(F.col("top")[0]["prob"], 3).alias("confidence"),
        F.array_join(top, "; ").alias("top_3"),
    )


_ENERGY_SQL = f"({' + '.join(_near_sql(t) for t in _TONES)}) / sum(mag * mag) > 0.16"
_AVOID = ["L1", "L2", "L3", "L4", "L5"]
_GROUPING_S, _LOUD = 30, 1.1
_AVOID_SQL = ", ".join(f"'{a}'" for a in _AVOID)
_LOG_SQL = f"""(WITH c AS (SELECT n.label, n.vec_id, CAST(n.vec_id AS DOUBLE) AS off, t.best, round(t.prob, 3) AS confidence,
                         round(l.chunk_rms / (l.file_rms + 1e-9), 3) AS ratio, k.is_ping
                  FROM {_NOISE_SQL} n JOIN {_TOP_SQL} t USING (vec_id) JOIN {_LOUD_SQL} l USING (vec_id)
                  JOIN (SELECT vec_id, {_PEAK_SQL} OR {_ENERGY_SQL} AS is_ping FROM {_BINS_SQL} GROUP BY vec_id) k USING (vec_id)),
         v AS (SELECT * FROM c WHERE NOT is_ping AND best NOT IN ({_AVOID_SQL})),
         s AS (SELECT *, sum(fresh) OVER (PARTITION BY label ORDER BY off) AS g FROM (
                 SELECT *, CASE WHEN off - lag(off) OVER (PARTITION BY label ORDER BY off) <= {_GROUPING_S} THEN 0 ELSE 1 END
                   AS fresh FROM v)),
         e AS (SELECT *, count(*) OVER w AS size, min(off) OVER w AS first_off, bool_or(ratio >= {_LOUD}) OVER w AS hq
               FROM s WINDOW w AS (PARTITION BY label, g))
    SELECT c.label, c.vec_id, c.off AS chunk_offset_s, c.best AS top_prediction, c.confidence, c.ratio AS loudness_ratio,
           CASE WHEN e.size >= 2 THEN 'KEPT' ELSE 'DISCARDED' END AS status,
           CASE WHEN c.is_ping THEN 'Instrument Ping' WHEN e.vec_id IS NULL THEN 'Failed Validation'
                WHEN e.size >= 2 THEN 'Part of Event Group' ELSE 'Isolated Anomaly' END AS reason,
           CASE WHEN e.size >= 2 THEN 'rec' || c.label || '_' || CAST(CAST(e.first_off AS BIGINT) AS VARCHAR) || 's' END
             AS event_id,
           CASE WHEN e.size >= 2 THEN e.hq END AS high_quality
    FROM c LEFT JOIN e ON e.vec_id = c.vec_id)"""


def _candidate_log(spark, sf_dir):
    spectra = _spectra(spark, sf_dir)
    vectors = roles.table(spark, sf_dir, "embeddings")
    noise = detect.noise_points(vectors, ["label"], "vec_id", "embedding", _EPS, _MIN_SAMPLES).select("label", "vec_id")
    loud = detect.loudness(spectra, ["label"], "vec_id", "values")
    scored = _labelled(spectra).select(
        "label",
        "vec_id",
        F.col("vec_id").cast("double").alias("chunk_offset_s"),
        F.concat(F.lit("rec"), F.col("label").cast("string")).alias("stem"),
        F.col("top")[0]["label"].alias("top_prediction"),
        F.round(F.col("top")[0]["prob"], 3).alias("confidence"),
        detect.is_ping(F.col("bins"), _TONES, 250.0, 0.16, 2.2).alias("ping"),
    )
    candidates = (
        noise.join(scored, ["label", "vec_id"])
        .join(loud.select("label", "vec_id", F.round("loudness_ratio", 3).alias("loudness_ratio")), ["label", "vec_id"])
    )
    log = detect.classify_candidates(
        candidates, ["label"], "stem", F.col("ping"), F.col("top_prediction"), F.col("loudness_ratio"), _AVOID,
        _GROUPING_S, 2, _LOUD,
    )
    return log.drop("stem", "ping")


@query("candidate_cascade", f"SELECT * FROM {_LOG_SQL}")
def candidate_cascade(spark, sf_dir):
    return _candidate_log(spark, sf_dir)


_BASE_TIME = "2024-01-01 00:00:00"
_EVENTS_SQL = f"""(WITH k AS (SELECT *, TIMESTAMP '{_BASE_TIME}' + to_minutes(CAST(vec_id * 80 AS BIGINT)) AS time
                     FROM {_LOG_SQL} WHERE status = 'KEPT'),
         l AS (SELECT event_id, top_prediction, max(confidence) AS c FROM k GROUP BY 1, 2),
         t AS (SELECT event_id, array_to_string(list(top_prediction || ':' || printf('%.2f', c) ORDER BY c DESC, top_prediction), '; ')
                 AS labels FROM l GROUP BY 1)
    SELECT label, event_id, min(time) AS time, max(time) + INTERVAL '3 seconds' AS end_time,
           (epoch_us(max(time)) - epoch_us(min(time)))::DOUBLE / 1e6 + 3 AS duration_s, count(*) AS n_anomalies,
           bool_or(high_quality) AS high_quality, max(loudness_ratio) AS max_loudness_ratio,
           list(top_prediction ORDER BY confidence DESC, chunk_offset_s)[1] AS top_prediction, any_value(t.labels) AS labels
    FROM k JOIN t USING (event_id) GROUP BY label, event_id)"""


def _timed_log(spark, sf_dir):
    start = F.unix_micros(F.expr(f"TIMESTAMP_LTZ'{_BASE_TIME} UTC'"))
    return _candidate_log(spark, sf_dir).withColumn(
        "time", F.timestamp_micros(start + F.col("vec_id") * 80 * tm.MINUTE)
    )


@query("event_table", f"SELECT * FROM {_EVENTS_SQL}")
def event_table(spark, sf_dir):
    return shown(detect.event_table(_timed_log(spark, sf_dir), ["label"]))


_VIEW_FIXES_SQL = f"(SELECT ts, {roles.LAT_SQL} AS lat, {roles.LON_SQL} AS lon FROM events WHERE event_type = 'view')"


def _view_fixes(spark, sf_dir):
    return roles.stream(spark, sf_dir, "view").select(
        "time", roles.latitude().alias("latitude_deg"), roles.longitude().alias("longitude_deg")
    )


@query(
    "detector_product",
    f"""SELECT * EXCLUDE (ts, g_lat, g_lon, g_ts), ts AS time, round(g_lat, 6) AS latitude_deg, g_lon AS longitude_deg FROM """
    + nearest_sql(f"(SELECT * EXCLUDE (time), time AS ts FROM {_EVENTS_SQL})", _VIEW_FIXES_SQL, ["lat", "lon"], 600, "g"),
)
def detector_product(spark, sf_dir):
    return shown(
        products.detection_product(_timed_log(spark, sf_dir), ["label"], _view_fixes(spark, sf_dir), [], tolerance_s=600)
    )


_SPECTRUM_ROWS_SQL = f"""(SELECT vec_id, label, TIMESTAMP '{_BASE_TIME}' + to_minutes(CAST(vec_id * 20 AS BIGINT)) AS ts,
      sum(pow(10, level / 10)) FILTER (f > 0) AS power, arg_max(f, level) FILTER (f > 0) AS peak
    FROM {_BINS_SQL} GROUP BY 1, 2)"""


@query(
    "spectrum_product",
    _dense_sql(
        f"""SELECT CAST(label AS INTEGER) AS label, date_trunc('day', ts) AS time, round(10 * log10(avg(power)), 6)
                     AS level_broadband, round(avg(peak), 6) AS peak_freq_hz, round(avg(g_lat), 6) AS latitude_deg,
                   round(avg(g_lon), 6) AS longitude_deg
            FROM {nearest_sql(_SPECTRUM_ROWS_SQL, _VIEW_FIXES_SQL, ["lat", "lon"], 600, "g")} GROUP BY 1, 2""",
        "1 day",
        ["level_broadband", "peak_freq_hz", "latitude_deg", "longitude_deg"],
        "label",
    ),
)
def spectrum_product(spark, sf_dir):
    start = F.unix_micros(F.expr(f"TIMESTAMP_LTZ'{_BASE_TIME} UTC'"))
    rows = _spectra(spark, sf_dir).select(
        "label",
        F.timestamp_micros(start + F.col("vec_id") * 20 * tm.MINUTE).alias("time"),
        ac.energetic_sum(F.col("spec")).alias("level_broadband"),
        ac.peak_frequency(F.col("spec")).alias("peak_freq_hz"),
    )
    return shown(
        products.spectrum_product(
            rows, ["label"], _view_fixes(spark, sf_dir), [], ["level_broadband"], ["peak_freq_hz"], "1D", 600
        )
    )


# --- products of one instrument ---------------------------------------------------------------------

_SAMPLER_SQL = f"(SELECT * FROM {roles.LEGGED_SQL} WHERE instrument = 'purchase')"
_LEG_FIXES_SQL = (
    f"(SELECT leg, ts, {roles.LAT_SQL} AS lat, {roles.LON_SQL} AS lon FROM {roles.LEGGED_SQL} WHERE instrument = 'view')"
)
_SAMPLER_KEPT_SQL = f"""(SELECT leg, event_id, ts, optic, value, g_lat, g_lon FROM (
    SELECT p.*, CASE WHEN value - 3 > 0 THEN value - 3 END AS optic,
           max(CASE WHEN value < pressure_under THEN ts END) OVER (PARTITION BY p.leg ORDER BY ts
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bad
    FROM {nearest_sql(_SAMPLER_SQL, _LEG_FIXES_SQL, ["lat", "lon"], 600, "g", keys=["leg"])} p JOIN {_RULES_SQL} ON r.leg = p.leg)
    WHERE bad IS NULL OR ts - bad > INTERVAL '15 minutes')"""
_SAMPLER_CLEAN_SQL = _hampel_sql(_SAMPLER_KEPT_SQL, "leg", "optic", 120 * tm.MINUTE, "clean")


@query(
    "instrument_product",
    _dense_sql(
        f"""SELECT leg, date_trunc('hour', ts) AS time, round(avg(clean), 6) AS trilux_turbidity,
                   round(avg(value), 6) AS ts_pressure, round(avg(g_lat), 6) AS latitude_deg,
                   round(avg(g_lon), 6) AS longitude_deg FROM {_SAMPLER_CLEAN_SQL} GROUP BY 1, 2""",
        "1 hour",
        ["trilux_turbidity", "ts_pressure", "latitude_deg", "longitude_deg"],
        "leg",
    ),
)
def instrument_product(spark, sf_dir):
    raw = roles.legged(spark, sf_dir).where(F.col("instrument") == "purchase").select(
        "leg",
        "time",
        F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("dataTimestamp"),
        (F.col("value") - 3).cast("string").alias("TX_Turbidity"),
        F.col("value").cast("string").alias("TS_Pressure"),
    )
    mapping = {"TX_Turbidity": "trilux_turbidity", "TS_Pressure": "ts_pressure"}
    fixes = roles.positions(spark, sf_dir).where(F.col("source") == "GGA")
    tables = products.instrument_product(
        raw, *schema.FERRYBOX, ["leg"], mapping, fixes, _rules(spark), freqs=["1h"], tolerance_s=600, window_minutes=240
    )
    return shown(tables["intervals"].drop("interval"))


_ORDER_FIXES_SQL = """(SELECT CAST(o_orderkey % 6 + 1 AS INTEGER) AS leg, o_orderdate AS ts,
      CAST(min(o_custkey % 180) - 90 AS DOUBLE) AS lat, CAST(min(o_custkey % 180) * 2 - 180 AS DOUBLE) AS lon
    FROM orders GROUP BY 1, 2)"""
_PLAIN_SCANS_SQL = f'(SELECT leg, "cast", scan_no, time AS ts, pressure_dbar FROM {_SCANS_SQL})'


@query(
    "profile_product",
    'SELECT leg, "cast", scan_no, ts AS time, g_lat AS latitude_deg, g_lon AS longitude_deg, pressure_dbar FROM '
    + nearest_sql(_PLAIN_SCANS_SQL, _ORDER_FIXES_SQL, ["lat", "lon"], 86_400, "g", keys=["leg"]),
)
def profile_product(spark, sf_dir):
    raw = _scans(spark, sf_dir).select(
        "leg", "scan_no", "time", F.concat("cast", F.lit(".cnv")).alias("Source_File"),
        F.col("pressure_dbar").cast("string").alias("prdM"),
    )
    fixes = roles.table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 6 + 1).cast("int").alias("leg"),
        F.col("o_orderdate").cast("timestamp").alias("time"),
        (F.col("o_custkey") % 180 - 90).cast("double").alias("latitude_deg"),
        ((F.col("o_custkey") % 180) * 2 - 180).cast("double").alias("longitude_deg"),
    )
    out = products.profile_product(raw, ["leg"], {"prdM": "pressure_dbar"}, fixes, [], tolerance_s=86_400)
    return shown(out)


# --- column layouts: a part is a file -----------------------------------------------------------------

_HEADERS = [
    ["Timestamp", "Heading, degrees true", "junk"],
    ["junk", "Timestamp", "Heading, degrees true"],
    ["Timestamp", "Heading,_degrees_true"],
    ["timestamp", "pitch", "roll"],
    ["timestamp", "Heading,_degrees_true", "roll", "extra"],
]
_RENAMES = {
    "Timestamp": "time", "timestamp": "time", "Heading, degrees true": "heading_deg_true",
    "Heading,_degrees_true": "heading_deg_true", "pitch": "pitch", "roll": "roll",
}
# The last one is derived later, so no raw column can give it. Some instruments have no rename map, some files no header.
_VARIABLES = ["heading_deg_true", "pitch", "wind_speed_true"]
_MAPPED_SQL = "instrument NOT LIKE '%5'"
_HEADERS_SQL = (
    "CASE WHEN p_partkey % 23 = 0 THEN NULL "
    + " ".join(f"WHEN (p_partkey + p_size) % 5 = {i} THEN {h}" for i, h in enumerate(_HEADERS))
    + " END"
)
_FILES_SQL = f"""(SELECT 'NAVIGATION' AS experiment, p_brand AS instrument, CAST(p_size % 6 + 1 AS INTEGER) AS leg,
      printf('part_%08d.csv', p_partkey) AS file_name, {_HEADERS_SQL} AS header,
      CASE p_partkey % 3 WHEN 0 THEN '.csv' WHEN 1 THEN '.json' ELSE '.zip' END AS raw_type, p_partkey % 17 = 0 AS is_empty,
      CASE WHEN (p_partkey + p_size) % 5 < 3 THEN 'Timestamp' ELSE 'timestamp' END AS time_col,
      CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN 'garbage'
           ELSE strftime(TIMESTAMP '2024-01-01' + to_hours(p_partkey), '%Y-%m-%d %H:%M:%S') END AS first_raw,
      CASE WHEN p_partkey % 17 = 0 OR p_partkey % 11 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + to_hours(p_partkey) END
        AS first_time,
      CASE WHEN p_partkey % 17 = 0 OR p_partkey % 11 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + to_hours(p_partkey + p_size) END
        AS last_time FROM part)"""
_LAYOUT_SQL = f"""(SELECT f.*, n.layout FROM (SELECT *, coalesce(list_sort(list_distinct(header)), []) AS k FROM {_FILES_SQL}) f
    JOIN (SELECT instrument, k, 'L' || row_number() OVER (PARTITION BY instrument ORDER BY first_seen) AS layout
          FROM (SELECT instrument, coalesce(list_sort(list_distinct(header)), []) AS k, min(printf('%03d', leg) || file_name) AS first_seen
                FROM {_FILES_SQL} GROUP BY 1, 2)) n ON n.instrument = f.instrument AND n.k = f.k)"""


def _file_rows(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size")
    kind = (key + size) % 5
    header = F.lit(None).cast("array<string>")
    for number, names in enumerate(_HEADERS):
        header = F.when(kind == number, F.array(*[F.lit(n) for n in names])).otherwise(header)
    header = F.when(key % 23 != 0, header)
    start = F.unix_micros(F.expr(f"TIMESTAMP_LTZ'{_BASE_TIME} UTC'"))
    first = F.timestamp_micros(start + key * tm.HOUR)
    first_raw = F.when(key % 17 == 0, F.lit(None)).when(key % 11 == 0, "garbage").otherwise(
        F.date_format(first, "yyyy-MM-dd HH:mm:ss")
    )
    files = roles.table(spark, sf_dir, "part").select(
        F.lit("NAVIGATION").alias("experiment"),
        F.col("p_brand").alias("instrument"),
        (size % 6 + 1).cast("int").alias("leg"),
        F.format_string("part_%08d.csv", key).alias("file_name"),
        header.alias("header"),
        F.when(key % 3 == 0, ".csv").when(key % 3 == 1, ".json").otherwise(".zip").alias("raw_type"),
        (key % 17 == 0).alias("is_empty"),
        F.when(kind < 3, "Timestamp").otherwise("timestamp").alias("time_col"),
        first_raw.alias("first_raw"),
        size.alias("_hours"),
    )
    return files.withColumn("first_time", tm.to_utc("first_raw")).select(
        *[c for c in files.columns if c != "_hours"],
        "first_time",
        F.timestamp_micros(tm.micros("first_time") + F.col("_hours") * tm.HOUR).alias("last_time"),
    )


def _dimensions(spark, sf_dir):
    """Rename mapping and expected variables of every instrument."""
    instruments = roles.table(spark, sf_dir, "part").select(
        F.lit("NAVIGATION").alias("experiment"), F.col("p_brand").alias("instrument")
    ).distinct()
    pairs = F.array(*[F.struct(F.lit(r).alias("raw"), F.lit(c).alias("canonical")) for r, c in _RENAMES.items()])
    mapping = instruments.where(_MAPPED_SQL).select("experiment", "instrument", F.inline(pairs))
    variables = instruments.withColumn("variables", F.array(*[F.lit(v) for v in _VARIABLES]))
    return mapping, variables


def _audit(spark, sf_dir):
    return audit.audit(_file_rows(spark, sf_dir), *_dimensions(spark, sf_dir))


@query("layout_numbering", f"SELECT instrument, leg, file_name, layout FROM {_LAYOUT_SQL}")
def layout_numbering(spark, sf_dir):
    return audit.with_layout(_file_rows(spark, sf_dir)).select("instrument", "leg", "file_name", "layout")


_LAYOUT_AUDIT_SQL = f"""(SELECT experiment, instrument, layout, count(*) AS n_files, count(*) FILTER (is_empty) AS n_empty_files,
      array_to_string(list_sort(list(DISTINCT leg)), ', ') AS legs, min(first_time) AS first_time, max(last_time) AS last_time,
      array_to_string(list_sort(list(DISTINCT time_col)), ', ') AS time_col,
      arg_min(first_raw, printf('%03d', leg) || file_name) FILTER (first_raw IS NOT NULL) AS time_sample,
      count(*) FILTER (first_raw IS NOT NULL AND first_time IS NULL) AS n_unparsed_times,
      arg_min('LEG' || leg || '/' || file_name, printf('%03d', leg) || file_name) AS example_file
    FROM {_LAYOUT_SQL} GROUP BY 1, 2, 3)"""


@query(
    "layout_audit",
    f"""
    WITH t AS (SELECT instrument, layout, array_to_string(list(raw_type || ' x' || n ORDER BY n DESC, raw_type), ', ') AS raw_types
               FROM (SELECT instrument, layout, raw_type, count(*) AS n FROM {_LAYOUT_SQL} GROUP BY 1, 2, 3) GROUP BY 1, 2)
    SELECT a.*, t.raw_types FROM {_LAYOUT_AUDIT_SQL} a JOIN t USING (instrument, layout)
    """,
)
def layout_audit(spark, sf_dir):
    return shown(audit.layout_audit(audit.with_layout(_file_rows(spark, sf_dir))))


_RENAMES_SQL = "(VALUES " + ", ".join(f"('{r}', '{c}')" for r, c in _RENAMES.items()) + ") AS m(raw, canonical)"
_PAIRS_SQL = f"""(SELECT DISTINCT c.experiment, c.instrument, c.layout, c.raw, m.canonical
    FROM (SELECT experiment, instrument, layout, unnest(coalesce(header, [NULL])) AS raw FROM {_LAYOUT_SQL}) c
    LEFT JOIN {_RENAMES_SQL} ON m.raw = c.raw AND c.{_MAPPED_SQL})"""
_CONFLICTS_SQL = f"""(SELECT experiment, instrument, canonical, array_to_string(list_sort(list(DISTINCT raw)), ' | ') AS raw_columns,
      array_to_string(list_sort(list(DISTINCT layout)), ', ') AS layouts
    FROM {_PAIRS_SQL} WHERE canonical <> 'time' GROUP BY 1, 2, 3 HAVING count(DISTINCT raw) > 1)"""


@query("rename_conflicts", f"SELECT * FROM {_CONFLICTS_SQL}")
def rename_conflicts(spark, sf_dir):
    return _audit(spark, sf_dir)["conflicts"]


_KNOWN_SQL = [*_RENAMES, *_RENAMES.values()]
_SETS_SQL = f"""(SELECT experiment, instrument, layout, coalesce(array_to_string(list_sort(has), ' | '), '') AS provided,
      coalesce(array_to_string(list_sort(list_filter({_VARIABLES}, lambda v: NOT list_contains(has, v)
        AND (NOT mapped OR list_contains({_KNOWN_SQL}, v)))), ' | '), '') AS missing,
      CASE WHEN mapped THEN coalesce(array_to_string(list_sort(unmapped), ' | '), '') ELSE '' END AS dropped, NOT mapped AS no_rename_map
    FROM (SELECT experiment, instrument, layout, {_MAPPED_SQL} AS mapped,
        list_distinct(list_concat(coalesce(list(raw) FILTER (raw IS NOT NULL), []), coalesce(list(canonical) FILTER (canonical IS NOT NULL), []))) AS has,
        list(raw) FILTER (canonical IS NULL AND raw IS NOT NULL) AS unmapped
      FROM {_PAIRS_SQL} GROUP BY 1, 2, 3))"""


@query("column_sets", f"SELECT * FROM {_SETS_SQL}")
def column_sets(spark, sf_dir):
    sets = audit.column_sets(audit.with_layout(_file_rows(spark, sf_dir)), *_dimensions(spark, sf_dir))
    return sets.select(
        "experiment", "instrument", "layout", *[F.array_join(c, " | ").alias(c) for c in ("provided", "missing", "dropped")], "no_rename_map"
    )


_FILE_UNION_SQL = f"""(SELECT instrument, leg, layout, min(a) AS a, max(b) AS b FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY instrument, leg, layout ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY instrument, leg, layout ORDER BY a, b
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
      FROM (SELECT instrument, leg, layout, first_time AS a, last_time AS b FROM {_LAYOUT_SQL} WHERE first_time IS NOT NULL)))
    GROUP BY instrument, leg, layout, island)"""
_FILE_OVERLAPS_SQL = f"""(SELECT 'NAVIGATION' AS experiment, x.instrument, x.leg, x.layout AS layout_a, y.layout AS layout_b,
      round_even(sum(epoch_us(least(x.b, y.b)) - epoch_us(greatest(x.a, y.a)))::DOUBLE / 3.6e9, 2) AS overlap_hours,
      min(greatest(x.a, y.a)) AS overlap_start, max(least(x.b, y.b)) AS overlap_end
    FROM {_FILE_UNION_SQL} x JOIN {_FILE_UNION_SQL} y
      ON x.instrument = y.instrument AND x.leg = y.leg AND x.layout < y.layout AND x.a < y.b AND y.a < x.b
    WHERE greatest(x.a, y.a) < least(x.b, y.b) GROUP BY 1, 2, 3, 4, 5)"""


@query("file_overlaps", f"SELECT * FROM {_FILE_OVERLAPS_SQL}")
def file_overlaps(spark, sf_dir):
    return shown(audit.layout_overlaps(audit.with_layout(_file_rows(spark, sf_dir))))


@query(
    "audit_summary",
    f"""
    WITH b AS (SELECT experiment, instrument, CAST(sum(n_files) AS BIGINT) AS n_files, count(*) AS n_layouts,
                      CAST(sum(n_unparsed_times) AS BIGINT) AS unparsed_times FROM {_LAYOUT_AUDIT_SQL} GROUP BY 1, 2),
         m AS (SELECT instrument, count(*) FILTER (missing <> '') AS n, bool_and(no_rename_map) AS no_rename_map FROM {_SETS_SQL} GROUP BY 1),
         c AS (SELECT instrument, count(*) AS n FROM {_CONFLICTS_SQL} GROUP BY 1),
         o AS (SELECT instrument, count(*) AS n FROM {_FILE_OVERLAPS_SQL} GROUP BY 1)
    SELECT b.*, coalesce(m.n, 0) AS layouts_missing_variables, m.no_rename_map, coalesce(c.n, 0) AS rename_conflicts,
           coalesce(o.n, 0) AS leg_overlaps, n_layouts > 1 OR coalesce(m.n, 0) > 0 OR coalesce(c.n, 0) > 0
             OR coalesce(o.n, 0) > 0 OR unparsed_times > 0 AS flagged
    FROM b LEFT JOIN m USING (instrument) LEFT JOIN c USING (instrument) LEFT JOIN o USING (instrument)
    """,
)
def audit_summary(spark, sf_dir):
    return _audit(spark, sf_dir)["summary"]


@query(
    "file_ends",
    """
    SELECT l_orderkey AS file, arg_min(l_quantity, k) AS first_l_quantity, arg_max(l_quantity, k) AS last_l_quantity
    FROM (SELECT *, CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey * 1000000 + l_quantity * 10000 + l_suppkey AS k
          FROM lineitem) GROUP BY 1
    """,
)
def file_ends(spark, sf_dir):
    position = (
        F.col("l_linenumber").cast("long") * 1_000_000_000_000
        + F.col("l_partkey") * 1_000_000
        + (F.col("l_quantity") * 10_000).cast("long")
        + F.col("l_suppkey")
    )
    rows = roles.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file"), "l_quantity", position.alias("row_no"))
    return audit.first_and_last(rows, ["file"], "row_no", ["l_quantity"])
