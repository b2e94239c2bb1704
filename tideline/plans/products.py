"""Products made of several operators: cleaning, true wind, positions, profiles, spectra, detections, gaps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import schema
from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.functions import wind
from tideline.operators import asof, audit, cleaning, detect, gaps, position, profile, projection, ranges, resample
from tideline.session import materialize
from tideline.sources import lines, ranged

# Where leg, experiment and instrument stand in the path of a per-file table and of a raw file.
PROCESSED_FILE = r"/LEG(\d+)/([^/]+)/([^/]+)/[^/]+$"
RAW_FILE = r"/LEG(\d+)[^/]*/([^/]+)/(?:SEAPATH/)?([^/]+)/[^/]+$"


@dataclass
class Navigation:
    """Ship data the true wind needs; any of them may be missing.

    hdt and sxn23 give a heading, vtg course and speed over ground, positions
    the fixes with their source.
    """

    hdt: DataFrame | None = None
    sxn23: DataFrame | None = None
    vtg: DataFrame | None = None
    positions: DataFrame | None = None
    tolerance_s: float = schema.NAVIGATION_TOLERANCE_S
    half_window_s: float = schema.VELOCITY_HALF_WINDOW_S


def position_velocity(navigation: Navigation) -> list[asof.Source]:
    """The fixes half a window before and after each row."""
    tolerance = tm.seconds_us(navigation.tolerance_s)
    half = tm.seconds_us(navigation.half_window_s)
    return [
        asof.Source(
            navigation.positions,
            {f"_lat_{end}": "latitude_deg", f"_lon_{end}": "longitude_deg", f"_src_{end}": "source"},
            tolerance,
            shift_us=shift,
            match_time=f"_t_{end}",
        )
        for end, shift in (("a", -half), ("b", half))
    ]


def velocity_from_matches(half_window_s: float) -> tuple[Column, Column]:
    """(course, speed in knots) of a matched pair; NULL unless one source saw both ends far enough apart."""
    us_a, us_b = tm.micros("_t_a"), tm.micros("_t_b")
    usable = (F.col("_src_a") == F.col("_src_b")) & (us_b - us_a >= tm.seconds_us(half_window_s))
    course, speed = wind.velocity_between(
        F.col("_lat_a"), F.col("_lon_a"), F.when(usable, us_a), F.col("_lat_b"), F.col("_lon_b"), F.when(usable, us_b)
    )
    return F.when(usable, course), F.when(usable, speed)


def ship_velocity(df: DataFrame, navigation: Navigation, keys: list[str]) -> DataFrame:
    """Add course_over_ground_deg_true and speed_over_ground_kt out of positions alone."""
    matched = asof.nearest_asof(df, position_velocity(navigation), keys)
    course, speed = velocity_from_matches(navigation.half_window_s)
    return matched.select(
        *df.columns, course.alias("course_over_ground_deg_true"), speed.alias("speed_over_ground_kt")
    )


def true_wind(
    df: DataFrame, navigation: Navigation, keys: list[str], direction: str = "wind_angle_deg",
    speed: str = "wind_speed_m_s",
) -> DataFrame:
    """Add true wind and where heading and ship velocity came from.

    Heading: HDT, else SXN23. Ship velocity: VTG, else positions. All five
    lookups share one as-of pass. Provenance is NULL where there is no result.
    """
    tolerance = tm.seconds_us(navigation.tolerance_s)
    sources = []
    if navigation.hdt is not None:
        sources.append(asof.Source(navigation.hdt, {"_hdt": "heading_deg_true"}, tolerance))
    if navigation.sxn23 is not None:
        sources.append(asof.Source(navigation.sxn23, {"_sxn": "heading"}, tolerance))
    if navigation.vtg is not None:
        columns = {"_cog": "course_over_ground_deg_true", "_sog": "speed_over_ground_kt"}
        sources.append(asof.Source(navigation.vtg, columns, tolerance))
    if navigation.positions is not None:
        sources += position_velocity(navigation)
    matched = asof.nearest_asof(df, sources, keys) if sources else df

    none = F.lit(None).cast("double")
    hdt = F.col("_hdt") if navigation.hdt is not None else none
    sxn = F.col("_sxn") if navigation.sxn23 is not None else none
    cog = F.col("_cog") if navigation.vtg is not None else none
    sog = F.col("_sog") if navigation.vtg is not None else none
    gps_cog, gps_sog = (
        velocity_from_matches(navigation.half_window_s) if navigation.positions is not None else (none, none)
    )
    has_vtg = cog.isNotNull() & sog.isNotNull()
    staged = matched.select(
        *df.columns,
        F.coalesce(hdt, sxn).alias("_heading"),
        F.when(has_vtg, cog).otherwise(gps_cog).alias("_course"),
        F.when(has_vtg, sog).otherwise(gps_sog).alias("_speed"),
        F.when(has_vtg, F.lit("VTG")).otherwise(F.lit("GPS")).alias("_velocity_source"),
        F.when(hdt.isNotNull(), F.lit("HDT")).otherwise(F.lit("SXN23")).alias("_heading_source"),
    )
    true_direction, true_speed = wind.true_wind(
        F.col(direction), F.col(speed), F.col("_heading"), F.col("_course"), F.col("_speed") * wind.KNOT_M_S
    )
    done = true_speed.isNotNull()
    return staged.select(
        *df.columns,
        true_direction.alias("true_wind_direction_deg"),
        true_speed.alias("true_wind_speed_m_s"),
        F.when(done, F.col("_velocity_source")).alias("ship_velocity_source"),
        F.when(done, F.col("_heading_source")).alias("heading_source"),
    )


def clean(
    df: DataFrame, experiment: str, instrument: str, keys: list[str], rules: DataFrame | None = None,
    navigation: Navigation | None = None, pressure: str = "ts_pressure", optical: list[str] | None = None,
    window_minutes: float = schema.HAMPEL_WINDOW_MINUTES, spikes_in: list[str] | None = None,
) -> DataFrame:
    """The cleaning rules of one instrument, in order; other instruments come back unchanged.

    Water sampler: pressure removal (where rules are given), zero blanking,
    spike blanking. Ship anemometer: true wind (where navigation is given).
    """
    if (experiment, instrument) == schema.FERRYBOX:
        if rules is not None:
            df = cleaning.remove_low_pressure(df, rules, keys, pressure)
        df = cleaning.blank_nonpositive(df, schema.OPTICAL_COLUMNS if optical is None else optical)
        columns = cleaning.spike_columns(df, "time", keys) if spikes_in is None else spikes_in
        if columns:
            # Pressure removal has already dropped rows without time.
            df = cleaning.blank_spikes(df, keys, columns, window_minutes=window_minutes, untimed=rules is None)
    if (experiment, instrument) == schema.WIND_INSTRUMENT and navigation is not None:
        df = true_wind(df, navigation, keys)
    return df


def instrument_product(
    raw: DataFrame, experiment: str, instrument: str, keys: list[str], mapping: dict[str, str],
    positions: DataFrame | None = None, rules: DataFrame | None = None, navigation: Navigation | None = None,
    text_columns: list[str] = (), freqs: list[str] | None = None, tolerance_s: float = schema.GEOTAG_TOLERANCE_S,
    window_minutes: float = schema.HAMPEL_WINDOW_MINUTES,
) -> dict[str, DataFrame]:
    """Cleaned rows and all resampled intervals of one instrument, over every leg at once.

    `raw` has the keys, `time` and the raw columns. A position depends on the
    time of a row only and no rule looks at it, so it is attached last, to the
    rows that are left. Those feed both outputs, so they are written once.
    """
    geotagged = positions is not None and (experiment, instrument) != ("NAVIGATION", "GGA")
    extra = [*keys, "time"]
    renamed = projection.keep_and_rename(raw, {k: v for k, v in mapping.items() if k not in extra}, extra)
    typed = projection.coerce_numeric(renamed, exclude=[*keys, *text_columns])
    cleaned = clean(
        projection.drop_duplicate_records(typed), experiment, instrument, keys, rules, navigation,
        window_minutes=window_minutes,
    )
    if geotagged:
        cleaned = asof.geotag(cleaned, positions, keys, tm.seconds_us(tolerance_s))
    cleaned = materialize(cleaned)
    columns = [c for c, kind in cleaned.dtypes if kind == "double"]
    code = schema.CATEGORY_COLUMNS.get(instrument)
    if freqs is None:
        freqs = schema.GEOTAGGED_INTERVALS if geotagged else schema.PLAIN_INTERVALS
    intervals = resample.resample_all(
        cleaned, keys, freqs, [c for c in columns if c != code], projection.level_columns(columns),
        code if code in columns else None,
    )
    return {"cleaned": cleaned, "intervals": intervals}


def position_product(
    gga: DataFrame, ek80: DataFrame, ferrybox: DataFrame, bridge: DataFrame, windows: DataFrame, keys: list[str],
    as_of: Column, threshold_minutes: float = schema.GGA_GAP_FILL_THRESHOLD_MINUTES,
    bridge_threshold_minutes: float = schema.BRIDGE_GAP_FILL_THRESHOLD_MINUTES, stored: DataFrame | None = None,
) -> DataFrame:
    """One position table per leg: the primary fixes, and other sources inside its gaps only.

    The bridge log is used where the other two still leave a gap. All inputs
    have the keys, time, latitude_deg, longitude_deg and source. The gap
    windows feed four later steps, so they are written once.
    """
    found = gaps.without_future_end(gaps.find_gaps(gga, keys, "time", windows, threshold_minutes), as_of)
    open_windows = materialize(
        found.select(*keys, F.col("previous_time").alias("start"), F.col("current_time").alias("end"))
    )
    fills = [ranges.in_any_window(source, open_windows, keys, disjoint=True) for source in (ek80, ferrybox)]
    still_open = gaps.remaining_gaps(
        open_windows, fills[0].select(*keys, "time").unionByName(fills[1].select(*keys, "time")), keys,
        bridge_threshold_minutes,
    )
    last_resort = ranges.in_any_window(bridge, still_open, keys, disjoint=True)
    merged = position.merge_positions(gga, *fills, last_resort)
    if stored is None:
        return merged
    # The rebuild is the table others read; it is written before it is compared with the stored one.
    return position.keep_earlier_fills(materialize(merged), stored, open_windows, keys)


def profile_product(
    raw: DataFrame, keys: list[str], mapping: dict[str, str], positions: DataFrame | None, text_columns: list[str],
    scan: str = "scan_no", tolerance_s: float = schema.GEOTAG_TOLERANCE_S,
) -> DataFrame:
    """Profiles with cast label and position, scans in order; profiles are not resampled."""
    label = tx.cast_label(F.col("Source_File"), F.col("FileName") if "FileName" in raw.columns else F.lit(None))
    df = raw.withColumn("cast", label)
    extra = [*keys, "time", "cast", scan]
    if positions is not None:
        df = asof.geotag(df, positions, keys, tm.seconds_us(tolerance_s))
        extra += ["latitude_deg", "longitude_deg"]
    renamed = projection.keep_and_rename(df, {k: v for k, v in mapping.items() if k not in extra}, extra)
    typed = projection.coerce_numeric(renamed, exclude=[*keys, "cast", scan, *text_columns])
    return profile.profile_clusters(typed, keys, scan)


def spectrum_product(
    spectra: DataFrame, keys: list[str], positions: DataFrame | None, position_keys: list[str],
    level_columns: list[str], columns: list[str], freq: str, tolerance_s: float = schema.GEOTAG_TOLERANCE_S,
) -> DataFrame:
    """Spectrum summaries with a position, averaged as power per interval."""
    df = spectra
    if positions is not None:
        df = asof.geotag(df, positions, position_keys, tm.seconds_us(tolerance_s))
        columns = [*columns, "latitude_deg", "longitude_deg"]
    return resample.resample_mean(df, keys, freq, [*columns, *level_columns], level_columns)


def detection_product(
    log: DataFrame, keys: list[str], positions: DataFrame | None, position_keys: list[str],
    tolerance_s: float = schema.GEOTAG_TOLERANCE_S,
) -> DataFrame:
    """Event table of a candidate log, with the position at each event's start."""
    events = detect.event_table(log, keys)
    if positions is None:
        return events
    return asof.geotag(events, positions, position_keys, tm.seconds_us(tolerance_s))


def expected_combos(windows: DataFrame, instruments: list[tuple[str, ...]], names: list[str]) -> DataFrame:
    """Every leg with every instrument of the catalog, a constant list exploded on each leg."""
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in instruments])
    return windows.select("leg", F.explode(rows).alias("_i")).select("leg", "_i.*")


def coverage(ends: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Expected combinations with `has_data`: any time inside the leg window (see `gaps.first_and_last`)."""
    seen = ends.select(*keys, (F.col("_lo") <= F.col("_hi")).alias("_seen"))
    return expected.join(seen, keys, "left").select(*keys, F.coalesce("_seen", F.lit(False)).alias("has_data"))


def gap_analysis(
    df: DataFrame, expected: DataFrame, windows: DataFrame, keys: list[str],
    threshold_minutes: float | Column = schema.GAP_THRESHOLD_MINUTES, time: str = "time",
) -> dict[str, DataFrame]:
    """Gap table, gap statistics and coverage of every expected combination in one job.

    The rows are aggregated to occupied buckets once; gaps, window edges and
    coverage all read that shuffle. Combinations without data get a row of
    their own in the gap table and do not count in the statistics.
    """
    found, ends = gaps.gaps_and_ends(df, keys, time, windows, threshold_minutes)
    held = coverage(ends, expected, keys)
    return {
        "gaps": found.unionByName(gaps.no_data_gaps(held, keys, windows)),
        "statistics": gaps.gap_statistics(found, held, keys, windows),
        "coverage": held,
    }


def instrument_threshold(instrument: Column) -> Column:
    """Gap threshold in minutes, with the overrides of single instruments."""
    out = F.lit(schema.GAP_THRESHOLD_MINUTES)
    for name, minutes in schema.GAP_THRESHOLD_MINUTES_BY_INSTRUMENT.items():
        out = F.when(instrument == name, F.lit(minutes)).otherwise(out)
    return out


def audit_files(
    spark: SparkSession, processed: str | list[str], mapping: DataFrame, variables: DataFrame, raw: str | list[str] | None = None,
    rule: str = PROCESSED_FILE, raw_rule: str = RAW_FILE,
) -> dict[str, DataFrame]:
    """The six tables of the format audit, from the files below `processed`.

    Only the ends of the files are read. Leg, experiment and instrument come from a file's path by `rule`, the type of the raw file of the same
    stem from those below `raw` by `raw_rule`: of several, one that the pipeline converts. Files without a filled line are in
    `unreadable`; folders of derived products are passed over.
    """
    keys = ["leg", "experiment", "instrument"]

    def placed(files: DataFrame, path: str, pattern: str) -> DataFrame:
        part = [F.regexp_extract(path, pattern, k) for k in (1, 2, 3)]
        found = files.where(F.col(path).rlike(pattern)).withColumns(dict(zip(keys, [part[0].cast("int"), *part[1:]], strict=True)))
        return found.where(~F.col("instrument").isin(schema.SKIPPED_INSTRUMENTS))

    instrument = F.regexp_extract("file", rule, 3)
    preferred = F.coalesce(*[F.when(instrument == name, F.lit(column)) for name, column in schema.PREFERRED_TIME_COLUMN.items()])
    named = placed(lines.file_manifest(spark, processed, preferred), "file", rule).where(F.lower("file_name").endswith(".csv"))
    named = named.withColumn("_stem", F.regexp_replace("file_name", r"\.[^.]*$", ""))
    if raw is None:
        typed = named.withColumn("raw_type", F.lit("(no raw match)"))
    else:
        extension = F.lower(F.regexp_extract("file_name", r"(\.[^.]*)$", 1))
        others = placed(ranged.listed(spark, raw), "path", raw_rule).withColumn("_stem", F.regexp_replace("file_name", r"\.[^.]*$", ""))
        rank = F.struct(~extension.isin(schema.CONVERTED_TYPES), F.col("file_name"))
        types = others.groupBy(*keys, "_stem").agg(F.min_by(extension, rank).alias("_type"))
        typed = named.join(types, [*keys, "_stem"], "left").withColumn("raw_type", F.coalesce("_type", F.lit("(no raw match)"))).drop("_type")
    manifest = materialize(typed.drop("_stem", "first_record", "last_record", "size", "bytes_read"), "manifest")
    every = placed(ranged.listed(spark, processed), "path", rule).where(F.lower("file_name").endswith(".csv"))
    unreadable = every.join(manifest, every["path"] == manifest["file"], "left_anti").select(*keys, "file_name", F.lit("empty file").alias("error"))
    return audit.audit(manifest.drop("file"), mapping, variables, unreadable)
