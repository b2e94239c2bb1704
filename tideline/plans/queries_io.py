"""Queries that go through files and streams: what is derived from the tables is written, read back and compared.

Everything is written under the shared checkpoint folder of the session.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.operators import resample
from tideline.plans import products, roles
from tideline.plans.queries_series import _KEYS, _MEAN_SQL, _gap_columns, _statistics_sql
from tideline.plans.registry import query
from tideline.plans.roles import shown
from tideline.session import shared_folder
from tideline.sources import archives, lines, profiles, tables
from tideline.streaming import jobs


def _scratch(spark) -> str:
    return shared_folder(spark, "tideline")


# --- files ---------------------------------------------------------------------------------------


@query(
    "ingest_delimited",
    """
    SELECT event_id, round(value, 6) AS heading_deg_true, ts AS time, event_type IN ('click', 'view') AS first_layout,
           CASE WHEN event_type IN ('click', 'view') THEN event_id % 3 END AS _calibration
    FROM events
    """,
)
def ingest_delimited(spark, sf_dir):
    rows = roles.events(spark, sf_dir)
    out = _scratch(spark)
    text = F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp")
    first = F.col("instrument").isin("click", "view")
    rows.where(first).select(text, "event_id", F.col("value").alias("Heading, degrees true"), (F.col("event_id") % 3).alias("_calibration")).write.option(
        "header", "true"
    ).csv(f"{out}/a")
    rows.where(~first).select("event_id", F.col("value").alias("Heading,_degrees_true"), text).write.option(
        "header", "true"
    ).csv(f"{out}/b")
    raw = lines.read_delimited(spark, [f"{out}/a", f"{out}/b"])
    timed = lines.ensure_time(raw)
    return shown(
        timed.select(
            F.col("event_id").cast("long").alias("event_id"),
            F.coalesce(F.col("`Heading, degrees true`"), F.col("`Heading,_degrees_true`"))
            .cast("double").alias("heading_deg_true"),
            "time",
            F.col("`Heading, degrees true`").isNotNull().alias("first_layout"),
            F.col("_calibration").cast("long").alias("_calibration"),
        )
    )


@query(
    "ingest_json_lines",
    """
    SELECT event_id, round(value, 6) AS value, CASE WHEN event_id % 2 = 0 THEN event_type END AS kind FROM events
    WHERE event_id % 7 <> 0
    """,
)
def ingest_json_lines(spark, sf_dir):
    # Some lines lack a brace, every seventh is cut off inside a value.
    whole = F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "value": '), F.col("value").cast("string"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(', "kind": "'), "instrument", F.lit('"'))).otherwise(F.lit("")),
        F.lit("}"),
    )
    line = (
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "va')))
        .when(F.col("event_id") % 3 == 0, F.expr("substr(line, 2)"))
        .when(F.col("event_id") % 3 == 1, F.expr("substr(line, 1, length(line) - 1)"))
        .otherwise(F.col("line"))
    )
    out = _scratch(spark)
    roles.events(spark, sf_dir).withColumn("line", whole).select(line.alias("value")).write.text(out)
    wide = lines.widen(lines.read_json_lines(spark, out), "record", ["event_id", "value", "kind"])
    return shown(
        wide.select(F.col("event_id").cast("long").alias("event_id"), F.col("value").cast("double").alias("value"), "kind")
    )


_CNV_SQL = """(SELECT l_suppkey % 25 AS file_no, l_quantity, l_extendedprice,
    row_number() OVER (PARTITION BY l_suppkey % 25 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      l_extendedprice) AS scan_no FROM lineitem)"""


def _write_in_order(df, path, file_key, order):
    """One text file per key value, its lines in order."""
    placed = df.repartition(file_key).sortWithinPartitions(file_key, *order)
    placed.select(file_key, "value").write.partitionBy(file_key).text(path)


@query(
    "ingest_profiles",
    f"""SELECT CAST(file_no AS VARCHAR) AS station, CAST(scan_no AS INTEGER) AS scan_no, l_quantity AS pressure,
               l_extendedprice AS price FROM {_CNV_SQL}""",
)
def ingest_profiles(spark, sf_dir):
    item = roles.table(spark, sf_dir, "lineitem").withColumn("file_no", F.col("l_suppkey") % 25)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    data = item.select(
        "file_no", F.lit(9).alias("part"), F.struct(*order).alias("place"),
        F.concat_ws("   ", F.lit(""), F.col("l_quantity").cast("string"), F.col("l_extendedprice").cast("string")).alias("value"),
    )
    head = [
        F.lit("* Sea-Bird Data File:"), F.concat(F.lit("** Station: "), F.col("file_no").cast("string")),
        F.lit("# name 0 = prdM: Pressure [db]"), F.lit("# name 1 = cost: Price"), F.lit("*END*"),
    ]
    heads = item.select("file_no").distinct().select(
        "file_no", F.posexplode(F.array(*head)).alias("part", "value"), F.lit(None).cast(data.schema["place"].dataType).alias("place")
    )
    out = _scratch(spark)
    _write_in_order(data.unionByName(heads), out, "file_no", ["part", "place"])
    scans = profiles.read_cnv(spark, f"{out}/*/*.txt")
    wide = lines.widen(lines.widen(scans, "values", ["prdM", "cost"]), "metadata", ["Station"])
    return wide.select(
        F.col("Station").alias("station"), "scan_no", F.col("prdM").cast("double").alias("pressure"),
        F.col("cost").cast("double").alias("price"),
    )


@query(
    "ingest_spectra",
    """
    WITH b AS (SELECT vec_id, label, unnest(range(1, 65)) AS p, embedding FROM embeddings),
         s AS (SELECT vec_id, label, round(10 * log10(sum(pow(10, round(embedding[p]::DOUBLE * 100, 3) / 10)) FILTER (p > 1)), 6)
                 AS level_broadband FROM b GROUP BY 1, 2)
    SELECT CAST(label AS VARCHAR) AS serial, CAST(vec_id AS VARCHAR) AS sequence, level_broadband, 64 AS n_bins,
           TIMESTAMP '2024-01-05' + to_seconds(vec_id * 400 % 86400) + to_days(CAST(
             (SELECT count(*) FROM (SELECT vec_id AS v, lag(vec_id * 400 % 86400) OVER (ORDER BY vec_id) AS before
                                    FROM embeddings e WHERE e.label = s.label) w
              WHERE w.v <= s.vec_id AND w.v * 400 % 86400 < w.before) AS INTEGER)) AS time
    FROM s
    """,
)
def ingest_spectra(spark, sf_dir):
    vectors = roles.table(spark, sf_dir, "embeddings")
    clock = F.col("vec_id") * 400 % 86_400
    text = F.concat_ws(
        ":",
        *[F.lpad(part.cast("string"), 2, "0") for part in (F.floor(clock / 3600), F.floor(clock % 3600 / 60), clock % 60)],
    )
    levels = F.transform("embedding", lambda x: F.round(x.cast("double") * 100, 3).cast("string"))
    data = vectors.select(
        "label", F.lit(9).alias("part"), "vec_id",
        F.concat_ws("\t", text, F.lit(""), F.lit("10.5"), F.lit("40"), F.col("vec_id").cast("string"), F.lit("64"),
                    F.array_join(levels, "\t"), F.lit("")).alias("value"),
    )
    names = "\t".join(["Time", "Comment", "Temperature", "Humidity", "Sequence #", "Data Points", *[str(i * 1000) for i in range(64)], ""])
    head = [F.lit("File Details:"), F.concat(F.lit("S/N\t"), F.col("label").cast("string")), F.lit("Start Date\t2024-01-05"),
            F.lit("Data:"), F.lit(names)]
    heads = vectors.select("label").distinct().select(
        "label", F.posexplode(F.array(*head)).alias("part", "value"), F.lit(-1).cast("long").alias("vec_id")
    )
    out = _scratch(spark)
    _write_in_order(data.unionByName(heads), out, "label", ["part", "vec_id"])
    spectra = profiles.with_summaries(profiles.read_spectra(spark, f"{out}/*/*.txt"))
    return shown(spectra.select("serial", "sequence", "level_broadband", "n_bins", "time"))


def record_xml():
    """The XML of an event's record; every eleventh is not well-formed, every third has no position."""

    def points(number: int, name: str, value):
        return F.concat(
            F.lit(f'<p:Point ID="{number}" Descr="{name}" Unit="u"><p:Value>'), value.cast("string"), F.lit("</p:Value></p:Point>")
        )

    def sensor(descr: str, point):
        return F.concat(
            F.lit(f'<p:SensorData ID="X" SerialNo="7" Descr="{descr}"><p:Parameters>'), point, F.lit("</p:Parameters></p:SensorData>")
        )

    stamp = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    place = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(points(7, "Latitude", F.col("user_id") % 90))
    return F.concat(
        F.lit('<?xml version="1.0"?><p:Device xmlns:p="http://example.org/p" ID="D"><p:Time>'), stamp,
        F.lit("</p:Time><p:Data><p:Time>"), stamp, F.lit("</p:Time><p:RecordNumber>"), F.col("event_id").cast("string"),
        F.lit("</p:RecordNumber>"), sensor("Conductivity Sensor", points(0, "Conductivity", F.col("value"))),
        sensor("Oxygen Optode", points(1, "air saturation", F.col("value") / 2)),
        F.lit("<p:SystemData><p:Parameters>"), place, F.lit("</p:Parameters></p:SystemData></p:Data>"),
        F.when(F.col("event_id") % 11 == 0, F.lit("<broken>")).otherwise(F.lit("</p:Device>")),
    )


@query(
    "xml_records",
    """
    SELECT 'r' || event_id || '.xml' AS member, event_id AS "recordNumber", round(value, 6) AS "CS_Conductivity",
           round(value / 2, 6) AS "O2_AirSaturation", CASE WHEN event_id % 3 = 0 THEN 0 ELSE CAST(user_id % 90 AS DOUBLE) END AS latitude,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "dataTimestamp"
    FROM events WHERE event_id % 11 <> 0
    """,
)
def xml_records(spark, sf_dir):
    member = F.concat(F.lit("r"), F.col("event_id").cast("string"), F.lit(".xml"))
    held = roles.events(spark, sf_dir).select(F.lit("a.zip").alias(lines.FILE), member.alias("member"), record_xml().alias("xml"))
    flat = archives.flatten_records(archives.parse_records(held))
    wide = lines.widen(flat, "values", ["CS_Conductivity", "O2_AirSaturation"])
    return shown(
        wide.select(
            F.col("sourceFile").alias("member"), "recordNumber", "CS_Conductivity", "O2_AirSaturation", "latitude", "dataTimestamp"
        )
    )


@query(
    "interval_tables",
    f"""SELECT instrument, time, value, user_id FROM ({_MEAN_SQL.format(step='1 day')})
        WHERE instrument IN ('click', 'view')""",
)
def interval_tables(spark, sf_dir):
    rows = roles.events(spark, sf_dir)
    intervals = resample.resample_all(rows, ["instrument"], ["1D", "1h"], ["value", "user_id"])
    out = _scratch(spark)
    tables.write_product({"cleaned": rows.select("instrument", "time", "value"), "intervals": intervals}, out)
    tables.write_combined(spark, out, ["1D", "1h"], f"{out}/combined", only_instruments=["click", "view"])
    combined = spark.read.parquet(f"{out}/combined").where(F.col("interval") == "1D")
    return shown(combined.select("instrument", "time", "value", "user_id"))


@query(
    "gap_report",
    f"""SELECT leg, instrument, status, n_gaps, total_gap_minutes, pct_of_leg_gap FROM ({_statistics_sql(60)})""",
)
def gap_report(spark, sf_dir):
    # Legs are reported one after another; the report read back covers all of them.
    held = roles.windows(spark)
    expected = products.expected_combos(held, [(i,) for i in roles.INSTRUMENTS], ["instrument"])
    rows = roles.legged(spark, sf_dir)
    out = _scratch(spark)
    for part in (F.col("leg") <= 3, F.col("leg") > 3):
        report = products.gap_analysis(rows.where(part), expected.where(part), held, _KEYS, 60.0)
        tables.write_gap_report({name: report[name] for name in ("gaps", "statistics")}, out)
    read = tables.read_gap_report(spark, out)["statistics"]
    return shown(read.select("leg", "instrument", "status", "n_gaps", "total_gap_minutes", "pct_of_leg_gap"))


@query(
    "canonical_export",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' AS time FROM events""",
)
def canonical_export(spark, sf_dir):
    out = _scratch(spark)
    tables.export_csv(roles.events(spark, sf_dir).select("event_id", "time"), out)
    read = spark.read.options(header=True, inferSchema=False).csv(out)
    return read.select(F.col("event_id").cast("long").alias("event_id"), "time")


@query("time_only_read", "SELECT ts AS time FROM events")
def time_only_read(spark, sf_dir):
    out = _scratch(spark)
    tables.write_table(roles.events(spark, sf_dir).select("time", "value", "props"), out)
    return shown(tables.read_times(spark, out))


# --- streams -------------------------------------------------------------------------------------

_LATENESS = "0 seconds"


def _event_stream(spark, sf_dir):
    schema = roles.table(spark, sf_dir, "events").schema
    raw = jobs.read_new_files(spark, sf_dir, schema, pathGlobFilter="events.parquet")
    return raw.select(
        F.col("event_type").alias("instrument"), F.col("ts").cast("timestamp").alias("time"), "event_id", "user_id", "value"
    )


def _run(spark, stream):
    """Run a stream over everything that is there and read back what it wrote."""
    out = _scratch(spark)
    jobs.ingest_available(stream, f"{out}/table", f"{out}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/table")


@query("stream_ingest", "SELECT event_type AS instrument, ts AS time, event_id, user_id, value FROM events")
def stream_ingest(spark, sf_dir):
    return shown(_run(spark, _event_stream(spark, sf_dir)))


@query(
    "stream_resample",
    f"SELECT * FROM ({_MEAN_SQL.format(step='1 hour')}) WHERE time + INTERVAL '1 hour' <= (SELECT max(ts) FROM events)",
)
def stream_resample(spark, sf_dir):
    # The bin that holds the newest row is still open.
    stream = _event_stream(spark, sf_dir)
    return shown(_run(spark, jobs.resample_stream(stream, ["instrument"], "1h", ["value", "user_id"], lateness=_LATENESS)))


@query("stream_distinct", "SELECT event_id, ts AS time, value FROM events")
def stream_distinct(spark, sf_dir):
    once = _event_stream(spark, sf_dir).select("event_id", "time", "value")
    again = _event_stream(spark, sf_dir).select("event_id", "time", "value")
    return shown(_run(spark, jobs.distinct_stream(once.unionByName(again), ["event_id", "time", "value"], "1 hour")))


@query(
    "stream_sessions",
    """
    WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                      <= INTERVAL '2 hours' THEN 0 ELSE 1 END AS fresh FROM events),
         n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM s),
         g AS (SELECT user_id, min(ts) AS segment_start, max(ts) AS segment_end, count(*) AS n_rows FROM n GROUP BY user_id, no)
    SELECT * FROM g WHERE n_rows >= 2 AND segment_end + INTERVAL '2 hours' <= (SELECT max(ts) FROM events)
    """,
)
def stream_sessions(spark, sf_dir):
    stream = _event_stream(spark, sf_dir)
    return shown(_run(spark, jobs.session_stream(stream, ["user_id"], "2 hours", min_rows=2, lateness=_LATENESS)))


@query(
    "stream_gaps",
    f"""
    SELECT instrument, previous_time, current_time, gap_minutes FROM (
      SELECT instrument, {_gap_columns('prev', 'ts')} FROM (
        SELECT event_type AS instrument, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS prev FROM events)
      WHERE ts - prev > INTERVAL '60 minutes')
    WHERE date_trunc('hour', current_time) + INTERVAL '1 hour' <= (SELECT max(ts) FROM events)
    """,
)
def stream_gaps(spark, sf_dir):
    return shown(_run(spark, jobs.gap_stream(_event_stream(spark, sf_dir), ["instrument"], 60.0, _LATENESS)))


_LATE_SQL = "leg IN (2, 4) AND instrument = 'view'"


@query(
    "stream_backfill",
    f"""
    SELECT leg, instrument, event_id, ts AS time,
           {_LATE_SQL} AND ts < (SELECT max(ts) FROM {roles.LEGGED_SQL} WHERE NOT ({_LATE_SQL})) AS late, n_in_leg
    FROM (SELECT *, count(*) OVER (PARTITION BY leg) AS n_in_leg FROM {roles.LEGGED_SQL})
    """,
)
def stream_backfill(spark, sf_dir):
    """A stream in two batches: the second brings rows of two legs that are behind the watermark, and those legs are recomputed."""
    rows = roles.legged(spark, sf_dir).select("leg", "instrument", "event_id", "time")
    late = F.col("leg").isin(2, 4) & (F.col("instrument") == "view")
    out = _scratch(spark)

    def sized(found):
        return found.join(found.groupBy("leg").agg(F.count(F.lit(1)).alias("n_in_leg")), "leg")

    for part in (~late, late):
        rows.where(part).write.mode("append").parquet(f"{out}/in")
        arriving = jobs.read_new_files(spark, f"{out}/in", rows.schema)
        jobs.ingest_and_mend(arriving, f"{out}/held", f"{out}/state", sized, ["leg"]).awaitTermination()
    behind = spark.read.parquet(f"{out}/held/late").select("event_id", F.lit(True).alias("late"))
    table = spark.read.parquet(f"{out}/held/table").join(behind, "event_id", "left")
    return shown(table.select("leg", "instrument", "event_id", "time", F.coalesce("late", F.lit(False)).alias("late"), "n_in_leg"))
