"""Queries over hand-kept sheets, file names and faulty lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.plans import roles
from tideline.plans.registry import query
from tideline.plans.roles import shown
from tideline.session import shared_folder
from tideline.sources import discovery, lines, logsheets


@query(
    "leg_window_sheet",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS leg, CAST(o_orderdate AS TIMESTAMP) + INTERVAL '90 minutes' AS start,
           CAST(o_orderdate AS TIMESTAMP) + INTERVAL '2 days' AS "end"
    FROM orders WHERE o_custkey % 7 <> 0
    """,
)
def leg_window_sheet(spark, sf_dir):
    """Every order is a leg; some rows of the sheet lack an end."""
    day = F.col("o_orderdate").cast("timestamp")
    sheet = roles.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Leg Number"),
        F.date_format(day + F.expr("INTERVAL '90' MINUTE"), "d/M/yyyy H:mm").alias("Start time (UTC)"),
        F.when(F.col("o_custkey") % 7 != 0, F.date_format(day + F.expr("INTERVAL '2' DAY"), "yyyy-MM-dd HH:mm:ss")).alias("End time (UTC)"),
    )
    return shown(logsheets.leg_windows(sheet))


@query(
    "pressure_rule_sheet",
    """
    SELECT CAST(c_custkey AS INTEGER) AS leg, CASE WHEN c_custkey % 5 <> 0 THEN round(c_acctbal, 6) END AS pressure_under,
           c_custkey % 5 = 0 AS incomplete FROM customer
    """,
)
def pressure_rule_sheet(spark, sf_dir):
    """Rules of one leg per customer, and the rows that are left out."""
    sheet = roles.table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("Leg number"),
        F.when(F.col("c_custkey") % 5 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("Remove data when pressure is under"),
    )
    rules = logsheets.pressure_rules(sheet).withColumn("incomplete", F.lit(False))
    left = logsheets.incomplete_rules(sheet).withColumn("incomplete", F.lit(True))
    return shown(rules.unionByName(left))


@query(
    "bridge_log",
    """
    SELECT date_trunc('minute', ts) AS time, round((CASE WHEN user_id % 2 = 0 THEN -1 ELSE 1 END) * (user_id % 90 + (event_id % 60) / 60.0), 6)
             AS latitude_deg, round(CAST(user_id % 180 AS DOUBLE) + 0.5, 6) AS longitude_deg, 'Bridge' AS source
    FROM events WHERE event_id % 9 <> 0
    """,
)
def bridge_log(spark, sf_dir):
    """Fixes written as exports of the bridge log: eight lines, column names, rows; some positions are unreadable."""
    events = roles.events(spark, sf_dir).withColumn("file_no", F.col("event_id") % 40)
    latitude = F.concat(
        (F.col("user_id") % 90).cast("string"), F.lit("° "), (F.col("event_id") % 60).cast("string"), F.lit(".0' "),
        F.when(F.col("user_id") % 2 == 0, "S").otherwise("N"),
    )
    longitude = F.concat((F.col("user_id") % 180).cast("string"), F.lit("° 30.0' E"))
    row = F.concat_ws(
        ",", F.date_format("time", "dd/MM/yyyy HH:mm"), F.when(F.col("event_id") % 9 == 0, "no fix").otherwise(latitude), longitude
    )
    head = [*[F.lit(f"Log sheet {n}") for n in range(logsheets.BRIDGE_HEADER_LINES)], F.lit("Time,Lat,Lon")]
    heads = events.select("file_no").distinct().select("file_no", F.posexplode(F.array(*head)).alias("place", "value"))
    body = events.select("file_no", (F.col("event_id") + 100).alias("place"), row.alias("value"))
    out = shared_folder(spark, "bridge-log")
    placed = heads.unionByName(body).repartition("file_no").sortWithinPartitions("file_no", "place")
    placed.select("file_no", "value").write.partitionBy("file_no").text(out)
    fixes = logsheets.read_bridge_log(spark, f"{out}/*/*.txt")
    return shown(fixes.select("time", "latitude_deg", "longitude_deg", "source"))


@query(
    "recording_names",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'LUF' ELSE 'SJW' END AS kind, CAST(o_custkey AS VARCHAR) AS serial,
           CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1 second' * (o_custkey % 60) AS start,
           CASE WHEN o_orderkey % 2 = 0 THEN 'wav' ELSE 'txt' END AS extension
    FROM orders WHERE o_orderkey % 5 <> 0
    """,
)
def recording_names(spark, sf_dir):
    """Recordings among files, by their names."""
    key = F.col("o_orderkey")
    second = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey") % 60)
    name = F.concat(
        F.when(key % 3 == 0, "luf").otherwise("SJW"), F.col("o_custkey").cast("string"), F.date_format(second, "'_'yyyyMMdd'_'HHmmss"),
        F.when(key % 2 == 0, ".WAV").otherwise(".txt"),
    )
    files = roles.table(spark, sf_dir, "orders").select("o_orderkey", F.when(key % 5 == 0, F.concat(F.lit("copy of "), name)).otherwise(name).alias("file_name"))
    return shown(discovery.recordings(files).select("o_orderkey", "kind", "serial", "start", "extension"))


_PROBLEM_LINES_SQL = "(SELECT event_id % 50 AS g, event_id % 7 = 3 AS bad, row_number() OVER (PARTITION BY event_id % 50 ORDER BY event_id) AS no FROM events)"


@query(
    "json_line_problems",
    f"""
    WITH l AS {_PROBLEM_LINES_SQL}
    SELECT count(*) FILTER (NOT bad) AS n_records, count(*) FILTER (bad) AS n_skipped,
           array_to_string(coalesce(list(no ORDER BY no) FILTER (bad), [])[1:5], ' ') AS first_skipped FROM l GROUP BY g
    """,
)
def json_line_problems(spark, sf_dir):
    """Usable and unusable lines of files, and where the first unusable ones are."""
    row = F.when(F.col("event_id") % 7 == 3, F.lit('{"event_id": ')).otherwise(F.format_string('{"event_id": %d}', "event_id"))
    placed = roles.events(spark, sf_dir).select((F.col("event_id") % 50).alias("g"), "event_id", row.alias("value"))
    out = shared_folder(spark, "json-lines")
    placed.repartition("g").sortWithinPartitions("g", "event_id").select("g", "value").write.partitionBy("g").text(out)
    report = lines.json_line_report(spark, f"{out}/*/*.txt")
    numbers = F.transform("skipped_lines", lambda n: n.cast("string"))
    return report.select("n_records", "n_skipped", F.array_join(numbers, " ").alias("first_skipped"))
