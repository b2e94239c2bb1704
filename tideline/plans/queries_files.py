"""Queries over files that are read in parts: heads and tails, members of archives, a store of times by file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from tideline.plans import products, roles
from tideline.plans.queries_io import record_xml
from tideline.plans.registry import query
from tideline.plans.roles import shown
from tideline.session import shared_folder
from tideline.sources import archives, lines, tables, time_store
from tideline.sources.ranged import creator

_PER_FILE = 2_000
_PER_ARCHIVE = 500


@query(
    "file_head_tail",
    f"""
    SELECT event_id // {_PER_FILE} AS file_no, 'event_id|name|value' AS header, min(event_id) AS first_id, max(event_id) AS last_id,
           false AS is_empty, true AS bounded
    FROM events GROUP BY 1
    """,
)
def file_head_tail(spark, sf_dir):
    """First and last records of files, of which only the ends are read."""
    rows = roles.events(spark, sf_dir).select(
        F.floor(F.col("event_id") / _PER_FILE).alias("file_no"), "event_id",
        F.concat_ws(",", F.col("event_id").cast("string"), F.concat(F.lit('"'), "instrument", F.lit(', raw"')), F.col("value").cast("string")).alias("value"),
    )
    heads = rows.select("file_no").distinct().select("file_no", F.lit(-1).cast("long").alias("event_id"), F.lit("event_id,name,value").alias("value"))
    out = shared_folder(spark, "head-tail")
    placed = rows.unionByName(heads).repartition("file_no").sortWithinPartitions("file_no", "event_id")
    placed.select("file_no", "value").write.partitionBy("file_no").text(out)
    ends = lines.file_ends(spark, out)
    return ends.select(
        F.regexp_extract("file", r"file_no=(\d+)", 1).cast("long").alias("file_no"),
        F.concat_ws("|", "header").alias("header"),
        F.col("first_record")[0].cast("long").alias("first_id"),
        F.col("last_record")[0].cast("long").alias("last_id"),
        "is_empty",
        (F.col("bytes_read") <= 8_192).alias("bounded"),
    )


def _write_archives(spark, sf_dir) -> str:
    """Zips of some hundred records each, in nested folders beside other files; every seventh archive is cut off."""
    out = shared_folder(spark, "archives")
    create, per_archive = creator(), _PER_ARCHIVE

    def write(key: tuple, rows: pa.Table) -> pa.Table:
        import io
        import zipfile

        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("notes.txt", "no record")
            for name, xml in zip(rows.column("member").to_pylist(), rows.column("xml").to_pylist(), strict=True):
                archive.writestr(name, xml)
        content = held.getvalue()
        number = key[0].as_py()
        with create(f"{out}/{number % 3}/a{number}.zip") as file:
            file.write(content[: len(content) // 2] if number % 7 == 6 else content)
        return pa.table({"archive": pa.array([number], pa.int64()), "n": pa.array([rows.num_rows // per_archive], pa.int64())})

    number = F.floor(F.col("event_id") / _PER_ARCHIVE)
    member = F.concat(F.lit("day/"), (F.col("event_id") % 3).cast("string"), F.lit("/r"), F.col("event_id").cast("string"), F.lit(".XML"))
    records = roles.events(spark, sf_dir).select(number.alias("archive"), member.alias("member"), record_xml().alias("xml"))
    records.groupBy("archive").applyInArrow(write, "archive long, n long").write.format("noop").mode("overwrite").save()
    return out


_ARCHIVE_SQL = f"SELECT *, event_id // {_PER_ARCHIVE} AS archive FROM events"


@query(
    "ingest_archives",
    f"""
    SELECT 'a' || archive || '.zip' AS file, 'r' || event_id || '.XML' AS member, event_id AS "recordNumber", round(value, 6) AS "CS_Conductivity",
           round(value / 2, 6) AS "O2_AirSaturation", CASE WHEN event_id % 3 = 0 THEN 0 ELSE CAST(user_id % 90 AS DOUBLE) END AS latitude
    FROM ({_ARCHIVE_SQL}) WHERE event_id % 11 <> 0 AND archive % 7 <> 6
    """,
)
def ingest_archives(spark, sf_dir):
    """Usable records of real archives."""
    held = archives.read_archives(spark, _write_archives(spark, sf_dir))
    flat = archives.flatten_records(archives.parse_records(held))
    wide = lines.widen(flat, "values", ["CS_Conductivity", "O2_AirSaturation"])
    return shown(wide.select(F.col(lines.FILE).alias("file"), F.col("sourceFile").alias("member"), "recordNumber", "CS_Conductivity", "O2_AirSaturation", "latitude"))


@query(
    "archive_problems",
    f"""
    SELECT 'a' || archive || '.zip' AS file, CASE WHEN archive % 7 <> 6 THEN 'day/' || event_id % 3 || '/r' || event_id || '.XML' END AS member,
           'unreadable' AS problem
    FROM ({_ARCHIVE_SQL}) WHERE event_id % 11 = 0 AND archive % 7 <> 6 OR archive % 7 = 6 AND event_id % {_PER_ARCHIVE} = 0
    """,
)
def archive_problems(spark, sf_dir):
    """Archives and records that cannot be used."""
    parsed = archives.parse_records(archives.read_archives(spark, _write_archives(spark, sf_dir)))
    return parsed.where("problem is not null").select(F.col(lines.FILE).alias("file"), "member", "problem")


@query(
    "time_store_refresh",
    """
    SELECT event_id % 8 AS g, count(*) AS n_times, min(ts) AS first_time, max(ts) AS last_time,
           CASE WHEN event_id % 8 IN (2, 5) THEN 2 ELSE 1 END AS n_reads, event_id % 8 IN (2, 5) AS read_again
    FROM events WHERE event_id % 10 <> 0 OR event_id % 8 IN (2, 5) GROUP BY 1
    """,
)
def time_store_refresh(spark, sf_dir):
    """Times of files through a store: after two groups of files have changed, only those are read again."""
    out = shared_folder(spark, "time-store")
    rows = roles.events(spark, sf_dir).withColumn("g", F.col("event_id") % 8)
    text = F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp")

    def write(part) -> None:
        by_group = part.repartition("g", F.col("event_id") % 64)
        by_group.where("g % 2 = 1").select(text, "event_id", "g").write.mode("overwrite").option("header", "true").partitionBy("g").csv(f"{out}/text")
        by_group.where("g % 2 = 0").select("time", "event_id", "g").write.mode("overwrite").partitionBy("g").parquet(f"{out}/parquet")

    where, store = [f"{out}/text", f"{out}/parquet"], f"{out}/store"
    write(rows.where("event_id % 10 <> 0"))
    time_store.refresh(spark, where, store)
    write(rows.where("g in (2, 5)"))  # replaces the partitions it holds
    group = F.regexp_extract("path", r"g=(\d+)", 1).cast("long").alias("g")
    again = time_store.refresh(spark, where, store).select(group).distinct().withColumn("read_again", F.lit(True))
    seen = spark.read.parquet(f"{store}/files").select(group, "batch").groupBy("g").agg(F.countDistinct("batch").alias("n_reads"))
    found = time_store.read_store(spark, where, store).select(group, "time").groupBy("g").agg(
        F.count(F.lit(1)).alias("n_times"), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )
    marked = found.join(seen, "g").join(again, "g", "left")
    return shown(marked.select("g", "n_times", "first_time", "last_time", F.col("n_reads").cast("int").alias("n_reads"), F.coalesce("read_again", F.lit(False)).alias("read_again")))


@query(
    "combined_table",
    "SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, o_orderstatus AS _status, 3 AS n_columns FROM orders",
)
def combined_table(spark, sf_dir):
    """A combined table with the index columns of earlier exports: one without a name, one named after that."""
    price = F.col("o_totalprice").cast("double").cast("string")
    index = F.col("o_orderkey").cast("string")
    head = F.lit(',o_orderkey,Unnamed: 0,"o_totalprice",_status')
    rows = roles.table(spark, sf_dir, "orders").select(F.pmod("o_orderkey", F.lit(16)).alias("part"), F.lit(1).alias("place"), F.concat_ws(",", index, index, index, price, "o_orderstatus").alias("value"))
    heads = rows.select("part").distinct().select("part", F.lit(0).alias("place"), head.alias("value"))
    out = f"{shared_folder(spark, 'combined')}/all.csv"
    rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "place").select("part", "value").write.partitionBy("part").text(out)
    read = tables.read_combined(spark, out)
    return shown(
        read.select(
            F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_totalprice").cast("double").alias("o_totalprice"), "_status",
            F.lit(len(read.columns)).alias("n_columns"),
        )
    )


_SPANS_SQL = f"(SELECT instrument, leg, event_id % 2 AS part, min(ts) AS a, max(ts) AS b FROM {roles.LEGGED_SQL} GROUP BY 1, 2, 3)"


@query(
    "audit_report",
    f"""
    WITH o AS (SELECT x.instrument, count(*) AS n FROM {_SPANS_SQL} x JOIN {_SPANS_SQL} y
               ON x.instrument = y.instrument AND x.leg = y.leg AND x.part < y.part AND greatest(x.a, y.a) < least(x.b, y.b) GROUP BY 1)
    SELECT 'METEOROLOGY' AS experiment, instrument, count(*) AS n_files, count(DISTINCT part) AS n_layouts, 0::BIGINT AS unparsed_times,
           count(DISTINCT part) AS layouts_missing_variables, false AS no_rename_map, 1::BIGINT AS rename_conflicts, coalesce(any_value(o.n), 0) AS leg_overlaps,
           true AS flagged, any_value(e.n_rows) AS n_overlap_rows, count(*) AS n_listed
    FROM {_SPANS_SQL} LEFT JOIN o USING (instrument), (SELECT sum(n)::BIGINT AS n_rows FROM o) e GROUP BY instrument
    """,
)
def audit_report(spark, sf_dir):
    """The format audit of files in two layouts, from the files to the stored report and back."""
    out = shared_folder(spark, "audit")
    rows = roles.legged(spark, sf_dir).withColumn("part", F.col("event_id") % 2)
    place = ["leg", "instrument", "part"]
    stamp = F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    # The experiment stands in the path: with a constant among its partition columns the writer sorts anew and drops the order by time.
    ordered = rows.repartition(*place).sortWithinPartitions(*place, "time")
    for part, columns in ((0, [stamp.alias("Timestamp"), "user_id", "value"]), (1, ["value", stamp.alias("timestamp")])):
        ordered.where(F.col("part") == part).select(*columns, *place).write.mode("append").option("header", "true").partitionBy(*place).csv(f"{out}/files/experiment=METEOROLOGY")
    names = [(i, raw, canonical) for i in roles.INSTRUMENTS for raw, canonical in (("user_id", "level"), ("value", "level"), ("p", "pressure"))]
    mapping = spark.createDataFrame(names, "instrument string, raw string, canonical string").withColumn("experiment", F.lit("METEOROLOGY"))
    variables = spark.createDataFrame([(i, ["level", "pressure"]) for i in roles.INSTRUMENTS], "instrument string, variables array<string>").withColumn("experiment", F.lit("METEOROLOGY"))
    rule = r"(?=experiment=[^/]+/leg=(\d+)/)experiment=([^/]+)/leg=\d+/instrument=([^/]+)/"
    tables.write_audit_report(products.audit_files(spark, f"{out}/files", mapping, variables, rule=rule), f"{out}/report")
    summary, overlaps, files, unreadable = (spark.read.parquet(f"{out}/report/{name}") for name in ("summary", "overlaps", "files", "unreadable"))
    listed = files.groupBy("instrument").agg(F.count(F.lit(1)).alias("n_listed"))
    whole = overlaps.agg(F.count(F.lit(1)).alias("n_overlap_rows"))
    return summary.join(listed, "instrument").join(whole, F.lit(unreadable.count() == 0))
