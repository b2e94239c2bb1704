from __future__ import annotations

import zipfile

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tideline.operators import projection
from tideline.sources import archives, discovery, lines, logsheets, profiles, tables


def test_delimited_layouts_are_read_apart_and_united(spark, folder):
    (folder / "a.csv").write_text('Timestamp,"Heading, degrees true"\n2024-01-01,1.5\n2024-01-02,2.5\n')
    (folder / "b.csv").write_text('Timestamp,"Heading,_degrees_true",Unnamed: 0\n2024-01-03,3.5,9\n')
    df = lines.read_delimited(spark, str(folder))
    assert [k for _, k in df.dtypes] == ["string"] * len(df.columns)
    assert "Unnamed: 0" not in df.columns
    mapping = {"Timestamp": "time", "Heading, degrees true": "heading", "Heading,_degrees_true": "heading"}
    out = rows(projection.keep_and_rename(df, mapping))
    assert out == [("2024-01-01", "1.5"), ("2024-01-02", "2.5"), ("2024-01-03", "3.5")]
    assert projection.missing_canonical(df, {**mapping, "x": "pitch"}) == ["pitch"]
    assert lines.keep_raw_time(df.withColumn("time", F.lit("x"))).columns[-1] == "Timestamp"


def test_json_lines_are_repaired_and_bad_ones_counted(spark, folder):
    text = (
        '{"timestamp": "2024-01-01", "a": 1, "n": {"x": 1}}\n'
        "\n"
        '"a": 2, "b": "q"}\n'
        '{"a": 3\n'
        "[1,2]\n"
        '{"a": 1} x}\n'
        '{"a": 1}, {"b": 2}\n'
        '{"a":\n'
        "plain\n"
    )
    (folder / "m.json").write_text(text)
    (folder / "ok.json").write_text('{"a": 1}\n')
    records = lines.read_json_lines(spark, str(folder))
    got = {tuple(sorted(r["record"].items())) for r in records.where("__source_file = 'm.json'").collect()}
    assert got == {
        (("a", "1"), ("n", '{"x":1}'), ("timestamp", "2024-01-01")),
        (("a", "2"), ("b", "q")),
        (("a", "3"),),
    }
    assert lines.map_keys_seen(records) == ["timestamp", "a", "b", "n"]
    wide = lines.widen(records, "record", ["timestamp", "a", "b"])
    assert wide.columns == ["__source_file", "timestamp", "a", "b"]
    report = rows(lines.json_line_report(spark, str(folder), shown=3))
    assert report == [("m.json", 3, 5, [5, 6, 7]), ("ok.json", 1, 0, [])]


CNV = """* Sea-Bird SBE 9 Data File:
* FileName = C:\\Seabird\\CTDDATA\\St04_2.hex
** Ship: Example
* System UTC = Jan 05 2024 10:00:00
# name 0 = prdM: Pressure, Strain Gauge [db]
# name 1 = t090C: Temperature [ITS-90, deg C]
# span 0 = 1, 2
*END*
      1.000    10.5
      2.000    10.25

      3.000    10.0
"""


def test_profile_files(spark, folder):
    (folder / "Leg3_St04-2.cnv").write_text(CNV)
    (folder / "empty.cnv").write_text(CNV.split("*END*")[0])
    (folder / "odd.cnv").write_text(CNV + "   1 2 3\n")
    df = profiles.read_cnv(spark, str(folder))
    out = lines.widen(lines.widen(df, "values", ["prdM", "t090C"]), "metadata", ["FileName", "Ship", "System_UTC"])
    assert rows(out) == [
        ("Leg3_St04-2.cnv", n, f"{n}.000", t, "C:\\Seabird\\CTDDATA\\St04_2.hex", "Example", "Jan 05 2024 10:00:00")
        for n, t in ((1, "10.5"), (2, "10.25"), (3, "10.0"))
    ]
    assert rows(profiles.cnv_problems(spark, str(folder))) == [
        ("empty.cnv", "no data section"),
        ("odd.cnv", "columns and names do not match"),
    ]


LOG = (
    "File Details:\nStart Date\t2024-01-05\nS/N\t6952\nSample Rate [S/s]\t32000\nData:\n"
    "Time\tComment\tTemperature\tHumidity\tSequence #\tData Points\t0\t1000\t60000\t\n"
    "23:59:30\t\t10.5\t40\t1\t512\t99\t50\t60\t\n"
    "00:00:00\tok\t10.6\t40\t2\t512\t99\t70\t\t\n"
    "00:00:30\t\t10.6\n"
)


def test_spectrum_logs(spark, folder):
    (folder / "LUF6952_20240105_235930.txt").write_text(LOG)
    (folder / "bad.txt").write_text("Start Date\t2024-01-05\n")
    df = profiles.with_summaries(profiles.read_spectra(spark, str(folder)))
    out = rows(
        df.select("row_no", "time", "serial", "comment", "temperature", "n_bins", "peak_freq_hz",
                  F.round("level_broadband", 3), "level_0_5_2khz", "level_50_256khz", "f_max_hz")
    )
    assert out == [
        (0, "2024-01-05 23:59:30.000000", "6952", None, "10.5", 3, 60000.0, 60.414, 50.0, 60.0, 60000.0),
        (1, "2024-01-06 00:00:00.000000", "6952", "ok", "10.6", 3, 1000.0, 70.0, 70.0, None, 60000.0),
        (2, "2024-01-06 00:00:30.000000", "6952", None, "10.6", 3, None, None, None, None, 60000.0),
    ]
    assert rows(profiles.spectrum_problems(spark, str(folder))) == [("bad.txt", "no data table")]


def record(time: str, sensor: str = "", system: str = "", data: bool = True) -> str:
    body = f"<d:Data><d:Time>{time}</d:Time><d:RecordNumber>7</d:RecordNumber>{sensor}{system}</d:Data>" if data else ""
    head = f"<d:Time>{time}</d:Time>" if time else ""
    return (
        f'<?xml version="1.0"?><d:Device xmlns:d="http://example.org/d" ID="D1" SessionID="s" Descr="Box">{head}'
        f'<d:SystemInformation><d:SystemInfo ID="10">Owner A</d:SystemInfo></d:SystemInformation>{body}</d:Device>'
    )


SENSORS = (
    '<d:SensorData ID="4420-1" SerialNo="77" Descr="Conductivity Sensor"><d:Parameters>'
    '<d:Point ID="0" Descr="Conductivity" Unit="mS/cm" RangeMin="0" RangeMax="75"><d:Value>41.5</d:Value></d:Point>'
    '<d:Point ID="1" Descr="sound_speed" Unit="m/s"><d:Value>1500</d:Value></d:Point>'
    '<d:Point ID="2" Descr="Density"><d:Value>none</d:Value></d:Point>'
    "</d:Parameters></d:SensorData>"
    '<d:SensorData ID="TX" SerialNo="5" Descr="Optical"><d:Parameters>'
    '<d:Point ID="0" Descr="Turbidity" Unit="NTU"><d:Value>0.5</d:Value></d:Point></d:Parameters></d:SensorData>'
)
SYSTEM = (
    '<d:SystemData><d:Parameters><d:Point ID="0" Descr="Input Voltage" Unit="V"><d:Value>12.5</d:Value></d:Point>'
    '<d:Point ID="7"><d:Value>45.5</d:Value></d:Point><d:Point ID="8"><d:Value>-12.25</d:Value></d:Point>'
    "</d:Parameters></d:SystemData>"
)


def test_archives_of_records(spark, folder):
    with zipfile.ZipFile(folder / "20240105T000000-20240105T010000.zip", "w") as archive:
        archive.writestr("deep/er/a.xml", record("2024-01-05T00:10:00Z", SENSORS, SYSTEM))
        archive.writestr("b.xml", record("2024-01-05T00:20:00Z", SENSORS))
        archive.writestr("c.xml", "<broken><a>")
        archive.writestr("d.xml", record("", SENSORS))
        archive.writestr("e.xml", record("2024-01-05T00:30:00Z", data=False))
        archive.writestr("f.xml", record("2024-01-06T00:30:00Z", SENSORS))
        archive.writestr("readme.txt", "no record")
    (folder / "cut.zip").write_bytes(b"PK no archive")
    limit = F.to_timestamp(F.lit("2024-01-05 12:00:00"))
    parsed = archives.parse_records(archives.read_archives(spark, str(folder)), to_time=limit)
    problems = {r["member"]: r["problem"] for r in parsed.collect()}
    assert problems == {
        "deep/er/a.xml": None, "b.xml": None, "c.xml": "unreadable", "d.xml": "no time", "e.xml": "no data",
        "f.xml": "outside the time range", None: "unreadable",
    }
    flat = {r["sourceFile"]: r for r in archives.flatten_records(parsed).collect()}
    assert set(flat) == {"a.xml", "b.xml"}
    a = flat["a.xml"]
    assert (a["latitude"], a["longitude"], a["voltage_current"], a["owner"]) == (45.5, -12.25, 12.5, "Owner A")
    assert a["values"] == {"CS_Conductivity": 41.5, "CS_SoundSpeed": 1500.0, "TX_Turbidity": 0.5}
    assert a["units"]["CS_Conductivity"] == "mS/cm" and a["ranges"] == {"CS_Conductivity": "0-75"}
    assert set(a["sensors"]) == {"conductivity_sensor_77", "TX"}
    assert (flat["b.xml"]["latitude"], flat["b.xml"]["voltage_current"]) == (0.0, None)


def test_leg_windows_and_rules(spark):
    sheet = spark.createDataFrame(
        [("2", "05/01/2024 00:00", "2024-01-10"), ("1", "2024-01-01", "2024-01-05"), (None, "2024-01-01", "2024-01-02"),
         ("3", "soon", "2024-01-02")],
        ["Leg Number", "Start time (UTC)", "End time (UTC)"],
    )
    assert [tuple(r)[0] for r in logsheets.leg_windows(sheet).collect()] == [1, 2]
    bad = spark.createDataFrame([("4", "2024-01-05", "2024-01-05")], sheet.columns)
    with pytest.raises(Exception, match="window of leg 4"):
        logsheets.leg_windows(bad).collect()

    rules = spark.createDataFrame(
        [("1", "2.5"), ("2.0", "x"), ("3", "1")], ["Leg number", "Remove data when pressure is under"]
    )
    assert rows(logsheets.pressure_rules(rules)) == [(1, 2.5), (3, 1.0)]
    assert rows(logsheets.incomplete_rules(rules)) == [(2, None)]
    with pytest.raises(Exception, match="more than one pressure rule for leg 1"):
        logsheets.pressure_rules(rules.unionByName(rules)).collect()


def test_bridge_log(spark, folder):
    head = "\n".join(f"line {i}" for i in range(8))
    text = f"{head}\nTime,Speed,LAT,Lon\n08/07/2025 00:03,5,37° 44.2464' N,025° 39.7979' W\n,,,\n08/07/2025 00:09,5,bad,025° 0' E\n" \
        "08/07/2025 00:15,5,10° 30' S,001° 0' E\n"
    (folder / "bridge.csv").write_text(text, encoding="utf-8")
    out = rows(logsheets.read_bridge_log(spark, str(folder)).withColumns(
        {c: F.round(c, 6) for c in ("latitude_deg", "longitude_deg")}))
    assert out == [
        ("bridge.csv", "2025-07-08 00:03:00.000000", 37.73744, -25.663298, "Bridge"),
        ("bridge.csv", "2025-07-08 00:15:00.000000", -10.5, 1.0, "Bridge"),
    ]


def test_discovery(spark, folder):
    for name in ("LUF6952_20240105_120000.txt", "LUW6952_20240105_120000.wav", "notes.txt",
                 "C1_LEG4_METEOROLOGY_GMX300_cleaned_5min.csv", "C1_LEG4_METEOROLOGY_GMX300X_5min.csv",
                 "C1_LEG4_NAVIGATION_GPS-MERGED-SOURCES_5min.csv"):
        (folder / name).write_text("x")
    files = discovery.list_files(spark, str(folder))
    assert "content" not in files.columns
    found = rows(discovery.recordings(files).select("kind", "serial", "start", "extension"))
    assert found == [("LUF", "6952", "2024-01-05 12:00:00.000000", "txt"), ("LUW", "6952", "2024-01-05 12:00:00.000000", "wav")]
    tabs = rows(discovery.interval_tables(files, "C1", "5min").select("leg", "experiment", "instrument"))
    assert tabs == [(4, "METEOROLOGY", "GMX300"), (4, "NAVIGATION", "GPS-MERGED-SOURCES")]
    names = spark.createDataFrame([("EK80_CP300-ADCP_x",), ("EK80",)], ["m"])
    picked = names.select(discovery.instrument_of(F.col("m"), ["EK80", "EK80_CP300-ADCP"]).alias("i"))
    assert rows(picked) == [("EK80",), ("EK80_CP300-ADCP",)]


def test_time_from_file_name(spark, folder):
    (folder / "x_202401051200_a.csv").write_text("v\n1\n2\n")
    df = lines.numbered_lines(spark, str(folder)).where("line_no > 1 AND line <> ''")
    df = df.withColumn("row_no", F.col("line_no") - 1)
    out = rows(lines.ensure_time(df).select("line", "time"))
    assert out == [("1", "2024-01-05 12:00:00.000000"), ("2", "2024-01-05 12:00:01.000000")]


def test_sinks_keep_other_partitions(spark, folder):
    df = spark.createDataFrame(
        [(1, at("2024-01-01"), 1.0), (2, at("2024-01-02"), 2.0)], ["leg", "time", "v"]
    )
    path = str(folder / "t")
    tables.write_table(df, path, ["leg"])
    tables.write_table(df.where("leg = 2").withColumn("v", F.lit(9.0)), path, ["leg"])
    assert rows(spark.read.parquet(path).select("leg", "v")) == [(1, 1.0), (2, 9.0)]
    tables.export_csv(df, str(folder / "c"))
    text = spark.read.options(header=True).csv(str(folder / "c"))
    assert sorted(r["time"] for r in text.collect())[0] == "2024-01-01 00:00:00.000000+00:00"
    times = tables.read_times(spark, path, ["leg"])
    assert times.columns == ["leg", "time"]
    assert "v" not in times._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split(">")[0]


def test_product_tables_round_trip(spark, folder):
    cleaned = spark.createDataFrame([("N", "GGA", 1, at("2024-01-01"), 1.0)], ["experiment", "instrument", "leg", "time", "v"])
    intervals = cleaned.withColumn("interval", F.lit("1h")).unionByName(cleaned.withColumn("interval", F.lit("1D")))
    tables.write_product({"cleaned": cleaned, "intervals": intervals}, str(folder / "p"))
    assert tables.read_intervals(spark, str(folder / "p"), "1h", ["N"], ["GGA"]).count() == 1
    assert tables.read_intervals(spark, str(folder / "p"), "1h", ["M"]).count() == 0
    tables.write_combined(spark, str(folder / "p"), ["1h", "1D"], str(folder / "all"))
    assert spark.read.parquet(str(folder / "all")).count() == 2
    gaps = spark.createDataFrame([(1, "start"), (2, "end")], ["leg", "gap_type"])
    tables.write_gap_report({"gaps": gaps, "statistics": gaps}, str(folder / "g"))
    tables.write_gap_report({"gaps": gaps.where("leg = 1"), "statistics": gaps.where("leg = 1")}, str(folder / "g"))
    assert tables.read_gap_report(spark, str(folder / "g"))["gaps"].count() == 2
    tables.write_audit_report({"summary": gaps}, str(folder / "a"))
    assert spark.read.parquet(str(folder / "a" / "summary")).count() == 2


def test_file_manifest(spark, folder):
    (folder / "a.csv").write_text('Timestamp,"Heading, degrees true"\n2024-01-01 00:00:00,1.5\n2024-01-02 00:00:00,2.5\n2024-01-03 0')
    (folder / "b_202401051200.csv").write_text("v,w\n1,2\n3,4\n\n")
    (folder / "c.csv").write_text("timestamp,v\n")
    (folder / "d.csv").write_text("timestamp,dataTimestamp\nx,05/01/2024 10:00\n")
    (folder / "e.csv").write_text("")
    out = lines.file_manifest(spark, str(folder), "dataTimestamp")
    got = rows(out.select("file_name", F.concat_ws("|", "header"), "time_col", "first_raw", "last_time", "is_empty"))
    assert got == [
        ("a.csv", "Timestamp|Heading, degrees true", "Timestamp", "2024-01-01 00:00:00", "2024-01-01 00:00:00.000000", False),
        ("b_202401051200.csv", "v|w", "(filename)", "2024-01-05 12:00:00.000000+00:00", "2024-01-05 12:00:00.000000", False),
        ("c.csv", "timestamp|v", "timestamp", None, None, True),
        ("d.csv", "timestamp|dataTimestamp", "dataTimestamp", "05/01/2024 10:00", "2024-01-05 10:00:00.000000", False),
    ]


def test_only_unnamed_columns_are_dropped(spark, folder):
    (folder / "a.csv").write_text(",Timestamp,_calibration,_c9,Unnamed: 4\n0,20250902101530,7,8,9\n")
    got = lines.read_delimited(spark, str(folder / "a.csv"))
    assert set(got.columns) == {"Timestamp", "_calibration", "_c9", lines.FILE}
    kept = lines.drop_unnamed(spark.createDataFrame([(1, 2, 3)], ["Unnamed: 0", "_cond", "_c1"]))
    assert kept.columns == ["_cond", "_c1"]
