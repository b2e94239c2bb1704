"""Files that are read in parts: heads and tails, splits with their header, archive members, the time store."""

from __future__ import annotations

import gzip
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tideline.sources import archives, lines, logsheets, profiles, ranged, tables, time_store


@pytest.fixture()
def small_splits(spark):
    """Files are cut every 2000 bytes, so that one file spreads over many tasks."""
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_ends_do_not_depend_on_length(spark, folder):
    for name, n in (("short", 3), ("long", 50_000)):
        (folder / f"{name}.csv").write_text("a,b\n" + "".join(f'{k},"x, {k}"\n' for k in range(n)) + "\n\n")
    (folder / "wide.csv").write_text("a,b\r\n1," + "y" * 30_000 + "\r\n2," + "z" * 20_000)
    (folder / "one.csv").write_text("a,b")
    (folder / "none.csv").write_text("")
    (folder / "blank.csv").write_text("\n \n")
    (folder / "odd name %20[1].csv").write_text("a,b\n5,6\n")
    (folder / "packed.csv.gz").write_bytes(gzip.compress(b"a,b\n" + b"".join(b"%d,0\n" % k for k in range(9_000))))
    found = {r["file_name"]: r for r in lines.file_ends(spark, str(folder)).collect()}
    assert set(found) == {"short.csv", "long.csv", "wide.csv", "one.csv", "odd name %20[1].csv", "packed.csv.gz"}
    assert found["long.csv"]["last_record"] == ["49999", "x, 49999"] and found["long.csv"]["first_record"] == ["0", "x, 0"]
    assert found["long.csv"]["bytes_read"] == 8_192 < found["long.csv"]["size"]
    assert [len(x) for x in found["wide.csv"]["first_record"]] == [1, 30_000] and found["wide.csv"]["last_record"][0] == "2"
    assert found["one.csv"]["is_empty"] and found["one.csv"]["last_record"] is None
    assert found["packed.csv.gz"]["last_record"] == ["8999", "0"]
    assert found["odd name %20[1].csv"]["last_record"] == ["5", "6"]


def test_head_grows_until_it_is_enough(spark, folder):
    (folder / "a.txt").write_text("\n".join(f"line {k}" for k in range(4_000)))
    (folder / "b.txt").write_text("line 0\nline 1")

    def take(found, whole):
        return found[:1000] if whole or len(found) >= 1000 else None

    got = {r["file_name"]: r for r in ranged.heads(spark, str(folder), take).collect()}
    assert got["a.txt"]["head"][-1] == "line 999" and got["a.txt"]["bytes_read"] == 16_384
    assert got["b.txt"]["head"] == ["line 0", "line 1"]


def test_lines_are_numbered_over_splits(spark, folder, small_splits):
    (folder / "a.txt").write_text("\n".join(f"row {k}" if k % 5 else "" for k in range(3_000)))
    (folder / "b.txt").write_text("x\ny\n")
    every = lines.numbered_lines(spark, str(folder))
    assert every.select("_path", "line_no").distinct().count() == 3_002
    bad = every.where(F.col("line").startswith("row") & (F.col("line") != F.concat(F.lit("row "), F.col("line_no") - 1)))
    assert bad.count() == 0
    filled = lines.numbered_lines(spark, str(folder), F.col("line") != "")
    assert filled.where("line = 'row 2999'").first()["line_no"] == 2_400


def test_one_profile_over_many_tasks(spark, folder, small_splits):
    head = ["* Sea-Bird", "** Station: 7", "# name 0 = prDM: Pressure", "# name 1 = t090C: Temperature", "# name 2 = t090C: again", "", "*END*"]
    (folder / "a.cnv").write_text("\r\n".join([*head, *(f"  {k}   {k / 2}  1\r\n" for k in range(2_000)), ""]))
    (folder / "b.cnv").write_text("\n".join([*head, "1 2"]))
    (folder / "c.cnv").write_text("\n".join(head))
    (folder / "d.cnv").write_text("\n".join([*head, "1 2 3", "# 5", "6 7 8"]))
    (folder / "e.cnv").write_text("\n".join([*head, "1 2 3", "# 4 5 6", "6 7 8"]))
    scans = profiles.read_cnv(spark, str(folder))
    big = scans.where("Source_File = 'a.cnv'")
    assert big.count() == 2_000 and big.where("values['prDM'] <> scan_no - 1").count() == 0
    assert big.first()["metadata"]["Station"] == "7"
    assert profiles.numbered_lines(spark, str(folder)).rdd.getNumPartitions() > 1
    problems = rows(profiles.cnv_problems(spark, str(folder)))
    assert problems == [("b.cnv", "columns and names do not match"), ("c.cnv", "no data section"), ("d.cnv", "columns and names do not match"), ("e.cnv", "columns and names do not match")]


def test_lines_of_a_file_are_not_hashed(spark, folder, small_splits):
    # what is known of files meets the lines as the small side, without a shuffle of the lines.
    head = ["** Station: 7", "# name 0 = prDM: Pressure", "*END*"]
    (folder / "a.cnv").write_text("\n".join([*head, *(f"  {k}" for k in range(2_000))]))
    numbered = lines.numbered_lines(spark, str(folder)).agg(F.count_if(F.col("line_no") > 3).alias("n"))
    scans = profiles.read_cnv(spark, str(folder)).agg(F.count_if(F.col("metadata")["Station"] == "7").alias("n"))
    for found in (numbered, scans):
        assert found.collect()[0]["n"] == 2_000
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" not in plan and "hashpartitioning(_path" not in plan.split("== Initial Plan ==")[0]


def test_one_spectrum_log_over_many_tasks(spark, folder, small_splits):
    clock = [f"{k // 60 % 24:02d}:{k % 60:02d}:00" for k in range(0, 6_000, 7)]
    head = ["File Details:", "S/N\t77", "Start Date\t2024-03-01", "", "Data:", "Time\tComment\t100\t200"]
    (folder / "a.txt").write_text("\n".join([*head, *(f"{c}\t\t{k}\t2" for k, c in enumerate(clock))]))
    (folder / "b.txt").write_text("\n".join(head))
    (folder / "c.txt").write_text("S/N\t1\n")
    found = profiles.read_spectra(spark, str(folder))
    assert found.count() == len(clock)
    minutes = (F.unix_seconds("time") - F.unix_seconds(F.lit("2024-03-01").cast("timestamp"))) / 60
    assert found.where(minutes != F.col("row_no") * 7).count() == 0  # past midnight, four times
    assert found.where((F.col("serial") != "77") | (F.col("spec")[0]["level_db"] != F.col("row_no"))).count() == 0
    assert rows(profiles.spectrum_problems(spark, str(folder))) == [("b.txt", "no rows"), ("c.txt", "no data table")]


def test_one_bridge_log_over_many_tasks(spark, folder, small_splits):
    top = [f"sheet {k}" for k in range(8)]
    body = [f"0{1 + k % 9}/03/2024 10:{k % 60:02d},5° {k % 60}.0' N,6° 30.0' E" for k in range(1_500)]
    (folder / "a.csv").write_text("\n".join([*top, "Time, LAT ,Lon", *body, "no,fix,here"]))
    (folder / "b.csv").write_text("\n".join([*top, '"Lon","Time","Lat"', "6° 30.0' W,01/03/2024 10:00,5° 0.0' S"]))
    (folder / "c.csv").write_text("\n".join(top))
    got = logsheets.read_bridge_log(spark, str(folder))
    assert got.groupBy(lines.FILE).count().orderBy(lines.FILE).collect() == [("a.csv", 1_500), ("b.csv", 1)]
    assert rows(got.where(F.col(lines.FILE) == "b.csv").select("latitude_deg", "longitude_deg")) == [(-5.0, -6.5)]


def test_members_of_an_archive_are_dealt_in_chunks(spark, folder):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for k in range(300):
            archive.writestr(f"deep/{k % 4}/r{k}.Xml", f"<a>{k} é</a>", zipfile.ZIP_STORED if k % 2 else zipfile.ZIP_DEFLATED)
        archive.writestr("readme.txt", "x")
    content = bytearray(held.getvalue())
    (folder / "a.zip").write_bytes(content)
    at = content.find(b"<a>101 ")
    content[at + 3 : at + 6] = b"999"  # a member whose checksum fails
    (folder / "b.zip").write_bytes(content)
    (folder / "c.zip").write_bytes(content[:1_000])
    (folder / "d.zip").write_bytes(b"")
    with zipfile.ZipFile(folder / "e.zip", "w") as archive:
        archive.writestr("readme.txt", "x")
    chunks = archives.archive_members(spark, str(folder), chunk_bytes=500, chunk_members=40).where("file = 'a.zip'")
    assert chunks.count() > 7 and chunks.agg(F.sum(F.size("members")), F.max(F.size("members"))).first()[0] == 300
    got = archives.read_archives(spark, str(folder)).cache()
    # Spark lists no empty files, so d.zip is not there.
    assert got.groupBy(lines.FILE).count().orderBy(lines.FILE).collect() == [("a.zip", 300), ("b.zip", 300), ("c.zip", 1)]
    good = got.where(F.col(lines.FILE) == "a.zip")
    assert good.where(F.col("xml") != F.concat(F.lit("<a>"), F.regexp_extract("member", r"r(\d+)", 1), F.lit(" é</a>"))).count() == 0
    assert [r["member"] for r in got.where((F.col(lines.FILE) == "b.zip") & F.col("xml").isNull()).collect()] == ["deep/1/r101.Xml"]
    assert got.where("member is null").count() == 1


def test_store_reads_changed_files_only(spark, folder):
    data, store = folder / "data", str(folder / "store")
    data.mkdir()
    (data / "a.csv").write_text("Timestamp,v\n2024-01-01 00:00:00,1\nrubbish,2\n02/01/2024 00:00,3\n")
    (data / "b.csv").write_text("v,time\n1,2024-02-01 00:00:00\n")
    (data / "c.csv").write_text("")
    spark.range(2).select(F.timestamp_seconds("id").alias("time")).coalesce(1).write.parquet(str(data / "d"))

    def read_now():
        return sorted(r["path"].rsplit("/", 1)[1][:1] for r in time_store.refresh(spark, str(data), store).select("path").collect())

    assert read_now() == ["a", "b", "p"]  # Spark lists no empty files
    assert read_now() == []
    held = time_store.read_store(spark, str(data), store)
    assert held.count() == 5
    (data / "b.csv").write_text("v,time\n1,2024-02-01 00:00:00\n2,2024-02-02 00:00:00\n")
    stamp = (data / "a.csv").stat()
    os.utime(data / "a.csv", (stamp.st_atime, stamp.st_mtime + 5))  # the same content, modified later
    assert read_now() == ["a", "b"]
    assert time_store.read_store(spark, str(data), store).count() == 6
    (data / "a.csv").unlink()
    (data / "e.csv").write_text("Timestamp\n2024-05-01 00:00:00\n")
    assert read_now() == ["e"]
    got = time_store.times(spark, str(data), store).where("path like '%.csv'")
    assert sorted(r["time"].isoformat()[:10] for r in got.select("time").collect()) == ["2024-02-01", "2024-02-02", "2024-05-01"]


def test_combined_table_without_index_columns(spark, folder):
    (folder / "all.csv").write_text(",time,Unnamed: 3,v\n0,2024-01-01 00:00:00,9,1.5\n")
    assert tables.read_combined(spark, str(folder / "all.csv")).columns == ["time", "v"]
