from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import at, rows
from pyspark.sql import types as T

from tideline.operators import gaps
from tideline.sources import tables
from tideline.streaming import jobs

SCHEMA = T.StructType(
    [T.StructField("instrument", T.StringType()), T.StructField("time", T.TimestampType()), T.StructField("value", T.DoubleType())]
)


def drop(spark, folder, name, data):
    """Put one more file in the watched folder."""
    df = spark.createDataFrame([(i, at(t), v) for i, t, v in data], SCHEMA).coalesce(1)
    df.write.mode("append").parquet(str(folder / "in"))


def run(df, folder, name):
    query = (
        df.writeStream.format("parquet").option("path", str(folder / name))
        .option("checkpointLocation", str(folder / f"{name}_state")).trigger(availableNow=True).outputMode("append").start()
    )
    query.awaitTermination()
    assert query.exception() is None


def stream(spark, folder):
    return jobs.read_new_files(spark, str(folder / "in"), SCHEMA)


def test_new_files_are_ingested_once(spark, folder):
    drop(spark, folder, "1", [("a", "2024-01-01 00:00:00", 1.0)])
    for expected in (1, 1):
        jobs.ingest_available(stream(spark, folder), str(folder / "out"), str(folder / "ck"), ["instrument"]).awaitTermination()
        assert spark.read.parquet(str(folder / "out")).count() == expected
    drop(spark, folder, "2", [("b", "2023-01-01 00:00:00", 2.0)])
    jobs.ingest_available(stream(spark, folder), str(folder / "out"), str(folder / "ck"), ["instrument"]).awaitTermination()
    assert spark.read.parquet(str(folder / "out")).count() == 2


def test_resample_drops_late_rows_and_backfill_repairs(spark, folder):
    drop(spark, folder, "1", [("a", "2024-01-01 00:01:00", 1.0), ("a", "2024-01-01 00:02:00", 3.0), ("a", "2024-01-01 02:00:00", 9.0)])
    df = jobs.resample_stream(stream(spark, folder), ["instrument"], "1h", ["value"])
    run(df, folder, "out")
    drop(spark, folder, "2", [("a", "2024-01-01 00:03:00", 99.0), ("a", "2024-01-01 05:00:00", 1.0)])
    run(df, folder, "out")
    out = rows(spark.read.schema(SCHEMA).parquet(str(folder / "out")))
    assert ("a", "2024-01-01 00:00:00.000000", 2.0) in out and ("a", "2024-01-01 02:00:00.000000", 9.0) in out
    from tideline.operators import resample

    whole = resample.resample_mean(spark.read.parquet(str(folder / "in")), ["instrument"], "1h", ["value"], dense=False)
    jobs.backfill(whole, str(folder / "table"), ["instrument"])
    assert ("2024-01-01 00:00:00.000000", pytest.approx(103 / 3), "a") in rows(spark.read.parquet(str(folder / "table")))


def test_energetic_resample(spark, folder):
    drop(spark, folder, "1", [("a", "2024-01-01 00:01:00", 10.0), ("a", "2024-01-01 00:02:00", 20.0), ("a", "2024-01-01 09:00:00", 0.0)])
    run(jobs.resample_stream(stream(spark, folder), ["instrument"], "1h", ["value"], ["value"]), folder, "out")
    drop(spark, folder, "2", [("a", "2024-01-01 12:00:00", 0.0)])
    run(jobs.resample_stream(stream(spark, folder), ["instrument"], "1h", ["value"], ["value"]), folder, "out")
    first = rows(spark.read.schema(SCHEMA).parquet(str(folder / "out")))[0]
    assert first[2] == pytest.approx(17.403627)


def test_repeated_records_are_dropped(spark, folder):
    one = ("a", "2024-01-01 00:00:00", 1.0)
    drop(spark, folder, "1", [one, one, ("a", "2024-01-01 00:00:00", 2.0)])
    df = jobs.distinct_stream(stream(spark, folder), ["instrument", "time", "value"])
    run(df, folder, "out")
    drop(spark, folder, "2", [one])
    run(df, folder, "out")
    assert spark.read.schema(SCHEMA).parquet(str(folder / "out")).count() == 2


def test_sessions_include_rows_exactly_one_gap_apart(spark, folder):
    drop(spark, folder, "1", [("a", "2024-01-01 00:00:00", 0.0), ("a", "2024-01-01 00:00:15", 0.0), ("a", "2024-01-01 00:01:00", 0.0),
                              ("a", "2024-01-01 06:00:00", 0.0)])
    df = jobs.session_stream(stream(spark, folder), ["instrument"], "15 seconds", min_rows=2)
    run(df, folder, "out")
    drop(spark, folder, "2", [("a", "2024-01-01 12:00:00", 0.0)])
    run(df, folder, "out")
    out = rows(spark.read.parquet(str(folder / "out")))
    assert out == [("a", "2024-01-01 00:00:00.000000", "2024-01-01 00:00:15.000000", 2)]


def test_gaps_match_the_batch_operator(spark, folder):
    base = at("2024-01-01 00:00:00")
    steps = [0, 30, 59, 60, 200, 201, 261, 262, 4000, 4059, 9000]
    data = [(i, str((base + timedelta(seconds=s)).replace(tzinfo=None)), 0.0) for i in ("a", "b") for s in steps]
    half = len(data) // 2
    df = jobs.gap_stream(stream_for(spark, folder, data[:half:2] + data[1:half:2]), ["instrument"], 1.0)
    run(df, folder, "out")
    drop(spark, folder, "2", [("a", "2024-01-01 03:00:00", 0.0)])
    run(df, folder, "out")
    drop(spark, folder, "3", [("a", "2024-01-02 03:00:00", 0.0)])
    run(df, folder, "out")
    whole = spark.read.parquet(str(folder / "in"))
    expected = gaps.internal_gaps(whole, ["instrument"], "time", 1.0).select("instrument", "previous_time", "current_time", "gap_minutes")
    found = rows(spark.read.parquet(str(folder / "out")))
    # The bucket of the last row is still open on the stream.
    open_end = [r for r in rows(expected) if r[2].startswith("2024-01-02")]
    assert found == [r for r in rows(expected) if r not in open_end] and len(found) >= 4


def test_a_stream_without_any_gap(spark, folder):
    # a key whose batch holds no gap gives an empty table.
    data = [(f"k{k:02d}", f"2024-01-01 00:{m:02d}:00", 0.0) for k in range(12) for m in range(0, 50, 10)]
    df = jobs.gap_stream(stream_for(spark, folder, data), ["instrument"], 10.0)
    run(df, folder, "out")
    drop(spark, folder, "2", [("k00", "2024-01-01 00:50:00", 0.0), ("k00", "2024-01-01 03:00:00", 0.0)])
    run(df, folder, "out")
    assert spark.read.schema(df.schema).parquet(str(folder / "out")).count() == 0


def stream_for(spark, folder, data):
    drop(spark, folder, "1", data)
    return stream(spark, folder)


def test_stream_tables_can_be_read_back(spark, folder):
    drop(spark, folder, "1", [("a", "2024-01-01 00:00:00", 1.0)])
    jobs.ingest_available(stream(spark, folder), str(folder / "out"), str(folder / "ck")).awaitTermination()
    assert tables.read_times(spark, str(folder / "out"), ["instrument"]).count() == 1


def test_late_rows_go_to_their_own_table_and_their_partitions_are_recomputed(spark, folder):
    from pyspark.sql import functions as F

    def product(df):
        return df.groupBy("instrument").agg(F.sum("value").alias("total"), F.count("*").alias("n"))

    out = str(folder / "held")
    batches = [
        [("a", "2024-01-01 10:00:00", 1.0), ("b", "2024-01-01 12:00:00", 5.0)],
        [("a", "2024-01-01 09:00:00", 10.0), ("c", "2024-01-01 12:00:00", 2.0)],  # 9:00 is behind 12:00
        [("c", "2024-01-01 13:00:00", 1.0)],
    ]
    tables_ = []
    for data in batches:
        drop(spark, folder, "x", data)
        jobs.ingest_and_mend(stream(spark, folder), out, str(folder / "ck"), product, ["instrument"]).awaitTermination()
        tables_.append(rows(spark.read.parquet(f"{out}/table").select("instrument", "total", "n")))
    assert tables_[0] == [("a", 1.0, 1), ("b", 5.0, 1)]
    assert tables_[1] == [("a", 11.0, 2), ("b", 5.0, 1), ("c", 2.0, 1)]
    assert tables_[2] == [("a", 11.0, 2), ("b", 5.0, 1), ("c", 3.0, 2)]
    assert rows(spark.read.parquet(f"{out}/late").select("batch", "instrument", "value")) == [(1, "a", 10.0)]
    jobs.ingest_and_mend(stream(spark, folder), out, str(folder / "ck"), product, ["instrument"]).awaitTermination()
    assert spark.read.parquet(f"{out}/rows").count() == 5  # nothing new, nothing twice


def test_rows_within_the_lateness_are_not_late(spark, folder):
    out = str(folder / "held")
    for data in ([("a", "2024-01-01 12:00:00", 1.0)], [("a", "2024-01-01 11:30:00", 1.0), ("a", "2024-01-01 10:59:59", 1.0)]):
        drop(spark, folder, "x", data)
        jobs.ingest_and_mend(stream(spark, folder), out, str(folder / "ck"), lambda df: df, ["instrument"], 3_600_000_000).awaitTermination()
    assert rows(spark.read.parquet(f"{out}/late").select("time")) == [("2024-01-01 10:59:59.000000",)]
