"""What files there are, and what their names say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import schema
from tideline.functions import text as tx
from tideline.functions import time as tm

# Names of recordings and spectrum logs, prefix, serial, date, clock.
RECORDING_NAME = r"(?i)^(LUF|LUW|SJW)(\d+)_(\d{8})_(\d{6})\.(txt|wav)$"


def list_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Path, name, stem, folder, size and modification time. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return reader.load(path).select(
        "path",
        name.alias("file_name"),
        tx.file_stem(name).alias("stem"),
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("raw_mtime"),
    )


def recordings(files: DataFrame) -> DataFrame:
    """Files named like a recording, with kind, serial and start time; other files are left out."""
    part = [F.regexp_extract("file_name", RECORDING_NAME, i) for i in range(1, 6)]
    start = F.try_to_timestamp(F.concat(part[2], part[3]), F.lit("yyyyMMddHHmmss"))
    return files.where(F.col("file_name").rlike(RECORDING_NAME)).withColumns(
        {"kind": F.upper(part[0]), "serial": part[1], "start": start, "extension": F.lower(part[4])}
    )


def instrument_of(middle: Column, instruments: list[str]) -> Column:
    """The longest known instrument name that `middle` is, or starts with before an underscore."""
    hits = [
        F.when((middle == name) | middle.startswith(name + "_"), F.lit(name))
        for name in sorted(instruments, key=len, reverse=True)
    ]
    return F.coalesce(*hits)


def interval_tables(files: DataFrame, cruise: str, interval: str) -> DataFrame:
    """Tables named {cruise}_LEG{leg}_{experiment}_{instrument}..._{interval}.csv, with those parts."""
    pattern = rf"^\Q{cruise}\E_LEG(\d+)_([A-Z]+)_(.+)_\Q{interval}\E\.csv$"
    named = files.withColumns(
        {
            "leg": F.regexp_extract("file_name", pattern, 1).try_cast("int"),
            "experiment": F.regexp_extract("file_name", pattern, 2),
            "_middle": F.regexp_extract("file_name", pattern, 3),
        }
    )
    instrument = F.lit(None).cast("string")
    for experiment, names in schema.INSTRUMENTS.items():
        instrument = F.when(F.col("experiment") == experiment, instrument_of(F.col("_middle"), names)).otherwise(instrument)
    return named.withColumn("instrument", instrument).where(F.col("instrument").isNotNull()).drop("_middle")


def archive_ranges(files: DataFrame) -> DataFrame:
    """Add start and end from names that carry both; NULL where the name is of another form."""
    start, end = tm.range_in_name("file_name")
    return files.withColumns({"start": start, "end": end})


def recording_starts(files: DataFrame) -> DataFrame:
    """Add the start from names that carry only that."""
    return files.withColumn("start", tm.recording_start("file_name"))
