"""Stored tables: reads that prune, and the writers of products."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.operators.projection import resolve_time_column, select_combos
from tideline.sources.lines import FILE, drop_unnamed, read_delimited

_PARTITIONS = ["experiment", "instrument", "leg"]


def read_combined(spark: SparkSession, path: str) -> DataFrame:
    """A combined table of all legs, Parquet or CSV, without index columns of earlier exports."""
    if path.rstrip("/").lower().endswith(".csv"):
        return read_delimited(spark, path).drop(FILE)
    return drop_unnamed(spark.read.parquet(path))


def read_times(spark: SparkSession, path: str, keys: Iterable[str] = ()) -> DataFrame:
    """Keys and time only; the scan reads no other column."""
    df = read_combined(spark, path)
    name = resolve_time_column(df.columns)
    kind = dict(df.dtypes)[name]
    time = F.col(name) if kind.startswith("timestamp") else tm.to_utc(name)
    return df.select(*keys, time.cast("timestamp").alias("time")).where(F.col("time").isNotNull())


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Parquet, replacing only the partitions that `df` holds."""
    keys = list(partition_by)
    writer = df.write.mode("overwrite")
    if keys:
        writer = df.repartition(*keys, *_spread(df, keys)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*keys)
    writer.parquet(path)


def _spread(df: DataFrame, keys: list[str]) -> list:
    """With a time column, days spread a large partition over many tasks and files."""
    if "time" in df.columns and "time" not in keys:
        return [F.to_date("time")]
    return []


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with the time in canonical text."""
    if "time" in df.columns and dict(df.dtypes)["time"].startswith("timestamp"):
        df = df.withColumn("time", tm.format_time("time"))
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_product(tables: dict[str, DataFrame], path: str) -> None:
    """Cleaned rows and resampled intervals of an instrument product."""
    write_table(tables["cleaned"], f"{path}/cleaned", [k for k in _PARTITIONS if k in tables["cleaned"].columns])
    intervals = tables["intervals"]
    write_table(intervals, f"{path}/intervals", ["interval", *[k for k in _PARTITIONS if k in intervals.columns]])


def read_intervals(
    spark: SparkSession, path: str, interval: str, only_experiments: list[str] | None = None,
    only_instruments: list[str] | None = None,
) -> DataFrame:
    """One interval over all legs; filters prune partitions."""
    df = spark.read.parquet(f"{path}/intervals").where(F.col("interval") == interval)
    only = {"experiment": only_experiments, "instrument": only_instruments}
    return select_combos(df, **{k: v for k, v in only.items() if k in df.columns})


def write_combined(
    spark: SparkSession, path: str, intervals: Iterable[str], out: str, only_experiments: list[str] | None = None,
    only_instruments: list[str] | None = None,
) -> None:
    """One chronological table per interval, experiment and instrument across all legs."""
    for interval in intervals:
        df = read_intervals(spark, path, interval, only_experiments, only_instruments)
        keys = [k for k in ("interval", "experiment", "instrument") if k in df.columns]
        ordered = df.repartition(*keys, *_spread(df, keys)).sortWithinPartitions(*keys, F.col("time").asc_nulls_last())
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(out)


def write_gap_report(tables: dict[str, DataFrame], path: str) -> None:
    """Gap and statistics tables by leg; legs of earlier runs stay."""
    for name in ("gaps", "statistics"):
        write_table(tables[name], f"{path}/{name}", ["leg"])


def read_gap_report(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The report over every leg ever written."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("gaps", "statistics")}


def write_audit_report(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        write_table(df, f"{path}/{name}")
