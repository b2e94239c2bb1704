"""Structured Streaming transformations and the jobs around them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tideline.functions import acoustic as ac
from tideline.functions import time as tm
from tideline.sources.tables import write_table

_GAP_FIELDS = [
    T.StructField("previous_time", T.TimestampType()),
    T.StructField("current_time", T.TimestampType()),
    T.StructField("gap_minutes", T.DoubleType()),
]


def _interval(us: int) -> str:
    return f"{us} microseconds"


def read_new_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """A stream of files as they arrive; each file is read once per checkpoint."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def ingest_available(stream: DataFrame, out: str, checkpoint: str, partition_by: list[str] = ()) -> StreamingQuery:
    """Append everything that has arrived since the last run, then stop.

    Which files are new is kept in the checkpoint, so a file with an old
    modification time that shows up late is taken like any other.
    """
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).outputMode("append").start()


def _earlier_clock(spark: SparkSession, folder: str, batch: int) -> int | None:
    """The latest time (in microseconds) of all batches before this one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema("us long, batch long").parquet(folder).where(F.col("batch") < batch).agg(F.max("us")).first()[0]


def ingest_and_mend(
    stream: DataFrame, out: str, checkpoint: str, product: Callable[[DataFrame], DataFrame], partition_by: list[str],
    lateness_us: int = 0, time: str = "time",
) -> StreamingQuery:
    """Take what has arrived, keep rows behind the watermark apart as well, and recompute the partitions that any row touches.

    The watermark of a batch is the latest time of the batches before it less `lateness_us`; what is older is late. Below `out`,
    `rows/batch=N` holds all rows of a batch with a flag, `late/batch=N` the late ones, and `table` the product of all
    rows, of which each batch replaces the touched partitions. A batch that is run again replaces its own
    folders, so a failure between two steps costs nothing. Rows without time are never late.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        clock = _earlier_clock(spark, f"{out}/clock", number)
        late = F.lit(False) if clock is None else F.coalesce(tm.micros(time) < clock - lateness_us, F.lit(False))
        batch.withColumn("late", late).write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
        held = spark.read.parquet(f"{out}/rows/batch={number}")
        held.where("late").drop("late").write.mode("overwrite").parquet(f"{out}/late/batch={number}")
        held.agg(F.max(tm.micros(time)).alias("us")).write.mode("overwrite").parquet(f"{out}/clock/batch={number}")
        touched = held.select(*partition_by).distinct()
        known = spark.read.parquet(f"{out}/rows").where(F.col("batch") <= number).drop("batch", "late")
        same = [known[k].eqNullSafe(touched[k]) for k in partition_by]
        backfill(product(known.join(touched, same, "left_semi")), f"{out}/table", partition_by)

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def resample_stream(
    stream: DataFrame, keys: list[str], freq: str, columns: list[str], level_columns: list[str] = (),
    lateness: str = "10 minutes", time: str = "time",
) -> DataFrame:
    """Mean per bin once the watermark has passed it; only bins with data, dB columns as power."""
    means = [
        (ac.to_level(F.avg(ac.to_power(F.col(c)))) if c in level_columns else F.avg(c)).alias(c) for c in columns
    ]
    binned = (
        stream.withWatermark(time, lateness)
        .groupBy(*keys, F.window(time, _interval(tm.duration(freq))).alias("_bin"))
        .agg(*means)
    )
    return binned.select(*keys, F.col("_bin.start").alias(time), *columns)


def distinct_stream(stream: DataFrame, columns: list[str], lateness: str = "10 minutes", time: str = "time") -> DataFrame:
    """First of equal records within the watermark."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(columns)


def session_stream(
    stream: DataFrame, keys: list[str], gap: str, min_rows: int = 1, lateness: str = "10 minutes", time: str = "time"
) -> DataFrame:
    """Sessions of rows at most `gap` apart, as (segment_start, segment_end, n_rows), when they are over."""
    sessions = (
        stream.withWatermark(time, lateness)
        .groupBy(*keys, F.session_window(time, gap).alias("_session"))
        .agg(F.min(time).alias("segment_start"), F.max(time).alias("segment_end"), F.count(F.lit(1)).alias("n_rows"))
    )
    return sessions.where(F.col("n_rows") >= min_rows).select(*keys, "segment_start", "segment_end", "n_rows")


def _gap_finder(keys: list[str], width: int) -> StatefulProcessor:
    """Remembers the last time of a key and reports steps longer than `width` µs.

    The class is made here, so that workers need not have the package installed.
    """
    minute = float(tm.MINUTE)

    class GapFinder(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last_us", T.StructType([T.StructField("us", T.LongType())]))

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802,N803
            filled = [batch for batch in rows if len(batch)]
            if not filled:
                return
            buckets = pd.concat(filled).sort_values("first_us")
            starts = buckets["first_us"].to_numpy()
            known = self.last.get()[0] if self.last.exists() else starts[0]
            ends = np.concatenate([[known], buckets["final_us"].to_numpy()[:-1]])
            step = starts - ends
            found = step > width
            self.last.update((int(buckets["final_us"].max()),))
            # Of type object also where no gap is found: an empty list would become a column of floats, which Spark cannot turn into text.
            out = {name: pd.Series([value] * int(found.sum()), dtype=object) for name, value in zip(keys, key)}
            out["previous_time"] = pd.to_datetime(ends[found], unit="us", utc=True)
            out["current_time"] = pd.to_datetime(starts[found], unit="us", utc=True)
            out["gap_minutes"] = np.round(step[found] / minute, 3)
            yield pd.DataFrame(out)

        def close(self) -> None:
            pass

    return GapFinder()


def gap_stream(
    stream: DataFrame, keys: list[str], threshold_minutes: float, lateness: str = "10 minutes", time: str = "time"
) -> DataFrame:
    """Steps longer than the threshold between consecutive times of a key, as they become certain.

    Two times in one bucket of the threshold's width are never a gap, so a
    windowed minimum and maximum (with map-side combine) come first, and the
    stateful step sees one row per occupied bucket of a key, in time order.
    """
    width = tm.minutes_us(threshold_minutes)
    kinds = {f.name: f for f in stream.schema.fields}
    buckets = (
        stream.withWatermark(time, lateness)
        .groupBy(*keys, F.window(time, _interval(width)).alias("_bucket"))
        .agg(F.min(time).alias("_first"), F.max(time).alias("_final"))
        .select(*keys, tm.micros("_first").alias("first_us"), tm.micros("_final").alias("final_us"))
    )
    return buckets.groupBy(*keys).transformWithStateInPandas(
        _gap_finder(list(keys), width), T.StructType([*[kinds[k] for k in keys], *_GAP_FIELDS]), "Append", "None"
    )


def backfill(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions (such as a leg) that late data touched by their recomputed rows."""
    write_table(df, path, partition_by)
