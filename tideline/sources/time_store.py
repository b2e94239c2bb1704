"""A store of parsed times by file: a file is read again only when its size or modification time has changed.

Below the store's folder, `times/batch=...` holds the times that one refresh has read, and `files/batch=...`, written after them, the
fingerprints (path, size, modification time) of the files they come from. A refresh that was cut off leaves
times without fingerprints, which nobody reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.operators.projection import quoted, resolve_time_column
from tideline.session import materialize
from tideline.sources.lines import read_layouts

_FINGERPRINT = ["path", "size", "mtime"]
_FILES = "path string, size long, mtime timestamp, batch string"
_TIMES = "path string, size long, mtime timestamp, time timestamp, batch string"


def fingerprints(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, size, mtime) of the files below `path`; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def _stored(spark: SparkSession, store: str, name: str, shape: str) -> DataFrame:
    """One of the store's tables, empty where no refresh has written it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/{name}")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(f"{store}/{name}")


def _times_of(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    """(_path, time) of files: of each column layout the time column and nothing else."""
    parquet = [f for f in files if f.lower().endswith(".parquet")]
    text = [f for f in files if not f.lower().endswith(".parquet")]
    tables = [spark.read.parquet(*parquet).withColumn("_path", F.col("_metadata.file_path"))] if parquet else []
    tables += [rows for _, rows in read_layouts(spark, text)] if text else []
    found = []
    for table in tables:
        name = resolve_time_column(table.columns)
        time = quoted(name) if dict(table.dtypes)[name].startswith("timestamp") else tm.to_utc(quoted(name))
        found.append(table.select("_path", time.cast("timestamp").alias("time")))
    return found


def refresh(spark: SparkSession, path: str | list[str], store: str) -> DataFrame:
    """Bring the store up to the files below `path` and return (path, size, mtime, batch) of those it had to read.

    The listing is compared with the fingerprints by an anti-join; only files that it leaves are opened. Delimited files and Parquet may
    be mixed. Rows without a readable time are left out, and a file without any counts as read. Nothing is written where nothing has changed.
    """
    known = _stored(spark, store, "files", _FILES)
    changed = materialize(fingerprints(spark, path).join(known, _FINGERPRINT, "left_anti"), "changed-files")
    batch = uuid.uuid4().hex
    files = [(r["path"], r["size"]) for r in changed.select("path", "size").toLocalIterator()]
    filled = [name for name, size in files if size]
    if filled:
        # Readers show a path in two spellings; this finds the one that the listing has.
        spelt = spark.read.format("binaryFile").load(filled).select("path", F.col("_metadata.file_path").alias("_path"))
        marks = spelt.join(changed, "path")
        for table in _times_of(spark, filled):
            rows = table.where(F.col("time").isNotNull()).join(marks, "_path").select(*_FINGERPRINT, "time")
            rows.write.mode("append").parquet(f"{store}/times/batch={batch}")
    if files:
        changed.write.parquet(f"{store}/files/batch={batch}")
    return _stored(spark, store, "files", _FILES).where(F.col("batch") == batch)


def read_store(spark: SparkSession, path: str | list[str], store: str) -> DataFrame:
    """(path, time) of the files that are below `path` now, from the store alone; times of earlier versions and of deleted files are left out."""
    now = fingerprints(spark, path).join(_stored(spark, store, "files", _FILES), _FINGERPRINT)
    return _stored(spark, store, "times", _TIMES).join(now, [*_FINGERPRINT, "batch"], "left_semi").select("path", "time")


def times(spark: SparkSession, path: str | list[str], store: str) -> DataFrame:
    """(path, time) of all files below `path`, read through the store."""
    refresh(spark, path, store)
    return read_store(spark, path, store)
