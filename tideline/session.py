"""Session settings the operators rely on, and lineage cuts on shared storage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Where every partition of a side is measured to be small, hash it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Stream state off the heap; the stateful gap finder needs this store.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_WRITTEN: dict[str, list[str]] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator assumes (UTC above all)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tideline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package's settings; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name for intermediate data on storage that driver and executors share.

    It lies below `spark.checkpoint.dir`. Only a session that runs on this machine alone may leave that
    unset; its own temporary folder is then as good.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write `df` once as Parquet to the shared folder and read it again, for results that several later steps read.

    A lost executor costs a re-read, not a recomputation of everything before it; later steps
    read only the columns they need and know the table's size.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    _WRITTEN.setdefault(df.sparkSession.sparkContext.applicationId, []).append(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def clean_up(spark: SparkSession) -> None:
    """Delete what `materialize` has written in this session, once the products that read it are written."""
    jvm = spark.sparkContext._jvm
    for folder in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
