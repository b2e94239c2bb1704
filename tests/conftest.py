from __future__ import annotations

import sys
import tempfile
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tideline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def at(text: str) -> datetime:
    """A UTC time; Spark takes aware datetimes as instants."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def rows(df) -> list[tuple]:
    """Rows with times as UTC text, sorted."""
    from pyspark.sql import functions as F

    shown = df.select(
        *[
            F.date_format(F.col(f"`{n}`"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(n) if k == "timestamp" else F.col(f"`{n}`")
            for n, k in df.dtypes
        ]
    )
    return sorted((tuple(r) for r in shown.collect()), key=lambda r: [str(v) for v in r])
