"""The given tables in the roles of instruments, positions, profiles and recordings.

The SQL texts say the same for the comparison queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import prepare

SOURCE_OF = {"view": "GGA", "click": "EK80_gps", "signup": "Ferrybox", "error": "Bridge"}

_WINDOWS = [(leg, f"2024-01-{5 * leg - 4:02d} 00:00:00", f"2024-01-{5 * leg:02d} 23:00:00") for leg in range(1, 6)]
_WINDOWS += [(6, "2024-01-26 00:00:00", "2024-01-31 12:00:00"), (7, "2024-02-02 00:00:00", "2024-02-07 00:00:00")]
INSTRUMENTS = ["click", "error", "purchase", "signup", "view", "sonar"]

WINDOWS_SQL = "(VALUES " + ", ".join(
    f"({leg}, TIMESTAMP '{start}', TIMESTAMP '{end}')" for leg, start, end in _WINDOWS
) + ") AS w(leg, w_start, w_end)"
INSTRUMENTS_SQL = "(VALUES " + ", ".join(f"('{name}')" for name in INSTRUMENTS) + ") AS i(instrument)"

# Events with the leg whose window holds them.
LEGGED_SQL = (
    "(SELECT w.leg, e.event_type AS instrument, e.event_id, e.user_id, e.ts, e.value, w.w_start, w.w_end "
    f"FROM events e JOIN {WINDOWS_SQL} ON e.ts BETWEEN w.w_start AND w.w_end)"
)
LAT_SQL = "(fmod(value, 180.0) - 90)"
LON_SQL = "(CAST((user_id * 7) % 360 AS DOUBLE) - 180)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument rows: event type as instrument, `value` as the measure."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("instrument"),
        F.col("ts").cast("timestamp").alias("time"),
        "event_id",
        "user_id",
        "value",
        "props",
    )


def stream(spark: SparkSession, sf_dir: str, instrument: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("instrument") == instrument)


def windows(spark: SparkSession) -> DataFrame:
    """Leg windows; the last leg has no data."""
    rows = ", ".join(f"({leg}, TIMESTAMP_LTZ'{start} UTC', TIMESTAMP_LTZ'{end} UTC')" for leg, start, end in _WINDOWS)
    return prepare(spark).sql(f"SELECT * FROM VALUES {rows} AS w(leg, start, end)")


def legged(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.operators.ranges import assign_window

    return assign_window(events(spark, sf_dir), windows(spark), ["leg"])


def latitude() -> Column:
    return F.pmod(F.col("value"), F.lit(180.0)) - 90


def longitude() -> Column:
    return F.pmod(F.col("user_id") * 7, F.lit(360)).cast("double") - 180


def source() -> Column:
    pairs = [part for key, value in SOURCE_OF.items() for part in (F.lit(key), F.lit(value))]
    return F.create_map(*pairs)[F.col("instrument")]


def source_sql(column: str = "event_type") -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SOURCE_OF.items()) + " END"


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the position sources with made-up coordinates."""
    return (
        legged(spark, sf_dir)
        .withColumns({"latitude_deg": latitude(), "longitude_deg": longitude(), "source": source()})
        .where(F.col("source").isNotNull())
        .select("leg", "time", "latitude_deg", "longitude_deg", "source")
    )


def naive(column: str | Column) -> Column:
    """UTC time without a zone, as the SQL side has it."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def r6(column: str | Column) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def shown(df: DataFrame) -> DataFrame:
    """Result columns in comparable form: naive times, doubles rounded to six digits."""
    out = []
    for name, kind in df.dtypes:
        if kind == "timestamp":
            out.append(naive(name).alias(name))
        elif kind in ("double", "float"):
            out.append(r6(name).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def nearest_sql(left: str, right: str, columns: list[str], tolerance_s: int, prefix: str, shift_s: int = 0,
                keys: list[str] = ()) -> str:
    """A subquery: every row of `left` (with ts) and the nearest `right` row's columns as prefix_column.

    `shift_s` looks around ts + shift_s instead of ts.
    """
    at = f"(l.ts + INTERVAL '{shift_s} seconds')"
    on = "".join(f"l.{k} = r.{k} AND " for k in keys)
    onb = "".join(f"p.{k} = r.{k} AND " for k in keys)
    cols = [*columns, "ts"]
    before = ", ".join(f"r.{c} AS b_{c}" for c in cols)
    after = ", ".join(f"r.{c} AS a_{c}" for c in cols)
    atp = f"(p.ts + INTERVAL '{shift_s} seconds')"
    tol = f"INTERVAL '{tolerance_s} seconds'"
    atq = f"(ts + INTERVAL '{shift_s} seconds')"
    ok_b = f"(b_ts IS NOT NULL AND {atq} - b_ts <= {tol})"
    ok_a = f"(a_ts IS NOT NULL AND a_ts - {atq} <= {tol})"
    use_b = f"({ok_b} AND (a_ts IS NULL OR {atq} - b_ts <= a_ts - {atq}))"
    picked = ", ".join(
        f"CASE WHEN {use_b} THEN b_{c} WHEN {ok_a} THEN a_{c} END AS {prefix}_{c}" for c in cols
    )
    drop = ", ".join([f"b_{c}" for c in cols] + [f"a_{c}" for c in cols])
    return (
        f"(SELECT * EXCLUDE ({drop}), {picked} FROM ("
        f"SELECT p.*, {after} FROM (SELECT l.*, {before} FROM {left} l ASOF LEFT JOIN {right} r ON {on}{at} >= r.ts) p "
        f"ASOF LEFT JOIN {right} r ON {onb}{atp} <= r.ts))"
    )
