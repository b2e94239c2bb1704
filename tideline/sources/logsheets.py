"""Hand-kept tables: leg windows, pressure rules, the bridge navigation log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import geo
from tideline.functions import time as tm
from tideline.operators.projection import quoted
from tideline.session import materialize
from tideline.sources.lines import FILE, numbered_lines
from tideline.sources.ranged import heads

# Headings of the log sheets and the columns they become.
_WINDOW_COLUMNS = {"Leg Number": "leg", "Start time (UTC)": "start", "End time (UTC)": "end"}
_RULE_COLUMNS = {"Leg number": "leg", "Remove data when pressure is under": "pressure_under"}

BRIDGE_HEADER_LINES = 8


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[quoted(raw if raw in df.columns else name).alias(name) for raw, name in names.items()])


def _checked(value: Column, bad: Column, message: Column) -> Column:
    """The value, or a failed job with `message` where `bad` holds."""
    return F.when(bad, F.raise_error(message)).otherwise(value)


def leg_windows(sheet: DataFrame) -> DataFrame:
    """(leg, start, end) sorted by leg. Incomplete rows are dropped, a window that ends too early is an error."""
    rows = _renamed(sheet, _WINDOW_COLUMNS)
    typed = rows.select(
        F.col("leg").try_cast("double").cast("int").alias("leg"),
        tm.to_utc("start").alias("start"),
        tm.to_utc("end").alias("end"),
    ).dropna()
    message = F.concat(F.lit("window of leg "), F.col("leg").cast("string"), F.lit(" does not end after its start"))
    return typed.withColumn("end", _checked(F.col("end"), F.col("end") <= F.col("start"), message)).orderBy("leg")


def pressure_rules(sheet: DataFrame) -> DataFrame:
    """(leg, pressure_under), one per leg. Incomplete rows are dropped, a second row of a leg is an error."""
    typed = _typed_rules(sheet).dropna()
    grouped = typed.groupBy("leg").agg(F.count(F.lit(1)).alias("_n"), F.first("pressure_under").alias("_under"))
    message = F.concat(F.lit("more than one pressure rule for leg "), F.col("leg").cast("string"))
    return grouped.select("leg", _checked(F.col("_under"), F.col("_n") > 1, message).alias("pressure_under"))


def incomplete_rules(sheet: DataFrame) -> DataFrame:
    """The rows `pressure_rules` drops, for a warning."""
    return _typed_rules(sheet).where(F.col("leg").isNull() | F.col("pressure_under").isNull())


def _typed_rules(sheet: DataFrame) -> DataFrame:
    rows = _renamed(sheet, _RULE_COLUMNS)
    return rows.select(
        F.col("leg").try_cast("double").cast("int").alias("leg"),
        F.col("pressure_under").try_cast("double").alias("pressure_under"),
    )


def read_bridge_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Fixes of the bridge log (CSV export): source file, time, latitude_deg, longitude_deg, source.

    Eight lines precede the column names. Times are UTC to the minute,
    positions degrees and decimal minutes; incomplete rows are dropped. Only the top of a file is read
    for its names; its lines are read in splits and meet them in a join.
    """
    wanted = BRIDGE_HEADER_LINES + 1

    def top(lines: list[str], whole: bool) -> list[str] | None:
        return lines[:wanted] if whole or len(lines) >= wanted else None

    def cells(line: Column) -> Column:
        return F.split(F.replace(line, F.lit('"'), F.lit("")), ",")

    names = F.transform(cells(F.try_element_at("head", F.lit(wanted))), lambda name: F.lower(F.trim(name)))
    files = materialize(heads(spark, path, top).select("_path", names.alias("_names")), "heads")
    body = numbered_lines(spark, path).where(F.col("line_no") > wanted)
    table = body.join(files, "_path").select(FILE, "_names", cells(F.col("line")).alias("_row"))

    def cell(name: str) -> Column:
        at = F.array_position("_names", F.lit(name)).cast("int")
        return F.when(at > 0, F.trim(F.try_element_at("_row", F.nullif(at, F.lit(0)))))

    return table.select(
        FILE,
        F.try_to_timestamp(cell("time"), F.lit("dd/MM/yyyy HH:mm")).alias("time"),
        geo.parse_dms(cell("lat")).alias("latitude_deg"),
        geo.parse_dms(cell("lon")).alias("longitude_deg"),
        F.lit("Bridge").alias("source"),
    ).dropna(subset=["time", "latitude_deg", "longitude_deg"])
