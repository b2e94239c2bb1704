"""Vertical profiles (casts): summary table, labels, duplicates, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import geo
from tideline.functions import text as tx

SIGNATURE_COLUMNS = ["pressure_dbar", "temperature_C", "conductivity_S_m"]


def depth_valid(df: DataFrame, depth: str = "pressure_dbar") -> DataFrame:
    return df.withColumn(depth, F.col(depth).try_cast("double")).where(F.col(depth).isNotNull())


def _first_value(column: str, scan: str) -> Column:
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.col(scan)))


def cast_summary(df: DataFrame, keys: list[str], scan: str = "scan_no", depth: str = "pressure_dbar") -> DataFrame:
    """One row per cast: station, number, start, first position, greatest depth; `is_station` marks station casts."""
    station, number = tx.station_and_cast(F.col("cast"))
    return (
        df.groupBy(*keys, "cast")
        .agg(
            F.min("time").alias("start"),
            _first_value("latitude_deg", scan).alias("lat"),
            _first_value("longitude_deg", scan).alias("lon"),
            F.max(depth).alias("max_depth"),
            F.count(F.lit(1)).alias("n_scans"),
        )
        .withColumns({"station": station, "cast_no": number, "is_station": station.isNotNull()})
    )


def with_labels(casts: DataFrame, keys: list[str]) -> DataFrame:
    """Add a unique label: station-cast, with the date where that repeats, with the name where even that does.

    There is one row per cast, so the windows run over the casts of one key
    and label only.
    """
    label = tx.station_label(F.col("station"), F.col("cast_no"))
    dated = F.concat(F.col("label"), F.date_format("start", " (dd MMM)"))
    named = F.concat(F.col("label"), F.lit(" ["), F.col("cast"), F.lit("]"))
    twice = F.count(F.lit(1)).over(Window.partitionBy(*keys, "label")) > 1
    out = casts.withColumn("label", label).withColumn("_twice", twice)
    out = out.withColumn("label", F.when(F.col("_twice"), dated).otherwise(F.col("label"))).withColumn("_twice", twice)
    return out.withColumn("label", F.when(F.col("_twice"), named).otherwise(F.col("label"))).drop("_twice")


def cast_description(casts: DataFrame) -> DataFrame:
    """Add a one-line description: label, start, position, greatest depth."""
    place = F.concat_ws(
        " ", geo.hemisphere_text(F.col("lat"), "N", "S"), geo.hemisphere_text(F.col("lon"), "E", "W")
    )
    has_place = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return casts.withColumn(
        "description",
        F.concat_ws(
            " · ",
            "label",
            F.date_format("start", "yyyy-MM-dd HH:mm 'UTC'"),
            F.when(has_place, place),
            F.concat(F.lit("max "), tx.fixed(F.col("max_depth"), 0), F.lit(" dbar")),
        ),
    )


def cast_table(df: DataFrame, keys: list[str], scan: str = "scan_no", depth: str = "pressure_dbar") -> DataFrame:
    """Labelled station casts; casts that belong to no station are left out."""
    casts = cast_summary(df, keys, scan, depth).where("is_station").drop("is_station")
    return with_labels(casts, keys)


def signatures(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Row count and order-free content hash per cast."""
    content = F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("content")
    return df.groupBy(*keys, "cast").agg(F.count(F.lit(1)).alias("n_rows"), content)


def identical_casts(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Casts of one key that have the same rows as another, with the group's first cast and size."""
    signed = signatures(df, keys, columns)
    groups = (
        signed.groupBy(*keys, "n_rows", "content")
        .agg(F.min("cast").alias("same_as"), F.count(F.lit(1)).alias("n_casts"))
        .where(F.col("n_casts") > 1)
    )
    return signed.join(groups, [*keys, "n_rows", "content"]).select(*keys, "cast", "n_rows", "same_as", "n_casts")


def drop_cross_leg_copies(df: DataFrame, leg: str, columns: list[str]) -> DataFrame:
    """Drop casts whose content already occurred in an earlier leg; repeats within a leg stay."""
    signed = signatures(df, [leg], columns)
    first = signed.groupBy("n_rows", "content").agg(F.min(leg).alias("_first"))
    copies = signed.join(first, ["n_rows", "content"]).where(F.col(leg) > F.col("_first")).select(leg, "cast")
    return df.join(copies, [leg, "cast"], "left_anti")


def casts_without_position(df: DataFrame, keys: list[str]) -> DataFrame:
    """Casts none of whose rows has a latitude."""
    return (
        df.groupBy(*keys, "cast")
        .agg(F.bool_or(F.col("latitude_deg").isNotNull()).alias("_placed"))
        .where(~F.col("_placed"))
        .select(*keys, "cast")
    )


def profile_clusters(df: DataFrame, keys: list[str], scan: str = "scan_no") -> DataFrame:
    """Scans of a cast in one partition and in order, casts of a partition by their start.

    This is the order to write profiles in: one shuffle, where a total order
    would also take a sampling pass over everything before it.
    """
    return df.repartition(*keys, "cast").sortWithinPartitions(*keys, F.col("time").asc_nulls_last(), "cast", scan)


def profile_order(df: DataFrame, scan: str = "scan_no") -> DataFrame:
    """Total order: casts by their start, scans of a cast kept together and in order."""
    return df.orderBy(F.col("time").asc_nulls_last(), "cast", scan)
