"""Column layouts of instrument files: what comes in which form, and what that breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.operators import ranges
from tideline.session import materialize

INSTRUMENT = ["experiment", "instrument"]


def first_and_last(df: DataFrame, keys: list[str], position: str, columns: list[str]) -> DataFrame:
    """First and last record of each file by row position."""
    row = F.struct(*columns)
    return (
        df.groupBy(*keys)
        .agg(F.min_by(row, position).alias("_first"), F.max_by(row, position).alias("_last"))
        .select(
            *keys,
            *[F.col(f"_first.{c}").alias(f"first_{c}") for c in columns],
            *[F.col(f"_last.{c}").alias(f"last_{c}") for c in columns],
        )
    )


def header_key(header: Column) -> Column:
    """A layout is the set of column names, whatever their order; a file without a header has none of them."""
    return F.coalesce(F.array_sort(F.array_distinct(header)), F.array().cast("array<string>"))


def with_layout(files: DataFrame) -> DataFrame:
    """Add `layout`: L1, L2, ... per instrument by first appearance (leg, then file name)."""
    keyed = files.withColumn("_key", header_key(F.col("header")))
    layouts = keyed.groupBy(*INSTRUMENT, "_key").agg(F.min(F.struct("leg", "file_name")).alias("_first"))
    order = Window.partitionBy(*INSTRUMENT).orderBy("_first")
    numbered = layouts.select(
        *INSTRUMENT, "_key", F.concat(F.lit("L"), F.dense_rank().over(order).cast("string")).alias("layout")
    )
    return keyed.join(numbered, [*INSTRUMENT, "_key"]).select(*files.columns, "layout")


def _joined(values: Column, separator: str = ", ") -> Column:
    return F.array_join(F.array_sort(F.collect_set(values.cast("string"))), separator)


def rename_pairs(files: DataFrame, mapping: DataFrame) -> DataFrame:
    """(instrument, layout, raw column, canonical name or NULL) for every column of every layout.

    A layout without columns has one row without a raw column.
    """
    columns = files.select(*INSTRUMENT, "layout", F.explode_outer("header").alias("raw")).distinct()
    return columns.join(mapping.select(*INSTRUMENT, "raw", "canonical"), [*INSTRUMENT, "raw"], "left")


def column_sets(files: DataFrame, mapping: DataFrame, variables: DataFrame) -> DataFrame:
    """Per layout: names provided, variables missing, columns dropped by the rename, and whether there is no rename map.

    `variables` (instrument, variables) lists what an instrument should give. Where it has a rename map, only
    variables that the map knows count as missing: others, such as true wind, are derived later. Without a
    map nothing is renamed, so nothing is dropped.
    """
    maps = mapping.groupBy(*INSTRUMENT).agg(F.array_union(F.collect_set("raw"), F.collect_set("canonical")).alias("_known"))
    named = rename_pairs(files, mapping)
    per_layout = named.groupBy(*INSTRUMENT, "layout").agg(
        F.collect_set("raw").alias("_raw"),
        F.collect_set("canonical").alias("_canonical"),
        F.collect_set(F.when(F.col("canonical").isNull() & F.col("raw").isNotNull(), F.col("raw"))).alias("_unmapped"),
    )
    provided = F.array_union("_raw", "_canonical")
    no_map = F.col("_known").isNull()
    wanted = F.when(no_map, F.col("variables")).otherwise(F.array_intersect("variables", "_known"))
    return per_layout.join(variables, INSTRUMENT, "left").join(maps, INSTRUMENT, "left").select(
        *INSTRUMENT,
        "layout",
        F.array_sort(provided).alias("provided"),
        F.array_sort(F.array_except(wanted, provided)).alias("missing"),
        F.when(no_map, F.array().cast("array<string>")).otherwise(F.array_sort("_unmapped")).alias("dropped"),
        no_map.alias("no_rename_map"),
    )


def layout_audit(files: DataFrame) -> DataFrame:
    """Per layout: files, empty files, legs, time span, file types with counts, unparsed times, an example file.

    `files` has the layout, first_raw (text of the first time), first_time,
    last_time, raw_type, time_col and is_empty.
    """
    per_type = files.groupBy(*INSTRUMENT, "layout", "raw_type").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("is_empty").alias("_empty"),
        F.collect_set("leg").alias("_legs"),
        F.min("first_time").alias("_a"),
        F.max("last_time").alias("_b"),
        F.collect_set("time_col").alias("_cols"),
        F.min(F.when(F.col("first_raw").isNotNull(), F.struct("leg", "file_name", "first_raw"))).alias("_sample"),
        F.count_if(F.col("first_raw").isNotNull() & F.col("first_time").isNull()).alias("_bad"),
        F.min(F.struct("leg", "file_name")).alias("_example"),
    )
    types = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), F.col("raw_type").alias("t"))))
    out = per_type.groupBy(*INSTRUMENT, "layout").agg(
        F.sum("_n").alias("n_files"),
        F.sum("_empty").alias("n_empty_files"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_legs")))).alias("_legs"),
        F.min("_a").alias("first_time"),
        F.max("_b").alias("last_time"),
        types.alias("_types"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_cols")))).alias("_cols"),
        F.min("_sample").alias("_sample"),
        F.sum("_bad").alias("n_unparsed_times"),
        F.min("_example").alias("_example"),
    )
    return out.select(
        *INSTRUMENT,
        "layout",
        "n_files",
        "n_empty_files",
        F.array_join(F.transform("_legs", lambda x: x.cast("string")), ", ").alias("legs"),
        "first_time",
        "last_time",
        F.array_join(
            F.transform("_types", lambda x: F.concat(x["t"], F.lit(" x"), (-x["n"]).cast("string"))), ", "
        ).alias("raw_types"),
        F.array_join("_cols", ", ").alias("time_col"),
        F.col("_sample.first_raw").alias("time_sample"),
        "n_unparsed_times",
        F.concat(F.lit("LEG"), F.col("_example.leg").cast("string"), F.lit("/"), F.col("_example.file_name")).alias("example_file"),
    )


def rename_conflicts(files: DataFrame, mapping: DataFrame) -> DataFrame:
    """Canonical names (other than time) reached from more than one raw column."""
    named = rename_pairs(files, mapping).where(F.col("canonical").isNotNull() & (F.col("canonical") != "time"))
    return (
        named.groupBy(*INSTRUMENT, "canonical")
        .agg(
            F.count_distinct("raw").alias("_raws"),
            _joined(F.col("raw"), " | ").alias("raw_columns"),
            _joined(F.col("layout")).alias("layouts"),
        )
        .where(F.col("_raws") > 1)
        .drop("_raws")
    )


def layout_overlaps(files: DataFrame, keys: list[str] = (*INSTRUMENT, "leg")) -> DataFrame:
    """Pairs of layouts of one instrument and leg whose files cover the same time."""
    spans = files.select(*keys, "layout", F.col("first_time").alias("start"), F.col("last_time").alias("end"))
    return ranges.pairwise_overlaps(spans, list(keys), "layout")


def audit_summary(
    layouts: DataFrame, sets: DataFrame, conflicts: DataFrame, overlaps: DataFrame
) -> DataFrame:
    """Per instrument: layouts, files and problem counts; `flagged` where anything needs a look."""
    base = layouts.groupBy(*INSTRUMENT).agg(
        F.sum("n_files").alias("n_files"),
        F.count(F.lit(1)).alias("n_layouts"),
        F.sum("n_unparsed_times").alias("unparsed_times"),
    )
    missing = sets.groupBy(*INSTRUMENT).agg(
        F.count_if(F.size("missing") > 0).alias("layouts_missing_variables"), F.bool_and("no_rename_map").alias("no_rename_map")
    )
    n_conflicts = conflicts.groupBy(*INSTRUMENT).agg(F.count(F.lit(1)).alias("rename_conflicts"))
    n_overlaps = overlaps.groupBy(*INSTRUMENT).agg(F.count(F.lit(1)).alias("leg_overlaps"))
    out = base
    for part in (missing, n_conflicts, n_overlaps):
        out = out.join(part, INSTRUMENT, "left")
    counts = ["layouts_missing_variables", "rename_conflicts", "leg_overlaps"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in counts})
    problem = F.col("n_layouts") > 1
    for c in [*counts, "unparsed_times"]:
        problem = problem | (F.col(c) > 0)
    return out.withColumn("flagged", problem)


def audit(
    files: DataFrame, mapping: DataFrame, variables: DataFrame, unreadable: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All tables of the format audit over a manifest of files.

    The manifest with its layouts feeds every table, so it is written once.
    """
    placed = materialize(with_layout(files))
    layouts = layout_audit(placed)
    sets = column_sets(placed, mapping, variables)
    conflicts = rename_conflicts(placed, mapping)
    overlaps = layout_overlaps(placed)
    tables = {
        "summary": audit_summary(layouts, sets, conflicts, overlaps),
        "layouts": layouts.join(sets, [*INSTRUMENT, "layout"]),
        "conflicts": conflicts,
        "overlaps": overlaps,
        "files": placed.drop("header"),
    }
    if unreadable is not None:
        tables["unreadable"] = unreadable
    return tables
