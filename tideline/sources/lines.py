"""Delimited text and JSON lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions import time as tm
from tideline.operators.projection import add_canonical_time, quoted, time_source, union_by_name
from tideline.schema import TIME_ALIASES
from tideline.session import materialize
from tideline.sources import ranged

FILE = "__source_file"


def file_name() -> Column:
    return F.col("_metadata.file_name")


def file_ends(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header, first and last record (as arrays) of each delimited file, and how many bytes were read for them.

    Only the ends of a file are read. A last line that does not fit the header was cut off; the first record
    stands in for it. Files without a filled line are left out.
    """
    ends = ranged.text_ends(spark, path).where(F.col("line_1").isNotNull())
    whole = F.size("line_n") == F.size("line_1")
    return ends.select(
        F.col("path").alias("file"),
        "file_name",
        F.col("line_1").alias("header"),
        F.col("line_2").alias("first_record"),
        F.when(F.col("line_2").isNotNull(), F.when(whole, F.col("line_n")).otherwise(F.col("line_2"))).alias("last_record"),
        F.col("line_2").isNull().alias("is_empty"),
        "size",
        "bytes_read",
    )


def file_manifest(spark: SparkSession, path: str | list[str], preferred: str | Column | None = None) -> DataFrame:
    """What the format audit needs to know of each file: header, time column, first and last time as text and parsed.

    `preferred` is the time column to take where a file has it: a name, or a column over `file` (the path) and `file_name`.
    """
    ends = file_ends(spark, path)
    first = [] if preferred is None else [F.lit(preferred) if isinstance(preferred, str) else preferred]
    known = [F.when(F.array_contains("header", name), name) for name in [*first, *map(F.lit, TIME_ALIASES)]]
    timed = ends.withColumn("_time_col", F.coalesce(*known))
    at = F.array_position("header", F.col("_time_col")).cast("int")
    in_name = tm.format_time(tm.time_in_name("file_name"))

    def raw(record: str) -> Column:
        return F.when(F.col("_time_col").isNull(), in_name).otherwise(F.try_element_at(record, at))

    named = timed.select(
        *ends.columns,
        F.coalesce("_time_col", F.lit("(filename)")).alias("time_col"),
        raw("first_record").alias("first_raw"),
        raw("last_record").alias("last_raw"),
    )
    return named.withColumns({"first_time": tm.to_utc("first_raw"), "last_time": tm.to_utc("last_raw")})


def csv_layouts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(header, file) of every delimited file, from the heads of the files; files without a filled line are left out."""
    return file_ends(spark, path).select("header", "file")


def read_delimited(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text tables with a header line, every value a string, united by column name.

    Spark applies one header to all files of a read, so each layout is read on
    its own. Only layouts and, layout by layout, file paths come to the driver, as for any read
    of listed files; the lines are read once.
    """
    return union_by_name([rows.drop("_path") for _, rows in read_layouts(spark, path)])


def read_layouts(spark: SparkSession, path: str | list[str]) -> list[tuple[list[str], DataFrame]]:
    """(header, rows with their source file and `_path`) of each column layout, in the order of the first files; see `read_delimited`."""
    found = materialize(csv_layouts(spark, path), "layouts")
    parts = []
    for layout in found.groupBy("header").agg(F.min("file").alias("first")).orderBy("first").collect():
        header = layout["header"]
        files = [r["file"] for r in found.where(F.col("header") == F.array(*map(F.lit, header))).select("file").toLocalIterator()]
        read = spark.read.options(header=True, inferSchema=False, mode="PERMISSIVE").csv(files)
        # Spark names a column after its place where the header has nothing.
        nameless = {f"_c{k}" for k, name in enumerate(header) if not (name or "").strip()}
        named = read.select(*[quoted(c) for c in read.columns if c not in nameless], file_name().alias(FILE), F.col("_metadata.file_path").alias("_path"))
        parts.append((header, drop_unnamed(named)))
    if not parts:
        raise ValueError(f"no delimited text with a header under {path}")
    return parts


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop index columns that earlier exports wrote as `Unnamed: 0` and the like."""
    return df.select(*[quoted(c) for c in df.columns if not c.startswith("Unnamed")])


def keep_raw_time(df: DataFrame) -> DataFrame:
    """Rename a raw `time` column, so that the canonical one can be added."""
    return df.withColumnRenamed("time", "Timestamp") if "time" in df.columns else df


def ensure_time(df: DataFrame, preferred: str | None = None, name: str = FILE, row_no: str = "row_no") -> DataFrame:
    """Canonical time from a time column, else from the file name at one row per second.

    The second way needs the row number (from 1) inside the file.
    """
    if time_source(df.columns, preferred) is not None:
        return add_canonical_time(df, preferred)
    start = tm.micros(tm.time_in_name(name))
    return df.withColumn("time", F.timestamp_micros(start + (F.col(row_no) - 1) * tm.SECOND))


def numbered_lines(spark: SparkSession, path: str | list[str], kept: Column | None = None) -> DataFrame:
    """Source file, `_path`, line_no (from 1) and line of text files; with `kept`, a condition on `line`, only such lines are there and count.

    Files are read in splits. Lines are written once to the shared folder, so that every step sees the same splits; a split's lines
    count on from those of the splits before it.
    """
    text = spark.read.text(path).select(
        file_name().alias(FILE), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line")
    )
    given = text if kept is None else text.where(kept)
    stored = materialize(given.withColumn("_at", F.monotonically_increasing_id()), "lines")
    offsets = _split_offsets(stored)
    number = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return stored.join(offsets, ["_path", "_block"]).select(FILE, "_path", number.alias("line_no"), "line")


def _split_offsets(lines: DataFrame) -> DataFrame:
    """(_path, _block, _first, _before): the first line id of each split, and the number of lines in the file's earlier splits.

    Written once, so that joins know how small it is and never hash the lines.
    """
    blocks = lines.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_lines"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before")
    return materialize(blocks.select("_path", "_block", "_first", before), "offsets")


def _repaired(line: Column) -> Column:
    text = F.trim(line)
    text = F.when(text.startswith("{"), text).otherwise(F.concat(F.lit("{"), text))
    return F.when(text.endswith("}"), text).otherwise(F.concat(text, F.lit("}")))


def _parsed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.text(path).select(
        file_name().alias(FILE),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    # The parser stops after the first value. Wrapped in a list and in an object, a line with
    # anything after its record fails in one of the two or holds more than one value.
    text = _repaired(F.col("value"))
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).cast("array<variant>")
    wrapped = F.try_parse_json(F.concat(F.lit('{"r":'), text, F.lit("}")))
    is_object = (F.size(listed) == 1) & wrapped.isNotNull() & F.schema_of_variant(listed[0]).startswith("OBJECT")
    record = F.when(is_object, listed[0].cast("map<string,string>"))
    # Exploding a single value keeps filters on the record from parsing it a second time.
    return lines.select("*", F.explode(F.array(F.when(F.trim("value") != "", record))).alias("record"))


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source file, record map) of every usable line.

    A missing opening or closing brace is added. Blank lines, lines that still
    do not parse and lines that hold no object are left out.
    """
    return _parsed_lines(spark, path).where(F.col("record").isNotNull()).select(FILE, "record")


def json_line_report(spark: SparkSession, path: str | list[str], shown: int = 5) -> DataFrame:
    """Per file: usable lines, unusable lines, and the numbers of the first few unusable ones.

    Line numbers come from the order inside each file block and the lines of
    the blocks before it; only unusable lines are looked at one by one.
    """
    # Lines are parsed once; what is kept of them is narrow, and all steps see the same file blocks.
    marks = [F.col("record").isNotNull().alias("_good"), (F.trim("value") == "").alias("_blank")]
    parsed = materialize(_parsed_lines(spark, path).select(FILE, "_path", "_block", "_at", *marks), "json-lines")
    bad = parsed.where(~F.col("_blank") & ~F.col("_good")).select("_path", "_block", "_at")
    number = F.col("_before") + F.col("_at") - F.col("_first") + 1
    numbered = bad.join(_split_offsets(parsed), ["_path", "_block"]).select("_path", number.alias("_no"))
    rank = F.row_number().over(Window.partitionBy("_path").orderBy("_no"))
    first = (
        numbered.withColumn("_rank", rank)
        .where(F.col("_rank") <= shown)
        .groupBy("_path")
        .agg(F.sort_array(F.collect_list("_no")).alias("skipped_lines"))
    )
    totals = parsed.groupBy(FILE, "_path").agg(
        F.count_if("_good").alias("n_records"), F.count_if(~F.col("_good") & ~F.col("_blank")).alias("n_skipped")
    )
    return totals.join(first, "_path", "left").select(
        FILE, "n_records", "n_skipped", F.coalesce("skipped_lines", F.array().cast("array<bigint>")).alias("skipped_lines")
    )


def map_keys_seen(records: DataFrame, column: str = "record") -> list[str]:
    """Names that occur in a map column, `timestamp` first, the others sorted. Runs one small job."""
    names = {r[0] for r in records.select(F.explode(F.map_keys(column))).distinct().collect()}
    return [n for n in ("timestamp",) if n in names] + sorted(names - {"timestamp"})


def widen(df: DataFrame, column: str, names: Iterable[str]) -> DataFrame:
    """Map entries as columns; names the map lacks are NULL."""
    rest = [quoted(c) for c in df.columns if c != column]
    return df.select(*rest, *[F.try_element_at(F.col(column), F.lit(n)).alias(n) for n in names])
