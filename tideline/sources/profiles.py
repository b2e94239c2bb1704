"""Profile (CNV) files and spectrum logs: a header block followed by a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import acoustic as ac
from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.operators.sequence import day_rollover
from tideline.session import materialize
from tideline.sources.lines import FILE, numbered_lines
from tideline.sources.ranged import heads, own_copy

ROWS_AT_ONCE = 4_096  # rows of one log that a task orders, at most
_NAME_LINE = r"^# name \d+ = ([^:]+)"

# Header keys of a spectrum log and the columns they become.
SPECTRUM_HEADER = {
    "S/N": "serial",
    "Device": "device",
    "Model": "model",
    "Firmware": "firmware",
    "File Version": "file_version",
    "dB Ref re 1V": "db_ref_1v",
    "dB Ref re 1uPa": "db_ref_1upa",
    "Sample Rate [S/s]": "sample_rate_hz",
    "FFT Size": "fft_size",
    "Bin Width [Hz]": "bin_width_hz",
    "Window Function": "window_function",
    "Overlap [%]": "overlap_pct",
    "Power Calculation": "power_calculation",
    "Accumulations": "accumulations",
}

# Columns of a spectrum log's table that are no frequency bin.
SPECTRUM_ROW = {
    "Comment": "comment",
    "Temperature": "temperature",
    "Humidity": "humidity",
    "Sequence #": "sequence",
    "Data Points": "data_points",
}


def _filled(line: Column) -> Column:
    return F.trim(line) != ""


def _cnv_head(lines: list[str], whole: bool) -> list[str] | None:
    """Lines up to the first one of the table; all lines of a file that has none."""
    for k, line in enumerate(lines):
        if line.strip() and line.strip()[0] not in "#*":
            return lines[: k + 1]
    return lines if whole else None


def _cnv_files(spark: SparkSession, path: str | list[str], lines: DataFrame) -> DataFrame:
    """One row per file, from its head: names, metadata, `_start` (number of the table's first filled line) and the problem.

    Written before lines meet it, so that joins know how small it is and never hash the lines.
    """
    head = F.filter(F.transform("head", lambda line: F.trim(line)), lambda line: line != "")
    tops = heads(spark, path, own_copy(_cnv_head)).select("_path", F.col("file_name").alias(FILE), head.alias("_head"))
    last = F.coalesce(F.try_element_at("_head", F.lit(-1)), F.lit("#"))
    names = F.transform(
        F.filter("_head", lambda line: line.rlike(_NAME_LINE)), lambda line: F.regexp_extract(line, _NAME_LINE, 1)
    )
    entries = F.filter(
        F.transform(F.filter("_head", lambda line: line.startswith("*")), tx.metadata_entry), lambda e: e.isNotNull()
    )
    found = tops.select(
        "_path",
        FILE,
        tx.numbered_repeats(names).alias("names"),
        F.map_from_entries(tx.last_of_each(entries)).alias("metadata"),
        F.when(~last.startswith("#") & ~last.startswith("*"), F.size("_head")).alias("_start"),
    )
    files = materialize(found, "heads")
    # All lines without a mark are of the table; those with one are, where they follow its start.
    marked = F.trim("line").startswith("#") | F.trim("line").startswith("*")
    inside = lines.where(marked).join(files.select("_path", "_start"), "_path").where(F.col("line_no") >= F.col("_start"))
    table = lines.where(~marked).select("_path", "line").unionByName(inside.select("_path", "line"))
    n_cells = F.size(F.split(F.trim("line"), r"\s+"))
    widths = table.groupBy("_path").agg(F.min(n_cells).alias("_least"), F.max(n_cells).alias("_most"))
    return materialize(files.join(widths, "_path", "left").withColumn("problem", _cnv_problem()), "files")


def _cnv_problem() -> Column:
    fits = (F.col("_least") == F.col("_most")) & (F.col("_least") == F.size("names"))
    return F.when(F.col("_start").isNull(), F.lit("no data section")).when(
        ~fits, F.lit("columns and names do not match")
    )


def read_cnv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scans of profile files: source file, scan_no (from 1), values and metadata as maps.

    Only the head of a file is read for names and metadata; its lines are read in splits and meet them in a join.
    Files without a data section are left out; `cnv_problems` names them.
    """
    lines = numbered_lines(spark, path, _filled(F.col("line")))
    files = _cnv_files(spark, path, lines).where(F.col("problem").isNull()).select("_path", "names", "metadata", "_start")
    cells = F.split(F.trim("line"), r"\s+")
    return lines.join(files, "_path").where(F.col("line_no") >= F.col("_start")).select(
        F.col(FILE).alias("Source_File"),
        (F.col("line_no") - F.col("_start") + 1).cast("int").alias("scan_no"),
        # Filters on values may be evaluated before the one above, for header lines too.
        F.when((F.col("line_no") >= F.col("_start")) & (F.size(cells) == F.size("names")), F.map_from_arrays("names", cells)).alias("values"),
        "metadata",
    )


def cnv_problems(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source file, problem) of profile files that cannot be used."""
    lines = numbered_lines(spark, path, _filled(F.col("line")))
    return _cnv_files(spark, path, lines).select(FILE, "problem").where(F.col("problem").isNotNull())


def _spectrum_head(lines: list[str], whole: bool) -> list[str] | None:
    """Lines up to the names of the table; none where there is no table."""
    marks = [k for k, line in enumerate(lines) if line.strip() == "Data:"]
    names = [k for k in range(marks[0] + 1, len(lines)) if lines[k].strip()] if marks else []
    if names:
        return lines[: names[0] + 1]
    return [] if whole else None


def _spectrum_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file, from its head: header entries, names of the table (NULL without one), filled lines up to them."""
    head = F.filter("head", _filled)
    tops = heads(spark, path, own_copy(_spectrum_head)).select("_path", F.col("file_name").alias(FILE), head.alias("_head"))
    pairs = F.transform(
        F.filter(F.slice("_head", 1, F.greatest(F.size("_head") - 2, F.lit(0))), lambda line: line.contains("\t")),
        lambda line: F.struct(
            F.trim(F.split(line, "\t", 2)[0]).alias("key"), F.trim(F.split(line, "\t", 2)[1]).alias("value")
        ),
    )
    found = tops.select(
        "_path",
        FILE,
        F.map_from_entries(tx.last_of_each(pairs)).alias("header"),
        F.split(F.try_element_at("_head", F.lit(-1)), "\t").alias("columns"),
        F.size("_head").alias("_start"),
    )
    return materialize(found, "heads")


def spectrum_problems(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = numbered_lines(spark, path, _filled(F.col("line")))
    counts = lines.groupBy("_path").agg(F.count(F.lit(1)).alias("_lines"))
    files = _spectrum_files(spark, path).join(counts, "_path", "left")
    problem = F.when(F.col("columns").isNull(), F.lit("no data table")).when(F.col("_lines") <= F.col("_start"), F.lit("no rows"))
    return files.select(FILE, problem.alias("problem")).where(F.col("problem").isNotNull())


def read_spectra(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per spectrum: time, header and row fields, and `spec` as array of (freq_hz, level_db).

    The header gives the start date, the rows a time of day; a clock that goes
    back has passed midnight. A short row is filled with NULL. Only the head of a file is read for header and names; its lines
    are read in splits and meet them in a join.
    """
    files = _spectrum_files(spark, path).where(F.col("columns").isNotNull()).drop(FILE)
    body = numbered_lines(spark, path, _filled(F.col("line"))).join(files, "_path").where(F.col("line_no") > F.col("_start"))
    cells = F.transform(F.split("line", "\t"), lambda c: F.nullif(c, F.lit("")))
    row_no = (F.col("line_no") - F.col("_start") - 1).cast("int")
    lines = body.select(FILE, "_path", "header", "columns", row_no.alias("row_no"), cells.alias("_cells"))
    named = F.transform(
        "columns", lambda name, i: F.struct(name.alias("name"), F.try_element_at("_cells", i + 1).alias("cell"))
    )
    filled = lines.withColumn("_named", F.filter(named, lambda c: F.trim(c["name"]) != ""))
    fixed = ["Time", *SPECTRUM_ROW]
    named_fields = F.transform(
        F.filter("_named", lambda c: c["name"].isin(*fixed)), lambda c: F.struct(c["name"].alias("key"), c["cell"].alias("value"))
    )
    fields = F.map_from_entries(tx.last_of_each(named_fields))
    bins = F.transform(
        F.filter("_named", lambda c: ~c["name"].isin(*fixed)),
        lambda c: F.struct(
            c["name"].try_cast("double").alias("freq_hz"), c["cell"].try_cast("double").alias("level_db")
        ),
    )
    spectra = filled.select(FILE, "_path", "row_no", "header", fields.alias("_fields"), bins.alias("spec"))
    clock = F.split(F.trim(F.try_element_at("_fields", F.lit("Time"))), ":")

    def part(i: int) -> Column:
        return F.try_element_at(clock, F.lit(i)).try_cast("double")

    clock_us = F.round((part(1) * 3600 + part(2) * 60 + part(3)) * float(tm.SECOND)).cast("long")
    # Names may repeat in other folders.
    timed = day_rollover(spectra.withColumn("_clock_us", clock_us), ["_path"], ["row_no"], F.floor(F.col("row_no") / ROWS_AT_ONCE), F.col("_clock_us"))
    start = tm.micros(tm.to_utc(F.try_element_at("header", F.lit("Start Date"))))
    return timed.select(
        FILE,
        "row_no",
        F.timestamp_micros(start + F.col("_clock_us") + F.col("day_offset") * tm.DAY).alias("time"),
        *[F.try_element_at("header", F.lit(k)).alias(n) for k, n in SPECTRUM_HEADER.items()],
        *[F.try_element_at("_fields", F.lit(k)).alias(n) for k, n in SPECTRUM_ROW.items()],
        "spec",
    )


def with_summaries(spectra: DataFrame) -> DataFrame:
    """Add bin count, frequency limits, broadband and band levels, peak frequency."""
    spec = F.col("spec")
    freqs = F.transform(spec, lambda b: b["freq_hz"])
    return spectra.withColumns(
        {
            "n_bins": F.size(spec),
            "f_min_hz": F.array_min(freqs),
            "f_max_hz": F.array_max(freqs),
            "level_broadband": ac.energetic_sum(spec),
            **{name: ac.energetic_sum(spec, low, high) for name, (low, high) in ac.BANDS.items()},
            "peak_freq_hz": ac.peak_frequency(spec),
        }
    )
