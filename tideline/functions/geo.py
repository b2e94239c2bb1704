"""Position text and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.text import fixed

# Fixed value: degrees and decimal minutes with a hemisphere letter.
DMS_PATTERN = r"^\s*(\d+)\s*°\s*(\d+(?:\.\d+)?)\s*'\s*([NSEW])\s*$"


def parse_dms(text: Column) -> Column:
    """Text like 37° 44.2464' N as signed decimal degrees, NULL for anything else."""
    part = [F.regexp_extract(text, DMS_PATTERN, i) for i in (1, 2, 3)]
    size = part[0].try_cast("double") + part[1].try_cast("double") / 60.0
    return F.when(part[2].isin("S", "W"), -size).otherwise(size)


def is_null_island(lat: Column, lon: Column) -> Column:
    return (lat == 0) & (lon == 0)


def hemisphere_text(value: Column, positive: str, negative: str) -> Column:
    """12.34°N style text; NULL stays NULL."""
    side = F.when(value >= 0, F.lit(positive)).otherwise(F.lit(negative))
    return F.when(value.isNotNull(), F.concat(fixed(F.abs(value), 2), F.lit("°"), side))
