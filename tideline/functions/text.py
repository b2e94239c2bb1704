"""Names, labels and metadata keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide which names are stations.
_STATION_AND_CAST = r"(?i)St(\d+)[-_](\d+)(?=[-_.()]|$)"
_STATION_ONLY = r"(?i)St(\d+)$"


def file_stem(path: Column) -> Column:
    """Last path part without its extension; both slash kinds are separators."""
    name = F.regexp_extract(path, r"([^/\\]+)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def cast_label(source_file: Column, header_name: Column) -> Column:
    """Cast a profile row belongs to: its file, else the name in its header, else unknown."""
    return F.coalesce(
        F.nullif(file_stem(source_file), F.lit("")), F.nullif(file_stem(header_name), F.lit("")), F.lit("unknown")
    )


def station_and_cast(name: Column) -> tuple[Column, Column]:
    """(station, cast number) from a cast name; both NULL where it is no station cast."""
    station = F.regexp_extract(name, _STATION_AND_CAST, 1).try_cast("int")
    number = F.regexp_extract(name, _STATION_AND_CAST, 2).try_cast("int")
    only = F.regexp_extract(name, _STATION_ONLY, 1).try_cast("int")
    return F.coalesce(station, only), F.when(station.isNotNull(), number).when(only.isNotNull(), F.lit(1))


def station_label(station: Column, number: Column) -> Column:
    return F.format_string("St%02d-%d", station, number)


def metadata_entry(line: Column) -> Column:
    """(key, value) of a starred header line: split at the first '=', else the first ':'."""
    body = F.trim(F.regexp_replace(line, r"^\*+", ""))
    pattern = r"^([^=]*)=(.*)$"
    by_equals = body.rlike(pattern)
    by_colon = r"^([^:]*):(.*)$"

    def part(index: int) -> Column:
        return F.when(by_equals, F.regexp_extract(body, pattern, index)).when(
            body.rlike(by_colon), F.regexp_extract(body, by_colon, index)
        )

    key = F.replace(F.trim(part(1)), F.lit(" "), F.lit("_"))
    return F.when(part(1).isNotNull(), F.struct(key.alias("key"), F.trim(part(2)).alias("value")))


def fixed(number: Column, digits: int) -> Column:
    """Number text with a fixed number of digits, rounded by its exact binary value, ties to even."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", number, F.lit(pattern))


def last_of_each(entries: Column) -> Column:
    """(key, value) entries without those whose key comes again later."""

    def is_last(entry: Column, i: Column) -> Column:
        later = F.slice(entries, i + 2, F.size(entries))
        return ~F.exists(later, lambda other: other["key"] == entry["key"])

    return F.filter(entries, is_last)


def numbered_repeats(names: Column) -> Column:
    """Names in order, the second and later of one name as name_2, name_3."""

    def shown(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(names, F.lit(1), i), lambda other: other == name))
        return F.when(before > 0, F.concat(name, F.lit("_"), (before + 1).cast("string"))).otherwise(name)

    return F.transform(names, shown)


def camel_name(description: Column) -> Column:
    """oxygen concentration / oxygen_concentration -> OxygenConcentration."""
    words = F.split(F.replace(description, F.lit(" "), F.lit("_")), "_")
    return F.array_join(F.transform(words, lambda w: F.initcap(w)), "")


def category_text(code: Column, name: Column) -> Column:
    """Name of a code, or 'Code N' where the table has none."""
    return F.coalesce(name, F.concat(F.lit("Code "), code.cast("string")))
