"""Time as microseconds since the epoch, buckets of it, and parsing of mixed text formats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

_UNITS = {"s": SECOND, "min": MINUTE, "h": HOUR, "D": DAY}

CANONICAL_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'"
CANONICAL_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{6}\+00:00$"

_COMPACT_LENGTHS = {8: "", 12: "HHmm", 14: "HHmmss"}
_MILLISECONDS_ABOVE = 1e11

# Month names by their first three letters.
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# Dates: year first, day first (or month first where it can't be a day first), day and month name, month name and day.
_YEAR_FIRST = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)"
_DAY_FIRST = r"^(\d{1,2})[-/. ](\d{1,2})[-/. ](\d{4}|\d{2})(?!\d)"
_DAY_NAME = r"^(\d{1,2})[- ]?([A-Za-z]{3})[a-z]*[-, ]+(\d{4}|\d{2})(?!\d)"
_NAME_DAY = r"^([A-Za-z]{3})[a-z]*\.? +(\d{1,2})(?:st|nd|rd|th)?,? +(\d{4})(?!\d)"
_CLOCK = r"(?:^|[T ,])(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d+)?))? ?([AaPp])?\.?(?:[Mm]\.?)? ?(?:Z|UTC|GMT|([+-])(\d{2}):?(\d{2}))?$"
_TWO_DIGITS_FROM = 70  # two-digit years from here on are of the 20th century


def micros(time: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP column."""
    return F.unix_micros(F.col(time) if isinstance(time, str) else time)


def duration(freq: str) -> int:
    """Microseconds in an interval name such as 3min, 1h or 1D."""
    digits = "".join(ch for ch in freq if ch.isdigit())
    return int(digits or 1) * _UNITS[freq[len(digits):]]


def minutes_us(minutes: float) -> int:
    return int(round(minutes * MINUTE))


def seconds_us(seconds: float) -> int:
    return int(round(seconds * SECOND))


def bucket(us: Column, width: Column | int) -> Column:
    """Index of the bucket of `width` microseconds that holds `us` (exact for negatives too)."""
    width = F.lit(width) if isinstance(width, int) else width
    return ((us - F.pmod(us, width)) / width).cast("long")


def floor_time(time: Column | str, width: int) -> Column:
    us = micros(time)
    return F.timestamp_micros(us - F.pmod(us, F.lit(width)))


def _try_layout(text: Column, layout: str) -> Column:
    return F.try_to_timestamp(text, F.lit(layout))


def parse_compact(text: Column) -> Column:
    """yyyyMMdd[HHmm[ss]] read year-first, else day-first; NULL for anything else."""
    parsed = F.lit(None).cast("timestamp")
    for length, clock in _COMPACT_LENGTHS.items():
        both = F.coalesce(_try_layout(text, "yyyyMMdd" + clock), _try_layout(text, "ddMMyyyy" + clock))
        parsed = F.when(text.rlike(rf"^\d{{{length}}}$"), both).otherwise(parsed)
    return parsed


def parse_epoch(text: Column) -> Column:
    """Epoch seconds, or milliseconds where the number is that large."""
    number = text.try_cast("double")
    scale = F.when(F.abs(number) > F.lit(_MILLISECONDS_ABOVE), F.lit(1e3)).otherwise(F.lit(1e6))
    return F.timestamp_micros(F.round(number * scale).cast("long"))


def parse_iso(text: Column) -> Column:
    """ISO 8601 of any precision or offset, extended or basic; without an offset it is UTC."""
    basic = F.coalesce(_try_layout(text, "yyyyMMdd'T'HHmmss"), _try_layout(text, "yyyyMMdd'T'HHmmssX"))
    return F.when(text.rlike(r"^\d{4}-\d{2}(-\d{2})?([T ].*)?$"), text.try_cast("timestamp")).when(
        text.rlike(r"^\d{8}T\d{6}"), basic
    )


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once, which also keeps the generated code small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_free_text(text: Column) -> Column:
    """Day-first dates and month names, with or without a clock (fractions, AM and PM, offset).

    A date of two numbers and a year is day first; where the second number is no month, month first.
    """

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))

    def month(name: Column) -> Column:
        return F.nullif(F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.lower(name)), F.lit(0)).cast("int")

    def date(year: Column, month_: Column, day: Column) -> Column:
        return F.struct(year.cast("int").alias("year"), month_.cast("int").alias("month"), day.cast("int").alias("day"))

    def numbers(pattern: str) -> Column:
        return F.struct(part(pattern, 1).alias("a"), part(pattern, 2).alias("b"), part(pattern, 3).alias("c"))

    def day_first(p: Column) -> Column:
        swapped = (p["b"].cast("int") > 12) & (p["a"].cast("int") <= 12)
        return F.when(swapped, date(p["c"], p["a"], p["b"])).otherwise(date(p["c"], p["b"], p["a"]))

    found = (
        F.when(text.rlike(_YEAR_FIRST), _once(numbers(_YEAR_FIRST), lambda p: date(p["a"], p["b"], p["c"])))
        .when(text.rlike(_DAY_FIRST), _once(numbers(_DAY_FIRST), day_first))
        .when(text.rlike(_DAY_NAME), _once(numbers(_DAY_NAME), lambda p: date(p["c"], month(p["b"]), p["a"])))
        .when(text.rlike(_NAME_DAY), _once(numbers(_NAME_DAY), lambda p: date(p["c"], month(p["a"]), p["b"])))
    )
    # What is left after the date must be a clock or nothing.
    left = F.trim(F.regexp_replace(text, "|".join(f"({p})" for p in (_YEAR_FIRST, _DAY_FIRST, _DAY_NAME, _NAME_DAY)), ""))

    def built(p: Column) -> Column:
        def clock(group: int) -> Column:
            return F.nullif(F.regexp_extract(p["left"], _CLOCK, group), F.lit(""))

        hour = clock(1).cast("int")
        half = F.lower(clock(4))
        hour = F.when(half == "p", hour % 12 + 12).when(half == "a", hour % 12).otherwise(hour)
        year = p["found"]["year"]
        year = F.when(year >= 100, year).otherwise(year + F.when(year >= _TWO_DIGITS_FROM, 1900).otherwise(2000))
        zero = F.lit(0)
        time = F.try_make_timestamp(
            year, p["found"]["month"], p["found"]["day"], F.coalesce(hour, zero), F.coalesce(clock(2).cast("int"), zero),
            F.coalesce(clock(3), F.lit("0")).cast("decimal(16,6)"),
        )
        offset = (clock(6).cast("int") * 60 + clock(7).cast("int")) * F.when(clock(5) == "-", -1).otherwise(1)
        shifted = F.timestamp_micros(F.unix_micros(time) - F.coalesce(offset, zero).cast("long") * MINUTE)
        return F.when(p["found"].isNotNull() & ((p["left"] == "") | p["left"].rlike(_CLOCK)), shifted)

    return _once(F.struct(found.alias("found"), left.alias("left")), built)


def _date_first(text: Column) -> Column:
    """Free text without a weekday in front and a zone name behind, and with its date before its clock."""
    bare = F.regexp_replace(text, r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+", "")
    bare = F.regexp_replace(bare, r"(?i)\s*\b(gmt|utc)$", "")
    turned = F.regexp_replace(bare, r"^(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:\s*[AaPp][Mm])?)[,\s]+(\S.*)$", "$2 $1")
    return F.when(text.rlike(r"^[A-Za-z]|^\d{1,2}:|[A-Za-z]$"), turned).otherwise(text)


def to_utc(raw: Column | str, numeric: bool = False) -> Column:
    """Any supported timestamp text as TIMESTAMP; unparseable text becomes NULL.

    The order is compact digits (also as date-clock), epoch numbers, ISO 8601, then day-first text, with or without a weekday, its clock on
    either side.
    Each value is judged on its own, so one odd row never changes how the
    others are read. A `numeric` column has lost leading zeros: whole numbers of 7 and 11 digits
    are compact dates with one.
    """
    column = F.col(raw) if isinstance(raw, str) else raw
    text = F.trim(column.cast("string"))
    if numeric:
        whole = column.try_cast("decimal(38,0)").cast("string")
        text = F.when(whole.try_cast("double") == column.try_cast("double"), whole).otherwise(text)
        text = F.when(text.rlike(r"^(\d{7}|\d{11})$"), F.concat(F.lit("0"), text)).otherwise(text)
    digits = text.rlike(r"^-?\d+(\.\d+)?$")
    return (
        F.when(digits, F.coalesce(parse_compact(text), parse_epoch(text)))
        .when(text.rlike(r"^\d{4}-\d{2}|^\d{8}T"), F.coalesce(parse_iso(text), parse_free_text(text)))
        .when(text.rlike(r"^\d{8}[-_ ]\d{6}$"), parse_compact(F.regexp_replace(text, "[-_ ]", "")))
        .otherwise(_once(_date_first(text), parse_free_text))
    )


def format_time(time: Column | str) -> Column:
    """Canonical fixed-width UTC text with microseconds."""
    return F.date_format(time, CANONICAL_TIME)


def is_canonical(text: Column | str) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return column.rlike(CANONICAL_PATTERN)


def time_in_name(name: Column | str) -> Column:
    """The first run of 12 digits in a file stem, read year-first, else day-first."""
    column = F.col(name) if isinstance(name, str) else name
    return parse_compact(F.regexp_extract(column, r"(\d{12})", 1))


def recording_start(name: Column | str) -> Column:
    """Start time in names like ...-D20250902-T185151.raw."""
    column = F.col(name) if isinstance(name, str) else name
    stamp = F.concat(
        F.regexp_extract(column, r"D(\d{8})-T(\d{6})", 1), F.regexp_extract(column, r"D(\d{8})-T(\d{6})", 2)
    )
    return _try_layout(F.nullif(stamp, F.lit("")), "yyyyMMddHHmmss")


RANGE_NAME = r"^(\d{8}T\d{6})-(\d{8}T\d{6})\.zip$"


def range_in_name(name: Column | str) -> tuple[Column, Column]:
    """Start and end time in names like 20250902T000000-20250902T010000.zip."""
    column = F.col(name) if isinstance(name, str) else name
    return tuple(
        _try_layout(F.nullif(F.regexp_extract(column, RANGE_NAME, part), F.lit("")), "yyyyMMdd'T'HHmmss")
        for part in (1, 2)
    )
