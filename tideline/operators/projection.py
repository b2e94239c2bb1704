"""Column choice, renaming, coercion and row deduplication."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import schema
from tideline.functions import text as tx
from tideline.functions import time as tm

# Time-like names tried, in any case, when there is no `time` column.
_TIME_CANDIDATES = ["timestamp", "timestamp_utc", "datetime", "time_utc", "date_time"]


def quoted(name: str) -> Column:
    """A column whose name may hold dots, spaces or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def keep_and_rename(df: DataFrame, mapping: dict[str, str], extra: Iterable[str] = ()) -> DataFrame:
    """Known columns under their canonical name; several raw variants coalesce in mapping order."""
    variants: dict[str, list[str]] = {}
    for raw, canonical in mapping.items():
        if raw in df.columns:
            variants.setdefault(canonical, []).append(raw)
    for name in extra:
        if name in df.columns and name not in mapping:
            variants.setdefault(name, []).append(name)
    return df.select(*[F.coalesce(*[quoted(v) for v in raws]).alias(name) for name, raws in variants.items()])


def missing_canonical(df: DataFrame, mapping: dict[str, str]) -> list[str]:
    """Canonical names none of whose raw variants is present."""
    present = {mapping[c] for c in df.columns if c in mapping}
    return sorted(set(mapping.values()) - present)


def missing_canonical_rows(mapping: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """The same as rows: mapping (keys, raw, canonical) against the columns seen (keys, raw)."""
    found = mapping.join(present, [*keys, "raw"], "left_semi").select(*keys, "canonical").distinct()
    return mapping.select(*keys, "canonical").distinct().join(found, [*keys, "canonical"], "left_anti")


def to_number(value: Column) -> Column:
    """Number in a text, NULL where it is none; NaN counts as none."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def coerce_numeric(df: DataFrame, time: str = "time", exclude: Iterable[str] = ()) -> DataFrame:
    """Every column but time columns and the excluded ones as DOUBLE."""
    skip = {time, *schema.TIME_ALIASES, *exclude}
    kinds = dict(df.dtypes)
    return df.select(
        *[
            quoted(c) if c in skip or kinds[c].startswith("timestamp") else to_number(quoted(c)).alias(c)
            for c in df.columns
        ]
    )


def time_source(columns: list[str], preferred: str | None = None) -> str | None:
    """Raw column the canonical time is read from; None if only the file name can tell."""
    if preferred is not None and preferred in columns:
        return preferred
    return next((c for c in schema.TIME_ALIASES if c in columns), None)


def add_canonical_time(df: DataFrame, preferred: str | None = None) -> DataFrame:
    """Add `time` from the authoritative raw column; a `time` already there is renamed, not lost."""
    source = time_source(df.columns, preferred)
    if source is None:
        return df
    if "time" in df.columns:
        name, number = "timestamp", 2
        while name in df.columns:
            name, number = f"timestamp_{number}", number + 1
        df = df.withColumnRenamed("time", name)
        source = name if source == "time" else source
    numeric = df.schema[source].dataType.typeName() in ("integer", "long", "short", "double", "float", "decimal")
    return df.withColumn("time", tm.to_utc(quoted(source), numeric))


def resolve_time_column(columns: Iterable[str]) -> str:
    """The time column of an arbitrary table, by its name."""
    columns = list(columns)
    if "time" in columns:
        return "time"
    by_lower = {c.lower(): c for c in columns}
    for candidate in _TIME_CANDIDATES:
        if candidate in by_lower:
            return by_lower[candidate]
    for column in columns:
        if "time" in column.lower():
            return column
    raise ValueError(f"no time-like column among {columns}")


def level_columns(columns: Iterable[str]) -> list[str]:
    """Columns that hold dB levels, by their prefix."""
    return [c for c in columns if c.startswith(tuple(schema.LEVEL_PREFIXES))]


def select_combos(df: DataFrame, columns: Iterable[str] = (), **only: Iterable[str] | None) -> DataFrame:
    """Filter by key values (None = all) and, if given, keep the keys and some columns."""
    for key, values in only.items():
        if values is not None:
            df = df.where(F.col(key).isin(*values))
    return df.select(*[k for k in df.columns if k in only or k in columns]) if columns else df


def drop_duplicate_records(df: DataFrame, ignore: Iterable[str] = ()) -> DataFrame:
    """Drop exact repeats; raw time texts are left out of the comparison."""
    skip = {*schema.TIME_ALIASES, *ignore}
    return df.dropDuplicates([c for c in df.columns if c not in skip])


def drop_empty_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns without any value. Runs one aggregate over the table."""
    kept = set(keep)
    judged = [c for c in df.columns if c not in kept]
    if not judged:
        return df
    counts = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(judged)]).first()
    empty = {c for i, c in enumerate(judged) if counts[f"c{i}"] == 0}
    return df.select(*[quoted(c) for c in df.columns if c not in empty])


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """Union of differing layouts; columns in order of first appearance, missing ones NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def with_lineage(df: DataFrame, leg: Column, source_file: Column) -> DataFrame:
    return df.withColumns({"__leg": leg, "__source_file": source_file})


def chronological(df: DataFrame, time: str = "time", tie: Iterable[str] = ()) -> DataFrame:
    """By time, rows without a time last; `tie` makes the order of equals reproducible."""
    return df.orderBy(F.col(time).asc_nulls_last(), *tie)


def stack_streams(parts: dict[str, DataFrame], constants: DataFrame, file_key: str) -> DataFrame:
    """Independent streams under one another with a `time_source` tag; file constants on every row."""
    tagged = [df.withColumn("time_source", F.lit(name)) for name, df in parts.items()]
    return union_by_name(tagged).join(constants, file_key, "left")


def with_category_name(df: DataFrame, code: str, table: dict[int, str], name: str) -> DataFrame:
    """Add the name of a (rounded) code; the table is a constant of the plan."""
    pairs = [part for key, value in table.items() for part in (F.lit(key), F.lit(value))]
    rounded = F.round(F.col(code)).cast("int")
    return df.withColumn(name, tx.category_text(rounded, F.try_element_at(F.create_map(*pairs), rounded)))
