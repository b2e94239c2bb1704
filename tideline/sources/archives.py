"""Archives of XML records of the water sampler."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.sources.lines import FILE
from tideline.sources.ranged import listed, opener

_POINTS = (
    "STRUCT<Point: ARRAY<STRUCT<_ID: STRING, _Descr: STRING, _Unit: STRING, _RangeMin: STRING, _RangeMax: STRING, "
    "Value: STRING>>>"
)
_SENSOR = f"STRUCT<_ID: STRING, _SerialNo: STRING, _Descr: STRING, _ProdName: STRING, Parameters: {_POINTS}>"
_RECORD = (
    "_ID STRING, _SessionID STRING, _Descr STRING, _SerialNo STRING, _ProdName STRING, _DeviceType STRING, "
    "_ProtocolVer STRING, Time STRING, TimeReceived STRING, "
    "SystemInformation STRUCT<SystemInfo: ARRAY<STRUCT<_ID: STRING, _VALUE: STRING>>>, "
    "Data STRUCT<Time: STRING, RecordNumber: STRING, SpecifiedInterval: STRING, ActualInterval: STRING, "
    f"SensorData: ARRAY<{_SENSOR}>, SystemData: STRUCT<Parameters: {_POINTS}>>, _corrupt_record STRING"
)

# Sensor kinds by a word in their description, with their key and abbreviation.
_SENSOR_KINDS = [
    ("tide", "tide_sensor", "TS"),
    ("oxygen", "oxygen_optode", "O2"),
    ("conductivity", "conductivity_sensor", "CS"),
]
# System points by id, the words their description must hold, and their column.
_SYSTEM_POINTS = [
    ("0", "Input Voltage", "voltage_current"),
    ("1", "Input Voltage Avg", "voltage_avg"),
    ("2", "Input Voltage Min", "voltage_min"),
    ("3", "Input Voltage Max", "voltage_max"),
    ("4", "CPU Core Active", "cpu_active"),
    ("5", "Memory Used", "memory_used"),
    ("6", "Internal Temperature", "internal_temp"),
]
# System information by id.
_SYSTEM_INFO = {"10": "owner", "13": "location", "12": "reference", "21": "geoposition", "30": "verticalposition"}


def archive_members(spark: SparkSession, path: str | list[str], suffix: str = ".xml", chunk_bytes: int = 8 << 20, chunk_members: int = 1_000) -> DataFrame:
    """(path, file, chunk, members) of every archive, from its central directory; an unreadable one has no members (NULL).

    Members are the files that end in `suffix`, whatever folder of the archive they are in: name, offset, packed and full size,
    method, flags and checksum. A chunk holds about so many packed bytes, and at most so many members.
    """
    open_file = opener()
    member = "STRUCT<name: STRING, offset: LONG, packed: LONG, size: LONG, method: INT, flags: INT, crc: LONG>"
    parts = [("name", pa.string()), ("offset", pa.int64()), ("packed", pa.int64()), ("size", pa.int64()), ("method", pa.int32()), ("flags", pa.int32()), ("crc", pa.int64())]

    def chunks(name: str) -> Iterator[tuple]:
        import zipfile

        try:
            with zipfile.ZipFile(open_file(name)) as archive:
                entries = [e for e in archive.infolist() if e.filename.lower().endswith(suffix)]
        except (zipfile.BadZipFile, OSError, ValueError):  # the last where a file ends before its directory
            yield 0, None
            return
        held: list[dict] = []
        number = full = 0
        for e in entries:
            if held and (full + e.compress_size > chunk_bytes or len(held) == chunk_members):
                yield number, held
                held, number, full = [], number + 1, 0
            full += e.compress_size
            held.append({"name": e.filename, "offset": e.header_offset, "packed": e.compress_size, "size": e.file_size, "method": e.compress_type, "flags": e.flag_bits, "crc": e.CRC})
        if held:
            yield number, held

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for number, members in chunks(name):
                    columns = [pa.array([name]), pa.array([file]), pa.array([number], pa.int32()), pa.array([members], pa.list_(pa.struct(parts)))]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "file", "chunk", "members"])

    files = listed(spark, path).select("path", "file_name")
    return files.mapInArrow(read, f"path string, file string, chunk int, members ARRAY<{member}>")


def read_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source file, member, xml) of every XML record; an unreadable archive is one row without member and xml, an unreadable member one without xml.

    The central directory of an archive is read by itself; its members are dealt to tasks in chunks, so that one large
    archive spreads over many. A task reads the bytes of its members only.
    """
    open_file = opener()
    at_once = 4 << 20  # characters of a batch, about

    def unpacked(file, m: dict) -> str | None:
        import struct
        import zlib

        try:
            local = file.read_at(30, m["offset"])
            if local[:4] != b"PK\x03\x04" or m["flags"] & 1 or m["method"] not in (0, 8):
                return None
            name_length, extra_length = struct.unpack("<HH", local[26:30])
            content = file.read_at(m["packed"], m["offset"] + 30 + name_length + extra_length)
            content = zlib.decompress(content, -15) if m["method"] == 8 else content
        except (OSError, zlib.error, struct.error):
            return None
        return content.decode("utf-8", errors="replace") if zlib.crc32(content) == m["crc"] and len(content) == m["size"] else None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["file", "member", "xml"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, name, members in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if members is None:
                    yield batch_of([(name, None, None)])
                    continue
                rows, held = [], 0
                with open_file(path_) as file:
                    for m in members:
                        xml = unpacked(file, m)
                        rows.append((name, m["name"], xml))
                        held += len(xml or "")
                        if held >= at_once:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    # Chunks are few bytes each, so their number of tasks comes from the archives' sizes and not from the exchange's.
    size = listed(spark, path).agg(F.sum("size")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // (16 << 20)))
    dealt = archive_members(spark, path).repartition(tasks, "path", "chunk")
    return dealt.mapInArrow(read, "file string, member string, xml string").withColumnRenamed("file", FILE)


def parse_records(archives: DataFrame, from_time: Column | None = None, to_time: Column | None = None) -> DataFrame:
    """Add the parsed `record` and the `problem` that keeps it from being used (NULL if none)."""
    # Exploding a single value keeps filters on the record from parsing it a second time.
    parsed = archives.select("*", F.explode(F.array(F.from_xml("xml", _RECORD, {"ignoreNamespace": "true"}))).alias("record"))
    time = tm.to_utc(F.col("record.Time"))
    outside = F.lit(False)
    if from_time is not None:
        outside = outside | F.coalesce(time < from_time, F.lit(False))
    if to_time is not None:
        outside = outside | F.coalesce(time > to_time, F.lit(False))
    problem = (
        F.when(F.col("xml").isNull() | F.col("record._corrupt_record").isNotNull(), F.lit("unreadable"))
        .when(F.col("record.Time").isNull(), F.lit("no time"))
        .when(outside, F.lit("outside the time range"))
        .when(F.col("record.Data").isNull(), F.lit("no data"))
    )
    return parsed.withColumn("problem", problem)


def _value(points: Column, point_id: str, words: str = "") -> Column:
    hits = F.filter(points, lambda p: (p["_ID"] == point_id) & F.coalesce(p["_Descr"], F.lit("")).contains(words))
    return F.try_element_at(hits, F.lit(-1))["Value"].try_cast("double")


def _info(info: Column, key: str) -> Column:
    return F.try_element_at(F.filter(info, lambda i: i["_ID"] == key), F.lit(-1))["_VALUE"]


def _sensor_key(sensor: Column) -> Column:
    key = sensor["_ID"]
    for word, name, _ in reversed(_SENSOR_KINDS):
        with_serial = F.concat(F.lit(name + "_"), sensor["_SerialNo"])
        key = F.when(F.lower(sensor["_Descr"]).contains(word), with_serial).otherwise(key)
    return key


def _abbreviation(sensor: Column) -> Column:
    short = sensor["_ID"]
    for word, _, letters in reversed(_SENSOR_KINDS):
        short = F.when(F.lower(sensor["_Descr"]).contains(word), F.lit(letters)).otherwise(short)
    return short


def _measurement(sensor: Column, point: Column) -> Column:
    name = F.concat_ws("_", _abbreviation(sensor), tx.camel_name(F.lower(point["_Descr"])))
    limits = F.when(
        (F.coalesce(point["_RangeMin"], F.lit("")) != "") & (F.coalesce(point["_RangeMax"], F.lit("")) != ""),
        F.concat_ws("-", point["_RangeMin"], point["_RangeMax"]),
    )
    return F.struct(
        name.alias("name"),
        point["Value"].try_cast("double").alias("value"),
        F.coalesce(point["_Unit"], F.lit("")).alias("unit"),
        limits.alias("range"),
    )


def flatten_records(parsed: DataFrame) -> DataFrame:
    """One row per usable record: device, times, position, system values, and measurements as maps.

    `values`, `units` and `ranges` map a measurement name such as
    CS_Conductivity to its entry, `sensors` a sensor key to its id and
    description. `widen` turns entries into columns.
    """
    usable = parsed.where(F.col("problem").isNull())
    record, data = F.col("record"), F.col("record.Data")
    sensors = F.coalesce(data["SensorData"], F.array().cast(f"array<{_SENSOR}>"))
    measured = F.filter(
        F.flatten(
            F.transform(
                F.filter(sensors, lambda s: s["Parameters"]["Point"].isNotNull()),
                lambda s: F.transform(s["Parameters"]["Point"], lambda p: _measurement(s, p)),
            )
        ),
        lambda m: m["value"].isNotNull(),
    )
    system = data["SystemData"]["Parameters"]["Point"]
    info = record["SystemInformation"]["SystemInfo"]
    staged = usable.withColumn("_measured", measured)

    def entries(field: str) -> Column:
        kept = F.filter("_measured", lambda m: m[field].isNotNull())
        pairs = F.transform(kept, lambda m: F.struct(m["name"].alias("key"), m[field].alias("value")))
        return F.map_from_entries(tx.last_of_each(pairs))

    return staged.select(
        FILE,
        F.regexp_extract("member", r"([^/]+)$", 1).alias("sourceFile"),
        record["_ID"].alias("deviceId"),
        record["_SessionID"].alias("sessionId"),
        record["_Descr"].alias("deviceDescription"),
        record["_SerialNo"].alias("serialNo"),
        record["_ProdName"].alias("productName"),
        record["_DeviceType"].alias("deviceType"),
        record["_ProtocolVer"].alias("protocolVersion"),
        record["Time"].alias("timestamp"),
        record["TimeReceived"].alias("timeReceived"),
        *[_info(info, key).alias(name) for key, name in _SYSTEM_INFO.items()],
        data["Time"].alias("dataTimestamp"),
        data["RecordNumber"].try_cast("long").alias("recordNumber"),
        data["SpecifiedInterval"].try_cast("double").alias("interval_specified"),
        data["ActualInterval"].try_cast("double").alias("interval_actual"),
        F.coalesce(_value(system, "7"), F.lit(0.0)).alias("latitude"),
        F.coalesce(_value(system, "8"), F.lit(0.0)).alias("longitude"),
        *[_value(system, point_id, words).alias(name) for point_id, words, name in _SYSTEM_POINTS],
        F.map_from_entries(
            tx.last_of_each(
                F.transform(
                    sensors,
                    lambda s: F.struct(
                        _sensor_key(s).alias("key"),
                        F.struct(s["_ID"].alias("id"), s["_Descr"].alias("description")).alias("value"),
                    ),
                )
            )
        ).alias("sensors"),
        entries("value").alias("values"),
        entries("unit").alias("units"),
        entries("range").alias("ranges"),
    )
