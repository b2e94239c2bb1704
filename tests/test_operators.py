from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tideline.functions import geo, wind
from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.operators import asof, cleaning, detect, gaps, position, projection, ranges, resample, sequence, stats

BASE = at("2024-01-01 00:00:00")


def series(spark, seconds, key="a", **columns):
    """Rows of one key at the given seconds, with columns as lists."""
    data = [(key, BASE + timedelta(seconds=s), *[c[i] for c in columns.values()]) for i, s in enumerate(seconds)]
    return spark.createDataFrame(data, ["k", "time", *columns])


def seconds(column="time"):
    return ((F.unix_micros(column) - int(BASE.timestamp() * 1e6)) / 1e6).alias("s")


# --- time ---------------------------------------------------------------------------------------


def test_timestamp_texts(spark):
    cases = {
        "2024-03-05T10:11:12.123456Z": "2024-03-05 10:11:12.123456",
        "2024-03-05 10:11:12+02:00": "2024-03-05 08:11:12.000000",
        "2024-03-05": "2024-03-05 00:00:00.000000",
        "20240305": "2024-03-05 00:00:00.000000",
        "20240305T101112": "2024-03-05 10:11:12.000000",
        "20240305T101112Z": "2024-03-05 10:11:12.000000",
        "05032024": "2024-03-05 00:00:00.000000",
        "202403051011": "2024-03-05 10:11:00.000000",
        "05032024101112": "2024-03-05 10:11:12.000000",
        "1709633472": "2024-03-05 10:11:12.000000",
        "1709633472500": "2024-03-05 10:11:12.500000",
        "5/3/2024 10:11": "2024-03-05 10:11:00.000000",
        "05.03.2024 10:11:12": "2024-03-05 10:11:12.000000",
        "Mar 5 2024 10:11:12": "2024-03-05 10:11:12.000000",
        "soon": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], ["t"]).withColumn("time", tm.to_utc("t"))
    assert dict(rows(df)) == cases


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("1/9/2025 10:00:00.5", "2025-09-01 10:00:00.500000"), ("2025/09/02 10:00:00", "2025-09-02 10:00:00.000000"),
        ("Apr 21, 2025 10:00", "2025-04-21 10:00:00.000000"), ("21 April 2025 10:00", "2025-04-21 10:00:00.000000"),
        ("1/9/2025 10:00:00 AM", "2025-09-01 10:00:00.000000"), ("1/9/2025 12:30 PM", "2025-09-01 12:30:00.000000"),
        ("1/9/2025 12:30 am", "2025-09-01 00:30:00.000000"), ("2025-9-2 10:00", "2025-09-02 10:00:00.000000"),
        ("1/9/25 10:00", "2025-09-01 10:00:00.000000"), ("9/13/2025", "2025-09-13 00:00:00.000000"),
        ("1.9.2025 10:00:00+02:00", "2025-09-01 08:00:00.000000"), ("31/2/2025 10:00", None), ("1/9/2025 25:00", None), ("junk 1/9/2025", None),
        ("1/9/2025 and more", None), ("13/13/2025", None), ("Foo 21, 2025", None),
        ("Tue, 02 Sep 2025 10:00:00 GMT", "2025-09-02 10:00:00.000000"), ("Tuesday 2 September 2025", "2025-09-02 00:00:00.000000"),
        ("10:00 02/09/2025", "2025-09-02 10:00:00.000000"), ("10:00:01.25 PM, 2 Sep 2025", "2025-09-02 22:00:01.250000"), ("10:00", None),
        ("20250902-101500", "2025-09-02 10:15:00.000000"), ("20250902 101500", "2025-09-02 10:15:00.000000"), ("Tue soon", None),
    ],
)
def test_free_time_texts(spark, text, wanted):
    got = spark.createDataFrame([(text,)], ["t"]).select(F.date_format(tm.to_utc("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    assert got == wanted


def test_numbers_that_lost_their_zero(spark):
    df = spark.createDataFrame([(1092025, 10920251000.0), (21092025, 211020251000.0)], "Timestamp long, other double")
    got = df.select(tm.to_utc("Timestamp", numeric=True).cast("string"), tm.to_utc("other", numeric=True).cast("string")).collect()
    assert [tuple(r) for r in got] == [("2025-09-01 00:00:00", "2025-09-01 10:00:00"), ("2025-09-21 00:00:00", "2025-10-21 10:00:00")]


def test_canonical_time_keeps_an_existing_time_column(spark):
    df = spark.createDataFrame([("x", "2024-01-01", "2024-01-02")], ["time", "timestamp", "dataTimestamp"])
    out = projection.add_canonical_time(df, "dataTimestamp")
    assert out.columns == ["timestamp_2", "timestamp", "dataTimestamp", "time"]
    assert rows(out.select("timestamp_2", "time")) == [("x", "2024-01-02 00:00:00.000000")]
    assert projection.time_source(["Timestamp", "timestamp"]) == "timestamp"
    assert projection.resolve_time_column(["A", "DateTime"]) == "DateTime"
    assert projection.resolve_time_column(["A", "my_time_x"]) == "my_time_x"
    with pytest.raises(ValueError):
        projection.resolve_time_column(["A"])
    assert projection.add_canonical_time(df.select(F.col("time").alias("x"))).columns == ["x"]


# --- joins --------------------------------------------------------------------------------------


def test_nearest_tolerance_ties_and_shadowing(spark):
    left = series(spark, [10, 20, 30, 40, 50], n=[1, 2, 3, 4, 5])
    right = series(spark, [9, 11, 21.0, 31.000001, 39.5, 40.4, 50], lat=[1.0, 2.0, 3.0, 4.0, 5.0, None, 7.0], lon=[0.0] * 7)
    right = right.unionByName(series(spark, [50], lat=[6.0], lon=[0.0]))
    out = asof.nearest_asof(left, [asof.Source(right, {"lat": "lat", "lon": "lon"}, tm.SECOND)], ["k"])
    # A tie takes the earlier row; one second is still near; a row without latitude hides nothing;
    # of two rows at one time the one with the lesser values counts.
    assert dict(rows(out.select("n", "lat"))) == {1: 1.0, 2: 3.0, 3: None, 4: 5.0, 5: 6.0}


def test_nearest_keeps_rows_without_time_and_replaces_old_positions(spark):
    left = series(spark, [0, 1], latitude_deg=[9.0, 9.0]).withColumn("time", F.when(seconds() > 0, F.col("time")))
    fixes = series(spark, [1], latitude_deg=[1.5], longitude_deg=[2.5])
    out = asof.geotag(left, fixes, ["k"], tm.SECOND)
    assert rows(out.select("latitude_deg", "longitude_deg")) == [(1.5, 2.5), (None, None)]


def test_nearest_equals_brute_force(spark):
    rng = random.Random(7)
    left = sorted(rng.sample(range(0, 20_000), 400))
    right = sorted(rng.sample(range(0, 20_000), 300))
    out = asof.nearest_asof(
        series(spark, left, n=left), [asof.Source(series(spark, right, v=right), {"v": "v"}, 30 * tm.SECOND)], ["k"]
    )
    found = dict(rows(out.select("n", "v")))
    for t in left:
        best = min(right, key=lambda r: (abs(r - t), r))
        assert found[t] == (best if abs(best - t) <= 30 else None)


def test_window_membership_is_inclusive(spark):
    df = series(spark, [0, 10, 20, 30, 3600, 7200], n=[0, 10, 20, 30, 3600, 7200])
    bounds = [(10, 20), (15, 18), (3000, 3600)]
    windows = spark.createDataFrame(
        [("a", BASE + timedelta(seconds=a), BASE + timedelta(seconds=b)) for a, b in bounds], ["k", "start", "end"]
    )
    assert [r[0] for r in rows(ranges.in_any_window(df, windows, ["k"]).select("n"))] == [10, 20, 3600]
    assert sorted(r[0] for r in rows(ranges.in_any_window(df, windows, ["k"], anti=True).select("n"))) == [0, 30, 7200]


def test_interval_union_and_intersection_over_chunk_edges(spark):
    day = 86_400
    rng = random.Random(3)
    spans = [(a, a + rng.randrange(0, 40 * day)) for a in (rng.randrange(0, 900 * day) for _ in range(40))]
    other = [(a, a + rng.randrange(1, 30 * day)) for a in (rng.randrange(0, 900 * day) for _ in range(30))]

    def frame(pairs):
        return spark.createDataFrame(
            [("a", BASE + timedelta(seconds=x), BASE + timedelta(seconds=y)) for x, y in pairs], ["k", "start", "end"]
        )

    def merged(pairs):
        out = []
        for x, y in sorted(pairs):
            if out and x <= out[-1][1]:
                out[-1][1] = max(out[-1][1], y)
            else:
                out.append([x, y])
        return out

    union = ranges.interval_union(frame(spans), ["k"]).select(seconds("start").alias("a"), seconds("end").alias("b"))
    assert sorted(map(list, union.collect())) == merged(spans)
    both = ranges.interval_intersection(frame(spans), frame(other), ["k"])
    expected = sorted(
        [max(a, c), min(b, d)] for a, b in merged(spans) for c, d in merged(other) if max(a, c) < min(b, d)
    )
    assert sorted(map(list, both.select(seconds("start").alias("a"), seconds("end").alias("b")).collect())) == expected


# --- gaps ---------------------------------------------------------------------------------------


def test_gap_threshold_is_strict(spark):
    out = gaps.internal_gaps(series(spark, [0, 60, 120.000001, 130, 500]), ["k"], "time", 1.0)
    assert [r["gap_minutes"] for r in out.orderBy("previous_time").collect()] == [1.0, 6.167]


def test_gaps_equal_a_plain_walk(spark):
    rng = random.Random(5)
    times = sorted({round(rng.random() * 3_000_000, 3) for _ in range(1500)})
    out = gaps.internal_gaps(series(spark, times), ["k"], "time", 40.0)
    expected = sorted(round(b - a, 3) for a, b in zip(times, times[1:]) if b - a > 2400)
    found = sorted(round(r[0], 3) for r in out.select((F.unix_micros("current_time") - F.unix_micros("previous_time")) / 1e6).collect())
    assert found == expected and len(found) > 100


def test_segments_and_numbers_equal_a_plain_walk(spark):
    rng = random.Random(6)
    times = sorted({round(rng.random() * 2_000_000, 1) for _ in range(800)})
    df = series(spark, times, n=list(range(len(times))))
    width = tm.seconds_us(300)
    number, expected = 0, {}
    for i, t in enumerate(times):
        if i and t - times[i - 1] > 300:
            number += 1
        expected[i] = number
    assert dict(rows(gaps.with_segment(df, ["k"], "time", width).select("n", "segment_no"))) == expected
    assert gaps.segments(df, ["k"], "time", width).count() == number + 1


def test_a_step_of_exactly_the_gap_stays_in_the_segment(spark):
    out = gaps.segments(series(spark, [0, 15, 30.000001]), ["k"], "time", tm.seconds_us(15))
    assert sorted(r["n_rows"] for r in out.collect()) == [1, 2]


def test_covered_and_gap_time_fill_the_window(spark):
    rng = random.Random(8)
    times = sorted(rng.sample(range(1000, 90_000), 150))
    windows = spark.createDataFrame([(1, BASE, BASE + timedelta(seconds=100_000))], ["leg", "start", "end"])
    df = series(spark, times).withColumn("leg", F.lit(1))
    found = gaps.find_gaps(df, ["leg"], "time", windows, 5.0)
    covered = gaps.covered_intervals(found, windows, ["leg"])

    def total(frame, a, b):
        return frame.select(F.sum(F.unix_micros(b) - F.unix_micros(a))).first()[0] or 0

    assert total(found, "previous_time", "current_time") + total(covered, "start", "end") == 100_000 * tm.SECOND
    fills = series(spark, rng.sample(range(0, 100_000), 300)).withColumn("leg", F.lit(1))
    held = found.select("leg", F.col("previous_time").alias("start"), F.col("current_time").alias("end"))
    left = gaps.remaining_gaps(held, fills.select("leg", "time"), ["leg"], 5.0)
    inside = left.alias("l").join(held.alias("h"), (F.col("l.start") >= F.col("h.start")) & (F.col("l.end") <= F.col("h.end")))
    assert inside.count() >= left.count() > 0
    assert total(left, "start", "end") < total(held, "start", "end")


def test_future_end_gaps(spark):
    df = spark.createDataFrame([("end", BASE), ("internal", BASE)], ["gap_type", "current_time"])
    assert gaps.without_future_end(df, F.lit(BASE - timedelta(days=1))).count() == 1
    assert gaps.without_future_end(df, F.lit(BASE)).count() == 2


# --- order --------------------------------------------------------------------------------------


def test_carries_across_chunks(spark):
    values = [5, 1, 7, 2, 2, 9, 4, 8, 3, 6]
    df = series(spark, [i * 7 for i in range(10)], v=values)
    chunk = sequence.time_chunk("time", 20 * tm.SECOND)
    out = sequence.with_previous(df, ["k"], ["time"], chunk, {"p": F.col("v")})
    assert [r["p"] for r in out.orderBy("time").collect()] == [None, *values[:-1]]
    out = sequence.with_running(df, ["k"], ["time"], chunk, {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))})
    got = [(r["s"], r["m"]) for r in out.orderBy("time").collect()]
    assert got == list(zip(np.cumsum(values).tolist(), np.maximum.accumulate(values).tolist()))
    out = sequence.with_running(df, ["k"], ["time"], chunk, {"m": ("min", F.col("v"))}, include_current=False)
    assert [r["m"] for r in out.orderBy("time").collect()] == [None, 5, 1, 1, 1, 1, 1, 1, 1, 1]


def test_midnight_rollover_over_several_days(spark):
    clock = [80_000, 86_000, 10, 5_000, 4_000, 86_399]
    df = series(spark, [i * 10 for i in range(6)], c=clock)
    out = sequence.day_rollover(df, ["k"], ["time"], sequence.time_chunk("time", 25 * tm.SECOND), F.col("c"))
    assert [r["day_offset"] for r in out.orderBy("time").collect()] == [0, 0, 1, 1, 2, 2]


def test_flagged_runs_at_the_ends_and_over_chunks(spark):
    flags = [True, True, False, True, False, False, True, True, True]
    df = series(spark, [i * 86_400 for i in range(9)], f=flags)
    out = sequence.flagged_runs(df, ["k"], "time", F.col("f"))
    assert sorted(r["n_rows"] for r in out.collect()) == [1, 2, 3]


def test_thin_to_one_row_per_second(spark):
    df = series(spark, [0.2, 0.1, 0.9, 1.0, 2.5], v=[1, 2, 3, 4, 5])
    assert sorted(r["v"] for r in sequence.thin_to_step(df, ["k"], "time").collect()) == [2, 4, 5]


# --- cleaning -----------------------------------------------------------------------------------


def rules(spark, *pairs):
    return spark.createDataFrame(list(pairs), "leg int, pressure_under double")


def test_pressure_rule_boundaries(spark):
    minutes = [0.0, 1.0, 10.0, 16.0, 16.01, 40.0, 55.0]
    pressure = [5.0, 1.9, 2.0, 5.0, 5.0, 1.0, 5.0]
    df = series(spark, [m * 60 for m in minutes], ts_pressure=pressure, m=minutes).withColumn("leg", F.lit(1))
    out = cleaning.remove_low_pressure(df, rules(spark, (1, 2.0)), ["leg"])
    # 2.0 is not under 2.0; 15 minutes after a bad row is still inside the buffer, and so is 55 after 40.
    assert sorted(r["m"] for r in out.collect()) == [0.0, 16.01]


def test_pressure_rule_for_a_missing_leg(spark):
    df = series(spark, [0, 1], ts_pressure=[1.0, None]).withColumn("leg", F.lit(3))
    with pytest.raises(Exception, match="no pressure removal rule for leg 3"):
        cleaning.remove_low_pressure(df, rules(spark, (1, 2.0)), ["leg"]).collect()
    assert cleaning.remove_low_pressure(df, rules(spark, (1, 2.0)), ["leg"], strict=False).count() == 2


def hampel(values: pd.Series, window: str) -> pd.Series:
    """The rule on one in-memory series, as the expected result."""
    frame = pd.DataFrame({"v": values.to_numpy()}, index=values.index)
    median = frame["v"].rolling(window, center=True, min_periods=3).median()
    deviation = (frame["v"] - median).abs()
    spread = deviation.rolling(window, center=True, min_periods=3).median()
    return frame["v"].where(~(deviation > 3.0 * 1.4826 * spread))


def test_spikes_equal_a_rolling_median_over_many_chunks(spark):
    rng = random.Random(11)
    times = sorted({round(rng.random() * 60_000, 1) for _ in range(900)})
    values = [None if rng.random() < 0.05 else 20 + rng.random() + (30 if rng.random() < 0.05 else 0) for _ in times]
    df = series(spark, times, x=values, latitude=values)
    assert cleaning.spike_columns(df, "time") == ["x"]
    out = cleaning.blank_spikes(df, ["k"], ["x"], window_minutes=10)
    got = [r["x"] for r in out.orderBy("time").collect()]
    index = pd.to_datetime([BASE + timedelta(seconds=t) for t in times])
    expected = hampel(pd.Series(values, index=index, dtype=float), "10min")
    assert [None if v is None else round(v, 9) for v in got] == [None if np.isnan(v) else round(v, 9) for v in expected]
    assert sum(v is None for v in got) > sum(v is None for v in values)
    assert rows(out.select("latitude")) == rows(df.select("latitude"))


def test_spike_frame_is_open_on_the_left_and_needs_three(spark):
    # With a window of 20 s the frame of t=10 is (0, 20]: the row at 0 is outside.
    df = series(spark, [0, 10, 20], x=[1.0, 1.0, 50.0])
    assert sorted(r["x"] for r in cleaning.blank_spikes(df, ["k"], ["x"], window_minutes=1 / 3).collect()) == [1.0, 1.0, 50.0]
    # A constant neighbourhood has no spread, so any deviation is a spike.
    df = series(spark, [0, 1, 2, 3, 4], x=[1.0, 1.0, 1.0, 1.0, 1.1])
    assert [r["x"] for r in cleaning.blank_spikes(df, ["k"], ["x"]).orderBy("time").collect()] == [1.0] * 4 + [None]
    untimed = df.unionByName(df.limit(1).withColumn("time", F.lit(None).cast("timestamp")))
    assert cleaning.blank_spikes(untimed, ["k"], ["x"]).count() == 6


def test_zero_rule_ignores_absent_columns(spark):
    df = spark.createDataFrame([(0.0, -1.0), (1.0, 2.0)], ["trilux_turbidity", "other"])
    out = cleaning.blank_nonpositive(df, ["trilux_turbidity", "trilux_chlorophyll"])
    assert rows(out) == [(1.0, 2.0), (None, -1.0)]


# --- resampling -----------------------------------------------------------------------------------


def test_empty_bins_are_rows_and_packs_join(spark):
    step = 60
    where = [0, 30, 3 * step, 1500 * step, 2200 * step]
    df = series(spark, where, v=[1.0, 3.0, 5.0, 7.0, 9.0])
    out = resample.resample_mean(df, ["k"], "1min", ["v"])
    got = {int(r["s"] / step): r["v"] for r in out.select(seconds(), "v").collect()}
    assert sorted(got) == list(range(2201))
    assert {b: v for b, v in got.items() if v is not None} == {0: 2.0, 3: 5.0, 1500: 7.0, 2200: 9.0}


def test_a_stray_early_row_fills_bins_in_packs(spark):
    df = spark.createDataFrame([("a", at("2023-12-01 00:00:00"), 1.0), ("a", BASE, 2.0)], ["k", "time", "v"])
    filled = resample.resample_mean(df, ["k"], "1min", ["v"])
    assert filled.count() == 31 * 1440 + 1 and filled.where("v is not null").count() == 2
    assert filled.groupBy("time").count().where("count > 1").count() == 0


def test_dominant_code(spark):
    code = [0.0, 0.0, 61.0, 61.0, None, 5.0, None, None]
    df = series(spark, [0, 1, 2, 3, 4, 5, 60, 61], code=code, v=[1.0, 1.0, 2.0, 4.0, 99.0, 9.0, 3.0, 5.0])
    out = resample.resample_dominant(df, ["k"], "1min", "code", ["v"])
    # A tie goes to the higher code; rows of other codes and without code do not count; no code at all: all rows.
    assert rows(out.select("code", "v")) == [(61.0, 3.0), (None, 4.0)]


def test_levels_are_averaged_as_power(spark):
    df = series(spark, [0, 1], level_x=[10.0, 20.0], v=[10.0, 20.0])
    out = resample.resample_all(df, ["k"], ["1min"], ["level_x", "v"], ["level_x"]).first()
    assert (round(out["level_x"], 6), out["v"]) == (17.403627, 15.0)


# --- positions, statistics, detection -------------------------------------------------------------


def test_a_second_counts_once_for_the_best_source(spark):
    df = series(spark, [0.1, 0.5, 1.2, 2.0, 2.9], source=["Bridge", "GGA", "Ferrybox", "EK80_gps", "other"])
    got = dict(rows(position.source_seconds(df, ["k"]).select("source", "seconds")))
    assert got == {"GGA": 1, "EK80_gps": 1, "Ferrybox": 1, "Bridge": 0}


def test_percentiles_equal_numpy_on_skewed_values(spark):
    rng = random.Random(2)
    values = [round(rng.expovariate(1), 2) for _ in range(2000)] + [1e6]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 4.0)], ["k", "v"])
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p999": 0.999}
    got = {r["k"]: [r[p] for p in points] for r in stats.exact_percentiles(df, ["k"], "v", points).collect()}
    assert got["a"] == pytest.approx(np.quantile(values, list(points.values())).tolist())
    assert got["b"] == [4.0] * 4


def test_percentiles_with_far_and_infinite_values(spark):
    values = [float(v) for v in range(10_000)] + [1e12, float("inf"), float("-inf")]
    df = spark.createDataFrame([("a", v) for v in values], ["k", "v"])
    got = stats.exact_percentiles(df, ["k"], "v", {"q1": 0.25, "median": 0.5, "least": 0.0, "most": 1.0}).first()
    want = np.percentile(values, [25, 50])
    assert np.allclose([got["q1"], got["median"]], want) and got["least"] == float("-inf") and got["most"] == float("inf")


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([("a", 2.0)] * 3, ["k", "v"])
    out = stats.histogram(df, ["k"], "v", 4).orderBy("bin").collect()
    assert [(r["bin_start"], r["n"]) for r in out] == [(1.5, 0), (1.75, 0), (2.0, 3), (2.25, 0)]


def test_wind_rose_edges(spark):
    df = spark.createDataFrame(
        [("a", 349.0, 1.0), ("a", 11.24, 3.0), ("a", 11.25, 15.0), ("a", 90.0, 0.49), ("a", None, 1.0)], "k string, d double, s double"
    )
    got = {(r["sector"], r["speed_class"]): (r["n"], r["pct"]) for r in stats.wind_rose(df, ["k"], "d", "s").collect() if r["n"]}
    assert got == {(0, 0): (1, 25.0), (0, 1): (1, 25.0), (1, 5): (1, 25.0), (-1, -1): (1, 25.0)}


def brute_noise(points, eps, minimum):
    near = {i: [j for j in range(len(points)) if np.linalg.norm(points[i] - points[j]) <= eps] for i in range(len(points))}
    core = {i for i, n in near.items() if len(n) >= minimum}
    return {i for i, n in near.items() if not core.intersection(n)}


def test_noise_equals_brute_force_with_copies_and_small_blocks(spark):
    rng = np.random.default_rng(4)
    spread = np.vstack([rng.normal(0, 0.4, (40, 3)), rng.normal(6, 0.4, (30, 3)), rng.uniform(-20, 20, (30, 3)), np.full((5, 3), 50.0)])
    df = spark.createDataFrame(
        [(f, int(f * 1000 + i), [float(x) for x in v]) for f in (1, 2) for i, v in enumerate(spread)], "f int, id long, v array<double>"
    )
    out = detect.noise_points(df, ["f"], "id", "v", 1.0, 4, block=16)
    expected = brute_noise(spread, 1.0, 4)
    assert {r["id"] for r in out.where("f = 1").collect()} == {1000 + i for i in expected}
    assert out.where("f = 2").count() == len(expected) and 0 < len(expected) < len(spread)


def test_a_border_point_is_not_noise(spark):
    line = [0.0, 0.5, 1.0, 1.5, 2.4, 9.0]
    df = spark.createDataFrame([(1, i, [x]) for i, x in enumerate(line)], "f int, id int, v array<double>")
    out = detect.noise_points(df, ["f"], "id", "v", 1.0, 4)
    assert {r["id"] for r in out.collect()} == {5}


def test_cascade_order_and_grouping(spark):
    data = [  # offset, ping, label, loudness
        (0.0, True, "Water", 9.0), (3.0, False, "Water", 1.0), (6.0, False, "Whale", 1.0), (21.0, False, "Boat", 2.5),
        (36.1, False, "Boat", 9.0),
    ]
    df = spark.createDataFrame([("r", "rec", *d) for d in data], ["k", "stem", "chunk_offset_s", "ping", "label", "loud"])
    out = detect.classify_candidates(df, ["k"], "stem", F.col("ping"), F.col("label"), F.col("loud"), ["Water"])
    got = [(r["status"], r["reason"], r["event_id"], r["high_quality"]) for r in out.orderBy("chunk_offset_s").collect()]
    assert got == [
        ("DISCARDED", "Instrument Ping", None, None),
        ("DISCARDED", "Failed Validation", None, None),
        ("KEPT", "Part of Event Group", "rec_6s", True),
        ("KEPT", "Part of Event Group", "rec_6s", True),
        ("DISCARDED", "Isolated Anomaly", None, None),
    ]


# --- expressions ------------------------------------------------------------------------------------


def test_texts(spark):
    df = spark.createDataFrame([("37° 44.2464' N",), (" 025°39.0' W ",), ("25 39 W",), (None,)], ["t"])
    got = [None if r[0] is None else round(r[0], 6) for r in df.select(geo.parse_dms(F.col("t"))).collect()]
    assert got == [37.73744, -25.65, None, None]
    names = ["Leg3_St04-2_St99-1", "L002_ST1", "st7_3", "St5-12x", "test"]
    df = spark.createDataFrame([(n,) for n in names], ["n"])
    station, number = tx.station_and_cast(F.col("n"))
    assert [tuple(r) for r in df.select(station, number).collect()] == [(4, 2), (1, 1), (7, 3), (None, None), (None, None)]
    labels = spark.createDataFrame([("a/b/x.y.cnv", None), (None, "C:\\d\\q.hex"), (None, None)], "s string, h string")
    got = [r[0] for r in labels.select(tx.cast_label(F.col("s"), F.col("h"))).collect()]
    assert got == ["x.y", "q", "unknown"]
    df = spark.createDataFrame([(0.305,), (0.125,), (0.355,), (1234.5,)], ["x"])
    assert [r[0] for r in df.select(tx.fixed(F.col("x"), 2)).collect()] == ["0.30", "0.12", "0.35", "1234.50"]


def test_true_wind_of_a_ship_in_still_air(spark):
    df = spark.range(1)
    direction, speed = wind.true_wind(F.lit(0.0), F.lit(5.0), F.lit(30.0), F.lit(30.0), F.lit(5.0))
    assert df.select(speed).first()[0] == pytest.approx(0.0, abs=1e-12)
    direction, speed = wind.true_wind(F.lit(90.0), F.lit(5.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))
    assert tuple(df.select(direction, speed).first()) == pytest.approx((90.0, 5.0))


def test_velocity_across_the_antimeridian(spark):
    course, speed = wind.velocity_between(
        F.lit(0.0), F.lit(179.9999), F.lit(0), F.lit(0.0), F.lit(-179.9999), F.lit(60_000_000)
    )
    got = spark.range(1).select(course, speed).first()
    assert got[0] == pytest.approx(90.0)
    assert got[1] == pytest.approx(np.deg2rad(0.0002) * 6_371_000 / 60 / (1852 / 3600))


def test_file_pruning(spark):
    starts = [("f1", 0), ("f2", 100), ("f2b", 100), ("f3", 200), ("f4", 300)]
    files = spark.createDataFrame([("a", n, BASE + timedelta(seconds=s)) for n, s in starts], ["k", "file_name", "start"])
    windows = spark.createDataFrame([("a", BASE + timedelta(seconds=150), BASE + timedelta(seconds=200))], ["k", "start", "end"])
    assert [r[1] for r in rows(ranges.prune_by_start(files, windows, ["k"]))] == ["f2b", "f3"]
    ended = files.withColumn("end", F.timestamp_micros(F.unix_micros("start") + 50 * tm.SECOND))
    assert [r[1] for r in rows(ranges.prune_by_range(ended, windows, ["k"]))] == ["f2", "f2b", "f3"]
    unnamed = ended.withColumn("end", F.when(F.col("file_name") != "f4", F.col("end")))
    assert ranges.prune_by_range(unnamed, windows, ["k"]).count() == 5


def test_profiles_keep_their_scan_order(spark):
    from tideline.operators import profile

    data = [("b", 3, 60), ("a", 2, 0), ("b", 1, 60), ("a", 1, 0), ("b", 2, 60), ("c", 1, 30)]
    df = spark.createDataFrame([(1, c, n, BASE + timedelta(seconds=s)) for c, n, s in data], ["leg", "cast", "scan_no", "time"])
    total = [(r["cast"], r["scan_no"]) for r in profile.profile_order(df).collect()]
    assert total == [("a", 1), ("a", 2), ("c", 1), ("b", 1), ("b", 2), ("b", 3)]
    parts = profile.profile_clusters(df, ["leg"]).withColumn("p", F.spark_partition_id()).collect()
    for cast in "abc":
        mine = [(r["p"], r["scan_no"]) for r in parts if r["cast"] == cast]
        assert len({p for p, _ in mine}) == 1 and [n for _, n in mine] == sorted(n for _, n in mine)


def test_copies_of_one_time_on_both_sides(spark):
    times = [0] * 3000 + [100, 200, 5000]
    df = series(spark, times, v=[1.0] * 3000 + [2.0, 3.0, 4.0])
    out = asof.nearest_asof(df, [asof.Source(df, {"w": "v"}, tm.SECOND)], ["k"])
    assert dict(rows(out.groupBy("w").count())) == {1.0: 3000, 2.0: 1, 3.0: 1, 4.0: 1}
    assert rows(gaps.internal_gaps(df, ["k"], "time", 2.0).select("gap_minutes")) == [(80.0,)]
    assert dict(rows(gaps.with_segment(df, ["k"], "time", 150 * tm.SECOND).groupBy("segment_no").count())) == {0: 3002, 1: 1}


def test_crowded_days_are_cut_by_count(spark):
    rng = random.Random(8)
    day = 86_400
    spans = []
    for key in ("a", "b"):
        for _ in range(600):  # most starts fall on one day
            at = rng.choice([rng.randrange(50 * day), 9 * day + rng.randrange(3_000)])
            spans.append((key, rng.choice("pqrs"), at, at + rng.choice([0, 5, rng.randrange(40_000), rng.randrange(9 * day)])))
        spans += [(key, "p", 9 * day, 9 * day + 7)] * 40
    spans += [("c", "p", 0, 10), ("c", "q", 10, 20), ("c", "r", 5, 5)]
    df = spark.createDataFrame([(k, n, BASE + timedelta(seconds=a), BASE + timedelta(seconds=b)) for k, n, a, b in spans], ["k", "n", "start", "end"])

    def merged(of):
        out = []
        for a, b in sorted(of):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    seconds = lambda c: (F.unix_seconds(c) - F.unix_seconds(F.lit(BASE))).cast("int")
    union = ranges.interval_union(df, ["k"], rows_at_once=10).select("k", seconds("start").alias("a"), seconds("end").alias("b"))
    assert rows(union) == sorted(((k, a, b) for k in "abc" for a, b in merged([(s, e) for key, _, s, e in spans if key == k])), key=lambda r: [str(v) for v in r])

    expected = {}
    for k in "abc":
        per = {n: merged([(s, e) for key, name, s, e in spans if (key, name) == (k, n)]) for n in "pqrs"}
        for x in "pqrs":
            for y in "pqrs":
                shared = [(max(a, c), min(b, d)) for a, b in per[x] for c, d in per[y] if x < y and max(a, c) < min(b, d)]
                if shared:
                    expected[k, x, y] = (sum(b - a for a, b in shared), min(a for a, _ in shared), max(b for _, b in shared))
    for at_once in (7, 5_000):
        got = ranges.pairwise_overlaps(df, ["k"], "n", rows_at_once=at_once)
        found = {(r["k"], r["n_a"], r["n_b"]): (r["overlap_hours"], r["a"], r["b"]) for r in got.select("*", seconds("overlap_start").alias("a"), seconds("overlap_end").alias("b")).collect()}
        assert set(found) == set(expected)
        assert all(abs(found[p][0] - expected[p][0] / 3600) < 0.006 and found[p][1:] == expected[p][1:] for p in expected)
    halves = [df.where("n in ('p', 'q')"), df.where("n in ('r', 's')")]
    both = ranges.interval_intersection(*halves, ["k"], rows_at_once=10).select("k", seconds("start").alias("a"), seconds("end").alias("b"))
    sides = {k: [merged([(s, e) for key, n, s, e in spans if key == k and n in names]) for names in ("pq", "rs")] for k in "abc"}
    assert rows(both.groupBy("k").agg(F.sum(F.col("b") - F.col("a")).alias("t"))) == [(k, t) for k in "abc" if (t := sum(max(0, min(b, d) - max(a, c)) for a, b in sides[k][0] for c, d in sides[k][1]))]
    edges = ranges.seq.with_equal_chunks(df.select("k", F.unix_seconds("start").alias("v")).distinct(), ["k"], F.col("v"), 10, width=3_600)
    sizes = edges.groupBy("k", "_chunk").count()
    assert sizes.where("k <> 'c'").agg(F.max("count")).first()[0] <= 40 and sizes.count() > 40


def test_blocks_meet_only_where_pivots_allow(spark):
    rng = np.random.default_rng(12)
    centres = rng.uniform(-100, 100, (25, 6))
    spread = np.vstack([c + rng.normal(0, 0.3, (80, 6)) for c in centres] + [rng.uniform(-100, 100, (40, 6))])
    df = spark.createDataFrame([(1, i, [float(x) for x in v]) for i, v in enumerate(spread)], "f int, id int, v array<double>")
    blocks = detect._blocks(detect.indexed(df, ["f"], "id", "v"), ["f"], 20).select("f", "_block", "_low", "_high", "_members").cache()
    assert blocks.agg(F.max(F.size("_members")), F.sum(F.size("_members"))).first()[:] == (20, len(spread))
    sizes = blocks.select("_block", F.size("_members").alias("n"))
    pairs = detect.block_pairs(blocks, blocks, ["f"], 1.0)
    assert pairs.distinct().count() == pairs.count()
    met = pairs.join(sizes.withColumnsRenamed({"_block": "left_block", "n": "a"}), "left_block").join(sizes.withColumnsRenamed({"_block": "right_block", "n": "b"}), "right_block")
    compared = met.agg(F.sum(F.col("a") * F.col("b"))).first()[0]
    assert compared < len(spread) * 80 * 4 < len(spread) ** 2 / 6  # a few clusters' worth a point, not all points
    out = detect.noise_points(df, ["f"], "id", "v", 1.0, 4, block=20)
    assert {r["id"] for r in out.collect()} == brute_noise(spread, 1.0, 4)


def test_states_add_up_over_intervals_and_runs(spark):
    rng = random.Random(5)
    data = [("a" if rng.random() < 0.7 else "b", BASE + timedelta(seconds=rng.randrange(0, 90_000)), rng.choice([None, rng.random() * 50]), rng.random() * 9 + 60, rng.choice([None, 1, 2, 2, 3])) for _ in range(900)]
    df = spark.createDataFrame(data, "k string, time timestamp, v double, level double, code int")
    freqs, columns = ["10min", "15min", "1h", "1D"], ["v", "level"]
    assert resample.base_step(freqs) == 300 * 1_000_000
    for code in (None, "code"):
        whole = resample.resample_all(df, ["k"], freqs, columns, ["level"], code, dense=False)
        halves = [resample.partial_states(df.where(p), ["k"], 300 * 1_000_000, columns, ["level"], code) for p in ("v < 20", "v is null or v >= 20")]
        merged = resample.merge_states(halves[0].unionByName(halves[1]), ["k"], columns)
        assert merged.count() <= halves[0].count() + halves[1].count()
        later = resample.roll_up(merged, ["k"], freqs, columns, ["level"], code).drop("_step")
        shown = [F.round(c, 6).alias(c) for c in columns] + ([code] if code else [])
        assert rows(whole.select("k", "interval", "time", *shown)) == rows(later.select("k", "interval", "time", *shown))
        for f in freqs:
            one = resample.resample_all(df, ["k"], [f], columns, ["level"], code, dense=False)
            assert rows(one.select("k", "interval", "time", *shown)) == rows(whole.where(F.col("interval") == f).select("k", "interval", "time", *shown))
    hour = df.where("k = 'a'").groupBy(F.date_trunc("hour", "time").alias("time")).agg(F.round(F.avg("v"), 6).alias("v"), F.round(10 * F.log10(F.avg(F.pow(F.lit(10.0), F.col("level") / 10))), 6).alias("level"))
    got = resample.resample_all(df, ["k"], freqs, columns, ["level"], dense=False).where("k = 'a' and interval = '1h'")
    assert rows(got.select("time", F.round("v", 6).alias("v"), F.round("level", 6).alias("level"))) == rows(hour)


def test_chunks_have_no_more_edges_than_their_rows_need(spark):
    # edges meet the rows of a key in many shares, so they travel often.
    from tideline.operators import sequence

    df = spark.range(40_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v")).where("k = 0 OR v < 1000")
    edges = sequence.chunk_edges(df, ["k"], F.col("v"), 5_000)
    assert sorted((r["k"], r["_halvings"], len(r["_edges"] or [])) for r in edges.collect()) == [(0, 2, 3), (1, 0, 0)]
    met = df.join(edges, "k").withColumn("c", sequence.chunk_of(F.col("v"), F.col("_halvings"), F.col("_edges")))
    low, high = sequence.chunk_bounds(F.col("c"), F.col("_halvings"), F.col("_edges"))
    inside = F.coalesce(F.col("v") >= low, F.lit(True)) & F.coalesce(F.col("v") < high, F.lit(True))
    found = met.groupBy("k", "c").agg(F.count("*").alias("n"), F.bool_and(inside).alias("inside")).collect()
    assert sorted((r["k"], r["c"]) for r in found) == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0)]
    assert all(r["inside"] for r in found) and all(4_900 < r["n"] < 5_100 for r in found if r["k"] == 0)


def test_blocks_grow_with_recordings_and_floats_stay_floats(spark):
    # F8 to F11: a block travels to all it may meet, so their number must not grow with the points.
    assert [detect.block_size(n, 10) for n in (0, 10_000, 600_000)] == [256, 256, 938] and detect.block_size(10**8, 10) == 4_096
    values = np.random.default_rng(3).normal(size=(900, 4)).astype("float32")
    df = spark.createDataFrame([("r", k, v.tolist()) for k, v in enumerate(values)], "f string, id long, v array<float>")
    blocks = detect._blocks(detect.indexed(df, ["f"], "id", "v"), ["f"], 300, "array<float>")
    assert "_vector: array<float>" in blocks.schema["_members"].dataType.simpleString().replace("_vector:", "_vector: ")
    gap = values[:, None].astype(float) - values[None].astype(float)
    near = (gap**2).sum(-1) <= 0.36
    core = near.sum(1) >= 4
    expected = {k for k in range(900) if not core[k] and not (near[k] & core).any()}
    assert {r["id"] for r in detect.noise_points(df, ["f"], "id", "v", 0.6, 4, block=300).collect()} == expected and expected
