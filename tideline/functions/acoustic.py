"""Spectrum and magnitude expressions over arrays of bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level bands in Hz, lower edge inclusive, upper edge exclusive.
BANDS = {
    "level_0_5_2khz": (500.0, 2_000.0),
    "level_2_10khz": (2_000.0, 10_000.0),
    "level_10_50khz": (10_000.0, 50_000.0),
    "level_50_256khz": (50_000.0, float("inf")),
}


def to_power(level: Column) -> Column:
    return F.pow(F.lit(10.0), level / 10.0)


def to_level(power: Column) -> Column:
    return F.lit(10.0) * F.log10(power)


def usable_bins(spec: Column) -> Column:
    """Bins above 0 Hz that carry a level."""
    return F.filter(spec, lambda b: (b["freq_hz"] > 0) & b["level_db"].isNotNull())


def energetic_sum(spec: Column, low: float | None = None, high: float | None = None) -> Column:
    """10·log10 of the summed power of the bins in [low, high); NULL without any level."""

    def wanted(b: Column) -> Column:
        keep = b["level_db"].isNotNull() & (b["freq_hz"] > 0)
        if low is not None:
            keep = keep & (b["freq_hz"] >= low)
        if high is not None and high != float("inf"):
            keep = keep & (b["freq_hz"] < high)
        return keep

    bins = F.filter(spec, wanted)
    power = F.aggregate(bins, F.lit(0.0), lambda acc, b: acc + to_power(b["level_db"]))
    return F.when(F.size(bins) > 0, to_level(power))


def peak_frequency(spec: Column) -> Column:
    """Frequency of the loudest bin above 0 Hz; of equals, the first in bin order."""
    bins = usable_bins(spec)
    loudest = F.array_max(F.transform(bins, lambda b: b["level_db"]))
    at_peak = F.filter(bins, lambda b: b["level_db"] == loudest)
    return F.try_element_at(at_peak, F.lit(1))["freq_hz"]


def bin_name(freq: Column) -> Column:
    """Column name of a frequency bin, spec_<freq>Hz with the shortest number text."""
    whole = freq == F.floor(freq)
    text = F.when(whole, freq.cast("long").cast("string")).otherwise(freq.cast("string"))
    return F.concat(F.lit("spec_"), text, F.lit("Hz"))


def bin_frequency(name: Column) -> Column:
    return F.regexp_extract(name, r"^spec_(.+)Hz$", 1).try_cast("double")


def ordered_bins(spec: Column) -> Column:
    """Bins by increasing frequency."""
    return F.array_sort(spec)


def aliased_frequency(freq: Column, sample_rate: Column) -> Column:
    """Where a tone shows up after sampling: folded at the Nyquist frequency."""
    folded = F.pmod(freq, sample_rate)
    return F.when(freq <= sample_rate / 2, freq).otherwise(F.least(folded, sample_rate - folded))


def _near(freq: Column, tone: float, tolerance: float) -> Column:
    return (freq >= tone - tolerance) & (freq <= tone + tolerance)


def _square_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x)


def ping_energy_share(bins: Column, tones: list[float], tolerance: float) -> Column:
    """Energy near any of the tones over all energy; a bin near two tones counts twice.

    `bins` is an array of structs (freq_hz, magnitude).
    """

    def energy_near(tone: float) -> Column:
        in_band = F.filter(bins, lambda b: _near(b["freq_hz"], tone, tolerance))
        return _square_sum(F.transform(in_band, lambda b: b["magnitude"]))

    near = F.lit(0.0)
    for tone in tones:
        near = near + energy_near(tone)
    total = _square_sum(F.transform(bins, lambda b: b["magnitude"]))
    return F.when(total > 0, near / total)


def is_ping_by_energy(bins: Column, tones: list[float], tolerance: float, threshold: float) -> Column:
    """Most of the energy sits near the instrument tones; silence is no ping."""
    return F.coalesce(ping_energy_share(bins, tones, tolerance) > threshold, F.lit(False))


def is_ping_by_peak(bins: Column, tones: list[float], tolerance: float, ratio: float) -> Column:
    """A bin near a tone stands out from the mean magnitude by more than `ratio`."""
    magnitudes = F.transform(bins, lambda b: b["magnitude"])
    mean = F.aggregate(magnitudes, F.lit(0.0), lambda acc, x: acc + x) / F.size(bins)

    def stands_out(b: Column) -> Column:
        near = F.lit(False)
        for tone in tones:
            near = near | _near(b["freq_hz"], tone, tolerance)
        return near & (b["magnitude"] > mean * ratio)

    return F.coalesce((mean > 0) & F.exists(bins, stands_out), F.lit(False))


def rms(samples: Column) -> Column:
    return F.sqrt(_square_sum(samples) / F.size(samples))
