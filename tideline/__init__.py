"""Sensor time series on Spark: ingest, align, clean, resample, gap and coverage reports."""

__version__ = "0.1.0"
