"""All named queries."""

from __future__ import annotations

from tideline.plans import queries_clean, queries_files, queries_io, queries_profile, queries_rows, queries_series, queries_sheets  # noqa: F401  (registers its queries)
from tideline.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
