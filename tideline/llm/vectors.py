"""Vectors in columns: which take part, their integer form, and their arrays inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

FURTHEST = float(1 << 50)  # scaled entries beyond +-2 ** 50 count as this, so that they fit a long


def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    fine = F.forall(vector, lambda c: F.coalesce(c.cast("double").between(-1.7976931348623157e308, 1.7976931348623157e308), F.lit(False)))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def integers(vector: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * c) + shift of every entry c, as long."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(FURTHEST)), F.lit(-FURTHEST))).cast("long") + shift)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column whose lists all hold `width` numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
