"""Embedding whitening (operator 13): covariance of all distinct vectors, its components by QDWH, projections by broadcast.

Three passes over the distinct vectors: exact sums, products centred before they are multiplied, and the
covariance of the whitened vectors. What reaches the driver is as wide as a vector: sums and width x width
products. The components (at most `COMPONENTS` vectors) are broadcast to project every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.qdwh import eigenvectors
from tideline.llm.vectors import integers, matrix, usable
from tideline.llm.words import ship_package

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
_ROUNDING = 1e-13  # eigenvalues up to this part of the trace are taken for zero
_LONG = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """What the fit found. Lists of Python integers hold sums that may pass 64 bits."""

    width: int
    n: int  # distinct vectors
    sums: list[int]
    values: np.ndarray  # eigenvalues of the components, falling, all above zero
    components: np.ndarray  # columns
    trace: float
    identity_error: float

    @property
    def centre(self) -> np.ndarray:
        """Means rounded to integers; differences to them are exact."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the mean lies above `centre`, exact."""
        return [s - self.n * c for s, c in zip(self.sums, self.centre.tolist(), strict=True)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) - np.array(self.rest, float) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the entries of (n * x - S) ** 2, exact; None above 64 bits."""
        offset = x - self.centre
        most = (int(np.abs(offset).max()) + 1) * self.n if len(x) else 0
        if most * most * self.width < _LONG:
            return ((offset * self.n - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((offset.astype(object) * self.n - np.array(self.rest, object)) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact.tolist()]


def quantised(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add `_x`, the integer form of the vectors; rows without a usable vector go, and those of another length than most.

    Of lengths that are equally frequent, the shorter one stays.
    """
    fine = vectors.where(usable(F.col(f"`{vector}`")))
    most = fine.groupBy(F.size(f"`{vector}`").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = most["width"] if most else 0
    return fine.where(F.size(f"`{vector}`") == width).withColumn("_x", integers(F.col(f"`{vector}`"), SCALE, SHIFT))


def _products(distinct: DataFrame, width: int, project) -> np.ndarray:
    """Sum over all rows of the outer products of project(x)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = project(matrix(batch.column(0), width))
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    found = distinct.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j = found.column("i").to_numpy(), found.column("j").to_numpy()
    size = int(i.max()) + 1 if len(i) else 0
    out = np.zeros((size, size))
    out[i, j] = found.column("v").to_numpy()
    return (out + out.T) / 2


def fit(rows: DataFrame, scratch: str) -> Whitening | None:
    """Components of the distinct vectors `_x` of `rows`, which are written below `scratch`, on shared storage; None without rows.

    Components without variance (to double precision) are left out: nothing can be divided by their deviation.
    """
    spark = rows.sparkSession
    ship_package(spark)
    rows.select("_x").distinct().write.parquet(f"{scratch}/distinct")
    distinct = spark.read.parquet(f"{scratch}/distinct")
    first = distinct.select(F.size("_x").alias("width")).first()
    if first is None:
        return None
    width = first["width"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, [0] * width, [0] * width
        for batch in batches:
            x = matrix(batch.column(0), width)
            n += len(x)
            high = [a + b for a, b in zip(high, (x >> 25).sum(axis=0).tolist(), strict=True)]
            low = [a + b for a, b in zip(low, (x & ((1 << 25) - 1)).sum(axis=0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["i", "n", "high", "low"])

    wide = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")]
    found = distinct.mapInArrow(sums, "i int, n long, high long, low long").groupBy("i").agg(F.sum("n").alias("n"), *wide).orderBy("i").collect()
    n, totals = found[0]["n"], [(int(r["high"]) << 25) + int(r["low"]) for r in found]
    none = np.zeros((width, 0))
    known = Whitening(width, n, totals, np.zeros(0), none, 0.0, 0.0)
    covariance = _products(distinct, width, known.centred) / n
    trace = float(np.trace(covariance))
    values, vectors = eigenvectors(covariance)
    kept = int((values[:COMPONENTS] > _ROUNDING * trace).sum())
    known = Whitening(width, n, totals, values[:kept], vectors[:, :kept], trace, 0.0)
    if not kept:
        return known
    # The whitened vectors' mean is zero but for rounding, so these products are centred.
    error = np.abs(_products(distinct, width, known.whitened) / n - np.eye(kept)).max()
    return Whitening(width, n, totals, values[:kept], vectors[:, :kept], trace, float(error))


def with_components(rows: DataFrame, found: Whitening | None, key: str) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): every row of `rows` (`_x`) on every component.

    `deviation` is null where it passes 64 bits. Without a fit, or where all vectors are equal, there are no components and so no rows.
    """
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(found)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        kept = len(fitted.values) if fitted is not None else 0
        for batch in batches:
            if not kept or not batch.num_rows:
                continue
            x = matrix(batch.column(1), fitted.width)
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), kept)))
            deviation = pa.array(fitted.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), kept)))
            numbers, shares = np.tile(np.arange(1, kept + 1), len(x)), np.tile(fitted.values / fitted.trace, len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array(numbers, pa.int32()),
                    pa.array(np.full(len(numbers), fitted.n), pa.int64()),
                    deviation,
                    pa.array(fitted.whitened(x).ravel()),
                    pa.array(shares),
                    pa.array(np.full(len(numbers), fitted.identity_error)),
                ],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema[key].dataType.simpleString()
    shape = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select(F.col(f"`{key}`").alias("key"), "_x").mapInArrow(project, shape).withColumnRenamed("key", key)


def whiten(vectors: DataFrame, scratch: str, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Whitened coordinates of all usable rows of `vectors`, in long form; see `with_components`.

    Null vectors, empty ones and those with null or non-finite entries are left out, as are vectors of another length than most.
    A null key stays null; repeated rows are each returned, but count once in the fit. Other columns play no part.
    Entries beyond +-2 ** 50 after scaling count as that bound.
    """
    rows = quantised(vectors.select(F.col(f"`{key}`").alias(key), F.col(f"`{vector}`").alias(vector)), vector)
    return with_components(rows, fit(rows, scratch), key)
