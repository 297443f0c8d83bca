"""Embedding whitening: covariance by ``RowMatrix`` over exactly centred rows, local eigenvectors, whitening in tasks.

Entries become whole numbers, so the sums are exact, and so is ``n * x - S``; divided by n it gives a row that is centred before it is multiplied. The
Gramian of these rows over n is the covariance. Its eigenvectors are found on the driver, as its size is that of one vector squared, and go to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped

STEP, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Eigenvalues below this share of the largest are rounding.
NOUGHT = 1e-11
LONG = (1 << 63) - 1
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def whole_rows(vectors: DataFrame) -> DataFrame:
    """vec_id and x: floor(64 c) + 1000000 of every entry c, as longs, of the vectors that have no null and no non-finite entry.

    Entries of 2 ** 56 and more, for which x is no exact long, count as non-finite. A table has one dimension: the commonest length, the greater of
    equals; vectors of other lengths, like empty ones, are left out."""
    c = F.col("embedding")
    fine = vectors.where(c.isNotNull() & (F.size(c) > 0) & ~F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) >= float(1 << 56))))
    lengths = fine.groupBy(F.size(c).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = lengths[0].d if lengths else 0
    return fine.where(F.size(c) == d).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(c, lambda e: F.floor(e.cast("double") * STEP).cast("long") + SHIFT).alias("x"))


def _matrix(column: pa.ListArray, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def exact_sums(rows: DataFrame) -> tuple[int, list[int], int, int]:
    """How many rows, the sum of each dimension, the least and the greatest entry. Tasks add up their own; a row a dimension is collected."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, least, most = 0, None, 0, 0
        for batch in it:
            if batch.num_rows:
                x = _matrix(batch.column(0), batch.num_rows)
                low, high = int(x.min()), int(x.max())
                part = (x if max(-low, high) * len(x) < LONG else x.astype(object)).sum(axis=0).astype(object)
                n, total, least, most = n + len(x), part if total is None else total + part, min(low, least) if n else low, max(high, most) if n else high
        if n:
            d = len(total)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0)), pa.array([least] * d, pa.int64()), pa.array([most] * d, pa.int64())], names=["dim", "n", "total", "least", "most"])

    parts = rows.select("x").transform(mapped, run, "dim int, n long, total decimal(38,0), least long, most long")
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most")).orderBy("dim").collect()
    if not found:
        return 0, [], 0, 0
    return found[0].n, [int(r.total) for r in found], min(r.least for r in found), max(r.most for r in found)


class Whitener:
    """n, sums, eigenvalues (falling), weights (dimension x components), shares of the variance; ``narrow``: n * x - S fits into longs."""

    def __init__(self, n: int, sums: list[int], least: int, most: int) -> None:
        self.n, self.sums = n, sums
        self.narrow = 2 * n * max(abs(least), abs(most), 1) < LONG
        self.values, self.weights, self.shares = np.empty(0), np.empty((len(sums), 0)), np.empty(0)

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        if self.narrow:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.offsets(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int]:
        d = self.offsets(x)
        top = int(np.abs(d).max()) if d.size else 0
        return [int(v) for v in ((d if top * top * d.shape[1] <= LONG else d.astype(object)) ** 2).sum(axis=1)]

    def eigen(self, covariance: np.ndarray, components: int) -> None:
        """Falling eigenvalues, without those that are nought up to rounding; of each vector the greatest entry is positive."""
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        keep = np.flatnonzero(values > max(values[0], 0) * NOUGHT)[:components]
        vectors = vectors[:, keep]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
        self.values, self.weights = values[keep], vectors / np.sqrt(values[keep])
        self.shares = values[keep] / np.trace(covariance)


def _vectors(rows: DataFrame, make) -> DataFrame:
    """One column of MLlib vectors, ``make`` of the entries of many rows."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                out = make(_matrix(batch.column(0), batch.num_rows))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32), out.ravel())], names=["v"])

    arrays = rows.select("x").transform(mapped, run, "v array<double>")
    return MLUtils.convertVectorColumnsFromML(arrays.select(array_to_vector("v").alias("v")), "v")


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener:
    """The whitening of ``whole_rows``; without rows, or where all are equal, it has no component."""
    w = Whitener(*exact_sums(rows))
    if w.n:
        gram = RowMatrix(_vectors(rows, w.centred), w.n, len(w.sums)).computeGramianMatrix().toArray()
        if np.trace(gram) > 0:
            w.eigen(gram / w.n, components)
    return w


def identity_error(rows: DataFrame, w: Whitener) -> float:
    """The largest absolute entry of the whitened rows' covariance (divisor n, centred before multiplying) minus the identity."""
    k = len(w.values)
    if not k or w.n < 2:
        return 0.0
    c = RowMatrix(_vectors(rows, lambda x: w.centred(x) @ w.weights), w.n, k).computeCovariance().toArray()
    return float(np.abs(c * ((w.n - 1) / w.n) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact: a row for each remaining vector and component.

    deviation is null where the exact number, which deviation_exact has, is no long. Components are numbered from 1 by falling eigenvalue; those whose
    eigenvalue is nought have no rows, so equal vectors alone, a single vector and an empty table give none. Repeated rows count and return as often as
    they stand; null ids stay; other columns are not carried along. Broadcast are the weights: a vector's length times the components."""
    spark = vectors.sparkSession
    rows = whole_rows(vectors)
    w = fit(rows, components)
    k = len(w.values)
    if not k:
        return spark.createDataFrame([], RESULT)
    error = identity_error(rows, w)
    sent = spark.sparkContext.broadcast(w)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in it:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), batch.num_rows)
            m = len(x)
            exact = w.deviations(x)
            each = np.repeat(np.arange(m), k)
            columns = [
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)),
                pa.array([v if v <= LONG else None for v in exact], pa.int64()).take(pa.array(each)), pa.array((w.centred(x) @ w.weights).ravel()), pa.array(np.tile(w.shares, m)), pa.array(np.full(m * k, error)),
                pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0)).take(pa.array(each)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return rows.transform(mapped, run, RESULT)
