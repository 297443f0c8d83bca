"""Helpers for semantics that Spark spells differently: latest rows, deterministic arg max, optional ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row a key, the first in ``order``; a window group limit keeps the shuffle small."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def arg_max(payload: Column, value: Column, tie: Column, where: Column) -> Column:
    """Aggregate: the payload of the highest value, of equals the one with the least ``tie``; null payloads don't count."""
    usable = where & payload.isNotNull() & value.isNotNull()
    return F.min_by(payload, F.when(usable, F.struct((-value).alias("v"), tie.alias("t"))))


def between_ids(df: DataFrame, column: str, start: int | None, end: int | None) -> DataFrame:
    """An inclusive range, open where a bound is None; it reaches the scan."""
    if start is not None:
        df = df.where(F.col(column) >= start)
    if end is not None:
        df = df.where(F.col(column) <= end)
    return df


def newest(df: DataFrame, column: str) -> int | None:
    return df.agg(F.max(column)).first()[0]


def part_of(df: DataFrame, order: Sequence[str], size: int, start: int = 0) -> DataFrame:
    """``size`` rows from place ``start`` on (from 0), in an order that must be total for the same rows on each run."""
    return df.orderBy(*order).offset(start).limit(size)


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """``run``: numbers from 1, within the keys, the stretches of consecutive rows with one value; null is a value like others."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = (F.row_number().over(w) == 1) | ~F.lag(value).over(w).eqNullSafe(F.col(value))
    return df.withColumn("_first", first.cast("int")).withColumn("run", F.sum("_first").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_first")
