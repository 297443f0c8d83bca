"""A sample of exact size that depends on the rows alone: those with the least keyed hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import order_statistics


def lane(keys: list[str], seed: int = 0) -> Column:
    """A number of 52 bits from the keys and the seed."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("~")) for k in keys]
    return F.conv(F.substring(F.md5(F.encode(F.concat_ws("|", *parts, F.lit(str(seed))), "UTF-8")), 1, 13), 16, 10).cast("long")


def bottom_k(rows: DataFrame, keys: list[str], k: int, seed: int = 0) -> DataFrame:
    """``k`` rows, or all if there are no more. Neither partitions nor the order of rows matter, and a larger sample holds every smaller one.

    The k-th least hash is found by counting, so nothing is sorted or gathered; of rows with that very hash the first in the order of all
    columns are taken. ``keys`` should tell rows apart: what has equal keys is drawn together."""
    tagged = rows.withColumn("_lane", lane(keys, seed))
    n = tagged.count()
    if n <= k:
        return rows
    if k <= 0:
        return rows.limit(0)
    _, (last,) = order_statistics(tagged, "_lane", [k - 1])
    below, even = tagged.where(F.col("_lane") < int(last)), tagged.where(F.col("_lane") == int(last))
    ordered = even.orderBy(*[F.col(c).asc_nulls_first() for c in rows.columns]).limit(k - below.count())
    return below.unionByName(ordered).drop("_lane")
