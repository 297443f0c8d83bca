"""Exact order statistics of a distributed column: a few passes, each a histogram of the intervals that still hold a wanted rank.

No value is sorted, gathered or held in a buffer: a pass counts equal parts of each interval in the tasks and brings ``PARTS`` counts with their least and greatest value
to the driver, and the part that holds the rank is the next interval. The greatest value of an interval always has a part to itself, so every pass ends with less.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 2048


def order_statistics(df: DataFrame, column: str, ranks: list[int]) -> tuple[int, list[float]]:
    """How many values there are, and those of the given ranks (from 0) in rising order. Nulls and NaN count as no values; values are taken as doubles, so
    longs beyond 2 ** 53 are not told apart. ``df`` is read once a pass and should be a table."""
    x = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    n, low, high = x.agg(F.count(F.lit(1)), F.min("x"), F.max("x")).first()
    wanted = {r: (low, high, 0) for r in ranks}
    if any(not 0 <= r < n for r in ranks):
        raise IndexError(f"ranks {ranks} of {n} values")
    while spans := sorted({(a, b, before) for a, b, before in wanted.values() if a < b}):
        part = lambda a, b: F.floor((F.col("x") / 2 - a / 2) / (b / 2 - a / 2) * PARTS)  # noqa: E731  halves, as the whole span may be beyond doubles
        which = F.coalesce(*(F.when(F.col("x").between(a, b), F.struct(F.lit(i).alias("i"), part(a, b).alias("p"))) for i, (a, b, _) in enumerate(spans)))
        rows = x.select("x", which.alias("w")).where("w is not null").groupBy("w.i", "w.p").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        parts: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r.i, r.p)):
            parts.setdefault(r.i, []).append(r)
        for rank, span in wanted.items():
            if span in spans:
                before = span[2]
                for r in parts[spans.index(span)]:
                    if rank < before + r.n:
                        wanted[rank] = (r.low, r.high, before)
                        break
                    before += r.n
    return n, [wanted[r][0] for r in ranks]


def quantiles(df: DataFrame, column: str, shares: list[float], nearest: bool = False) -> list[float | None]:
    """Of each share: the value between the two ranks about it, in proportion; ``nearest``: the least value that this share of all values does not exceed.
    None without values."""
    n = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    if not n:
        return [None] * len(shares)
    if nearest:
        return order_statistics(df, column, [min(n - 1, max(0, math.ceil(s * n) - 1)) for s in shares])[1]
    places = [s * (n - 1) for s in shares]
    around = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    at = dict(zip(around, order_statistics(df, column, around)[1]))
    return [at[math.floor(p)] + (p - math.floor(p)) * (at[math.ceil(p)] - at[math.floor(p)]) for p in places]
