"""Columns over short arrays: medians, hinges, robust scaling. All of them skip nulls and stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once. A column that a lambda merely mentions is computed anew for every element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def present(v: Column) -> Column:
    return F.filter(v, lambda x: x.isNotNull() & ~F.isnan(x))


def _middle(s: Column) -> Column:
    """Median of a sorted array, which is best a bound name; null when empty."""
    n = F.size(s)
    return F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2)


def _ordered(v: Column, f: Callable[[Column], Column]) -> Column:
    return let(F.sort_array(present(v)), f)


def _deviation(s: Column, m: Column) -> Column:
    """Median of the distances of a sorted array's values from m."""
    return let(F.sort_array(F.transform(s, lambda x: F.abs(x - m))), _middle)


def median(v: Column) -> Column:
    return _ordered(v, _middle)


def mad(v: Column) -> Column:
    """Median of absolute deviations from the median."""
    return median_and_mad(v)["mad"]


def median_and_mad(v: Column) -> Column:
    """Both as a struct, from one sorted array; fields are null when nothing is present."""
    return _ordered(v, lambda s: let(_middle(s), lambda m: F.struct(m.alias("median"), _deviation(s, m).alias("mad"))))


def hinges(v: Column) -> tuple[Column, Column]:
    """Lower and upper Tukey hinge: medians of the halves, the middle value left out of both; null below two values."""
    both = _ordered(v, lambda s: let(F.floor(F.size(s) / 2).cast("int"), lambda half: F.struct(
        F.when(half > 0, let(F.slice(s, 1, half), _middle)).alias("low"), F.when(half > 0, let(F.slice(s, F.size(s) - half + 1, half), _middle)).alias("high"))))
    return both["low"], both["high"]


def iqr(v: Column) -> Column:
    low, high = hinges(v)
    return high - low


def median_and_iqr_of_sorted(s: Column) -> tuple[Column, Column]:
    """The median, and the upper less the lower hinge, of a sorted column without nulls and NaN; no lambdas, so all of it is compiled."""
    n = F.size(s)
    half = F.floor(n / 2).cast("int")
    at = lambda i: F.get(s, F.floor(i).cast("int"))
    middle = lambda begin, many: (at(begin + (many - 1) / 2) + at(begin + many / 2)) / 2
    return F.when(n > 0, middle(F.lit(0), n)), F.when(half > 0, middle(n - half, half) - middle(F.lit(0), half))


def _mean(p: Column) -> Column:
    return F.when(F.size(p) > 0, F.aggregate(p, F.lit(0.0), lambda a, x: a + x) / F.size(p))


def mean(v: Column) -> Column:
    return let(present(v), _mean)


def _stdev(p: Column) -> Column:
    squares = let(_mean(p), lambda m: F.aggregate(p, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)))
    return F.when(F.size(p) >= 2, F.sqrt(squares / F.greatest(F.size(p) - 1, F.lit(1))))


def stdev(v: Column) -> Column:
    """Sample standard deviation; null below two values."""
    return let(present(v), _stdev)


def completeness(v: Column) -> Column:
    return F.when(F.size(v) > 0, F.size(present(v)) / F.size(v)).otherwise(0.0)


def robust_scale(v: Column) -> Column:
    """(x - median) / MAD; a MAD of nearly nothing gives way to the deviation, that to one; below two values all null."""
    spread = lambda c: F.struct(c["median"].alias("m"), let(stdev(v), lambda d: F.when(c["mad"] > 1e-9, c["mad"]).when(d > 1e-9, d).otherwise(1.0)).alias("scale"))
    scaled = let(let(median_and_mad(v), spread), lambda c: F.transform(v, lambda x: F.when(x.isNotNull() & ~F.isnan(x), (x - c["m"]) / c["scale"])))
    return F.when(F.size(present(v)) >= 2, scaled).otherwise(F.transform(v, lambda x: F.lit(None).cast("double")))


def all_equal(v: Column) -> Column:
    """Whether all values are one and none is unknown; false for no values at all."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull()) & (F.array_min(v) == F.array_max(v)), F.lit(False))


def zeros(v: Column, missing: int = 12) -> Column:
    """Entries that are exactly zero; an unknown vector counts as all zero."""
    return F.coalesce(F.size(F.filter(v, lambda x: F.coalesce(x == 0, F.lit(False)))), F.lit(missing))


def slots(entries: Column, n: int = 12) -> Column:
    """An array of n from structs of slot and value, with slots from 1; slots without an entry are null, of several the first counts."""
    value = lambda i: F.get(F.filter(entries, lambda e: e["slot"] == i), F.lit(0))["value"]
    return F.transform(F.sequence(F.lit(1), F.lit(n)), value)


def cosine(a: Column, b: Column) -> Column:
    """Over the places where both are finite, in single precision as stored; minus infinity where a length is zero."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    zipped = F.zip_with(a, b, lambda x, y: F.struct(x.alias("a"), y.alias("b")))
    pairs = F.filter(zipped, lambda p: ok(p["a"]) & ok(p["b"]))
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda s, p: s + f(p))
    f32 = lambda x: x.cast("float").cast("double")
    dot, aa, bb = (total(g) for g in (lambda p: f32(p["a"]) * f32(p["b"]), lambda p: f32(p["a"]) * f32(p["a"]), lambda p: f32(p["b"]) * f32(p["b"])))
    return F.when((aa > 0) & (bb > 0), dot / F.sqrt(aa * bb)).otherwise(F.lit(float("-inf")))
