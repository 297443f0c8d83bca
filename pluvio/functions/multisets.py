"""Counted multisets: each value once, with how often it occurs. They merge by adding counts, across tasks, sessions and radii, and are taken apart by
negative counts; medians and deviations of the merged ones are exact."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count(rows: DataFrame, keys: list[str], value: str, n: str = "n") -> DataFrame:
    """A row for each value of a key; counts are added up in tasks before rows are exchanged. ``rows`` may have counts of their own."""
    many = F.sum(n) if n in rows.columns else F.count(F.lit(1))
    return rows.groupBy(*keys, value).agg(many.cast("bigint").alias(n))


def merge(*sets: DataFrame, keys: list[str], value: str, n: str = "n") -> DataFrame:
    """Several tables of counted values, such as those of two sessions, as one; values whose counts cancel out go."""
    whole = sets[0]
    for s in sets[1:]:
        whole = whole.unionByName(s)
    return count(whole, keys, value, n).where(F.col(n) != 0)


def pack(counted: DataFrame, keys: list[str], slot: str, value: str, n: str = "n") -> DataFrame:
    """keys and ``entries``, an array of (slot, v, n): as long as a key has different values, not as it has reports."""
    entry = F.struct(F.col(slot).cast("int").alias("slot"), F.col(value).cast("double").alias("v"), F.col(n).cast("bigint").alias("n"))
    return counted.groupBy(*keys).agg(F.collect_list(entry).alias("entries"))


def _order(slot: np.ndarray, v: np.ndarray) -> np.ndarray:
    """By slot, then value; slots are small numbers, which are dealt out rather than compared."""
    order = np.argsort(v)
    return order[np.argsort(slot[order].astype(np.int16), kind="stable")]


def _sorted(slot: np.ndarray, v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By slot and value, equal ones added up; what cancels out goes, what stays below zero is an error."""
    some = n != 0
    slot, v, n = slot[some], v[some], n[some]
    order = _order(slot, v)
    slot, v, n = slot[order], v[order], n[order]
    if not len(slot):
        return slot, v, n
    first = np.flatnonzero(np.append(True, (slot[1:] != slot[:-1]) | (v[1:] != v[:-1])))
    n = np.add.reduceat(n, first)
    if (n < 0).any():
        raise ValueError("more was taken from a multiset than it holds")
    return slot[first][n > 0], v[first][n > 0], n[n > 0]


def _middles(slot: np.ndarray, v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where slots begin, how much each holds, and its median; sorted entries of positive counts."""
    begin = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.empty(0, np.int64)
    upto = np.cumsum(n)
    before = np.concatenate(([0], upto))[begin]
    many = np.diff(np.append(before, upto[-1] if len(upto) else 0))
    low, high = np.searchsorted(upto, before + (many - 1) // 2, "right"), np.searchsorted(upto, before + many // 2, "right")
    return begin, many, (v[low] + v[high]) / 2


def medians(slot: np.ndarray, v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each slot, rising: its number, count, median, and median distance from the median."""
    slot, v, n = _sorted(slot, v, n)
    begin, many, middle = _middles(slot, v, n)
    away = np.abs(v - np.repeat(middle, np.diff(np.append(begin, len(slot)))))
    order = _order(slot, away)
    return slot[begin], many, middle, _middles(slot[order], away[order], n[order])[2]
