"""What the corpus operators share: reading tables, cutting lineage, hashing text with numpy, bounded bitmaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..stored import stored
from ..workers import portable

_M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Only the named columns of a table, so that other columns can't clash with an operator's own."""
    bound_arrow_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def bound_arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts can be long: what a Python worker holds at once is kept to ``rows`` rows."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back. The table goes when the application ends; results may read it until then."""
    bound_arrow_batches(df.sparkSession)
    return stored(df, name)


def buckets_for(df: DataFrame, least: int, bytes_each: int, most: int = 1 << 15) -> int:
    """How many buckets hold ``df`` with about ``bytes_each`` of its files in each; sources of unknown size get ``least``.

    The size is the planner's, which takes it from the files; nothing is read."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return least if size > 1 << 58 else min(most, max(least, -(-size // bytes_each)))


def release_memory() -> None:
    """Gives freed memory back to the system; Python workers outlive their tasks and are used again."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mapped(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow whose tasks leave no freed memory behind; for ``df.transform``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(it)
        finally:
            release_memory()

    return df.mapInArrow(portable(run), schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def batches(it: Iterator[pa.RecordBatch], max_bytes: int, weigh: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the named column of each holds about ``max_bytes`` at most, one row at least."""
    for batch in it:
        col = batch.column(batch.schema.get_field_index(weigh))
        if batch.num_rows == 0:
            continue
        sizes = np.nan_to_num(np.asarray(pc.binary_length(col).to_numpy(zero_copy_only=False), dtype=np.float64))
        group = np.floor(np.cumsum(sizes + 64) / max_bytes).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit lanes: multiply and shift, twice."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def random_lanes(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit lanes from a seed; the same in every process."""
    return mix64(mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & _M64)))


# Segment hashing: the prefix sums of T[byte] * R^i give each word's hash in O(1), whatever its length.
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_BYTE = random_lanes(11, 256)
_ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        for k, base in enumerate((_R, _R_INV)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes and the starts and ends of the words: maximal runs of anything but space and \\x09-\\x0D."""
    a = np.frombuffer(data, np.uint8)
    gap = np.ones(len(a) + 2, np.bool_)
    np.logical_or(a == 32, (a >= 9) & (a <= 13), out=gap[1:-1])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return a, edges[0::2], edges[1::2]


def word_hashes(data: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of UTF-8 bytes (A-Z lower-cased), with the words' starts and ends."""
    a, s, e = word_spans(data.translate(_ASCII_LOWER) if lower else data)
    if not len(s):
        return np.empty(0, np.uint64), s, e
    up, down = _power_tables(len(a))
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE[a] * up[: len(a)], out=sums[1:])
    return mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)), s, e


_SHINGLE = random_lanes(23, 64) | np.uint64(1)


def shingle_hashes(words: np.ndarray, width: int = 5) -> np.ndarray:
    """A hash for each run of ``width`` words, in text order; fewer words make one shingle, none make none."""
    n = len(words)
    if n == 0:
        return words
    if n < width:
        return mix64(np.array([int((words * _SHINGLE[:n]).sum(dtype=np.uint64)) + n & _M64], np.uint64))
    z = words[: n - width + 1] * _SHINGLE[0]
    for k in range(1, width):
        z = z + words[k : n - width + 1 + k] * _SHINGLE[k]
    return mix64(z)


def batch_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts of a batch, in order, and where each text's words begin (and the last one's end)."""
    parts = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
    starts = np.cumsum([0, *(len(x) + 1 for x in parts)])
    h, s, _ = word_hashes(b"\n".join(parts), lower)
    return h, np.searchsorted(s, starts)


def batch_shingles(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_hashes`` of all texts of a batch at once, and where each text's begin."""
    n = np.diff(first)
    many = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    begin = np.concatenate(([0], np.cumsum(many)))
    out = np.empty(begin[-1], np.uint64)
    short = np.flatnonzero((n > 0) & (n < width))
    whole = np.ones(len(out), np.bool_)
    whole[begin[short]] = False
    if len(words) >= width:
        z = words[: len(words) - width + 1] * _SHINGLE[0]
        for k in range(1, width):
            z = z + words[k : len(words) - width + 1 + k] * _SHINGLE[k]
        out[whole] = mix64(z[(np.arange(len(words)) + width <= np.repeat(first[1:], n))[: len(z)]])
    for k in range(1, width):
        at = short[n[short] == k]
        if len(at):
            rows = words[first[at][:, None] + np.arange(k)]
            out[begin[at]] = mix64((rows * _SHINGLE[:k]).sum(axis=1, dtype=np.uint64) + np.uint64(k))
    return out, begin


def bitmap_bits(count: int, least: int = 1 << 20, most: int = 1 << 28) -> int:
    """A power of two with 32 bits or more a key, between ``least`` and ``most`` (32 MB)."""
    return min(most, max(least, 1 << max(0, count * 32 - 1).bit_length()))


def bitmap_of(df: DataFrame, lane: Column, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits, set where ``lane`` (a long) falls; its size is bounded, whatever the rows' number.

    It may only be used where a false positive costs time and nothing else."""
    at = df.select(F.pmod(lane, F.lit(bits)).alias("at"))
    rows = at.groupBy(F.floor(F.col("at") / 32768).alias("k")).agg(
        F.expr("bitmap_construct_agg(cast(at % 32768 as bigint))").alias("m")
    )
    out = np.zeros(bits // 8, np.uint8)
    for k, m in rows.collect():  # bits / 32768 rows of 4 KB at most
        out[k * 4096 : (k + 1) * 4096] = np.frombuffer(bytes(m), np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    at = lanes.astype(np.int64) % np.int64(len(bitmap) * 8)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
