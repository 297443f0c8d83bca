"""Document fingerprints by Order MinHash.

A k-mer is numbered by its occurrence, so that repeats are distinct. Each of ``functions`` hash functions selects the
``tuple_size`` smallest numbered k-mers, puts them back in text order and hashes the tuple. Two texts agree in a function
with a probability that falls with their edit distance, since moving a passage changes the order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import mix64, random_lanes

K, FUNCTIONS, TUPLE = 8, 32, 2
_MULTIPLIERS = random_lanes(71, 256) | np.uint64(1)
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def numbered_kmers(points: np.ndarray, k: int = K) -> np.ndarray:
    """A hash for each k-mer and its occurrence number, in text order; a text shorter than k is one k-mer."""
    n = len(points)
    if n == 0:
        return np.empty(0, np.uint64)
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(28)
    width, base, have = min(k, n), int(_BASE), 1
    h = x
    while have * 2 <= width:  # hashes of runs of 1, 2, 4, ... code points
        h = h[:-have] + h[have:] * np.uint64(pow(base, have, 1 << 64))
        have *= 2
    if have < width:
        rest = x
        m = len(x) - width + 1
        total = h[:m].copy()
        for j in range(have, width):
            total += rest[j : j + m] * np.uint64(pow(base, j, 1 << 64))
        h = total
    h = mix64(h)
    s = np.sort(h)
    again = s[1:][s[1:] == s[:-1]]
    if len(again):
        seen = np.zeros(1 << 16, np.bool_)
        seen[(again & np.uint64(0xFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
        order = np.argsort(h[at], kind="stable")
        v = h[at][order]
        first = np.concatenate(([True], v[1:] != v[:-1]))
        start = np.maximum.accumulate(np.where(first, np.arange(len(v)), 0))
        number = (np.arange(len(v)) - start).astype(np.uint64)
        h[at[order]] = mix64(v + number * np.uint64(0x9E3779B97F4A7C15))
    return h


def fingerprint(text: str | None, k: int = K, functions: int = FUNCTIONS, size: int = TUPLE) -> np.ndarray:
    """``functions`` 32-bit tuple hashes; all zero for an empty or null text."""
    h = numbered_kmers(code_points(text or ""), k)
    n = len(h)
    out = np.zeros(functions, np.uint32)
    if n == 0:
        return out
    size = min(size, n)
    at_once = max(1, (1 << 19) // n)
    for f in range(0, functions, at_once):
        many = min(at_once, functions - f)
        ranks = h[None, :] * _MULTIPLIERS[f : f + many, None]
        if n <= 64:
            picked = np.argsort(ranks, axis=1, kind="stable")[:, :size]
        else:
            wanted, picked = 12 * size, None
            limit = np.uint64(min((1 << 64) - 1, (1 << 64) // n * wanted))
            row, col = np.nonzero(ranks < limit)
            counts = np.bincount(row, minlength=many)
            if counts.min() >= size:
                order = np.lexsort((col, ranks[row, col], row))
                first = np.cumsum(counts) - counts
                picked = col[order][first[:, None] + np.arange(size)]
            else:
                picked = np.argsort(ranks, axis=1, kind="stable")[:, :size]
        picked = np.sort(picked, axis=1)  # text order
        t = np.full(many, np.uint64(size))
        for j in range(size):
            t = mix64(t * np.uint64(0x9E3779B97F4A7C15) + h[picked[:, j]])
        out[f : f + many] = (t >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The TUPLE-th root of the share of functions whose tuples agree, since all k-mers of a tuple must be common and in order:
    an estimate of the texts' common share, 1 for equal texts, two empty ones included."""
    return float(np.mean(a == b)) ** (1 / TUPLE)


def to_text(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
SPARK_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, halo, doc_id, text) sorted by bucket, halo, doc_id, text; a row that follows a bucket's last is its halo."""
    import hashlib

    held = None  # bucket, doc_id, text, fingerprint
    rows: list[tuple] = []

    def close(text: str, mark: np.ndarray) -> None:
        _, doc, own, f = held
        e = edited(own, text)
        g = fingerprint(e)
        rows.append((doc, len(own), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), to_text(f), to_text(g), likeness(f, g), likeness(f, mark)))

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA)
        rows.clear()
        return out

    for batch in it:
        for bucket, halo, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text = text or ""
            if halo and (held is None or held[0] != bucket):
                continue  # a later row of the same halo
            mark = fingerprint(text)
            if held is not None and held[0] == bucket:
                close(text, mark)
            held = None if halo else (bucket, doc, text, mark)
            if len(rows) >= 1000:
                yield flush()
    if rows:
        yield flush()
