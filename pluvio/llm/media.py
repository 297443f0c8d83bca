"""Media columns: content-defined chunking of payloads.

A gear hash rolls over the payload and cuts where its low bits are zero, so that equal passages give equal chunks wherever
they stand. Chunks are known by digest and stored once, and so is an ordered list of chunks; records of equal payloads refer to one
list. Reading follows the list and checks every digest.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, bitmap_bits, bitmap_of, buckets_for, in_bitmap, mapped, materialize, partitions, random_lanes

GEAR = (random_lanes(41, 256) >> np.uint64(32)).astype(np.uint32)
LEAST, MASK, MOST = 2048, np.uint32((1 << 13) - 1 << 19), 65536  # bytes of a chunk: 2 KB, 10 KB on average, 64 KB
UNIT, MAGIC = 64, b"CDC1"
_BATCH_BYTES = 4 << 20


def payload_of(text: str | None) -> tuple[int, bytes]:
    """The bytes of the text, and the payload: padded with zero bytes to a positive multiple of 64."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(data), data + b"\0" * (-len(data) % UNIT if data else UNIT)


def gear_cuts(data: bytes) -> list[int]:
    """The ends of the chunks. The hash of a place covers the 32 bytes up to it."""
    n = len(data)
    if n <= LEAST:
        return [n]
    h = GEAR[np.frombuffer(data, np.uint8)]
    have = 1
    while have < 32:  # the hash over runs of 1, 2, 4, ... 32 bytes
        longer = h.copy()
        longer[have:] += h[:-have] << np.uint32(have)
        h, have = longer, have * 2
    marks = np.flatnonzero((h & MASK) == 0) + 1
    cuts, at = [], 0
    while n - at > LEAST:
        k = np.searchsorted(marks, at + LEAST)
        end = min(int(marks[k]) if k < len(marks) else n, at + MOST, n)
        cuts.append(end)
        at = end
    if at < n:
        cuts.append(n)
    return cuts


def chunks_of(payload: bytes) -> list[bytes]:
    at, out = 0, []
    for end in gear_cuts(payload):
        out.append(payload[at:end])
        at = end
    return out


def manifest_of(parts: list[tuple[bytes, int]]) -> bytes:
    """The ordered chunk list as stored: magic, number of chunks, then digest and length of each."""
    return MAGIC + struct.pack("<I", len(parts)) + b"".join(d + struct.pack("<I", n) for d, n in parts)


def read_manifest(data: bytes) -> list[tuple[bytes, int]]:
    if data[:4] != MAGIC:
        raise ValueError("not a chunk list")
    (n,) = struct.unpack_from("<I", data, 4)
    return [(data[8 + 36 * i : 40 + 36 * i], struct.unpack_from("<I", data, 40 + 36 * i)[0]) for i in range(n)]


def reconstruct(manifest: bytes, store: dict[bytes, bytes]) -> bytes:
    """The payload that a chunk list names; every chunk's length and digest are checked."""
    out = []
    for digest, n in read_manifest(manifest):
        chunk = store[digest]
        if len(chunk) != n or hashlib.sha256(chunk).digest() != digest:
            raise ValueError(f"chunk {digest.hex()} is damaged")
        out.append(chunk)
    return b"".join(out)


def feature_of(payload: bytes) -> str:
    """Sum, entropy in bits to four places, and the four fullest of 16 bands of the samples."""
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    p = counts[counts > 0] / len(payload)
    bands = counts.reshape(16, 16).sum(axis=1)
    top = np.lexsort((np.arange(16), -bands))[:4]
    return f"sum={int((counts * np.arange(256)).sum())};entropy={abs(float(-(p * np.log2(p)).sum())):.4f};bands=" + "-".join(map(str, top))


RESULT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks long, n_shared long"


def _result(doc_id: int | None, n_bytes: int, manifest: bytes, store: dict[bytes, bytes], shared: int) -> tuple:
    import zlib

    payload = reconstruct(manifest, store)
    form = hashlib.sha256(manifest)
    form.update(payload)
    return (doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(manifest) + len(payload), form.hexdigest(), feature_of(payload), len(read_manifest(manifest)), shared)


_READ = f"{RESULT}, list binary"
_ARROW = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in _READ.split(", "))])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW.types)], schema=_ARROW)


def _lane(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _listed(payload: bytes) -> tuple[list[tuple[bytes, bytes]], bytes, int]:
    """Digest and bytes of each chunk, the stored list, and the lane of the list."""
    parts = [(hashlib.sha256(c).digest(), c) for c in chunks_of(payload)]
    manifest = manifest_of([(d, len(c)) for d, c in parts])
    return parts, manifest, _lane(hashlib.sha256(manifest).digest())


_LANES = "lane long, whole boolean, n long, a long, b long, twice boolean, doc long"


def _digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list (``whole``) and chunk in a batch: references, least and greatest list that has it, whether one has it twice, and least document."""
    for batch in batches(it, _BATCH_BYTES):
        seen: dict[tuple[int, bool], list] = {}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parts, _, mine = _listed(payload_of(text)[1])
            doc, lanes = -1 if doc is None else doc, [_lane(d) for d, _ in parts]
            many = Counter(lanes)
            for key in [(mine, True), *((x, False) for x in many)]:
                n = 1 if key[1] else many[key[0]]
                was = seen.get(key, [0, mine, mine, False, doc])
                seen[key] = [was[0] + n, min(was[1], mine), max(was[2], mine), was[3] or n > 1, min(was[4], doc)]
        lane, whole = zip(*seen)
        yield pa.RecordBatch.from_arrays([pa.array(lane, pa.int64()), pa.array(whole), *(pa.array(c) for c in zip(*seen.values()))], [x.split()[0] for x in _LANES.split(", ")])


_STORED = "doc_id long, n_bytes long, key string, list binary, manifest binary, own array<binary>, place int, digest binary, length int, chunk binary"
_STORED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("key", pa.string()), ("list", pa.binary()), ("manifest", pa.binary()), ("own", pa.list_(pa.binary())), ("place", pa.int32()), ("digest", pa.binary()), ("length", pa.int32()), ("chunk", pa.binary())]
)


def _cut(shared: np.ndarray, lists: np.ndarray, owners: np.ndarray):
    """What the store holds: for a payload whose chunks no other list has, its list and its chunks; else a row for each of its chunks. Of equal
    payloads only the owner's is stored, and each has a row that names the list."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, _BATCH_BYTES):
            rows: list[tuple] = []
            for doc_id, text, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n, payload = payload_of(text)
                parts, manifest, mine = _listed(payload)
                name = None
                if in_bitmap(lists, np.array([mine], np.int64))[0]:
                    name = hashlib.sha256(manifest).digest()
                    rows.append((doc_id, n, key, name, None, None, None, None, None, None))
                    if not in_bitmap(owners, np.array([mine ^ (-1 if doc_id is None else doc_id)], np.int64))[0]:
                        continue
                if in_bitmap(shared, np.array([_lane(d) for d, _ in parts], np.int64)).any():
                    rows += [(doc_id, n, key, name, None, None, i, d, len(c), c) for i, (d, c) in enumerate(parts)]
                else:
                    rows.append((doc_id, n, key, name, manifest, [c for _, c in parts], None, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _STORED_ARROW.types)], schema=_STORED_ARROW)

    return run


def store(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Writes every text's payload in chunks: the records, and the chunks that several places refer to (digest, chunk, references), each once.

    Both are tables of the shared folder. Digests alone are counted first; chunks that more than one list (or place of a list) has, lists that more than one record
    has, and the owners of all lists, the least documents, go into bitmaps of bounded size. The payload of a list is stored by its owner; chunks that no other list has are
    stored beside it, all others meet by digest, and one copy stays. A false positive stores a payload once more, or sends its chunks that way, and changes nothing else."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    each = rows.transform(mapped, _digests, _LANES).groupBy("lane", "whole")
    lanes = each.agg(F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"), F.max("twice").alias("twice"), F.min("doc").alias("doc"))
    lanes = materialize(lanes.where("whole or a < b or twice").select("lane", "whole", "doc", "n"), "shared_digests")
    bits = bitmap_bits(lanes.count())
    lists = lanes.where("whole")
    # every list has an owner there, so a payload is left out only where another record surely stores it
    maps = bitmap_of(lanes.where("not whole"), F.col("lane"), bits), bitmap_of(lists.where("n > 1"), F.col("lane"), bits), bitmap_of(lists, F.col("lane").bitwiseXOR(F.col("doc")), bits)
    keyed = rows.withColumn("key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.spark_partition_id(), F.monotonically_increasing_id()))
    records = materialize(keyed.transform(mapped, _cut(*maps), _STORED), "media")
    sent = records.where(F.col("place").isNotNull())
    # written before it is joined, so that both sides of the join are plain exchanges and a hot chunk's partition can be split
    chunks = materialize(sent.groupBy("digest").agg(F.first("chunk").alias("chunk"), F.count(F.lit(1)).alias("references")), "chunk_store")
    return records, chunks


def read_back(records: DataFrame, chunks: DataFrame) -> DataFrame:
    """Payloads rebuilt from the store, every chunk checked, and their features. A missing or damaged chunk fails each record that uses it."""
    stored = records.where(F.col("manifest").isNotNull()).select("doc_id", "n_bytes", "manifest", "own", "list").transform(mapped, _read_own, _READ)
    places = records.where(F.col("place").isNotNull()).select("doc_id", "n_bytes", "key", "list", "place", "digest", "length")
    fetched = places.join(chunks, "digest", "left")
    n = buckets_for(records, max(8, partitions(records.sparkSession)), 8 << 20)
    rebuilt = fetched.select("key", "doc_id", "n_bytes", "place", "digest", "length", "chunk", "references", "list").repartition(n, "key").sortWithinPartitions("key", "place").transform(mapped, _rebuild, _READ)
    read = materialize(stored.unionByName(rebuilt), "media_read")
    columns = [x.split()[0] for x in RESULT.split(", ")]
    named = records.where(F.col("list").isNotNull() & F.col("manifest").isNull() & F.col("place").isNull()).select("doc_id", "n_bytes", "list")
    once = read.where(F.col("list").isNotNull()).groupBy("list").agg(F.first(F.struct(*columns[2:])).alias("x"), F.max("list").alias("found"))
    many = named.groupBy("list").agg(F.count(F.lit(1)).alias("many"))
    whole = F.when(F.col("found").isNull(), F.raise_error(F.lit("a chunk list is damaged or missing")).cast("long")).otherwise(F.col("x.payload_bytes"))
    equal = named.join(once.join(many, "list"), "list", "left")
    return read.where(F.col("list").isNull()).select(*columns).unionByName(equal.select("doc_id", "n_bytes", whole.alias("payload_bytes"), *(f"x.{c}" for c in columns[3:-1]), F.when(F.col("many") > 1, F.col("x.n_chunks")).otherwise(F.col("x.n_shared")).alias("n_shared")))


def store_and_read(docs: DataFrame) -> DataFrame:
    """Stores every text's payload as chunks, each distinct chunk once, reads all of them back and computes features.

    media_bytes and media_sha256 are those of the stored form: the ordered chunk list, then the chunks in its order. Null text: empty. Empty payloads are 64
    zero bytes. Equal texts give equal values; rows with equal or null ids are kept apart by a key. An empty table gives an empty result."""
    return read_back(*store(docs))


def _read_own(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        out = []
        each = (x.as_py() for x in batch.column(3))  # one payload's chunks at a time, however long the others are
        for doc_id, n, manifest, own, name in zip(*(batch.column(i).to_pylist() for i in range(3)), each, batch.column(4).to_pylist()):
            listed = read_manifest(manifest)
            if len(listed) != len(own):
                raise ValueError(f"{len(listed)} chunks are listed, {len(own)} are stored")
            out.append(_result(doc_id, n, manifest, {d: c for (d, _), c in zip(listed, own)}, 0) + (name,))
        yield _rows(out)


def _rebuild(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and place: a record's chunks follow each other."""
    key, head, name, parts, shared, out = None, None, None, [], 0, []

    def close() -> None:
        manifest = manifest_of([(d, n) for d, n, _ in parts])
        out.append(_result(*head, manifest, {d: c for d, _, c in parts}, shared) + (name,))

    for batch in it:
        for k, doc, n_bytes, _, digest, length, chunk, refs, of in zip(*(batch.column(i).to_pylist() for i in range(9))):
            if k != key:
                if key is not None:
                    close()
                key, head, name, parts, shared = k, (doc, n_bytes), of, [], 0
            parts.append((digest, length, chunk if chunk is not None else b""))
            shared += (refs or 0) > 1
        if len(out) >= 500:
            yield _rows(out)
            out = []
    if key is not None:
        close()
    if out:
        yield _rows(out)
