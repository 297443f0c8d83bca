"""Sharding by fixed virtual slots.

Every record hashes into one of ``slots`` virtual slots, which never changes. Bytes are summed for each slot, and a
versioned map says which shard holds each slot. Rebalancing edits the map and moves whole slots; no record is hashed anew.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLOTS = 4096
MAP = "virtual_slot int, shard int, bytes long, rows long, version int"


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of each record. Null text: size 1, CRC 0. Rows with null ids are dealt by their text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64(F.col("doc_id").cast("long"))), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(totals: DataFrame, shards: int) -> DataFrame:
    """Version 1: slots by falling bytes, each to the shard that holds least so far. ``totals`` has a row a slot at most."""
    held = [(0, 0, s) for s in range(shards)]
    out = []
    for slot, size, rows in sorted(totals.select("virtual_slot", "bytes", "rows").collect(), key=lambda r: (-r[1], r[0])):
        b, n, s = heapq.heappop(held)
        out.append((slot, s, size, rows, 1))
        heapq.heappush(held, (b + size, n + rows, s))
    return totals.sparkSession.createDataFrame(out, MAP)


def grow_map(slot_map: DataFrame) -> DataFrame:
    """The next version with one more shard: slots move only into the new shard, until it holds its share of the bytes."""
    rows = [tuple(r) for r in slot_map.collect()]  # a row a slot at most
    if not rows:
        return slot_map
    new, version = max(r[1] for r in rows) + 1, max(r[4] for r in rows) + 1
    held: dict[int, int] = {}
    for _, s, b, _, _ in rows:
        held[s] = held.get(s, 0) + b
    share, got, moved = sum(held.values()) / (new + 1), 0, set()
    for slot, s, b, _, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
        if held[s] - b >= share - b / 2 and got + b <= share + b / 2:
            held[s] -= b
            got += b
            moved.add(slot)
    return slot_map.sparkSession.createDataFrame([(v, new if v in moved else s, b, n, version) for v, s, b, n, _ in rows], MAP)


def rebalance_map(slot_map: DataFrame, totals: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """The next version for new slot totals: slots leave the fullest shard for the emptiest until all lie within ``tolerance`` of the mean."""
    size = {r[0]: (r[1], r[2]) for r in totals.select("virtual_slot", "bytes", "rows").collect()}
    rows = [tuple(r) for r in slot_map.collect()]
    if not rows:
        return slot_map
    at = {r[0]: r[1] for r in rows}
    shards = range(max(at.values()) + 1)
    for v in size:
        at.setdefault(v, v % len(shards))
    held = {s: sum(size.get(v, (0, 0))[0] for v, t in at.items() if t == s) for s in shards}
    mean = sum(held.values()) / len(shards)
    for _ in range(len(at)):
        full, empty = max(shards, key=lambda s: (held[s], -s)), min(shards, key=lambda s: (held[s], s))
        if held[full] <= mean * (1 + tolerance) and held[empty] >= mean * (1 - tolerance):
            break
        gap = held[full] - held[empty]
        fit = [v for v, s in at.items() if s == full and 0 < size.get(v, (0, 0))[0] < gap]
        if not fit:
            break
        v = min(fit, key=lambda v: (abs(size[v][0] - gap / 2), v))
        at[v] = empty
        held[full] -= size[v][0]
        held[empty] += size[v][0]
    version = max(r[4] for r in rows) + 1
    return slot_map.sparkSession.createDataFrame([(v, s, *size.get(v, (0, 0)), version) for v, s in sorted(at.items())], MAP)


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """shard and slot of each record. ``slot`` numbers a shard's records from 0 without a gap.

    Rows are ranked within their virtual slot only; a slot's first number is the rows of the slots before it in its shard.
    The map has a row a virtual slot, so its side of the join has a bounded size."""
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    firsts = slot_map.select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        records.withColumn("rank", rank)
        .join(F.broadcast(firsts), "virtual_slot")
        .withColumn("slot", (F.col("first") + F.col("rank") - 1).cast("long"))
        .drop("first", "rank")
    )
