import plain
from pyspark.sql import functions as F

from pluvio.llm import queries, sharding


def test_query(spark, documents):
    rows = queries.op10_virtual_slots(spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(docs)
    held, slots = {}, {}
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(docs[r.doc_id]) + 1, plain.crc(docs[r.doc_id]), "bytes", None)
        held[r.shard] = held.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.rebalanced_shard in (r.shard, 8)
    assert set(held) == set(range(8)) and max(held.values()) <= 1.02 * min(held.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_maps(spark):
    records = spark.range(20000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    r = sharding.with_slots(records, 512).cache()
    totals = sharding.slot_totals(r)
    one = sharding.first_map(totals, 8)
    two = sharding.grow_map(one)
    a, b = ({x.virtual_slot: x for x in m.collect()} for m in (one, two))
    assert {x.version for x in a.values()} == {1} and {x.version for x in b.values()} == {2}
    assert all(b[v].shard in (a[v].shard, 8) for v in a)
    held = {}
    for x in b.values():
        held[x.shard] = held.get(x.shard, 0) + x.bytes
    assert len(held) == 9 and max(held.values()) <= 1.1 * min(held.values())
    heavier = totals.withColumn("bytes", F.when(F.col("virtual_slot") % 8 == 0, F.col("bytes") * 3).otherwise(F.col("bytes")))
    three = {x.virtual_slot: x for x in sharding.rebalance_map(one, heavier).collect()}
    held = {}
    for x in three.values():
        held[x.shard] = held.get(x.shard, 0) + x.bytes
    assert max(held.values()) <= 1.05 * min(held.values()) and sum(three[v].shard == a[v].shard for v in a) > 256


def test_odd_rows(spark, odd, empty):
    r = sharding.with_slots(odd)
    m = sharding.first_map(sharding.slot_totals(r), 3)
    placed = sharding.place(r, m).collect()
    assert len(placed) == odd.count() and sum(x.size == 1 and x.text_crc32 == 0 for x in placed) == 3
    for s in {x.shard for x in placed}:
        assert sorted(x.slot for x in placed if x.shard == s) == list(range(sum(x.shard == s for x in placed)))
    e = sharding.with_slots(empty)
    m = sharding.first_map(sharding.slot_totals(e), 3)
    assert sharding.place(e, m).count() == 0 and sharding.grow_map(m).count() == 0
