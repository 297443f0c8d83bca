"""Distributes Order MinHash over a corpus: each document meets the next one by ascending doc_id."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, mapped, partitions
from .order_minhash import SPARK_SCHEMA, compare_with_next


def fingerprint_documents(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row a document: its fingerprint, its edited text's, and its likeness to that and to the next document.

    Ids are cut into ranges of about equal counts; an id (or null) that fills several ranges is cut further by the hash of its texts. The
    first document of a range also goes to the range before it (after the last range: the first), so the texts are shuffled once
    and no task sees more than a range. Only the ranges' bounds come to the driver. Null text: empty. Null ids come first; equal ids are
    ordered by their texts' hash, then by text. A single document follows itself. An empty table gives an empty result."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    key, mark = F.coalesce(F.col("doc_id"), F.lit(-(2**63))), F.xxhash64("text")
    n = buckets or buckets_for(docs, max(2, 2 * partitions(spark)), 16 << 20, 1 << 13)
    quantiles = rows.select(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n).alias("q")).first().q
    if quantiles is None:
        return spark.createDataFrame([], SPARK_SCHEMA)
    times = Counter(quantiles)
    cuts = sorted(times)
    before = [sum(times[c] for c in cuts[:i]) for i in range(len(cuts) + 1)]
    # the range is the number of cuts below the key: a binary search in the sorted cuts; rows of a cut that occurs m times are dealt to m ranges
    place = F.expr(_search("key", cuts)) if cuts else F.lit(0)
    at = lambda values: F.get(F.array(*map(F.lit, values)), F.col("place"))
    part = F.floor((F.col("mark") / float(1 << 64) + 0.5) * F.col("times"))
    within = F.when((F.col("key") == F.col("cut")) & (F.col("times") > 1), F.least(F.greatest(part, F.lit(0)), F.col("times") - 1)).otherwise(0)
    dealt = rows.withColumn("key", key).withColumn("mark", mark).withColumn("place", place.cast("int"))
    dealt = dealt.withColumn("cut", at([*cuts, None]) if cuts else F.lit(None).cast("long")).withColumn("times", at([*(times[c] for c in cuts), 1])).withColumn("before", at(before))
    dealt = dealt.select("doc_id", "text", "key", "mark", (F.col("before") + within).cast("int").alias("bucket"))
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("key", "mark")).alias("first")).orderBy("bucket").collect()  # a row a range
    pairs = spark.createDataFrame([(r.first.key, r.first.mark, firsts[i - 1].bucket) for i, r in enumerate(firsts)], "key long, mark long, halo_of int")
    halo = dealt.join(F.broadcast(pairs), ["key", "mark"]).groupBy("halo_of").agg(F.min_by(F.struct("doc_id", "text", "key", "mark"), "text").alias("row"))
    both = dealt.select("bucket", F.lit(0).alias("halo"), "doc_id", "text", "key", "mark").unionByName(halo.select(F.col("halo_of").alias("bucket"), F.lit(1).alias("halo"), "row.*"))
    return both.repartition(n, "bucket").sortWithinPartitions("bucket", "halo", "key", "mark", "text").drop("key", "mark").transform(mapped, compare_with_next, SPARK_SCHEMA)


def _search(name: str, cuts: list[int]) -> str:
    """SQL for the number of cuts below a value, as a balanced tree of comparisons."""

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"if({name} <= {_literal(cuts[mid])}, {tree(lo, mid)}, {tree(mid + 1, hi)})"

    return tree(0, len(cuts))


def _literal(value: int) -> str:
    return f"{value}L" if value > -(2**63) else "(-9223372036854775807L - 1L)"
