import random

import plain
import pytest

from pluvio.llm import jaccard_join as j


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = sorted(zip([d for d, _ in rows], plain.components(rows)), key=str)
    got = sorted(((r.doc_id, (r.n_shingles, r.component_id, r.n_links)) for r in j.join(df).collect()), key=str)
    assert got == want


def test_documents(documents):
    check(documents)


@pytest.mark.parametrize(("region", "tile", "pivots"), [(4, 2, 2), (6, 3, 4)])
def test_recursion_and_tiles(documents, monkeypatch, region, tile, pivots):
    for k, v in (("REGION", region), ("TILE", tile), ("PIVOTS", pivots)):
        monkeypatch.setattr(j, k, v)
    check(documents)


def test_a_crowd_of_near_copies(spark, monkeypatch):
    for k, v in (("REGION", 12), ("TILE", 5), ("PIVOTS", 3)):
        monkeypatch.setattr(j, k, v)
    rnd = random.Random(1)
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(i % 7):
            w[rnd.randrange(len(w))] = f"v{rnd.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w)))
    rows += [(i, " ".join(f"u{rnd.randrange(10**6)}" for _ in range(40)) + " " + " ".join(base[:30])) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_odd_rows(odd, empty):
    check(odd)
    assert j.join(empty).count() == 0


def test_threshold_is_inclusive(spark):
    word = [f"w{i}" for i in range(20)]
    rows = [(1, " ".join(word[:11])), (2, " ".join(word[:12] + ["z"])), (3, " ".join(word[:16])), (4, " ".join(word[4:16]))]  # 7 and 8 of 9; 12 and 8 of 12
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_same_as_sql(spark):
    import compare

    from pluvio.llm import queries

    sf = "/root/testdata/sf0.001"
    assert compare.difference(queries.op1_ngram_jaccard(spark, sf), compare.oracle(sf), queries.ORACLE_SQL["op1_ngram_jaccard"]) == ""


@pytest.mark.parametrize(("buckets", "hub", "hubs"), [(700, 2, 100_000), (3, 2, 0)])
def test_many_buckets_and_hubs(documents, monkeypatch, buckets, hub, hubs):
    """Chunks with fewer postings in a bucket than classes name each posting's class; hubs with and without a table of their own."""
    monkeypatch.setattr(j, "buckets_for", lambda *_: buckets)
    monkeypatch.setattr(j, "HUB", hub)
    monkeypatch.setattr(j, "HUBS", hubs)
    check(documents)


def test_components_of_a_star(spark):
    from pyspark.sql import functions as F

    edges = spark.range(1, 3000).select(F.col("id").alias("u"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") - 1).alias("v"))
    got = j.components(edges)
    assert got.where("root <> 0").count() == 0 and got.select("u").distinct().count() == got.count() == 2999


def test_components_that_are_not_settled_are_an_error(spark, monkeypatch):
    import pytest

    from pluvio.llm import jaccard_join

    edges = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(64)], "u string, v string")
    assert {r.root for r in jaccard_join.components(edges).collect()} == {"0000"}
    monkeypatch.setattr(jaccard_join, "ROUNDS", 3)
    with pytest.raises(RuntimeError, match="not settled"):
        jaccard_join.components(edges)
