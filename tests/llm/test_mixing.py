import plain
from pyspark.sql import functions as F

from pluvio.llm import mixing


def check(df, near):
    rows = df.select("doc_id", "text", "source").collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(plain.WORD.findall(r.text or ""))
    want = plain.targets(sizes)
    got = mixing.mix(df).collect()
    assert sorted(r.size for r in got) == sorted(len(plain.WORD.findall(r.text or "")) for r in rows)
    taken = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        key = next(s for s in want if abs(want[s] - r.target) < 1e-6 and sizes[s] == r.source_size)
        taken[key] = taken.get(key, 0) + r.taken
    for s, t in taken.items():
        same = [x for x in want if abs(want[x] - want[s]) < 1e-6 and sizes[x] == sizes[s]]
        assert abs(taken[s] - len(same) * want[s]) <= near * max(1, len(same) * want[s]), s
    return got


def test_documents(documents):
    a = check(documents, 0.1)
    b = mixing.mix(documents.repartition(3)).collect()
    key = lambda r: (r.doc_id, r.taken, r.copies)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_many_documents_come_close(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 90 + 5).cast("int")).alias("text"), F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 2 == 0, F.concat(F.lit("s"), (F.col("id") % 8).cast("string"))).alias("source"))
    check(df, 0.01)


def test_odd_rows(odd, empty):
    check(odd, 1.0)
    assert mixing.mix(empty).count() == 0


def test_tilts_meet_the_targets(documents):
    rows = mixing.sized(documents)
    h = rows.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n"))
    t = mixing.solve_tilts(h, mixing.targets(h))
    size, n = F.col("size").cast("double"), F.col("n")
    mass = h.join(t, "source_key").groupBy("source_key", "target").agg(F.sum(size * n * mixing.rate_of(F.col("tilt"), size)).alias("mass")).collect()
    assert mass and all(abs(r.mass - r.target) <= 1e-9 * r.target for r in mass)


def test_no_python_in_the_plan(documents):
    plan = mixing.mix(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_share_their_copies(spark):
    """A third of all rows are one document: it makes one item, and its copies are dealt evenly."""
    rows = [(7, "a b c d e", "x")] * 700 + [(i, "w " * (i % 40 + 1), "x") for i in range(100, 1500)] + [(None, "n n n", None)] * 5 + [(8, "same", "x"), (8, "same", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = check(df, 0.02)
    same = [r.copies for r in got if r.doc_id == 7]
    assert len(same) == 700 and max(same) - min(same) <= 1
    lanes = {(r.doc_id, r.lane): r for r in mixing.mixed_lanes(df).collect()}
    assert len(lanes) == 1404 and sum(r.copies for r in lanes.values()) == sum(r.copies for r in got)


def test_targets_that_cannot_be_met_are_told(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(mixing, "STEPS", 1)
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") * F.col("id") + 1).cast("int")).alias("text"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"))
    with pytest.raises(ArithmeticError, match="targets not met"):
        mixing.mix(df)
