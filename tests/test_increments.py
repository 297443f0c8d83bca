import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from pluvio.operators import consensus, incremental, qc1
from pluvio.sources import numbering, pages_json, sessions, tables, versions


def _page(total=1.0):
    import json

    def slot():
        return {"values": [total, total, total, None, " Missing "]}

    return json.dumps({"Totals": [slot()] * 12, "Day 1": [slot()] * 12})


def test_ids_stay(spark, tmp_path):
    root = str(tmp_path / "ids")
    keys = lambda *names: spark.createDataFrame([(n,) for n in names], "k string")
    ids = lambda df: {r.k: r.id for r in df.collect()}
    assert ids(numbering.assign(keys("b", "a", "b", None), "k", root)) == {"a": 1, "b": 2}
    assert ids(numbering.assign(keys("c", "b"), "k", root)) == {"b": 2, "c": 3}
    assert ids(numbering.assign(keys("c", "b"), "k", root)) == {"b": 2, "c": 3}  # again, as after a failure
    assert ids(numbering.assign(keys("A"), "k", root)) == {"A": 4}
    assert ids(numbering.known(spark, root, "k")) == {"a": 1, "b": 2, "c": 3, "A": 4}
    assert ids(numbering.assign(keys(None), "k", str(tmp_path / "none"))) == {}


def test_pages_in_parts_have_the_ids_of_pages_at_once(spark, tmp_path):
    from pluvio.streaming import pages as streams

    source, ids = tmp_path / "in", str(tmp_path / "ids")
    source.mkdir()
    names = [f"p{i:02d}" for i in range(9)]
    for n in names[:3]:
        (source / f"{n}.json").write_text(_page())
    first = pages_json.tables(pages_json.parse(pages_json.discover(spark, str(source))), ids)["ensemble_files"]  # batch
    assert sorted(r.file_id for r in first.collect()) == [1, 2, 3]
    for part in (names[3:6], names[6:]):  # stream, twice
        for n in part:
            (source / f"{n}.json").write_text(_page())
        streams.ingest(spark, str(source), str(tmp_path / "out"), str(tmp_path / "ck"), ids).awaitTermination()
    known = {r.source_path.rsplit("/", 1)[1]: r.id for r in numbering.known(spark, ids, "source_path").collect()}
    at_once = pages_json.with_ids(pages_json.parse(pages_json.discover(spark, str(source))))
    assert known == {r.source_path.rsplit("/", 1)[1]: r.file_id for r in at_once.collect()} == {f"{n}.json": i for i, n in enumerate(names, 1)}
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.select("file_id").distinct().count() == 9 and out.count() == 9 * 12 * 5


def test_newest_batch_of_a_key_counts(spark, tmp_path):
    root, schema = str(tmp_path / "v"), "k int, v string"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "k int")
    now = lambda at=root: sorted(map(tuple, versions.current(spark, at, ["k"], schema).collect()))
    assert now() == []
    versions.write(rows((1, "a"), (1, "b"), (2, "c")), keys(1, 1, 2), root, 0)
    versions.write(rows((1, "d")), keys(1, 3), root, 1)
    assert now() == [(1, "d"), (2, "c")]
    versions.write(rows((1, "e"), (3, "f")), keys(1, 3), root, 1)  # the batch again
    versions.write(rows(), keys(2), root, 2)  # gone
    assert now() == [(1, "e"), (3, "f")]
    versions.compact(spark, root, ["k"], schema, str(tmp_path / "w"))
    assert now(str(tmp_path / "w")) == [(1, "e"), (3, "f")]


def _check(spark):
    r = random.Random(3)
    cells = [(f, m, d, e, round(r.random(), 2) if r.random() < 0.9 else None, 0) for f in range(1, 41) for m in (1, 2, 3) for d in (1, 2) for e in range(3)]
    values = spark.createDataFrame(cells, incremental.CELLS)
    monthly = spark.createDataFrame([(f"s{f}", 1900, m, round(r.random() * 3, 2)) for f in range(1, 30) for m in (1, 2)], "station_file_id string, year int, month int, rainfall_in double")
    rr = spark.createDataFrame([(f"s{f}::1900", f"s{f}", 1900) for f in range(1, 41)], "rr_vector_id string, station_file_id string, year int")
    matched = spark.createDataFrame([(f, f"s{f}::1900") for f in range(1, 36)], "file_id long, rr_vector_id string")
    return values, monthly, rr, matched


def _same(spark, root, monthly, rr, matched):
    columns = [c.split()[0] for c in incremental.VERDICTS.split(", ")]
    whole = qc1.results(consensus.daily(incremental.cells(spark, root)), matched, rr, monthly, 1, 0.5).select(*columns)
    key = lambda rows: sorted(map(str, rows.select(*columns).collect()))
    return key(incremental.verdicts(spark, root)) == key(whole)


def test_changes_touch_their_keys_only(spark, tmp_path):
    root = str(tmp_path)
    values, monthly, rr, matched = _check(spark)
    args = (matched, rr, monthly, 1, 0.5)
    assert incremental.apply(values, root, 0, *args).count() == 120 and _same(spark, root, monthly, rr, matched)
    change = values.where("file_id in (3, 40) and month = 2 and ensemble_member < 2").withColumn("rainfall", F.lit(0.75))
    dirty = incremental.apply(change, root, 1, *args)
    assert sorted(map(tuple, dirty.select("file_id", "month").collect())) == [(3, 2), (40, 2)]
    assert spark.read.parquet(f"{root}/verdicts/rows/batch=1").count() == 4  # two keys of two days
    assert _same(spark, root, monthly, rr, matched)
    incremental.apply(change, root, 1, *args)  # repeated
    assert _same(spark, root, monthly, rr, matched) and incremental.verdicts(spark, root).count() == 240


def test_changed_totals_reach_their_pages(spark, tmp_path):
    root = str(tmp_path)
    values, monthly, rr, matched = _check(spark)
    incremental.apply(values, root, 0, matched, rr, monthly, 1, 0.5)
    new = spark.createDataFrame([("s7", 1900, 1, 9.0), ("s33", 1900, 3, 0.4)], monthly.schema)  # one changed, one that had no month so far
    after = monthly.where("not (station_file_id = 's7' and month = 1)").unionByName(new)
    dirty = incremental.apply(values.limit(0), root, 1, matched, rr, after, 1, 0.5, changed_totals=new)
    assert sorted(map(tuple, dirty.select("file_id", "month").collect())) == [(f, m) for f in (7, 33) for m in (1, 2, 3)]
    assert _same(spark, root, after, rr, matched) and not _same(spark, root, monthly, rr, matched)


def test_writers_never_share_a_number(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: sessions.claim(spark, root, "daily_qc_status"), range(16)))
    assert len(set(got)) == 16
    assert sessions.claim(spark, root, "daily_qc_status", 100) == 100
    assert tables.next_session(spark, root, "daily_qc_status", "qc_session_id") == 101


def test_both_writers_stay_and_a_failed_one_is_not_seen(spark, tmp_path):
    root, name = str(tmp_path), "daily_qc_status"
    rows = lambda n: spark.range(n).select(F.col("id").alias("file_id"), F.lit(1).alias("month"), F.lit(1).alias("day_of_month"), F.lit("pass").alias("final_flag"))
    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(lambda n: sessions.run(rows(n), root, name, "qc_session_id"), (3, 5))
    count = lambda *s: {r.qc_session_id: r["count"] for r in sessions.read(spark, root, name, *s).groupBy("qc_session_id").count().collect()}
    assert count() == {a: 3, b: 5} and count(b) == {b: 5}
    c = sessions.claim(spark, root, name)
    broken = rows(2).select("*", F.raise_error(F.lit("no")).cast("double").alias("final_score"), F.lit(c).alias("qc_session_id"))
    with pytest.raises(Exception, match="no"):
        sessions.publish(spark, root, name, c, sessions.stage(broken, root, name, c))
    sessions.stage(rows(7).withColumn("qc_session_id", F.lit(c)), root, name, c)  # staged, not published
    assert count() == {a: 3, b: 5}
    sessions.publish(spark, root, name, a, sessions.stage(rows(4).withColumn("qc_session_id", F.lit(a)), root, name, a))  # a rerun
    assert count() == {a: 4, b: 5}
    assert sessions.read(spark, root, "daily_qc_results").count() == 0
