import compare
import pytest
from pyspark.sql import functions as F

from pluvio.llm import queries, warc

SF = "/root/testdata/sf0.001"


def _pages(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * (i % 9)) for i in range(300)] + [(None, None, None), (5, "u\r\nX: y", ""), (5, "u\r\nX: y", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_same_as_sql(spark):
    got = queries.op7_merkle_audit(spark, SF).select("page_id", "length", "record_sha256", "corrupt")
    assert compare.difference(got, compare.oracle(SF), queries.ORACLE_SQL["op7_merkle_audit"]) == ""


def test_audit_finds_what_changed(spark):
    leaves = warc.lay_out(_pages(spark), file_bytes=4000).cache()
    assert leaves.select("file").distinct().count() > 3
    key = ["file", "place"]
    bad = leaves.where("page_id % 50 = 7 or page_id is null").select(*key)
    gone = leaves.groupBy("file").agg(F.max("place").alias("place")).where("file = 0")
    theirs = leaves.join(bad.withColumn("bad", F.lit(True)), key, "left").withColumn("digest", F.when(F.col("bad"), F.lit("0" * 64)).otherwise(F.col("digest"))).drop("bad").join(gone, key, "left_anti")
    mine = warc.tree(leaves, 4)
    found = warc.audit(mine, warc.tree(theirs, 4), 4)
    assert {tuple(r) for r in found.select(*key).collect()} == {tuple(r) for r in bad.unionByName(gone).collect()}
    assert warc.audit(mine, warc.tree(leaves, 4), 4).count() == 0
    assert warc.tree(leaves, 4).groupBy("file").agg(F.max("level").alias("l")).where("l < 1").count() == 0


def test_offsets_and_parse(spark):
    pages = _pages(spark)
    leaves = warc.lay_out(pages, file_bytes=1 << 20).orderBy("place").collect()
    record = {r.d: bytes(r.record) for r in pages.select(warc.record_bytes(F.col("url"), F.col("page_id"), F.col("html")).alias("record")).withColumn("d", F.sha2("record", 256)).collect()}
    data = b"".join(record[r.digest] for r in leaves)
    parsed = list(warc.parse_records(data))
    assert [p[0] for p in parsed] == [r.offset for r in leaves] and len(parsed) == 303
    assert all(len(block) == int(head["Content-Length"]) and "\n" not in head["WARC-Target-URI"] for _, head, block in parsed)


def test_files_round_trip(spark, tmp_path):
    pages = _pages(spark).where("page_id is not null").dropDuplicates(["page_id"])
    warc.write_files(pages, str(tmp_path / "w"), file_bytes=4000)
    back = warc.read_files(spark, str(tmp_path / "w"))
    want = {(r.page_id, r.html) for r in pages.collect()}
    assert {(r.page_id, r.html) for r in back.collect()} == want


def test_empty(spark):
    none = _pages(spark).limit(0)
    leaves = warc.lay_out(none)
    assert leaves.count() == 0 and warc.audit(warc.tree(leaves), warc.tree(leaves)).count() == 0


def test_audit_of_stored_files(spark, tmp_path):
    """Leaves read from the files are those that were laid out; a replica's changed bytes, and bytes changed in a stored file, are found."""
    import gzip

    long = spark.createDataFrame([(900, "http://x/long", "é<p>word</p>\r\n\r\nWARC/1.0" * 20_000)], "page_id long, url string, html string")
    pages = _pages(spark).unionByName(long)
    warc.write_files(pages, str(tmp_path / "a"), file_bytes=4000)
    warc.write_files(pages, str(tmp_path / "b"), file_bytes=4000, damaged=F.col("page_id") % 50 == 7)
    columns = ["file", "page_id", "length", "digest", "place", "offset"]
    mine, theirs = warc.stored_leaves(spark, str(tmp_path / "a")).cache(), warc.stored_leaves(spark, str(tmp_path / "b"))
    laid = warc.lay_out(pages, file_bytes=4000).select(*columns)
    assert sorted(mine.select(*columns).collect(), key=str) == sorted(laid.collect(), key=str)
    found = warc.audit(warc.tree(mine, 4), warc.tree(theirs, 4), 4)
    assert {r.page_id for r in found.join(mine, ["file", "place"]).collect()} == set(range(7, 300, 50)) and found.count() == 6
    name = next((tmp_path / "b").rglob("part-*"))
    data = bytearray(gzip.decompress(name.read_bytes()))
    data[0:4] = b"warc"
    name.write_bytes(gzip.compress(bytes(data)))
    (name.parent / f".{name.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="no record at 0"):
        warc.stored_leaves(spark, str(tmp_path / "b")).collect()
    warc.write_files(pages.limit(0), str(tmp_path / "none"))
    assert warc.stored_leaves(spark, str(tmp_path / "none")).count() == 0


def test_files_are_packed_at_the_fastest_level(spark, tmp_path):
    import gzip
    import random

    r = random.Random(4)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(300)]
    pages = spark.createDataFrame([(i, f"http://a/{i}", " ".join(r.choice(words) for _ in range(2000))) for i in range(20)], "page_id long, url string, html string")
    warc.write_files(pages, str(tmp_path / "w"))
    packed = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").rglob("part-*")))
    whole = gzip.decompress(packed)
    assert len(packed) > 1.05 * len(gzip.compress(whole, 6)) and len(packed) < len(whole) / 1.5
    assert sum(1 for _ in warc.parse_records(whole)) == 20
