import hashlib

import numpy as np
import plain
import pytest

from pluvio.llm import media


def check(df):
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), len(plain.payload(r.text)), plain.sha(plain.payload(r.text)), plain.crc(plain.payload(r.text)[-64:]), media.feature_of(plain.payload(r.text)))
        for r in df.select("doc_id", "text").collect()
    )
    rows = media.store_and_read(df).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.feature) for r in rows) == want
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.payload_sha256, (r.media_bytes, r.media_sha256)) == (r.media_bytes, r.media_sha256)
    return rows


def test_documents(documents):
    rows = check(documents)
    assert any(r.n_shared for r in rows)


def test_odd_rows(odd, empty):
    check(odd)
    assert media.store_and_read(empty).count() == 0


def test_cuts_follow_the_content():
    rng = np.random.default_rng(2)
    body = rng.integers(0, 256, 400_000, dtype=np.uint8).tobytes()
    a, b = media.chunks_of(body), media.chunks_of(b"some bytes before" + body)
    assert b"".join(a) == body and b"".join(b) == b"some bytes before" + body
    assert len(set(a) & set(b)) >= len(a) - 3
    assert all(media.LEAST <= len(c) <= media.MOST for c in a[:-1])
    slow = [sum(int(media.GEAR[body[i - k]]) << k for k in range(min(32, i + 1))) % 2**32 for i in range(3000)]
    marks = [i + 1 for i in range(3000) if slow[i] & int(media.MASK) == 0 and i + 1 >= media.LEAST]
    assert not marks or media.gear_cuts(body[:3000])[0] == marks[0]


def test_damage_is_found():
    parts = [(hashlib.sha256(c).digest(), c) for c in (b"one", b"two")]
    m = media.manifest_of([(d, len(c)) for d, c in parts])
    assert media.reconstruct(m, dict(parts)) == b"onetwo" and media.read_manifest(m) == [(d, 3) for d, _ in parts]
    with pytest.raises(ValueError):
        media.reconstruct(m, {parts[0][0]: b"one", parts[1][0]: b"tw0"})


def test_damage_in_the_store_fails_whoever_uses_it(spark):
    """Two records share a long passage, one shares nothing: damage to either's stored bytes is found on reading."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    text = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    common = text(200_000)
    df = spark.createDataFrame([(1, text(9000) + common), (2, common + text(7000)), (3, text(60_000))], "doc_id long, text string")
    records, chunks = media.store(df)
    assert media.read_back(records, chunks).count() == 3 and chunks.where("references > 1").count() > 5
    assert records.where("manifest is not null").select("doc_id").collect() == [(3,)]
    broken = lambda c: F.concat(F.expr(f"substring({c}, 1, length({c}) - 1)"), F.lit(b"~"))
    with pytest.raises(Exception, match="damaged"):
        media.read_back(records.where("doc_id = 3").withColumn("own", F.transform("own", lambda c: F.concat(F.lit(b"~"), c))), chunks).collect()
    used = chunks.where("references > 1").select("digest").first().digest
    hurt = chunks.withColumn("chunk", F.when(F.col("digest") == F.lit(used), broken("chunk")).otherwise(F.col("chunk")))
    for i in (1, 2):
        with pytest.raises(Exception, match="damaged"):
            media.read_back(records.where(F.col("doc_id") == i), hurt).collect()
        with pytest.raises(Exception, match="damaged"):
            media.read_back(records.where(F.col("doc_id") == i), chunks.where(F.col("digest") != F.lit(used))).collect()
    assert media.read_back(records.where("doc_id = 3"), hurt).count() == 1


def test_equal_payloads_are_stored_once(spark):
    """Copies refer to one list: the store holds a payload once, and every copy still gets its values from it."""
    rng = np.random.default_rng(6)
    text = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    one, other = text(50_000), text(1000)
    df = spark.createDataFrame([(d, one) for d in range(20)] + [(d, other) for d in range(20, 30)] + [(None, other), (40, text(3000))], "doc_id long, text string")
    records, chunks = media.store(df)
    kept = sum(sum(map(len, r.own)) if r.own else len(r.chunk) for r in records.collect() if r.own or r.chunk)
    assert kept < 60_000
    rows = media.read_back(records, chunks).collect()
    assert len(rows) == 32 and all(r.n_shared == (0 if r.doc_id == 40 else r.n_chunks) for r in rows)
    check(df)
