"""Each stage against a plain version on its own input."""

import plain
from pyspark.sql import functions as F

import corpus_pipeline as p
from pluvio.llm import mixing, pieces

SF = "/root/testdata/sf0.001"
COLUMNS = set(p.COLUMNS)


def rows(df):
    return df.select(*p.COLUMNS).collect()


def test_language_stage_drops_what_has_no_letter(spark, documents, odd, empty):
    out = p.keep_known_languages(spark, odd, SF)
    assert set(out.columns) == COLUMNS
    kept = {r.text for r in rows(out)}
    assert all(any(c.isalpha() for c in t or "") for t in kept)
    assert p.keep_known_languages(spark, documents, SF).count() == documents.count()
    assert p.keep_known_languages(spark, empty, SF).count() == 0


def test_one_of_each_component_stays(spark, documents, odd, empty):
    docs = [(r.doc_id, r.text) for r in rows(documents)]
    want = sorted(d for (d, _), (_, c, _) in zip(docs, plain.components(docs)) if c == d)
    assert sorted(r.doc_id for r in rows(p.drop_near_duplicates(spark, documents, SF))) == want
    got = rows(p.drop_near_duplicates(spark, odd, SF))
    prose = [r for r in got if r.text and r.text.startswith("The quick") and r.text.count("quick") == 4]
    assert [r.doc_id for r in prose] == [1] and {3, 4, 5, 6, 7, 8, 9} <= {r.doc_id for r in got}
    assert p.drop_near_duplicates(spark, empty, SF).count() == 0


def test_null_ids_keep_one(spark):
    t = "one two three four five six seven eight"
    df = spark.createDataFrame([(None, t), (None, t), (None, "other words here that link with nothing"), (4, t + " x y")], "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang", "'s' source", "cast(null as long) n_chars")
    got = sorted((str(r.doc_id), r.text) for r in rows(p.drop_near_duplicates(spark, df, SF)))
    assert len([x for x in got if x[1] == t]) == 1 and len(got) == 3


def test_private_data_goes(spark, documents):
    out = rows(p.sanitize(spark, documents, SF))
    before = {r.doc_id: r.text for r in rows(documents)}
    assert len(out) == len(before)
    for r in out:
        spans = plain.base_spans(before[r.doc_id])
        assert (r.text != before[r.doc_id]) == bool(spans)
        assert not any(before[r.doc_id][a:b] in r.text for a, _, b, k in spans if k == "email") and r.n_chars == len(r.text)


def test_mix_repeats_documents(spark, documents):
    want = {r.doc_id: r.copies for r in mixing.mix(documents).collect()}
    got = {}
    for r in rows(p.mix_sources(spark, documents, SF)):
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: c for d, c in want.items() if c}


def test_run(spark):
    out = p.run(spark, SF)
    assert out.count() > 0 and out.where("not lossless").count() == 0
    assert out.where(F.size("ids") != F.col("n_pieces")).count() == 0
    assert [n for n, _ in p.STAGES] == ["language_id", "near_duplicates", "pii", "mixing", "pieces"] and pieces.DROPOUT > 0


def test_language_stage_keeps_short_labelled_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    letters = docs.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    kept = p.keep_known_languages(spark, docs, SF)
    assert letters.join(kept, "doc_id", "left_anti").count() == 0 and letters.count() >= 900
    junk = spark.createDataFrame([(-1, "".join(chr(0x4E00 + i * 37 % 5000) for i in range(4000)), None, "s", 4000)], kept.schema)
    assert p.keep_known_languages(spark, docs.select(*p.COLUMNS).unionByName(junk), SF).where("doc_id = -1").count() == 0


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_repeated_rows_are_mixed_as_often_as_the_mix_takes_them(spark, odd, empty):
    text = "seven equal rows of one text"
    docs = _docs(spark, [(1, text, "en", "a", 28)] * 7 + [(2, text, "en", "a", 28), (2, text, "en", "b", 28), (2, text, "de", "b", 28)] + [(i, f"filler {i} " * (i % 5 + 1), "en", "ab"[i % 2], 9) for i in range(10, 60)])
    for df in (docs, odd):
        want = {}
        for r in mixing.mix(df).collect():
            want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
        got = {}
        for r in rows(p.mix_sources(spark, df, SF)):
            got[r.doc_id] = got.get(r.doc_id, 0) + 1
        assert got == {d: c for d, c in want.items() if c}
    assert p.mix_sources(spark, empty, SF).count() == 0


def test_encode_takes_odd_rows(spark, odd, empty):
    out = p.encode(spark, odd, SF).collect()
    assert len(out) == odd.count() and all(r.lossless for r in out)
    assert {r.n_pieces for r in out if r.doc_id in (3, 4)} == {0}
    assert p.encode(spark, empty, SF).count() == 0
