import zlib

import numpy as np
from pyspark.sql import functions as F

from pluvio.llm import language_id, queries


def test_held_out_accuracy(spark, documents):
    got = {r.doc_id: r for r in queries.op3_language_id(spark, "/root/testdata/sf0.01").collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 for d, r in got.items())
    held = [d for d, r in got.items() if r.held_out]
    assert sum(got[d].lang_pred == truth[d] for d in held) >= 0.95 * len(held)


def test_odd_rows(odd, empty, documents):
    model = language_id.train(documents, F.lit(False))
    got = language_id.predict(odd, model, "doc_id", "text", "row").collect()
    assert len(got) == odd.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters and (letters or r.score == 0.0)
    assert language_id.predict(empty, model, "doc_id").count() == 0
    nothing = language_id.train(empty, F.lit(False))
    assert nothing[0] == [] and {r.lang_pred for r in language_id.predict(odd, nothing, "doc_id").collect()} == {"und"}


def test_prediction_reads_the_text_only(documents):
    model = language_id.train(documents, F.lit(False))
    a = language_id.predict(documents, model, "doc_id").select("doc_id", "lang_pred", "score")
    b = language_id.predict(documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model, "doc_id").select("doc_id", "lang_pred", "score")
    assert a.exceptAll(b).count() == 0


def test_binding():
    points = np.array([0, ord("a"), ord("b"), ord("é")])
    letters = language_id.letter_vectors(points)
    assert set(np.unique(letters)) == {-1, 1} and (letters == language_id.letter_vectors(points)).all()
    t = language_id.Trigrams(["abé", "", "É", "1 2"])
    gap, a, b, e = letters.astype(np.int64)
    bind = lambda x, y, z: np.roll(x, 2) * np.roll(y, 1) * z
    bundles, different = t.bundles()
    assert (bundles[0] == bind(gap, a, b) + bind(a, b, e) + bind(b, e, gap)).all() and (bundles[2] == bind(gap, e, gap)).all()
    assert t.has.tolist() == [True, False, True, False] and different.tolist() == [3, 0, 1, 0] and not bundles[1].any() and not bundles[3].any()


def _plain_bundle(text):
    gap_runs = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    points = [0 if c == " " else ord(c) for c in " ".join(["", *gap_runs.split(), ""])] if gap_runs.split() else []
    out = np.zeros(language_id.DIMENSIONS, np.int64)
    for k in range(len(points) - 2):
        x, y, z = language_id.letter_vectors(np.array(points[k : k + 3])).astype(np.int64)
        out += np.roll(x, 2) * np.roll(y, 1) * z
    return out


def test_against_a_plain_version(spark, documents, monkeypatch):
    """Prototypes and predictions from sums over single trigrams, letter by letter."""
    rows = [(i, r.text[:300], r.lang) for i, r in enumerate(documents.where("text is not null and lang is not null").limit(40).collect())]
    rows += [(90, "ñ", None), (91, "日本語のテキスト", None), (92, "ÀÉ  x", None), (93, "", None), (94, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sums = {}
    for _, t, lang in rows:
        if lang:
            sums[lang] = sums.get(lang, 0) + _plain_bundle(t)
    unit = {x: v / np.linalg.norm(v) for x, v in sums.items()}
    monkeypatch.setattr(language_id, "_COLUMNS", 100)
    model = language_id.train(df, F.lit(False))
    assert model[0] == sorted(unit) and np.allclose(model[1], [unit[x] for x in sorted(unit)])
    for r in language_id.predict(df, model, "doc_id", "text").collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        v = _plain_bundle(r.text)
        cosines = {x: float(u @ v / np.linalg.norm(v)) for x, u in unit.items()}
        best = max(sorted(cosines), key=lambda x: round(cosines[x], 9))
        assert r.lang_pred == best and abs(r.score - max(0, cosines[best])) < 1e-8


def test_neighbours_and_order_change_nothing(spark, documents):
    model = language_id.train(documents, F.lit(False))
    texts = ["ñ", "That it.", "Avec.", "x", "日本", "1 a 2", *(r.text for r in documents.limit(30).collect())]
    told = lambda order: {r.text: (r.lang_pred, r.score) for r in language_id.predict(spark.createDataFrame([(t,) for t in order], "text string").coalesce(1), model, "text").collect()}
    want = told(texts)
    assert want["ñ"][1] > 0
    assert told(texts[::-1]) == want
    for t in texts[:6]:
        assert told([t]) == {t: want[t]}


def test_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([("abc", "zz"), ("abc", "aa"), ("abc", "mm")], "text string, lang string")
    model = language_id.train(df, F.lit(False))
    r = language_id.predict(df, model, "lang").collect()
    assert {x.lang_pred for x in r} == {"aa"} and {x.score for x in r} == {1.0}
