import math

import plain
import pytest
from pyspark.sql import functions as F

from pluvio.llm import pii

CASES = [
    "a@b.c_x@d.e", "x.y@z", "@a.b", "a@b..c", "a@-.-", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "001.002.003.255", "1.2.3", "4111-1111-1111-1111", "4111 1111 1111 1112", "4111111111111111" * 3, "12" * 9, "+1 (555) 123-4567.", "+12 +123456789", "+1" + "-" * 40 + "2", "+123456789012345678",
    "mail éà a@b.de, é1.1.1.1ü", "a" * 50000, "1" * 50000, "1 " * 30000, "a@b" + ".c" * 20000, "+1" + "2" * 20000 + "(", "😀 a@b.co 😀 10.0.0.1", None, "", "\n\n", "%+-@a.b", "a@b.c@d.e", "6011000990139424 6011000990139424",
]


def test_base_spans(spark, documents, odd):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string").unionByName(documents.select("doc_id", "text")).unionByName(odd.select("doc_id", "text"))
    want = sorted((str(r.doc_id), plain.sha(plain.joined(plain.base_spans(r.text)))) for r in df.collect())
    got = pii.find(df).collect()
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    for r in got:
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        assert [kinds.count(k) for k in pii.KINDS] == [r.n_email, r.n_ip, r.n_card, r.n_phone]
        assert len(kinds) - sum(kinds.count(k) for k in pii.KINDS) == r.n_terms


@pytest.fixture(scope="module")
def telling(spark):
    """``Zelda`` stands by phone numbers only, in many different texts; ``common`` everywhere."""
    rows = [(i, f"note {i} alpha common Zelda +1 555 010-{1000 + i} common beta tail{i}") for i in range(6)]
    rows += [(100 + i, f"common words alpha beta gamma number {i} without any contact") for i in range(40)]
    rows += [(200, "common Zelda far away from any number"), (201, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def plain_shares(rows):
    """PMI over IC of (phone, term) and the bits of evidence, straight from their definitions."""
    import math
    import re

    n = len(rows)
    term = lambda t: set(x.lower() for x in re.findall(r"[^\W\d_]{3,}", t or ""))
    held = [(d, t) for d, t in rows if plain.base_spans(t)]
    out = {}
    for x in set().union(*(term(t) for _, t in held)):
        n_ct, n_t = sum(x in term(t) for _, t in held), sum(x in term(t) for _, t in rows)
        if n_ct >= 2:
            pmi = math.log2(n_ct * n / (len(held) * n_t))
            out[x] = (pmi / math.log2(n / len(held)), n_ct * pmi)
    return out


def test_terms_that_tell(telling):
    rows = [(r.doc_id, r.text) for r in telling.collect()]
    all_shares = plain_shares(rows)
    want = {t: s for t, (s, bits) in all_shares.items() if s >= pii.GENERALISE and bits >= pii.EVIDENCE + math.log2(len(all_shares))}
    based = pii.prepare(telling)
    got = {r.term: r.share for r in pii.disclosing(telling, pii.entities(based)).where("value is null").collect()}
    assert set(got) == set(want) and "zelda" in got and "common" not in got and "alpha" not in got
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)


def test_sanitize(telling, odd, empty):
    texts = {r.doc_id: r.text for r in pii.sanitize(telling).collect()}
    assert texts[0].count("[PHONE]") == 1 and "Zelda" not in texts[0] and "common" in texts[0]
    assert texts[200] == "common Zelda far away from any number" and texts[201] is None
    out = pii.sanitize(odd)
    assert out.columns == odd.columns and out.count() == odd.count() and out.where("text is null").count() == 2
    nine = out.where("doc_id = 9").first()
    assert nine.text == "Écris à [EMAIL] ou [PHONE], [IP], [CARD] fin 😀" and nine.n_chars == len(nine.text)
    assert pii.sanitize(empty).count() == 0 and pii.find(empty).count() == 0


def test_no_python_in_the_plan(telling):
    plan = pii.find(telling)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rewrite_of_overlapping_spans(spark):
    span = lambda a, b, k: F.struct(F.lit(a).alias("start"), F.lit(0).alias("rank"), F.lit(b).alias("end"), F.lit(k).alias("kind"), F.lit("").alias("value"))
    r = spark.range(1).select(pii.rewrite(F.lit("0123456789"), F.array(span(1, 4, "ip"), span(2, 6, "card"), span(7, 9, "drop"))).alias("t")).first()
    assert r.t == "0[IP]69"


def test_terms_that_tell_go_everywhere_in_the_document(spark, telling):
    far = "Zelda wrote this. " + "common words alpha beta gamma without contact " * 5 + "ask zelda at +1 555 010-2000 or a@b.co" + " common alpha beta" * 9 + " Zelda"
    df = telling.unionByName(spark.createDataFrame([(300, far)], telling.schema))
    texts = {r.doc_id: r.text for r in pii.sanitize(df).collect()}
    assert "zelda" not in texts[300].lower() and "[PHONE]" in texts[300] and "Zelda" in texts[200]
    spans = next(r.spans for r in pii.find(df).collect() if r.doc_id == 300).split(",")
    assert {far[int(x.split(":")[1]) : int(x.split(":")[2])] for x in spans if x.split(":")[0] in ("term", "drop")} == {"Zelda", "zelda"} and len(spans) == 5


def test_what_proves_nothing(spark):
    """Rare words of near copies, and words that meet an entity by chance, tell nothing; a value's own words do."""
    rnd = __import__("random").Random(4)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))
    copy = f"{prose(60)} quorxin {prose(60)} write to once@copies.example"
    rows = [(1, copy), (2, copy + " too"), (3, copy + " again")]
    rows += [(10 + i, f"{prose(30)} Zeldanna {prose(30)} mail zel.danna@home.example {prose(10)}") for i in range(3)]
    rows += [(100 + i, prose(50) + (f" reach p{i}@x{i}.example" if i % 3 == 0 else "")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    told = pii.disclosing(df, pii.entities(pii.prepare(df))).collect()
    assert {(r.kind, r.term) for r in told if r.value} == {("email", "zeldanna"), ("email", "mail")}
    assert {r.term for r in told if r.value is None} <= {"reach"}
    texts = {r.doc_id: r.text for r in pii.sanitize(df).collect()}
    assert "quorxin" in texts[1] and all("Zeldanna" not in texts[d] for d in (10, 11, 12)) and texts[100].endswith("[EMAIL]")
