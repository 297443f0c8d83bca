import numpy as np
import plain
import pytest

from pluvio.llm import order_minhash as omh
from pluvio.llm.fingerprints import fingerprint_documents


def check(df, buckets):
    from pyspark.sql import functions as F

    marked = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text")).collect()
    rows = [(r.doc_id, r.text) for r in sorted(marked, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.mark, r.text.encode()))]
    want = []
    for i, (d, t) in enumerate(rows):
        e, n = omh.edited(t, rows[(i + 1) % len(rows)][1]), rows[(i + 1) % len(rows)][1]
        f = omh.fingerprint(t)
        want.append((str(d), len(t), plain.sha(e), omh.to_text(f), omh.to_text(omh.fingerprint(e)), omh.likeness(f, omh.fingerprint(e)), omh.likeness(f, omh.fingerprint(n))))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in fingerprint_documents(df, buckets).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("buckets", [2, 7, 40])
def test_against_one_pass_in_order(documents, buckets):
    check(documents, buckets)


def test_odd_rows(spark, odd, empty):
    check(odd, 3)
    assert fingerprint_documents(empty).count() == 0
    check(spark.createDataFrame([(5, "only one")], "doc_id long, text string"), 4)


def slow(text):
    """The definition, k-mer by k-mer."""
    p = omh.code_points(text)
    k = min(omh.K, len(p))
    seen, h = {}, []
    plain_h = {}
    for i in range(len(p) - k + 1):
        gram = tuple(p[i : i + k].tolist())
        if gram not in plain_h:
            plain_h[gram] = omh.numbered_kmers(p[i : i + k], k)[0]
        number = seen[gram] = seen.get(gram, -1) + 1
        base = plain_h[gram]
        h.append((base, number))
    return h


def test_occurrences_are_numbered():
    text = "abcdefgh" * 3 + "xyz"
    got = omh.numbered_kmers(omh.code_points(text))
    pairs = slow(text)
    assert len(got) == len(pairs) and len(set(got.tolist())) == len(set(pairs))
    for g, (base, number) in zip(got, pairs):
        repeated = sum(b == base for b, _ in pairs) > 1
        assert repeated or g == base


def test_order_matters_and_edits_cost():
    rng = np.random.default_rng(1)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(300)]
    text = " ".join(words)
    f = omh.fingerprint(text)
    swapped = omh.fingerprint(" ".join(words[150:] + words[:150]))
    edited = omh.fingerprint(" ".join(words[:290] + ["other"] * 10))
    far = omh.fingerprint(" ".join(words[::-1]))
    assert omh.likeness(f, f) == 1 and omh.likeness(f, edited) > 0.85 > omh.likeness(f, swapped) > omh.likeness(f, far)


def test_an_id_that_fills_many_ranges(spark):
    """A third of the rows has no id, another id is frequent, and one row is repeated."""
    rows = [(None, f"text number {i} without an id") for i in range(60)] + [(5, f"another text {i}") for i in range(50)] + [(7, "the same row")] * 20 + [(100 + i, f"a text of its own {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(df, 12)
    sizes = fingerprint_documents(df, 12).rdd.glom().map(len).collect()
    assert sum(n > 0 for n in sizes) >= 5


M64 = (1 << 64) - 1


def _mixed(x):
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & M64
    x ^= x >> 29
    x = x * 0xA0761D6478BD642F & M64
    return x ^ x >> 32


def _slow_fingerprint(text):
    """Every k-mer hashed by itself, numbered, ranked under each function; the two least in text order make the tuple."""
    p = [ord(c) for c in text]
    k, out = min(omh.K, len(p)), []
    seen, h = {}, []
    for i in range(len(p) - k + 1) if p else []:
        total = 0
        for j, c in enumerate(p[i : i + k]):
            x = (c + 1) * 0x9FB21C651E98DF25 & M64
            total = total + (x ^ x >> 28) * pow(0xC2B2AE3D27D4EB4F, j, 1 << 64) & M64
        gram = tuple(p[i : i + k])
        seen[gram] = seen.get(gram, -1) + 1
        h.append((_mixed(total), seen[gram], gram))
    repeated = {g for g, n in seen.items() if n}
    h = [_mixed(v + n * 0x9E3779B97F4A7C15 & M64) if g in repeated else v for v, n, g in h]
    size = min(omh.TUPLE, len(h))
    for f in range(omh.FUNCTIONS):
        m = int(omh._MULTIPLIERS[f])
        chosen = sorted(sorted(range(len(h)), key=lambda i: (h[i] * m & M64, i))[:size])
        t = size
        for i in chosen:
            t = _mixed(t * 0x9E3779B97F4A7C15 + h[i] & M64)
        out.append((t >> 32) & 0xFFFFFFFF | 1)
    return out if h else [0] * omh.FUNCTIONS


def test_against_the_definition(documents):
    texts = [r.text[:300] for r in documents.limit(12).collect() if r.text] + ["", "a", "abcdefg", "abcdefgh", "abcabcabc" * 20, "aaaaaaaaaaaaaaaaaaaaaaaaa", "é😀" * 30]
    for t in texts:
        assert omh.fingerprint(t).tolist() == _slow_fingerprint(t), t
