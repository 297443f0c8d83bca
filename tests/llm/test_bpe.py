import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pluvio.llm import bpe, queries

PIECES = ["a", "aa", "the", " ", "  ", "\n", "\t", "'s", "'re", "1", "12", "é", "ß", "漢", "😀", "́", " ", "\u0085", "\x1c", "<|endoftext|>", "<|", "endoftext", "|>", "!", "_", "...", "꟎", "\U0001e6c0", "²", "Ⅷ", "ing", "\x00", "�"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def mine():
    return bpe.codec(bpe.default_vocabulary())


def _texts():
    r = random.Random(5)
    return (
        ["".join(r.choice(PIECES) for _ in range(r.randint(0, 60))) for _ in range(4000)]
        + [c * k for c in "a -=" for k in range(1, 200, 7)]
        + ["".join(chr(r.choice([r.randint(1, 127), r.randint(1, 0x7FF), r.randint(1, 0xD7FF), r.randint(0xE000, 0x10FFFF)])) for _ in range(40)) for _ in range(1500)]
        + ["".join(r.choice("abcdefgh") for _ in range(60_000))]
    )


def test_same_ids_and_texts_as_the_library(mine, library):
    texts = _texts()
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = mine.encode(text)
        assert ids.tolist() == want.ids, text
        assert mine.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_any_ids_decode_as_in_the_library(mine, library):
    r = random.Random(6)
    for _ in range(500):
        ids = [r.randrange(mine.vocabulary.count) for _ in range(12)]
        assert mine.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)
    with pytest.raises(ValueError):
        mine.decode(np.array([mine.vocabulary.count]))


def test_patterns_agree_where_the_faster_is_taken(mine):
    for c in range(0x250):
        text = f"a{chr(c)}1{chr(c)}!{chr(c)} b{chr(c)}{chr(c)} _{chr(c)}"
        if re.fullmatch(bpe.LATIN, chr(c)):
            assert mine._cut_latin.findall(text) == mine._cut.findall(text), hex(c)


def _by_rank(v, word):
    """Merging as it is defined: the pair of least rank, the leftmost of equals, again and again."""
    one = {bytes(v.bytes_of.gather(np.array([i]))[0]): i for i in range(v.count) if v.size[i] == 1}
    out = [one[bytes([b])] for b in word]
    while True:
        found = [(v.rank[a * v.count + b], i) for i, (a, b) in enumerate(zip(out, out[1:])) if a * v.count + b in v.rank]
        if not found:
            return out
        _, i = min(found)
        made = bytes(v.bytes_of.gather(np.array(out[i : i + 2]))[0])
        out[i : i + 2] = [next(t for t in range(v.count) if v.left[t] == out[i] and v.right[t] == out[i + 1] and v.size[t] == len(made))]


def test_pair_table_is_what_merging_gives(mine):
    v, r = mine.vocabulary, random.Random(7)
    short = [i for i in range(v.count) if 1 <= v.size[i] <= 4 and i < 3000]
    for _ in range(150):
        a, b = r.choice(short), r.choice(short)
        word = bytes(v.bytes_of.gather(np.array([a, b]))[0])
        assert v.fits(a, b) == (_by_rank(v, word) == [a, b])
        assert v.encode_word(word) == _by_rank(v, word)


def test_broken_vocabularies_are_refused(tmp_path):
    import json

    spec = json.load(open(bpe.default_vocabulary(), encoding="utf-8"))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}}, {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}):
        path = tmp_path / "v.json"
        path.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            bpe.Vocabulary(str(path))


def test_query(spark, library):
    sf = "/root/testdata/sf0.01"
    want = {}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    for r, e in zip(docs, library.encode_batch([r.text or "" for r in docs], add_special_tokens=False)):
        back = library.decode(e.ids, skip_special_tokens=False)
        want[r.doc_id] = (len(e.ids), hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == (r.text or ""))
    got = queries.op11_bpe_backtracking(spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.lossless) for r in got} == want and len(got) == len(docs)


def test_odd_rows(spark, odd, empty, library):
    got = bpe.encode_documents(odd)
    rows = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in got.collect())
    assert rows == sorted((r.doc_id if r.doc_id is not None else -1, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())
    back = bpe.decode_documents(got.withColumn("text", F.lit(1)))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=str)
    assert bpe.decode_documents(got.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))).where("text is not null").count() == 0
    assert bpe.encode_documents(empty).count() == 0 and bpe.decode_documents(bpe.encode_documents(empty)).count() == 0
