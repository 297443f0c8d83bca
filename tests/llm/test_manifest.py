import hashlib
import random
import zlib

import compare
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvio.llm import manifest, queries


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """All levels, and for each leaf its siblings to the top."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    ways = []
    for i in range(len(leaves)):
        way = []
        for level in levels[:-1]:
            a = i - i % 8
            way.append((level[a:i], level[i + 1 : a + 8]))
            i //= 8
        ways.append(way)
    return levels[-1][0], ways


def plain(rows):
    """The contract, row by row: (doc_id, leaf, subroot, root, proof, folded, verified), sorted."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    spell = lambda r, text: H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text))
    by_lang = {}
    for r in rows:
        bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
        by_lang.setdefault(r.lang, []).append(((r.doc_id is not None, r.doc_id or 0), spell(r, r.text), spell(r, r.text.translate(low) if bad else r.text), r.doc_id))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: plain_tree([r[1] for r in sorted(by_lang[x], key=lambda r: r[:3])]) for x in langs}
    root, over = plain_tree([trees[x][0] for x in langs]) if langs else (None, [])
    out = []
    for k, x in enumerate(langs):
        for (_, leaf, claimed, doc_id), way in zip(sorted(by_lang[x], key=lambda r: r[:3]), trees[x][1]):
            way = way + over[k]
            folded = claimed
            for before, after in way:
                folded = H([*before, folded, *after])
            out.append((doc_id, leaf, trees[x][0], root, H(d for b, a in way for d in [*b, *a]), folded, folded == root))
    return sorted(out, key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 700), min_size=1, max_size=3), st.integers(0, 2), st.randoms(use_true_random=False))
def test_fragments_are_a_monoid(sizes, keep, r):
    leaves = {f"={t}": [hashlib.sha256(f"{t}.{i}".encode()).hexdigest() for i in range(n)] for t, n in enumerate(sizes)}
    forest = manifest.Forest({t: len(x) for t, x in leaves.items()}, keep)
    nodes = [((t, 0, i), d.encode()) for t, x in leaves.items() for i, d in enumerate(x)]
    r.shuffle(nodes)
    cuts = sorted(r.randrange(len(nodes) + 1) for _ in range(6))
    parts = [forest.of(dict(nodes[a:b])) for a, b in zip([0, *cuts], [*cuts, len(nodes)])]
    while len(parts) > 1:  # in any order and grouping
        a = parts.pop(r.randrange(len(parts)))
        b = parts.pop(r.randrange(len(parts)))
        parts.append(forest.merge(a, b))
    (whole,) = parts
    assert {t: d.decode() for (t, _, _), d in whole.open.items()} == {t: plain_tree(x)[0] for t, x in leaves.items()}
    assert whole == forest.merge(whole, manifest.Fragment()) == forest.of(dict(nodes))
    if not keep:
        for t, x in leaves.items():
            i = r.randrange(len(x))
            got = [[p.decode() for p in pair] for pair in forest.above((t, 0, i), whole.closed)]
            assert got == [["".join(b), "".join(a)] for b, a in plain_tree(x)[1][i]]


def _docs(spark, n, langs=("de", "en", None)):
    r = random.Random(3)
    rows = [(i, f"Text {i} " * (i % 4), r.choice(langs) if i % 3 else "en", "s", i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("n", [0, 1, 2, 9, 513, 1500])
def test_same_as_plain(spark, n):
    docs = _docs(spark, n)
    assert sorted(map(tuple, manifest.audit_documents(docs).collect()), key=str) == plain(docs.collect())


def test_depths_and_ranges_do_not_matter(spark):
    docs = _docs(spark, 700)
    want = plain(docs.collect())
    leaves = manifest.tampered(docs, F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0)
    for depth, ranges in ((1, 7), (2, 1), (4, 3)):
        placed = manifest.place(leaves, ranges)
        got = manifest.prove(placed, manifest.build(placed, depth=depth), "claimed")
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_blocks_grow_with_the_rows():
    assert manifest.block_depth({"=a": 1 << 20}) == 3
    assert manifest.block_depth({"=a": 1 << 40}) == 8
    assert sum(n // 8 ** manifest.block_depth({"=a": 1 << 40}) for n in [1 << 40]) <= manifest.BLOCKS


def test_missing_leaves_are_an_error(spark):
    placed = manifest.place(manifest.tampered(_docs(spark, 600), F.lit(False)))
    sizes = manifest.tree_sizes(placed)
    with pytest.raises(Exception, match="due|completed"):
        manifest.build(placed.where("position <> 5"), sizes)


def test_many_languages(spark):
    docs = spark.createDataFrame([(i, "T", f"l{i % 70:03d}", None, None) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, manifest.audit_documents(docs).collect()), key=str) == plain(docs.collect())


def test_odd_rows(spark, odd, empty):
    assert sorted(map(tuple, manifest.audit_documents(odd).collect()), key=str) == plain(odd.collect())
    assert manifest.audit_documents(empty).count() == 0


def test_query_same_as_sql_and_plain(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op12_merkle_manifest(spark, sf)
    assert compare.difference(got, compare.oracle(sf), queries.ORACLE_SQL["op12_merkle_manifest"]) == ""
    assert sorted(map(tuple, got.collect()), key=str) == plain(spark.read.parquet(f"{sf}/documents.parquet").collect())
