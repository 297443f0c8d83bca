from fractions import Fraction

import numpy as np
import pytest

from pluvio.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x int, component int"


def _plain(vectors, components=32):
    """Whole numbers, exact deviations, covariance from exact fractions, eigenvectors of it; vectors: (id, list)."""
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for _, v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(row[j] for row in x) for j in range(dims)]
    off = [[n * row[j] - s[j] for j in range(dims)] for row in x]
    cov = np.array([[float(Fraction(sum(o[i] * o[j] for o in off), n**3)) for j in range(dims)] for i in range(dims)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    white = np.array(off, float) / n @ u / np.sqrt(e)
    return n, [sum(v * v for v in o) for o in off], white, e / np.trace(cov)


def _compare(got, vectors, components=32):
    n, deviation, white, explained = _plain(vectors, components)
    k = white.shape[1]
    ids = [i for i, _ in vectors]
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert len(got) == n * k
    mine = np.array([[by[i][c][0].whitened for c in range(1, k + 1)] for i in ids])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-6
    for i, d in zip(ids, deviation):
        for c in range(1, k + 1):
            r = by[i][c][0]
            assert r.n == n and r.deviation == d and r.deviation_exact == d and abs(r.explained / explained[c - 1] - 1) < 1e-9 and 0 <= r.identity_error < 1e-6
    assert len({r.identity_error for r in got}) == 1


def test_same_as_plain(spark):
    rng = np.random.default_rng(4)
    mixed = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 5
    rows = [(i, v.astype(np.float32).tolist(), 0, 1, 2) for i, v in enumerate(mixed)]
    df = spark.createDataFrame(rows, SCHEMA)
    vectors = [(i, np.float32(v).tolist()) for i, v, *_ in rows]
    _compare(whitening.whiten(df).collect(), vectors)
    _compare(whitening.whiten(df.repartition(7), 3).collect(), vectors, 3)


def test_left_out_rows_and_repeats(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(40)]
    good += [(7, good[7][1])]  # a repeated row
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 2.0, 3.0]), (103, [1.0, float("inf"), 2.0, 3.0]), (104, []), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in good + odd], SCHEMA)
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == set(range(40)) and len(got) == 41 * 4 and sum(r.vec_id == 7 for r in got) == 8
    n, deviation, _, _ = _plain(good)
    assert {(r.vec_id, r.deviation) for r in got} == set(zip([i for i, _ in good], deviation)) and {r.n for r in got} == {n}
    unnamed = whitening.whiten(spark.createDataFrame([(None, v, 0, 1, 2) for _, v in good], SCHEMA)).collect()
    assert len(unnamed) == 41 * 4 and {r.vec_id for r in unnamed} == {None}


def test_no_variance(spark):
    row = [0.5, -1.0, 2.0]
    for rows in ([], [row], [row] * 5, [None]):
        df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in enumerate(rows)], SCHEMA)
        out = whitening.whiten(df)
        assert out.count() == 0 and out.columns == [f.split()[0] for f in whitening.RESULT.replace("(38,0)", "").split(", ")]
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 0, 1, 2) for i in range(9)], SCHEMA)  # one direction only
    got = whitening.whiten(flat).collect()
    assert {r.component for r in got} == {1} and len(got) == 9 and got[0].explained == pytest.approx(1)


def test_numbers_beyond_longs(spark):
    far = [(i, [float(i % 3) * 1e13, float(i), 1.0 - i]) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0, 1, 2) for i, v in far], SCHEMA)).collect()
    _, deviation, _, _ = _plain([(i, np.float32(v).tolist()) for i, v in far])
    assert max(deviation) > whitening.LONG
    assert {(r.vec_id, int(r.deviation_exact), r.deviation) for r in got} == {(i, d, d if d <= whitening.LONG else None) for (i, _), d in zip(far, deviation)}
    w = whitening.Whitener(3, [1 << 60, 5], 0, 1 << 61)
    assert not w.narrow and w.offsets(np.array([[1 << 61, 2]]))[0, 0] == 3 * (1 << 61) - (1 << 60)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op13_embedding_whitening(spark, sf).collect()
    keep = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    assert len(keep) == 500
    n, deviation, white, explained = len(keep), None, None, None
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for _, v in keep])
    off = n * x - x.sum(axis=0)
    deviation = dict(zip([i for i, _ in keep], (off**2).sum(axis=1).tolist()))
    cov = (off / n).T @ (off / n) / n
    e, u = np.linalg.eigh(cov)
    white = off / n @ u[:, ::-1][:, :32] / np.sqrt(e[::-1][:32])
    mine = {(r.vec_id, r.component): r for r in got}
    assert len(mine) == len(got) == n * 32
    for c in range(32):
        col = np.array([mine[i, c + 1].whitened for i, _ in keep])
        assert min(np.abs(col - white[:, c]).max(), np.abs(col + white[:, c]).max()) < 1e-7
        assert abs(mine[keep[0][0], c + 1].explained / (e[::-1][c] / np.trace(cov)) - 1) < 1e-9
    assert all(r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9 for r in got)
