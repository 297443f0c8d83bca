"""Boosted trees: held against a slow version that looks at every row for every split."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import booster, sampling
from pluvio.operators.booster import Settings

COLUMNS = ("a", "b", "c")


def _data(n=240, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rnd.uniform(0, 10), rnd.choice([None, 1.0, 2.0, float("nan")]), float(rnd.randrange(12))
        rows.append((i, a, b, c, math.sin(a) + (0.5 if b is None or b != b else b) + c / 5 + rnd.gauss(0, 0.05)))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double")


def _slow(told, columns, settings, lane):
    """Predictions for all rows of (h, fold, parts, y), learnt from those outside the lane's fold."""
    unit = 2.0 ** (math.frexp(max(abs(r.y) for r in told))[1] - booster.UNIT_BITS)
    q = [round(r.y / unit) for r in told]
    mine = [i for i, r in enumerate(told) if r.fold != lane]
    margin = [sum(q[i] for i in mine) / len(mine)] * len(told)

    def grow(number, learn, rows, level):
        g, n = sum(slope[i] for i in learn), len(learn)
        best = None
        if level < settings.depth:
            for j in booster.chosen(settings, columns, number, lane):
                for p in range(booster.MISSING):
                    for null_left in (False, True):
                        left = [i for i in learn if (null_left if told[i].parts[j] == booster.MISSING else told[i].parts[j] <= p)]
                        a, m = sum(slope[i] for i in left), len(left)
                        if m < settings.least_rows or n - m < settings.least_rows:
                            continue
                        gain = a * a / (m + settings.ridge) + (g - a) ** 2 / (n - m + settings.ridge) - g * g / (n + settings.ridge)
                        if gain * unit * unit > booster.LEAST_GAIN and (best is None or gain > best[0]):
                            best = (gain, j, p, null_left)
        if best is None:
            for i in rows:
                margin[i] += -settings.rate * g / (n + settings.ridge)
            return
        _, j, p, null_left = best
        goes = lambda i: null_left if told[i].parts[j] == booster.MISSING else told[i].parts[j] <= p
        grow(number, [i for i in learn if goes(i)], [i for i in rows if goes(i)], level + 1)
        grow(number, [i for i in learn if not goes(i)], [i for i in rows if not goes(i)], level + 1)

    for number in range(settings.trees):
        slope = [round(m - v) for m, v in zip(margin, q)]
        drawn = booster.draws(np.array([r.h for r in told]), settings.seed, number, lane) < settings.rows
        grow(number, [i for i in mine if drawn[i]], range(len(told)), 0)
    return [m * unit for m in margin]


def test_same_as_the_slow_version(spark):
    df = _frame(spark, _data())
    settings = Settings(trees=3, depth=3, rate=0.3)
    parts, cuts = booster.prepared(df, COLUMNS, "y", ["id"], F.col("id") % 2)
    models, told = booster.boost(parts, COLUMNS, cuts, 2, settings)
    rows = told.collect()
    assert len(rows) == 240 and len(models) == 3
    for lane in range(3):
        assert [r.margins[lane] for r in rows] == pytest.approx(_slow(rows, len(COLUMNS), settings, lane), abs=1e-9)
    got = {r.h: r.z for r in df.select(sampling.lane(["id"], 0).alias("h"), booster.predict(models[2]).alias("z")).collect()}
    assert {r.h: r.margins[2] for r in rows} == pytest.approx(got)


def test_partitions_and_order_do_not_matter(spark, tmp_path):
    rows = _data()
    settings = Settings(trees=10, depth=4, rate=0.2)  # more trees than a snapshot has
    seen = []
    for df in (_frame(spark, rows).repartition(7), _frame(spark, rows[::-1]).coalesce(1)):
        parts, cuts = booster.prepared(df, COLUMNS, "y", ["id"])
        (model,), told = booster.boost(parts, COLUMNS, cuts, 0, settings)
        seen.append(model)
        assert told.count() == 240
    assert np.array_equal(seen[0].trees.value, seen[1].trees.value) and np.array_equal(seen[0].trees.part, seen[1].trees.part)
    booster.save(seen[0], str(tmp_path / "m"))
    back = booster.load(spark, str(tmp_path / "m"))
    df = _frame(spark, rows)
    pairs = df.select(booster.predict(seen[0]).alias("x"), booster.predict(back).alias("z"), "y").collect()
    assert all(r.x == r.z for r in pairs)
    mean = sum(r.y for r in pairs) / len(pairs)
    assert sum((r.x - r.y) ** 2 for r in pairs) < 0.15 * sum((r.y - mean) ** 2 for r in pairs)


def test_nulls_take_the_side_that_fits(spark):
    """The label of rows without a value is that of the high ones in one set and of the low ones in the other."""
    for like in (0.0, 1.0):
        rows = [(i, None if i % 3 == 0 else float(i % 3), None, 0.0, like if i % 3 == 0 else float(i % 3 == 2)) for i in range(90)]
        parts, cuts = booster.prepared(_frame(spark, rows), COLUMNS, "y", ["id"])
        (model,), _ = booster.boost(parts, COLUMNS, cuts, 0, Settings(trees=4, depth=1, rate=0.9, rows=1.0, columns=1.0))
        got = {r.a: r.z for r in _frame(spark, rows).select("a", booster.predict(model).alias("z")).distinct().collect()}
        assert got[None] == pytest.approx(like, abs=0.05) and got[1.0] == pytest.approx(0, abs=0.05) and got[2.0] == pytest.approx(1, abs=0.05)


def test_least_rows_and_odd_labels(spark):
    rows = [(i, float(i), None, 0.0, 0.0) for i in range(20)] + [(20 + i, 100.0 + i, None, 0.0, 9.0) for i in range(4)] + [(90, 1.0, 1.0, 1.0, None), (91, 1.0, 1.0, 1.0, float("nan")), (92, 1.0, 1.0, 1.0, float("inf"))]
    parts, cuts = booster.prepared(_frame(spark, rows), COLUMNS, "y", ["id"])
    (model,), told = booster.boost(parts, COLUMNS, cuts, 0, Settings(trees=1, depth=1, rows=1.0, columns=1.0))
    assert told.count() == 24
    place = model.trees.part[0, 0]
    assert model.trees.column[0, 0] == 0 and model.cuts[0][place] == 18.0  # five rows at least: the four high ones and one more
    none = booster.prepared(_frame(spark, []), COLUMNS, "y", ["id"])
    (empty,), told = booster.boost(none[0], COLUMNS, none[1], 0, Settings(trees=3))
    assert told.count() == 0 and {r.z for r in _frame(spark, rows).select(booster.predict(empty).alias("z")).collect()} == {0.0}


def test_cuts():
    assert booster.cuts_of(np.array([3.0, 1.0, 1.0, np.nan, np.inf])) == [1.0]
    assert booster.cuts_of(np.array([])) == []
    many = booster.cuts_of(np.arange(10_000.0))
    assert len(many) == 254 and all(b - a < 41 for a, b in zip(many, many[1:]))
    parts = booster.parts_of([np.array([0.0, 1.0, 2.0, np.nan])], [[1.0]])
    assert parts.ravel().tolist() == [0, 0, 1, 255]


def test_a_level_is_a_job_of_one_stage(spark, monkeypatch):
    plans = []
    frame = type(spark.range(1))
    told = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), told(df))[1])
    rows = spark.range(500).selectExpr("id", "cast(id % 17 as double) a", "cast(id % 5 as double) b", "cast(id % 17 + id % 5 as double) y").repartition(23)
    parts, cuts = booster.prepared(rows, ("a", "b"), "y", ["id"])
    models, _ = booster.boost(parts, ("a", "b"), cuts, settings=booster.Settings(trees=3, depth=3))
    assert len(plans) == 9 and all("MapInArrow" in p and "Exchange" not in p for p in plans)
    assert all("Coalesce" in p for p in plans) and len(models[-1].trees.column) == 3
