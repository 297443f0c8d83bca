import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import analysis, lookups, ranks, sampling
from pluvio.sources import numbering


def _cases():
    r = random.Random(1)
    yield [r.gauss(0, 1) for _ in range(500)]
    yield [r.choice([0.0, 0.0, 0.0, 1e-300, 5.0, 1e300, -1e300]) for _ in range(200)]
    yield [10.0**k for k in range(-300, 300, 7)]
    yield [2.5] * 40
    yield [7.0]
    yield [1.7e308, -1.7e308, 1.0, 2.0]


def test_ranks_are_those_of_the_sorted_values(spark):
    for values in _cases():
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5).cache()
        n = len(values)
        wanted = sorted({0, n - 1, n // 2, n // 3, min(n - 1, n // 2 + 1)})
        assert ranks.order_statistics(df, "v", wanted) == (n, [sorted(values)[i] for i in wanted])


def test_quantiles_between_ranks_and_nearest(spark):
    r = random.Random(2)
    values = [round(r.expovariate(1), 2) for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in values], "v double").cache()
    shares = [0.0, 0.05, 0.5, 0.98, 1.0]
    assert ranks.quantiles(df, "v", shares) == pytest.approx(np.quantile(values, shares))
    assert ranks.quantiles(df, "v", shares, nearest=True) == [sorted(values)[max(0, math.ceil(s * 301) - 1)] for s in shares]
    assert ranks.quantiles(df.where("v < 0"), "v", [0.5, 0.9]) == [None, None]
    assert lookups.colour_ceiling(df.where("v < 0"), "v").first()[0] is None
    with pytest.raises(IndexError):
        ranks.order_statistics(df, "v", [301])


def _rows(spark, n, parts):
    return spark.range(n).select((F.col("id") % 50).alias("a"), F.when(F.col("id") % 9 != 0, F.col("id")).alias("b"), (F.col("id") * 3 % 7).alias("more")).repartition(parts)


def test_a_sample_depends_on_the_rows_alone(spark):
    of = lambda parts, k, seed=0: sorted(map(str, sampling.bottom_k(_rows(spark, 2000, parts), ["a", "b"], k, seed).collect()))
    one, other = of(1, 300), of(7, 300)
    assert one == other and len(one) == 300 and of(3, 300, 1) != one
    assert set(of(2, 40)) <= set(one)
    assert len(of(2, 5000)) == 2000 and of(2, 0) == []
    same = spark.range(100).select(F.lit(1).alias("a"), F.lit(None).cast("long").alias("b"), F.lit(2).alias("more"))  # all are drawn together
    assert sampling.bottom_k(same, ["a", "b"], 17).count() == 17


def test_a_sample_is_spread(spark):
    taken = sampling.bottom_k(spark.range(20_000), ["id"], 2000).agg(F.avg("id"), F.stddev("id")).first()
    assert abs(taken[0] - 10_000) < 500 and abs(taken[1] - 5773) < 300


def test_stations_of_any_span(spark):
    r = random.Random(4)
    rows = [(1900 + r.randrange(6), f"s{r.randrange(300)}") for _ in range(900)] + [(1903, None)]
    obs = spark.createDataFrame(rows, "year int, station_id string")
    bitmaps = analysis.station_bitmaps(obs, numbering.dense(obs, "station_id")).cache()
    spans = [(a, b) for a in range(1898, 1908) for b in range(a, 1908)] + [(1905, 1900), (1900, 1902), (1900, 1902)]
    got = {(x.first_year, x.last_year): x.n_stations for x in analysis.stations_of_spans(bitmaps, spark.createDataFrame(spans, "first_year int, last_year int")).collect()}
    assert got == {(a, b): len({s for y, s in rows if s and a <= y <= b}) for a, b in spans}


def test_bitmaps_of_many_stations(spark):
    obs = spark.range(70_000).select(F.lit(1900).alias("year"), F.format_string("s%06d", "id").alias("station_id"))
    bitmaps = analysis.station_bitmaps(obs, numbering.dense(obs, "station_id"))
    assert bitmaps.count() == 3  # 32,768 ids each
    assert analysis.stations_of_spans(bitmaps, spark.createDataFrame([(1900, 1900)], "first_year int, last_year int")).first().n_stations == 70_000
