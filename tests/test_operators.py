"""Domain operators on tables of a few rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvio.functions import compat
from pluvio.operators import assign, booster, consensus, export, frames, lookups, match, qc1, regional, secondary, vectors
from pluvio.plans import adapters as a
from pluvio.schemas import SCHEMAS

SF = "/root/testdata/sf0.001"


def test_two_consensus_definitions(spark):
    rows = [(1, 1, 1, j, v, m) for j, (v, m) in enumerate([(0.10, 0), (0.10, 0), (None, 0), (None, 1), (0.12, 0)], 1)]
    df = spark.createDataFrame(rows, "file_id long, day_of_month int, month int, ensemble_member int, rainfall double, is_missing int")
    assert consensus.daily(df).first().consensus_value == 0.10
    assert consensus.daily_for_maps(df).first().value == 0.10


def _stations(spark, vectors_):
    rows = [(f"s{i}", y, m, v) for i, (y, vec) in enumerate(vectors_) for m, v in enumerate(vec, 1) if v is not None]
    monthly = spark.createDataFrame(rows, "station_file_id string, year int, month int, rainfall_in double")
    st = spark.createDataFrame([(f"s{i}", f"Name {i}", str(i), 51.0 + i / 10, -1.0, 100) for i in range(len(vectors_))], "station_file_id string, location_name string, station_number string, latitude double, longitude double, elevation_ft int")
    return monthly, st


def _pages(spark, pages):
    rows = [(p, m, 1, v, 0) for p, vec in pages.items() for m, v in enumerate(vec, 1) if v is not None]
    totals = spark.createDataFrame(rows, "file_id long, month int, ensemble_member int, total double, is_missing int")
    files = spark.createDataFrame([(p, f"P{p}.json", None, None, None, None) for p in pages], "file_id long, file_name string, descriptor string, section_id string, year_start int, year_end int")
    return totals, files


def _plain_match(stations, page, k, least):
    known = [i for i, v in enumerate(page) if v is not None]
    if len(known) < least:
        return []
    exact = lambda s: sum(abs(round((s[i] or 0) * 100) - round(page[i] * 100)) <= 1 for i in known)
    return sorted((exact(s) for _, s in stations), reverse=True)[:k]


def test_match_against_all_pairs(spark):
    import random

    rnd = random.Random(3)
    stations = [(1900 + i % 3, [rnd.choice([None, 0.0, 1.0, 1.01, 1.02, 2.5, 3.0]) for _ in range(12)]) for i in range(14)]
    pages = {p: [rnd.choice([None, 0.0, 1.0, 2.5, 3.01]) for _ in range(12)] for p in range(1, 9)}
    monthly, st = _stations(spark, stations)
    totals, files = _pages(spark, pages)
    rr = vectors.station_years(monthly, st)
    have = {r.rr_vector_id for r in rr.collect()}
    kept = [s for i, s in enumerate(stations) if f"s{i}::{s[0]}" in have]
    got = match.top_k(vectors.member_values(totals), vectors.pages(totals, files), rr, k=4, min_overlap=6).collect()
    for p, vec in pages.items():
        mine = sorted((r for r in got if r.ensemble_vector_id == f"ensemble_file::{p}"), key=lambda r: r.query_rank)
        assert [r.exact_agreement_count for r in mine] == _plain_match(kept, vec, 4, 6)
        order = [(-r.exact_agreement_count, -r.adjusted_score, r.rr_vector_id) for r in mine]
        assert order == sorted(order)


def test_places(spark):
    v = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 1.5, 2.5, 3.5]
    zeros = [0.0, 0.0, 0.0, 0.0, *v[4:]]
    monthly, st = _stations(spark, [(1900, v), (1900, zeros), (1900, [x + 1 for x in v]), (1901, [x + 2 for x in v])])
    rr = vectors.station_years(monthly, st)
    row = lambda page, rank, s, y, exact: (1, rank, f"ensemble_file::{page}", f"s{s}::{y}", exact)
    m = spark.createDataFrame(
        [row(1, 1, 0, 1900, 9), row(2, 1, 1, 1900, 9), row(2, 2, 0, 1900, 5), row(2, 3, 2, 1900, 4), row(3, 1, 0, 1900, 8), row(3, 2, 2, 1900, 7), row(4, 1, 0, 1900, 8), row(4, 2, 2, 1900, 7), row(4, 3, 3, 1901, 7)],
        "session_id long, query_rank long, ensemble_vector_id string, rr_vector_id string, exact_agreement_count long")
    files = spark.createDataFrame([(i, f"P{i}.json") for i in range(1, 6)], "file_id long, file_name string")
    got = {r.file_id: r for r in assign.metadata(m, rr, st, files, 1).collect()}
    assert [got[i].match_type for i in range(1, 6)] == ["exact", "approximate", None, None, None]
    assert got[1].matched_location_name == "Name 0" and got[1].matched_elevation_ft == 100.0
    assert got[2].matched_location_name is None and got[2].matched_year == 1900 and abs(got[2].matched_latitude - 51.1) < 1e-9


def test_first_check_reasons(spark):
    daily = spark.createDataFrame([(p, m, d, v) for p in (1, 2, 3) for m in (1, 3) for d, v in ((1, 1.0), (2, 1.105))], "file_id long, month int, day_of_month int, consensus_value double")
    monthly = spark.createDataFrame([("s", 1900, 1, 2.10)], "station_file_id string, year int, month int, rainfall_in double")
    rr = spark.createDataFrame([("s::1900", "s", 1900), ("t::1900", "t", 1900)], "rr_vector_id string, station_file_id string, year int")
    matched = spark.createDataFrame([(1, "s::1900"), (2, "t::1900")], "file_id long, rr_vector_id string")
    got = {(r.file_id, r.month): (r.reason, r.qc_flag) for r in qc1.results(daily, matched, rr, monthly, 1).collect()}
    assert got[1, 1] == ("exact_monthly_compare", "pass") and got[1, 3] == ("missing_rr_monthly_value", "fail")
    assert got[2, 1] == got[3, 3] == ("non_exact_specifier", "fail")


def test_neighbours(spark):
    deg = lambda km: km / (6371 * 3.141592653589793 / 180)
    places = {1: 0, 2: deg(10), 3: deg(30), 4: deg(60)}
    meta = spark.createDataFrame([(p, 1900, 51.0 + d, 0.0, 1) for p, d in places.items()], "file_id long, matched_year long, matched_latitude double, matched_longitude double, match_source_session_id long")
    cons = spark.createDataFrame([(p, 1, d, v) for p, v in ((1, 0.0), (2, 1.0), (3, 3.0), (4, 9.0)) for d in (1, 2)], "file_id long, month int, day_of_month int, consensus_value double")
    ok = spark.createDataFrame([(1, p, 1, d, "fail" if (p, d) == (2, 2) else "pass") for p in places for d in (1, 2)], "qc_session_id long, file_id long, month int, day_of_month int, final_flag string")
    got = {(r.file_id, r.day_of_month): r for r in regional.daily_stats(meta, cons, ok, 1, 1).collect()}
    a1, a2 = got[1, 1], got[1, 2]
    assert (a1.n_20km, a1.median_20km, a1.mad_20km, a1.n_50km, a1.median_50km, a1.mad_50km) == (1, 1.0, 0.0, 2, 2.0, 1.0)
    assert (a2.n_20km, a2.median_20km, a2.n_50km) == (0, None, 1)
    assert len(got) == 8 and regional.violations(regional.daily_stats(meta, cons, ok, 1, 1)).drop("rows").first() == (0, 0, 0, 0)


def test_pairs_against_all_pairs(spark):
    import math
    import random

    rnd = random.Random(5)
    rows = [(i, 1900 + i % 2, rnd.uniform(55, 75), rnd.uniform(-3, 3)) for i in range(150)]
    m = spark.createDataFrame(rows, "file_id long, year int, lat double, lon double")
    got = {(r.file_id, r.nb_file_id) for r in regional.station_pairs(m, m).collect()}
    km = lambda a, b: 6371 * math.hypot(math.radians(b[2] - a[2]), math.radians(b[3] - a[3]) * math.cos(math.radians((a[2] + b[2]) / 2)))
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and a[1] == b[1] and km(a, b) <= 50}


def test_second_check_covers(spark):
    stats = spark.range(2000).select(F.col("id").alias("file_id"), F.lit(1900).cast("long").alias("matched_year"), (F.col("id") % 12 + 1).cast("int").alias("month"), F.lit(1).alias("day_of_month"), F.lit(3).cast("long").alias("n_20km"), (F.rand(1) * 2).alias("median_20km"), F.lit(None).cast("double").alias("mad_20km"), (F.col("id") % 4).alias("n_50km"), F.rand(2).alias("median_50km"), F.rand(3).alias("mad_50km"))
    stats = stats.withColumn("consensus_value", F.when(F.col("file_id") % 97 != 0, F.col("median_20km") + F.randn(4) * 0.1 + 0.5)).cache()
    status = stats.select(F.lit(1).cast("long").alias("qc_session_id"), "file_id", "month", "day_of_month", F.when(F.col("file_id") % 3 == 0, "fail").otherwise("pass").alias("final_flag"))
    t = secondary.train(secondary.training_rows(stats, status, 1), settings=booster.Settings(trees=16, depth=3, rate=0.3))
    assert t.coverage_achieved >= 0.97 and t.k > 0 and t.n_calib > 100 and t.r2_transformed > 0.8
    out = secondary.score(stats, status, t, 1)
    r = {x.secondary_flag: x.n for x in out.groupBy("secondary_flag").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert r["pass"] > 400 and out.where("secondary_flag = 'indeterminate' and predicted_consensus is not null").count() == 0
    assert out.where("secondary_flag = 'indeterminate'").count() >= 150


def _rows(spark, rows):
    cols = "file_id long, file_name string, matched_location_name string, matched_latitude double, matched_longitude double, matched_elevation_ft double, matched_year long, match_type string, group_key string, month int, day_of_month int, consensus_value double, qc1_flag string, qc2_flag string"
    return spark.createDataFrame([(f, f"P{f}.json", "Mill", 51.25, -1.5, 300.0, 1901, "exact", "g", 1, d, v, a_, b) for f, d, v, a_, b in rows], cols)


def test_merge_takes_the_best_verdict(spark):
    rows = _rows(spark, [(7, 1, 0.7, "fail", "pass"), (3, 1, 0.3, "fail", "indeterminate"), (7, 2, 0.7, "pass", None), (3, 2, 0.3, "pass", None), (7, 3, 0.1, "pass", None)])
    got = {r.day_of_month: r.file_id for r in export.merged_days(rows).collect()}
    assert got == {1: 7, 2: 3, 3: 7}
    s = export.merged_stations(rows).first()
    assert s.file_name == "P7.json" and s.sources == ["P3", "P7"] and s.n_sources == 2


def test_frames(spark):
    plan = frames.plan(spark, dt.date(1901, 1, 1), dt.date(1901, 1, 2), 3)
    obs = spark.createDataFrame([("a", dt.date(1901, 1, 1), 51.0, 0.0, 3.0, False), ("b", dt.date(1901, 1, 1), 52.0, 0.0, 9.0, True), ("b", dt.date(1901, 1, 2), 52.0, 0.0, 6.0, False)], "station_id string, obs_date date, latitude double, longitude double, value double, is_error boolean")
    got = {(r.frame, r.station_id): r for r in frames.points(plan, obs).collect()}
    assert plan.count() == 4 and got[1, "a"].value == pytest.approx(2.0) and got[1, "b"].is_error and got[1, "b"].value is None
    assert got[3, "b"].value == 6.0 and (3, "a") not in got
    with pytest.raises(ValueError):
        frames.total_frames(dt.date(1901, 1, 2), dt.date(1901, 1, 1), 1)


def test_adapters_follow_the_schemas(spark):
    for name, df in (("ensemble_daily_values", a.member_days(spark, SF)), ("ensemble_files", a.pages(spark, SF)), ("monthly_rainfall", a.monthly(spark, SF)), ("stations", a.stations(spark, SF)), ("ensemble_metadata", a.metadata(spark, SF))):
        want = {f.name: f.dataType for f in SCHEMAS[name]}
        assert {f.name: f.dataType for f in df.schema} == want, name


def test_map_consensus_of_a_range(spark):
    df = spark.createDataFrame([(i, 1, 1, float(i)) for i in range(1, 7)], "file_id long, month int, day_of_month int, rainfall double")
    ids = lambda *r: sorted(x.file_id for x in consensus.daily_for_maps(df, *r).collect())
    assert ids() == [1, 2, 3, 4, 5, 6] and ids(2, 4) == [2, 3, 4] and ids(5) == [5, 6] and ids(None, 2) == [1, 2]


def test_match_in_blocks_is_the_match_at_once(spark):
    import random

    rnd = random.Random(9)
    monthly, st = _stations(spark, [(1900, [rnd.choice([0.0, 1.0, 2.5, 3.0]) for _ in range(12)]) for _ in range(25)])
    totals, files = _pages(spark, {p: [rnd.choice([0.0, 1.0, 2.5, 3.01]) for _ in range(12)] for p in range(1, 7)})
    rr = vectors.station_years(monthly, st)
    run = lambda block: sorted(map(tuple, match.top_k(vectors.member_values(totals), vectors.pages(totals, files), rr, k=4, block=block).collect()))
    whole = run(1000)
    assert len(whole) == 24 and run(7) == whole


def test_match_without_stations_or_pages(spark):
    monthly, st = _stations(spark, [(1900, [1.0] * 12)])
    totals, files = _pages(spark, {1: [1.0] * 12})
    rr = vectors.station_years(monthly, st)
    members, pages = vectors.member_values(totals), vectors.pages(totals, files)
    assert match.top_k(members, pages, rr.limit(0)).count() == 0
    assert match.top_k(members.limit(0), pages, rr).count() == 0


def test_runs_take_null_as_a_value(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "a"), (2, 1, None)], "k int, t int, v string")
    got = {(r.k, r.t): r.run for r in compat.runs(df, ("k",), ("t",), "v").collect()}
    assert got == {(1, 1): 1, (1, 2): 1, (1, 3): 2, (1, 4): 2, (1, 5): 3, (2, 1): 1}
    assert compat.runs(df.limit(0), ("k",), ("t",), "v").count() == 0


def test_parts_by_offset_make_up_the_whole(spark):
    df = spark.range(10)
    assert [[r.id for r in compat.part_of(df, ("id",), 4, s).collect()] for s in (0, 4, 8, 12)] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9], []]


def test_colour_positions_are_held_to_the_scale(spark):
    df = spark.createDataFrame([(-1.0, 4.0), (1.0, 4.0), (9.0, 4.0), (None, 4.0), (0.0, 0.0)], "v double, c double")
    assert [r.p for r in df.select(lookups.colour_position(F.col("v"), F.col("c")).alias("p")).collect()] == [0.0, 0.5, 1.0, None, 0.0]


def test_new_assignment_leaves_no_old_place(spark):
    old = spark.createDataFrame([(1, "x", "n1"), (2, "y", "n2")], "k int, place string, name string")
    new = spark.createDataFrame([(2, "z"), (3, "w")], "k int, place string")
    assert sorted(tuple(r) for r in assign.reassigned(old, new, "k", "place").collect()) == [(1, None, "n1"), (2, "z", "n2")]


def _index(n, seed):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    cents = rng.integers(0, 400, (n, 12))
    cents[rng.random((n, 12)) < 0.1] = 0  # blank months rank as zero
    rows = pa.table({"rr_vector_id": [f"s{i:06d}" for i in range(n)], "cents": cents.tolist(), "norm": rng.normal(size=(n, 12)).astype(np.float32).tolist()})
    return match.Index(rows), cents


def test_index_finds_what_all_pairs_find():
    import numpy as np

    index, cents = _index(3000, 1)
    rng = np.random.default_rng(2)
    for trial in range(60):
        months = rng.choice(12, rng.integers(1, 13), replace=False)
        own = {int(m): rng.integers(0, 420, rng.integers(1, 6)) for m in months}
        cells = np.array([m * match._SHIFT + v for m, values in own.items() for v in values], np.int64)
        agree = sum((np.abs(cents[:, m, None] - v[None, :]) <= 1).any(axis=1).astype(int) for m, v in own.items())
        norm = rng.normal(size=12)
        norm[rng.random(12) < 0.2] = np.nan
        cosine = index.cosine(norm, np.arange(3000))
        want = sorted(zip((-agree).tolist(), (0.1 - cosine).tolist(), index.names))[:10]
        got, read, scored = index.best(cells, norm, 0.1, 10, [])
        assert [(-a_, 0.1 - c, n) for a_, c, n in got] == want
        assert read <= 12 * 3000 and scored <= 3000
        half = want[3][0]  # the bound of what is known elsewhere
        others = np.full(10, -half, np.int64)
        which, found, _, _ = index.candidates(cells, 10, others)
        assert set(which.tolist()) == set(np.flatnonzero(agree >= max(found.min() if len(found) else 99, -half)).tolist()) or -half == 0


def test_stations_that_cannot_be_among_the_best_are_not_scored():
    import numpy as np

    rng = np.random.default_rng(3)
    pages = [np.array([m * match._SHIFT + v for m in range(12) for v in rng.integers(0, 400, 2)], np.int64) for _ in range(40)]
    scored = {}
    for n in (2000, 32000):
        index, _ = _index(n, 4)
        scored[n] = np.mean([index.best(p, np.ones(12), 0.0, 10, [])[2] for p in pages])
    assert scored[32000] < 0.75 * 16 * scored[2000] and scored[32000] < 0.1 * 32000, scored


def test_match_reports_its_work(spark):
    import random

    rnd = random.Random(9)
    monthly, st = _stations(spark, [(1900, [rnd.choice([0.0, 1.0, 2.5, 3.0]) for _ in range(12)]) for _ in range(25)])
    totals, files = _pages(spark, {p: [rnd.choice([0.0, 1.0, 2.5, 3.01]) for _ in range(12)] for p in range(1, 7)})
    got = match.ranked(vectors.member_values(totals), vectors.pages(totals, files), vectors.station_years(monthly, st), k=4, block=7).collect()
    assert len(got) == 6 and all(0 < r.scored <= 25 and 0 < r.listed <= 12 * 25 and len(r.best) == 4 for r in got)


def test_copies_of_stations_and_pages_are_ranked_once(spark):
    """Twelve copies of two vectors: no page counts more than two stations to the end, and ties still go to the least ids."""
    monthly, st = _stations(spark, [(1900 + i, [float(m + i % 2) for m in range(1, 13)]) for i in range(24)])
    totals, files = _pages(spark, {p: [float(m) for m in range(1, 13)] for p in range(1, 6)})
    rr = vectors.station_years(monthly, st)
    got = match.ranked(vectors.member_values(totals), vectors.pages(totals, files), rr, k=4, block=7).collect()
    even = sorted(r.rr_vector_id for r in rr.collect() if r.raw_vector[0] == 1.0)
    assert len(got) == 5 and all(r.scored <= 2 and [b.rr_vector_id for b in r.best] == even[:4] and {b.exact for b in r.best} == {12} for r in got)


def test_vectors_of_odd_months(spark):
    nan = float("nan")
    rain = [("a", 1900, 1, 2.0), ("a", 1900, 1, 1.0), ("a", 1900, 2, 3.0), ("a", 1900, 2, None), ("a", 1900, 3, nan), ("a", 1900, 3, 4.0), ("a", 1900, 4, nan), ("a", 1900, 13, 9.0)]
    monthly = spark.createDataFrame(rain, "station_file_id string, year int, month int, rainfall_in double")
    stations = spark.createDataFrame([("a", "A", "1", 1.0, 2.0)], "station_file_id string, location_name string, station_number string, latitude double, longitude double")
    got = vectors.station_years(monthly, stations).first()
    assert got.raw_vector == [1.0, 0.0, 4.0] + [0.0] * 9 and got.n_present == 2
    members = [(1, 1, 5.0, 0), (1, 1, nan, 0), (1, 1, 1.0, 0), (1, 2, None, 0), (1, 2, 3.0, None), (1, 3, 7.0, 1), (1, 4, nan, 0), (1, 5, 2.0, 0), (1, 6, 1.0, 0), (1, 6, 2.0, 0), (1, 6, 4.0, 0), (1, 6, 8.0, 0), (1, 6, 9.0, 0)]
    totals = spark.createDataFrame([(f, m, 1, t, x) for f, m, t, x in members], "file_id long, month int, ensemble_member int, total double, is_missing int")
    files = spark.createDataFrame([(1, "n", "d", "s", 1900, 1900)], "file_id long, file_name string, descriptor string, section_id string, year_start int, year_end int")
    got = vectors.pages(totals, files).first()
    assert got.raw_vector == [3.0, 1.5, None, None, 2.0, 4.0] + [None] * 6
    assert got.monthly_iqr == [4.0, 3.0, None, None, None, 7.0] + [None] * 6
