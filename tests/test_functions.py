"""Small cases with results worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from pluvio.functions import arrays, compat, geo, qc, text


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def arr(*v):
    return F.array(*(F.lit(x).cast("double") for x in v)).cast("array<double>")


@pytest.mark.parametrize(
    ("values", "median", "mad", "iqr"),
    [((), None, None, None), ((3.0,), 3.0, 0.0, None), ((1.0, 2.0), 1.5, 0.5, 1.0), ((2.10, 2.10, 2.11, 0.0, 2.10), 2.10, 0.0, 1.055), ((None, 4.0, 1.0, None, 9.0), 4.0, 3.0, 8.0)],
)
def test_medians(spark, values, median, mad, iqr):
    r = one(spark, arrays.median(arr(*values)).alias("m"), arrays.mad(arr(*values)).alias("d"), arrays.iqr(arr(*values)).alias("i"))
    for got, want in ((r.m, median), (r.d, mad), (r.i, iqr)):
        assert got is None if want is None else math.isclose(got, want, abs_tol=1e-12)


def test_constant_vector_scales_to_zeros_and_has_no_cosine(spark):
    v = arr(*[2.0] * 12)
    r = one(spark, arrays.robust_scale(v).alias("s"), arrays.cosine(arrays.robust_scale(v), v).alias("c"))
    assert r.s == [0.0] * 12 and r.c == -math.inf


def test_scale_with_too_few_values(spark):
    assert one(spark, arrays.robust_scale(arr(None, 1.0, None)).alias("s")).s == [None] * 3


def test_zeros_of_unknown_vector(spark):
    r = one(spark, arrays.zeros(F.lit(None).cast("array<double>")).alias("a"), arrays.zeros(arr(0.0, None, 1.0, 0.0)).alias("b"))
    assert (r.a, r.b) == (12, 2)


def test_slots(spark):
    entries = F.array(*(F.struct(F.lit(m).alias("slot"), F.lit(v).alias("value")) for m, v in ((2, 5.0), (12, 7.0))))
    assert one(spark, arrays.slots(entries).alias("s")).s == [None, 5.0, *[None] * 9, 7.0]


def test_fixed_decimals_round_half_to_even(spark):
    r = one(spark, *(text.decimals(F.lit(x).cast("double"), 1).alias(f"c{i}") for i, x in enumerate((2.25, 2.35, 1234567.0, None, float("nan")))))
    assert list(r) == ["2.2", "2.4", "1234567.0", "NA", "NA"]


def test_cents_tolerance(spark):
    gap = lambda a, b: F.abs(text.cents(F.lit(a)) - text.cents(F.lit(b)))
    r = one(spark, gap(1.00, 1.01).alias("a"), gap(1.00, 1.02).alias("b"))
    assert (r.a, r.b) == (1, 2)


def test_text(spark):
    p = text.page_name_parts(F.lit("DRain_1921-1930_RainNos_Glos_x_C-S-435"))
    q = text.page_name_parts(F.lit("other"))
    r = one(spark, *(c.alias(n) for n, c in p.items()), *(c.alias("no_" + n) for n, c in q.items()))
    assert list(r) == [1921, 1930, "Glos_x", "C-S-435", None, None, None, None]
    r = one(spark, text.safe_id(F.lit("Añb c/d.json")).alias("a"), text.safe_id(F.lit(None).cast("string")).alias("b"), text.meta_value(F.lit("qc1=pass|x=1"), "qc1").alias("c"), text.meta_value(F.lit(""), "qc2").alias("d"))
    assert list(r) == ["Añb_c_d.json", "station", "pass", "NA"]
    r = one(spark, *(text.lenient_double(F.lit(x)).alias(f"c{i}") for i, x in enumerate((" 1.5 ", "NA", "", "x"))))
    assert list(r) == [1.5, None, None, None]


def test_ladder(spark):
    cases = [("pass", None, 1), ("fail", "pass", 2), ("review", "fail", 3), ("fail", "indeterminate", 4), ("fail", "fail", 5), (None, "pass", 5), (None, None, 5), (" PASS ", "fail", 1)]
    df = spark.createDataFrame(cases, "q1 string, q2 string, want int")
    assert df.where(qc.trust_rank(F.col("q1"), F.col("q2")) != F.col("want")).count() == 0
    trusted = {tuple(r) for r in df.select("q1", "q2", qc.trusted(F.col("q1"), F.col("q2")).alias("t")).collect()}
    assert ("fail", "indeterminate", True) in trusted and ("fail", "fail", False) in trusted and (None, None, False) in trusted


def test_rollup_of_flags(spark):
    df = spark.createDataFrame([(1, "pass"), (1, "review"), (2, "pass"), (2, "fail"), (2, "review"), (3, "pass")], "k int, f string")
    assert dict(df.groupBy("k").agg(qc.worst(F.col("f"))).collect()) == {1: "review", 2: "fail", 3: "pass"}


def test_arg_max_takes_the_least_of_equals_and_skips_null_payloads(spark):
    df = spark.createDataFrame([("b", "x", 5.0), ("a", None, 5.0), ("c", "z", 4.0)], "id string, name string, v double")
    r = df.agg(compat.arg_max(F.col("id"), F.col("v"), F.col("id"), F.lit(True)).alias("i"), compat.arg_max(F.col("name"), F.col("v"), F.col("id"), F.lit(True)).alias("n")).first()
    assert (r.i, r.n) == ("a", "x")


def test_distance(spark):
    km = one(spark, geo.equirectangular_km(F.lit(51.0), F.lit(0.0), F.lit(52.0), F.lit(0.0)).alias("d")).d
    assert math.isclose(km, 6371 * math.radians(1), rel_tol=1e-12)


def test_statistics_of_long_arrays_are_computed_once(spark):
    """A lambda that recomputed the median for every element would take minutes here."""
    import statistics
    import time

    n = 1000
    v = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.pmod(F.xxhash64(i, F.col("id")), F.lit(100_003)) / 7.0)
    df = spark.range(40).select("id", v.alias("v")).repartition(4)
    began = time.time()
    got = df.select("v", arrays.mad(F.col("v")).alias("mad"), arrays.stdev(F.col("v")).alias("sd"), arrays.robust_scale(F.col("v")).alias("s"), arrays.iqr(F.col("v")).alias("iqr")).collect()
    assert time.time() - began < 30
    for r in got[:3]:
        m = statistics.median(r.v)
        want = statistics.median(abs(x - m) for x in r.v)
        assert math.isclose(r.mad, want) and math.isclose(r.sd, statistics.stdev(r.v)) and math.isclose(r.s[5], (r.v[5] - m) / want)
        assert math.isclose(r.iqr, statistics.median(sorted(r.v)[500:]) - statistics.median(sorted(r.v)[:500]))


def test_all_equal(spark):
    r = one(spark, *(arrays.all_equal(arr(*v)).alias(f"c{i}") for i, v in enumerate(((2.0, 2.0, 2.0), (2.0, None, 2.0), (2.0, 3.0), ()))))
    assert list(r) == [True, False, False, False]


def test_json_text(spark):
    """The same text as json.dumps, for numbers of every size."""
    import json
    import random
    import struct

    rnd = random.Random(9)
    xs = [0.0, -0.0, 1.0, -2.5, 0.1, 1e-4, 9.9e-5, 1e-5, 1e7, 12345678.5, 1e15, 9.5e15, 1e16, 1.5e16, 1e22, 1e100, 1.7e308, float("nan"), float("inf"), float("-inf"), 123456789012345680.0]
    xs += [float(f"{rnd.uniform(-1, 1) * 10 ** rnd.randint(-8, 14):.12g}") for _ in range(400)]
    most = len(xs)
    xs += [5e-324] + [rnd.uniform(-1, 1) * 10 ** rnd.randint(-20, 25) for _ in range(200)] + [x for x in (struct.unpack("d", rnd.randbytes(8))[0] for _ in range(200)) if x == x]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    got = [r.t for r in df.coalesce(1).select(text.json_number(F.col("x")).alias("t")).collect()]
    assert [t for t, x in zip(got[:most], xs) if t != json.dumps(x)] == [] and got[-1] == "null"
    assert [t for t, x in zip(got[most:], xs[most:]) if json.loads(t) != x] == []
    one = spark.createDataFrame([([1.0, None, 0.5], "b"), ([], None), (None, "c")], "v array<double>, s string")
    told = [tuple(r) for r in one.select(text.json_list(F.col("v")), text.json_object(z=F.lit("1"), a=F.concat(F.lit('"'), "s", F.lit('"')))).collect()]
    assert told == [("[1.0, null, 0.5]", '{"a": "b", "z": 1}'), ("[]", '{"z": 1}'), (None, '{"a": "c", "z": 1}')]
