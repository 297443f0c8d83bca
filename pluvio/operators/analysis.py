"""The analysis data set and its summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import compat

WET_MM, EXTREMES_MM = 1.0, (10.0, 25.0, 50.0)
MIN_STATIONS_A_MONTH, MIN_DAYS_A_STATION = 10, 120


def daily_national(obs: DataFrame) -> DataFrame:
    """daily_national: trusted observations of a day over all stations. Of equal maxima the least station_id counts."""
    good = F.col("passed") & F.col("value_mm").isNotNull()
    value = F.when(good, F.col("value_mm"))
    over = lambda mm: F.count_if(good & (F.col("value_mm") >= mm))
    peak = lambda c: compat.arg_max(F.col(c), F.col("value_mm"), F.col("station_id"), good)
    ge10, ge25, ge50 = EXTREMES_MM
    return obs.groupBy("obs_date", "year").agg(
        F.count(value).alias("n_stations_reporting"), F.avg(value).alias("mean_mm"), F.max(value).alias("max_mm"), peak("station_id").alias("argmax_station_id"), peak("location_name").alias("argmax_location"),
        over(WET_MM).alias("n_wet"), over(ge10).alias("n_ge10"), over(ge25).alias("n_ge25"), over(ge50).alias("n_ge50"),
    )


def _share(cond) -> F.Column:
    return 100.0 * F.avg(cond.cast("int"))


def coverage(obs: DataFrame) -> DataFrame:
    place = F.concat(F.col("latitude").cast("string"), F.lit(","), F.col("longitude").cast("string"))
    return obs.groupBy("year").agg(F.count(F.lit(1)).alias("n_obs"), F.count_distinct("station_id").alias("n_stations"), F.count_distinct(place).alias("n_unique_stations"), (100.0 * F.sum(F.col("passed").cast("int")) / F.count(F.lit(1))).alias("pct_passed"))


def qc_rates(obs: DataFrame) -> DataFrame:
    q1, q2 = F.lower("qc1"), F.lower("qc2")
    second = q2 != "na"
    return obs.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_obs"), _share(q1 == "pass").alias("qc1_pass_pct"), _share(q1 == "review").alias("qc1_review_pct"), _share(q1 == "fail").alias("qc1_fail_pct"),
        F.count_if(second).alias("n_qc2"), (100.0 * F.avg(F.when(second, (q2 == "pass").cast("int")))).alias("qc2_pass_pct"), _share(F.col("passed")).alias("trusted_pct"),
    )


def monthly_qc(obs: DataFrame, least: int = MIN_STATIONS_A_MONTH) -> DataFrame:
    """Stations count once a month, as passed when any of their days did."""
    once = obs.groupBy("station_id", "year", "month").agg(F.max((F.lower("qc1") == "pass").cast("int")).alias("q"), F.max(F.col("passed").cast("int")).alias("t"))
    return once.groupBy(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)).alias("month_start"), "year", "month").agg(
        F.count(F.lit(1)).alias("n_stations"), (100.0 * F.avg("q")).alias("qc1_pass_pct"), (100.0 * F.avg("t")).alias("trusted_pct")
    ).where(F.col("n_stations") >= least)


def station_qc(obs: DataFrame, least: int = MIN_DAYS_A_STATION) -> DataFrame:
    return obs.groupBy("station_id").agg(
        F.min("location_name").alias("location_name"), F.round(F.min("latitude"), 3).alias("lat"), F.round(F.min("longitude"), 3).alias("lon"), F.count(F.lit(1)).alias("n_obs"),
        _share(F.lower("qc1") == "pass").alias("qc1_pass_pct"), _share(F.col("passed")).alias("trusted_pct"),
    ).where(F.col("n_obs") >= least)


def extremes_of(df: DataFrame, by: str, tie: str, n: int, highest: bool = False) -> DataFrame:
    """The n worst (or best) rows by a measure, ties by a unique column."""
    order = F.col(by).desc_nulls_last() if highest else F.col(by).asc_nulls_last()
    return df.orderBy(order, F.col(tie).asc_nulls_last()).limit(n)


def annual(daily: DataFrame) -> DataFrame:
    return daily.groupBy("year").agg(F.avg("mean_mm").alias("mean_daily_mm"), F.sum("mean_mm").alias("annual_total_mm"), F.sum("n_stations_reporting").alias("station_days"))


def intensity(obs: DataFrame) -> DataFrame:
    """sdii_mm: mean of wet station-days; wet_fraction: their share of the reporting ones."""
    wet = F.col("passed") & (F.col("value_mm") >= WET_MM)
    known = F.col("passed") & F.col("value_mm").isNotNull()
    return obs.groupBy("year").agg(F.avg(F.when(wet, F.col("value_mm"))).alias("sdii_mm"), F.avg(F.when(known, wet.cast("int"))).alias("wet_fraction"))


def wettest_days(daily: DataFrame, since: int = 1880, n: int = 12) -> DataFrame:
    rows = daily.where(F.col("year") >= since).orderBy(F.col("mean_mm").desc_nulls_last(), "obs_date").limit(n)
    return rows.select("obs_date", "n_stations_reporting", F.round("mean_mm", 2).alias("mean_mm"), F.round("max_mm", 1).alias("max_mm"), "argmax_location")


def extreme_station_days(obs: DataFrame, n: int = 12) -> DataFrame:
    rows = obs.where(F.col("passed") & F.col("value_mm").isNotNull()).orderBy(F.col("value_mm").desc(), "obs_date", "station_id").limit(n)
    return rows.select("obs_date", "station_id", "location_name", F.round("value_mm", 1).alias("value_mm"), F.round("latitude", 3).alias("lat"), F.round("longitude", 3).alias("lon"))


def extreme_rates(daily: DataFrame) -> DataFrame:
    """Heavy days a thousand reporting station-days."""
    total = F.sum("n_stations_reporting")
    rate = lambda c: F.try_divide(1000.0 * F.sum(c), total)
    return daily.groupBy("year").agg(*(rate(f"n_ge{k}").alias(f"ge{k}_rate") for k in (10, 25, 50)))


def event_map(obs: DataFrame, date: str) -> DataFrame:
    return obs.where((F.col("obs_date") == F.to_date(F.lit(date))) & F.col("passed") & F.col("value_mm").isNotNull()).select("station_id", "longitude", "latitude", "value_mm")


def verdict_counts(obs: DataFrame) -> DataFrame:
    return obs.groupBy("qc1", "qc2").agg(F.count(F.lit(1)).alias("n"))


def parse_summary(obs: DataFrame) -> DataFrame:
    return obs.groupBy("year").agg(F.count(F.lit(1)).alias("n_observations"), F.count_if("passed").alias("n_passed"), F.count_distinct("station_id").alias("n_stations"), F.count_distinct("obs_date").alias("n_days"))


def events_in_range(annual_rows: DataFrame, events: list[tuple[str, str, str]]) -> DataFrame:
    """Known events (date, kind, label) whose year lies within the loaded ones, with that year's total."""
    spark = annual_rows.sparkSession
    table = spark.createDataFrame(events, "date string, kind string, label string").withColumn("event_date", F.to_date("date"))
    span = annual_rows.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    kept = table.withColumn("year", F.year("event_date")).join(F.broadcast(span), F.col("year").between(F.col("lo"), F.col("hi")))
    return kept.join(annual_rows.select("year", "annual_total_mm"), "year", "left").select("event_date", "year", "kind", "label", "annual_total_mm")


def station_bitmaps(obs: DataFrame, ids: DataFrame) -> DataFrame:
    """year, bucket, stations: which stations report in a year, as bitmaps of their dense ids (``numbering.dense``), 32,768 ids each.

    Stored once, they count the stations of any span of years without the observations."""
    once = obs.where(F.col("station_id").isNotNull()).select("year", "station_id").distinct().join(ids, "station_id")
    return once.groupBy("year", F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("stations"))


def stations_of_spans(bitmaps: DataFrame, spans: DataFrame) -> DataFrame:
    """first_year, last_year, n_stations: different stations that report in a span (``first_year``, ``last_year``, both included); 0 where none does.

    A span meets the bitmaps of its years; they are or-ed by bucket and counted. Repeated spans are one."""
    asked = spans.select(F.col("first_year").cast("int").alias("first_year"), F.col("last_year").cast("int").alias("last_year")).distinct()
    each = asked.where(F.col("first_year") <= F.col("last_year")).withColumn("year", F.explode(F.sequence("first_year", "last_year")))
    whole = each.join(bitmaps.withColumn("year", F.col("year").cast("int")), "year").groupBy("first_year", "last_year", "bucket").agg(F.bitmap_or_agg("stations").alias("stations"))
    counts = whole.groupBy("first_year", "last_year").agg(F.sum(F.bitmap_count("stations")).alias("n_stations"))
    return asked.join(counts, ["first_year", "last_year"], "left").select("first_year", "last_year", F.coalesce("n_stations", F.lit(0)).cast("bigint").alias("n_stations"))
