"""Frames of an animation as rows: which two days a frame lies between, and every station's interpolated value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def total_frames(start: dt.date, end: dt.date, per_day: int) -> int:
    if end < start or per_day < 1:
        raise ValueError("a frame range needs start <= end and a frame a day at least")
    return (end - start).days * per_day + 1


def plan(spark: SparkSession, start: dt.date, end: dt.date, per_day: int) -> DataFrame:
    """frame, name, day_a, day_b, step. The last frame lies on the end itself."""
    day_a = F.date_add(F.lit(start), F.floor(F.col("frame") / per_day).cast("int"))
    last = day_a >= F.lit(end)
    return spark.range(total_frames(start, end, per_day)).withColumnRenamed("id", "frame").select(
        "frame", F.format_string("frame_%07d.png", "frame").alias("name"), day_a.alias("day_a"), F.when(last, F.lit(end)).otherwise(F.date_add(day_a, 1)).alias("day_b"), F.when(last, 0.0).otherwise((F.col("frame") % per_day) / per_day).alias("step")
    )


def shards(spark: SparkSession, frames: int, shards: int) -> DataFrame:
    """shard, first_index, last_index: balanced blocks; the first ones are longer by one."""
    base, extra = divmod(frames, shards)
    i = F.col("shard")
    first = i * base + F.least(i, F.lit(extra))
    return spark.range(shards).withColumnRenamed("id", "shard").select("shard", first.alias("first_index"), (first + base + (i < extra).cast("int") - 1).alias("last_index")).where("last_index >= first_index")


def missing(expected: DataFrame, existing: DataFrame) -> DataFrame:
    return expected.join(existing.select("name").distinct(), "name", "left_anti")


def points(frames: DataFrame, obs: DataFrame, step: str = "step") -> DataFrame:
    """frame, station_id, latitude, longitude, value, is_error, for stations that report on either day of a frame.

    ``obs``: station_id, obs_date, latitude, longitude, value and optionally is_error. A station that failed both checks on the frame's own
    day is an error point without value; missing, failed and absent values count as zero, so stations fade in and out."""
    if "is_error" not in obs.columns:
        obs = obs.withColumn("is_error", F.lit(False))
    row = F.struct("latitude", "longitude", "value", "is_error")
    sides = frames.select("frame", "step", F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("day_a").alias("obs_date")), F.struct(F.lit("b").alias("side"), F.col("day_b").alias("obs_date")))).alias("d")).select("frame", "step", "d.*")
    met = sides.join(obs.select("station_id", "obs_date", row.alias("row")), "obs_date")
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("row"))).alias(s)
    both = met.groupBy("frame", "step", "station_id").agg(side("a"), side("b"))
    at = lambda c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}"))
    value = lambda s: F.when(F.coalesce(F.col(f"{s}.is_error"), F.lit(False)), 0.0).otherwise(F.coalesce(F.col(f"{s}.value"), F.lit(0.0)))
    error = F.coalesce(F.col("a.is_error"), F.lit(False))
    return both.select("frame", "station_id", at("latitude").alias("latitude"), at("longitude").alias("longitude"), F.when(~error, value("a") + (value("b") - value("a")) * F.col("step")).alias("value"), error.alias("is_error"))
