"""Consensus of the transcriptions of a day or a month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import compat

CELL = ("file_id", "month", "day_of_month")


def daily(values: DataFrame, start_file_id: int | None = None, end_file_id: int | None = None) -> DataFrame:
    """file_id, month, day_of_month, consensus_value: the median of a day's transcriptions, where unknown counts as zero.

    The values are sorted and the middle ones taken; a median's buffers, one a day, would cost more than the sort."""
    v = compat.between_ids(values, "file_id", start_file_id, end_file_id)
    cell = Window.partitionBy(*CELL)
    ranked = v.select(*CELL, F.coalesce("rainfall", F.lit(0.0)).alias("v")).withColumn("rank", F.row_number().over(cell.orderBy("v"))).withColumn("n", F.count(F.lit(1)).over(cell))
    return ranked.where((2 * F.col("rank")).between(F.col("n"), F.col("n") + 2)).groupBy(*CELL).agg((F.min("v") / 2 + F.max("v") / 2).alias("consensus_value"))


def daily_for_maps(values: DataFrame, start_file_id: int | None = None, end_file_id: int | None = None) -> DataFrame:
    """The maps' variant: unknown transcriptions are left out; ``spread`` is their range, ``members`` their number."""
    v = compat.between_ids(values, "file_id", start_file_id, end_file_id)
    return (
        v.where(F.col("rainfall").isNotNull()).groupBy(*CELL)
        .agg(F.median("rainfall").alias("value"), (F.max("rainfall") - F.min("rainfall")).alias("spread"), F.count("rainfall").alias("members"))
    )


def monthly_from_days(consensus: DataFrame) -> DataFrame:
    return consensus.groupBy("file_id", "month").agg(F.sum("consensus_value").alias("monthly_total"), F.count(F.lit(1)).alias("days"))


def days_of_month(values: DataFrame) -> DataFrame:
    """file_id, month, days: the days that a page's month has, ascending; 31 at most, whatever the number of transcriptions."""
    return values.groupBy("file_id", "month").agg(F.sort_array(F.collect_set("day_of_month")).alias("days"))
