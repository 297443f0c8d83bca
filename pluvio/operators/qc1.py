"""First check: a page's monthly sum of daily consensus against the independent monthly total, and its roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import qc, text
from .assign import EXACT_MONTHS

CHECK, VERSION, TOLERANCE, PROMOTE = "exact_monthly_consistency", "1.0", 0.01, 0.95


def eligible(matches: DataFrame, session_id: int, exact_metadata: DataFrame | None = None) -> DataFrame:
    """file_id, rr_vector_id of pages whose best match agrees in nine months; also ``exact`` in the metadata where that is given."""
    best = matches.where((F.col("session_id") == session_id) & (F.col("query_rank") == 1) & (F.col("exact_agreement_count") >= EXACT_MONTHS))
    out = best.select(F.expr("cast(replace(ensemble_vector_id, 'ensemble_file::', '') as bigint)").alias("file_id"), "rr_vector_id")
    if exact_metadata is not None:
        out = out.join(exact_metadata.where(F.col("match_type") == "exact").select("file_id"), "file_id", "left_semi")
    return out


def results(daily: DataFrame, matched: DataFrame, station_vectors: DataFrame, monthly: DataFrame, qc_session_id: int, tolerance: float = TOLERANCE, created_at: str | None = None) -> DataFrame:
    """daily_qc_results: a verdict for each day of a page, from its month. Reasons: exact_monthly_compare, missing_rr_monthly_value
    (the station-year has other months), non_exact_specifier (no station-year, or one without a single month)."""
    # a month's days travel with its sum, so that ``daily`` is made once
    totals = daily.where("file_id is not null and month is not null").groupBy("file_id", "month").agg(F.sum("consensus_value").alias("monthly_total"), F.collect_list(F.struct("day_of_month")).alias("days"))
    rr = matched.join(station_vectors.select("rr_vector_id", "station_file_id", "year"), "rr_vector_id").join(monthly, ["station_file_id", "year"])
    values = rr.select("file_id", F.col("month").cast("int").alias("month"), F.col("rainfall_in").alias("rr_total"))
    known = values.select("file_id").distinct().withColumn("known", F.lit(True))
    judged = totals.withColumn("month", F.col("month").cast("int")).join(values, ["file_id", "month"], "left").join(known, "file_id", "left")
    gap = F.abs(F.col("monthly_total") - F.col("rr_total"))
    reason = F.when(F.col("known").isNull(), "non_exact_specifier").when(F.col("rr_total").isNull(), "missing_rr_monthly_value").otherwise("exact_monthly_compare")
    passed = F.coalesce(gap <= tolerance, F.lit(False)) & F.col("known").isNotNull()
    judged = judged.select("file_id", "month", "days", "monthly_total", "rr_total", gap.alias("absolute_difference"), reason.alias("reason"), passed.alias("passed"))
    compared = F.col("reason") == "exact_monthly_compare"  # only then is there a difference to tell
    details = text.json_object(
        absolute_difference=F.when(compared, text.json_number(F.col("absolute_difference"))), monthly_total_consensus=text.json_number(F.col("monthly_total")),
        reason=F.concat(F.lit('"'), "reason", F.lit('"')), rr_monthly_total=text.json_number(F.when(compared, F.col("rr_total"))), tolerance=text.json_number(F.lit(float(tolerance))),
    )
    told = judged.withColumn("details_json", details).withColumn("day_of_month", F.explode("days.day_of_month"))
    return told.select(
        F.lit(qc_session_id).cast("bigint").alias("qc_session_id"), "file_id", F.col("day_of_month").cast("tinyint").alias("day_of_month"), F.col("month").cast("tinyint").alias("month"),
        F.lit(CHECK).alias("check_name"), F.lit(VERSION).alias("check_version"), F.col("passed").cast("double").alias("qc_score"),
        F.when(F.col("passed"), "pass").otherwise("fail").alias("qc_flag"), "details_json", F.lit(created_at).cast("string").alias("created_at"), "reason", "monthly_total", "rr_total",
    )


def consolidate(rows: DataFrame, threshold: float = PROMOTE, promoted_at: str | None = None) -> DataFrame:
    """daily_qc_status: the worst flag and mean score of a day's checks; days that pass with a high score are promoted."""
    flag, score = qc.worst(F.col("qc_flag")), F.avg("qc_score")
    good = (flag == "pass") & (F.coalesce(score, F.lit(0.0)) >= threshold)
    return rows.groupBy("qc_session_id", "file_id", "day_of_month", "month").agg(
        score.alias("final_score"), flag.alias("final_flag"), F.when(good, 1).otherwise(0).alias("promoted_good"), F.when(good, F.lit(promoted_at).cast("string")).alias("promoted_at")
    )
