"""Second check: is a day that failed the first one still what its neighbours lead to expect?

Two boosted-tree regressors: the first predicts log1p of a day's consensus from neighbour statistics, the second the size of
the first one's error. A factor k on that error is calibrated on rows held out, so that the interval covers ``coverage`` of them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import stored
from . import booster, ranks, sampling

FEATURES = ("n_20km", "median_20km", "mad_20km", "n_50km", "median_50km", "mad_50km", "month")
TARGET, COVERAGE, FOLDS, HELD_OUT, LEAST_ERROR = "consensus_value", 0.99, 5, 0.2, 1e-6
KEY = ("file_id", "month", "day_of_month")


@dataclass
class Trained:
    value_model: booster.Model
    error_model: booster.Model
    k: float
    coverage_target: float
    coverage_achieved: float
    n_train: int
    n_calib: int
    mae_inches: float
    r2_transformed: float


def training_rows(stats: DataFrame, status: DataFrame, qc_session_id: int, max_rows: int | None = None, seed: int = 0) -> DataFrame:
    """Days that passed the first check, have a neighbour within 50 km and a value; a sample of exactly ``max_rows``, the same in every run, if there are more."""
    passed = status.where((F.col("qc_session_id") == qc_session_id) & (F.col("final_flag") == "pass")).select(*KEY)
    rows = stats.where((F.col("n_50km") > 0) & F.col(TARGET).isNotNull()).join(passed, list(KEY), "left_semi").select(*KEY[:1], "day_of_month", *FEATURES, TARGET)
    return rows if max_rows is None else sampling.bottom_k(stored.stored(rows, "training_rows"), list(KEY), max_rows, seed)


def train(rows: DataFrame, coverage: float = COVERAGE, folds: int = FOLDS, held_out: float = HELD_OUT, seed: int = 0, settings: booster.Settings | None = None) -> Trained:
    """Folds and the held-out part follow from a hash of the key, so they are the same in every run. The folds' models and the whole one grow in the same jobs."""
    settings = settings or booster.Settings(seed=seed)
    lane = F.pmod(F.xxhash64(*KEY, F.lit(seed)), F.lit(10_000))
    data = stored.stored(rows.withColumn("y", F.log1p(TARGET)).withColumn("lane", lane), "second_check_rows")
    calib, fit = data.where(F.col("lane") < int(held_out * 10_000)), data.where(F.col("lane") >= int(held_out * 10_000))
    parts, cuts = booster.prepared(fit, FEATURES, "y", list(KEY), F.pmod("lane", F.lit(folds)), seed)
    value_models, told = booster.boost(parts, FEATURES, cuts, folds, settings)
    own = F.try_element_at("margins", F.col("fold") + 1)  # of the model that has not seen the row
    errors = told.select("h", F.lit(-1).alias("fold"), "parts", F.abs(F.col("y") - own).alias("y"))
    error_models, _ = booster.boost(errors, FEATURES, cuts, 0, settings)
    value_model, error_model = value_models[-1], error_models[-1]
    scored = stored.stored(_predict(calib, value_model, error_model).withColumn("gap", F.abs(F.col("y") - F.col("z"))), "second_check_gaps")
    k = calibrate(scored, coverage)
    row = scored.agg(
        F.count(F.lit(1)).alias("n"), covered(k).alias("covered"),
        F.avg(F.abs(F.expm1("z") - F.expm1("y"))).alias("mae"), F.sum(F.col("gap") * F.col("gap")).alias("rss"), F.var_pop("y").alias("var"),
    ).first()
    r2 = 1 - row.rss / (row.var * row.n) if row.n and row.var else float("nan")
    return Trained(value_model, error_model, float(k), coverage, float(row.covered or 0.0), fit.count(), row.n, float(row.mae or 0.0), float(r2))


def calibrate(scored: DataFrame, coverage: float) -> float:
    """The least factor on ``err`` that covers this share of ``gap``, between two ranks in proportion; 0 without rows."""
    return float(ranks.quantiles(scored.select((F.col("gap") / F.col("err")).alias("k")), "k", [coverage])[0] or 0.0)


def covered(k: float) -> Column:
    return F.avg((F.col("gap") <= k * F.col("err")).cast("double"))


def _predict(df: DataFrame, value_model: booster.Model, error_model: booster.Model) -> DataFrame:
    return df.withColumn("z", booster.predict(value_model)).withColumn("err", F.greatest(booster.predict(error_model), F.lit(LEAST_ERROR)))


def verdict(scored: DataFrame, k: float) -> DataFrame:
    """Adds bounds and the flag from ``z`` and ``err``: inside (bounds included) passes, outside fails, untestable rows are
    indeterminate with null predictions."""
    testable = (F.col("n_50km") > 0) & F.col(TARGET).isNotNull() & ~F.isnan(F.col(TARGET))
    low, high = F.expm1(F.col("z") - k * F.col("err")), F.expm1(F.col("z") + k * F.col("err"))
    inside = (F.col(TARGET) >= low) & (F.col(TARGET) <= high)
    only = lambda c: F.when(testable, c)
    return (
        scored.withColumn("predicted_consensus", only(F.expm1("z"))).withColumn("predicted_abs_error", only(F.col("err")))
        .withColumn("expectation_lower", only(low)).withColumn("expectation_upper", only(high))
        .withColumn("secondary_flag", F.when(~testable, "indeterminate").when(inside, "pass").otherwise("fail"))
    )


def score(stats: DataFrame, status: DataFrame, trained: Trained, qc_session_id: int, train_session_id: int = 1, created_at: str | None = None) -> DataFrame:
    """secondary_qc_status of the days that failed the first check."""
    failed = status.where((F.col("qc_session_id") == qc_session_id) & (F.col("final_flag") == "fail")).select(*KEY)
    rows = stats.join(failed, list(KEY), "left_semi")
    judged = verdict(_predict(rows, trained.value_model, trained.error_model), trained.k)
    return judged.select(
        "file_id", "matched_year", "month", "day_of_month", TARGET, "predicted_consensus", "predicted_abs_error", "expectation_lower", "expectation_upper", "secondary_flag",
        F.lit(train_session_id).cast("bigint").alias("train_session_id"), F.lit(qc_session_id).cast("bigint").alias("qc_session_id"), F.lit(created_at).cast("string").alias("created_at"),
    )


def save(trained: Trained, path: str) -> None:
    booster.save(trained.value_model, f"{path}/value_model")
    booster.save(trained.error_model, f"{path}/error_model")
    facts = {k: getattr(trained, k) for k in ("k", "coverage_target", "coverage_achieved", "n_train", "n_calib", "mae_inches", "r2_transformed")}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load(spark: SparkSession, path: str) -> Trained:
    facts = json.loads(spark.read.text(f"{path}/metadata").first().value)
    return Trained(booster.load(spark, f"{path}/value_model"), booster.load(spark, f"{path}/error_model"), **facts)
