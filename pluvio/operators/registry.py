"""Check sessions: started, given rows and features, consolidated, completed. A session is a partition, replaced as a whole."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import compat, qc
from ..schemas import SCHEMAS
from ..sources import tables
from . import qc1

STATUSES = ("running", "completed", "failed")


def _now() -> str:
    return dt.datetime.now(dt.UTC).isoformat(timespec="seconds")


def start(spark: SparkSession, root: str, config: dict, parent: int | None = None, threshold: float = qc1.PROMOTE) -> int:
    session = tables.next_session(spark, root, "qc_sessions", "qc_session_id")
    row = (session, _now(), None, "running", parent, json.dumps(config, sort_keys=True), threshold, None)
    tables.write_session(spark.createDataFrame([row], SCHEMAS["qc_sessions"]), root, "qc_sessions", "qc_session_id")
    return session


def complete(spark: SparkSession, root: str, session: int, status: str = "completed", message: str | None = None) -> None:
    if status not in STATUSES:
        raise ValueError(f"status {status!r} is none of {STATUSES}")
    row = tables.read(spark, root, "qc_sessions").where(F.col("qc_session_id") == session).first()
    if row is None:
        raise LookupError(f"no session {session}")
    new = {**row.asDict(), "completed_at": _now(), "status": status, "message": message}
    tables.write_session(spark.createDataFrame([tuple(new[f.name] for f in SCHEMAS["qc_sessions"])], SCHEMAS["qc_sessions"]), root, "qc_sessions", "qc_session_id")


def insert_results(rows: DataFrame, root: str, session: int) -> None:
    """Replaces a session's rows. A flag outside pass, review and fail stops the write."""
    flag = F.when(F.col("qc_flag").isin(*qc.FLAGS), F.col("qc_flag")).otherwise(F.raise_error(F.concat(F.lit("unknown flag: "), F.coalesce("qc_flag", F.lit("null")))))
    tables.write_session(rows.withColumn("qc_session_id", F.lit(session)).withColumn("qc_flag", flag), root, "daily_qc_results", "qc_session_id")


def upsert_features(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with new: rows of a (file, day, month) that new has come from new, its latest by updated_at."""
    key = ("file_id", "day_of_month", "month")
    fresh = compat.latest(new, key, F.col("updated_at").desc_nulls_last())
    return old.join(fresh.select(*key), list(key), "left_anti").unionByName(fresh)


def consolidate(spark: SparkSession, root: str, session: int, threshold: float = qc1.PROMOTE) -> DataFrame:
    rows = tables.read(spark, root, "daily_qc_results").where(F.col("qc_session_id") == session)
    tables.write_session(qc1.consolidate(rows, threshold, _now()), root, "daily_qc_status", "qc_session_id")
    return tables.read(spark, root, "daily_qc_status").where(F.col("qc_session_id") == session)


def flag_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("qc_session_id", "final_flag").agg(F.count(F.lit(1)).alias("n"), F.sum("promoted_good").alias("promoted"))
