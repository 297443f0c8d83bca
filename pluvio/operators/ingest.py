"""Ingest: files to tables, with a manifest of what was read and what failed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import monthly_csv, pages_json, sef, tables
from . import analysis


def _now() -> str:
    return dt.datetime.now(dt.UTC).isoformat(timespec="seconds")


def first_files(parsed: DataFrame, n: int) -> DataFrame:
    """The rows of the first n paths. Paths alone are ranked, so it is known which files these are before any is parsed, and the others are left unread."""
    last = parsed.select("source_path").orderBy("source_path").limit(n).agg(F.max("source_path")).first()[0]
    return parsed.where(F.col("source_path") <= F.lit(last))


def _run(spark: SparkSession, parsed: DataFrame, make, root: str, label: str, overwrite: bool, max_files: int | None, errors: str) -> dict:
    started = _now()
    if max_files is not None:
        parsed = first_files(parsed, max_files)
    parsed = parsed.persist()
    made = make(parsed)
    mode = "overwrite" if overwrite else "errorifexists"
    for name, df in made.items():
        tables.write(df, root, name, mode)
    files = parsed.count()
    failed = spark.read.parquet(f"{root}/{errors}").count()
    rows = {name: spark.read.parquet(f"{root}/{name}").count() for name in made}
    parsed.unpersist()
    facts = {"started_at": started, "completed_at": _now(), "files_found": files, "files_failed": failed, "rows": rows, "status": "completed_with_errors" if failed else "success"}
    tables.write_manifest(spark, f"{root}/_metadata/{label}.json", facts)
    return facts


def monthly_tables(spark: SparkSession, source_root: str, dataset_root: str, max_files: int | None = None, overwrite: bool = False) -> dict:
    return _run(spark, monthly_csv.read(spark, source_root), monthly_csv.tables, dataset_root, "monthly_ingest", overwrite, max_files, "ingestion_file_errors")


def pages(spark: SparkSession, source_root: str, dataset_root: str, max_files: int | None = None, overwrite: bool = False) -> dict:
    return _run(spark, pages_json.parse(pages_json.discover(spark, source_root)), pages_json.tables, dataset_root, "page_ingest", overwrite, max_files, "ensemble_ingestion_file_errors")


def sef_analysis(spark: SparkSession, sef_root: str, out_root: str, *years: int) -> None:
    """Re-reads exported text into ``observations`` and ``daily_national``, a partition a year; other years stay as they are."""
    obs = tables.conform(sef.read(spark, sef_root, *years), "observations")
    obs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(f"{out_root}/observations")
    back = spark.read.parquet(f"{out_root}/observations")
    back = back.where(back["year"].isin(*years)) if years else back
    tables.conform(analysis.daily_national(back), "daily_national").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(f"{out_root}/daily_national")
