"""The first check kept up to date: changed pages and changed monthly totals recompute only the months they touch.

A batch of daily values replaces cells (file, month, day, member). Its (file, month) keys are dirty, and so are those of pages matched with a station-year
whose monthly totals change; for these, and no others, consensus, sums and verdicts are made again, from the cells as they are now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from . import consensus, qc1

CELL = ["file_id", "month", "day_of_month", "ensemble_member"]
KEY = ["file_id", "month"]
CELLS = "file_id bigint, month tinyint, day_of_month tinyint, ensemble_member tinyint, rainfall double, is_missing tinyint"
VERDICTS = (
    "qc_session_id bigint, file_id bigint, day_of_month tinyint, month tinyint, check_name string, check_version string, qc_score double, qc_flag string, "
    "details_json string, created_at string, reason string, monthly_total double, rr_total double"
)


def cells(spark: SparkSession, root: str) -> DataFrame:
    return versions.current(spark, f"{root}/cells", CELL, CELLS)


def verdicts(spark: SparkSession, root: str) -> DataFrame:
    return versions.current(spark, f"{root}/verdicts", KEY, VERDICTS)


def touched_by_totals(changes: DataFrame, matched: DataFrame, station_vectors: DataFrame, known: DataFrame) -> DataFrame:
    """(file_id, month) whose verdict a change of monthly totals (station_file_id, year, month) may alter: all months of the pages matched with
    the station-year, since a page's reason also tells whether the station-year has any month at all."""
    years = changes.select("station_file_id", "year").distinct()
    files = station_vectors.select("rr_vector_id", "station_file_id", "year").join(years, ["station_file_id", "year"], "left_semi").join(matched, "rr_vector_id").select("file_id").distinct()
    return known.select(*KEY).distinct().join(files, "file_id", "left_semi")


def recheck(spark: SparkSession, root: str, dirty: DataFrame, batch: int, matched: DataFrame, station_vectors: DataFrame, monthly: DataFrame, session: int, tolerance: float = qc1.TOLERANCE) -> None:
    """Verdicts of the dirty keys, written as a batch. Keys without cells are left without verdicts."""
    now = cells(spark, root).join(dirty, KEY, "left_semi")
    found = qc1.results(consensus.daily(now), matched, station_vectors, monthly, session, tolerance)
    versions.write(found.select(*[c.split()[0] for c in VERDICTS.split(", ")]), dirty, f"{root}/verdicts", batch)


def apply(values: DataFrame, root: str, batch: int, matched: DataFrame, station_vectors: DataFrame, monthly: DataFrame, session: int, tolerance: float = qc1.TOLERANCE, changed_totals: DataFrame | None = None) -> DataFrame:
    """Takes a batch of daily values in, with the keys of monthly totals that changed since the last one, and gives back the dirty keys.

    For ``foreachBatch``: a batch that is repeated is the same batch."""
    spark = values.sparkSession
    rows = values.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in CELLS.split(", ")])
    versions.write(rows, rows.select(*CELL), f"{root}/cells", batch)
    dirty = spark.read.parquet(f"{root}/cells/keys/batch={batch}").select(*KEY).distinct()
    if changed_totals is not None:
        dirty = dirty.unionByName(touched_by_totals(changed_totals, matched, station_vectors, cells(spark, root))).distinct()
    recheck(spark, root, dirty, batch, matched, station_vectors, monthly, session, tolerance)
    return spark.read.parquet(f"{root}/verdicts/keys/batch={batch}")
