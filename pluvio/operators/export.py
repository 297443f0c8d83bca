"""Merges duplicate transcriptions of a station-year and writes them as Station Exchange Format text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import compat, qc, text

MM_PER_INCH, M_PER_FOOT = 25.4, 0.3048
# fixed values of the exchange format
HEADER = ("SEF", "ID", "Name", "Lat", "Lon", "Alt", "Source", "Link", "Vbl", "Stat", "Units", "Meta")
COLUMNS = ("Year", "Month", "Day", "Hour", "Minute", "Period", "Value", "Meta")
VERSION, VARIABLE, STATISTIC, UNITS, PERIOD = "1.0.0", "rr", "sum", "mm", "1day"


def joined(consensus: DataFrame, metadata: DataFrame, status: DataFrame, secondary: DataFrame | None, qc_session_id: int, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """Consensus days of located pages with both verdicts and the group that they merge in.

    Exact matches of one place and year merge; every other page stands alone. Of several second checks the newest counts."""
    newest = metadata.agg(F.max("match_source_session_id").alias("match_source_session_id"))
    meta = metadata.join(F.broadcast(newest), "match_source_session_id", "left_semi").where(F.col("matched_latitude").isNotNull() & F.col("matched_longitude").isNotNull())
    meta = compat.between_ids(meta, "matched_year", start_year, end_year)
    place = F.concat(F.lit("loc:"), "matched_location_name", F.lit("@"), F.round("matched_latitude", 4).cast("string"), F.lit(","), F.round("matched_longitude", 4).cast("string"))
    group = F.when((F.col("match_type") == "exact") & F.col("matched_location_name").isNotNull(), place).otherwise(F.concat(F.lit("file:"), F.col("file_id").cast("string")))
    first = status.where(F.col("qc_session_id") == qc_session_id).select("file_id", "month", "day_of_month", F.col("final_flag").alias("qc1_flag"))
    rows = consensus.join(meta.withColumn("group_key", group).drop("match_source_session_id"), "file_id").join(first, ["file_id", "month", "day_of_month"], "left")
    if secondary is None:
        return rows.withColumn("qc2_flag", F.lit(None).cast("string"))
    key = ("file_id", "matched_year", "month", "day_of_month")
    second = compat.latest(secondary.where(F.col("qc_session_id") == qc_session_id), key, F.desc("train_session_id"))
    return rows.join(second.select(*key, F.col("secondary_flag").alias("qc2_flag")), list(key), "left")


def merged_days(rows: DataFrame) -> DataFrame:
    """One row a group, year and day: from the transcription with the best verdicts, of equals the lowest page."""
    ranked = rows.withColumn("qc_rank", qc.trust_rank(F.col("qc1_flag"), F.col("qc2_flag")))
    days = Window.partitionBy("matched_year", "group_key", "month", "day_of_month").orderBy("qc_rank", "file_id")
    return ranked.withColumn("_n", F.row_number().over(days)).where("_n = 1").drop("_n").withColumn("source", text.safe_id(text.without_suffix(F.col("file_name"))))


def merged_stations(rows: DataFrame) -> DataFrame:
    """One row a group and year: the page with most first-check passes (then the lowest) lends its name; all sources are listed."""
    by_file = rows.groupBy("matched_year", "group_key", "file_id").agg(
        F.count_if(F.lower(F.trim("qc1_flag")) == "pass").alias("passes"),
        F.first(F.struct("file_name", "matched_location_name", "matched_latitude", "matched_longitude", "matched_elevation_ft", "match_type")).alias("page"),
    )
    best = F.min_by("page", F.struct((-F.col("passes")).alias("p"), F.col("file_id").alias("f")))
    sources = F.array_sort(F.collect_list(text.safe_id(text.without_suffix(F.col("page.file_name")))))
    return by_file.groupBy("matched_year", "group_key").agg(best.alias("page"), sources.alias("sources"), F.count(F.lit(1)).alias("n_sources")).select("matched_year", "group_key", "page.*", "sources", "n_sources").withColumn(
        "station_id", text.safe_id(text.without_suffix(F.col("file_name")))
    )


def clashes(stations: DataFrame) -> DataFrame:
    """Groups of one year that would be written to one file."""
    return stations.groupBy("matched_year", "station_id").agg(F.count(F.lit(1)).alias("n"), F.collect_set("group_key").alias("groups")).where("n > 1")


def documents(rows: DataFrame, qc_session_id: int, source: str = "NA", link: str = "NA", hour: int = 9, minute: int = 0) -> DataFrame:
    """year, station_id, n_observations, content: the whole text of each station-year's file (at most 372 lines of days)."""
    flag = lambda c: F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", "NA").otherwise(F.trim(F.col(c)))
    meta = F.concat(F.lit("qc1="), flag("qc1_flag"), F.lit("|qc2="), flag("qc2_flag"), F.lit("|source="), flag("source"))
    line = F.concat_ws("\t", "matched_year", "month", "day_of_month", F.lit(hour), F.lit(minute), F.lit(PERIOD), text.decimals(F.col("consensus_value") * MM_PER_INCH, 1), meta)
    days = merged_days(rows).groupBy("matched_year", "group_key").agg(F.array_sort(F.collect_list(F.struct(F.col("month").cast("int").alias("m"), F.col("day_of_month").cast("int").alias("d"), line.alias("line")))).alias("days"))
    s = merged_stations(rows)
    facts = F.concat(F.lit("orig.units=in|match.type="), F.coalesce("match_type", F.lit("NA")), F.lit(f"|qc.session={qc_session_id}|n.sources="), "n_sources", F.lit("|sources="), F.array_join("sources", ","))
    values = (F.lit(VERSION), F.col("station_id"), F.coalesce("matched_location_name", F.lit("NA")), text.decimals(F.col("matched_latitude"), 4), text.decimals(F.col("matched_longitude"), 4), text.decimals(F.col("matched_elevation_ft") * M_PER_FOOT, 1), F.lit(source), F.lit(link), F.lit(VARIABLE), F.lit(STATISTIC), F.lit(UNITS), facts)
    head = [F.concat(F.lit(f"{k}\t"), v) for k, v in zip(HEADER, values)]
    body = F.array_join(F.transform("days", lambda d: d["line"]), "\n")
    return s.join(days, ["matched_year", "group_key"]).select(
        F.col("matched_year").cast("int").alias("year"), "station_id", F.size("days").alias("n_observations"), F.concat(F.concat_ws("\n", *head, F.lit("\t".join(COLUMNS))), F.lit("\n"), body, F.lit("\n")).alias("content")
    )
