"""Streaming twins: pages ingested as their files arrive, and a windowed roll-up with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text
from ..sources import pages_json

_TEXT = StructType([StructField("value", StringType())])


def page_stream(spark: SparkSession, root: str, files_per_trigger: int = 200) -> DataFrame:
    """source_path, file_name, content, grid and error of pages as they arrive."""
    raw = spark.readStream.schema(_TEXT).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_trigger).text(root, wholetext=True)
    files = raw.select(F.col("_metadata.file_path").alias("source_path"), text.without_suffix(F.col("_metadata.file_name")).alias("file_name"), F.col("value").alias("content"))
    return pages_json.parse(files)


def daily_cells(parsed: DataFrame, ids: str) -> DataFrame:
    """The daily values of pages, with the ids of the table below ``ids``; new pages are added to it."""
    good = pages_json.with_ids(parsed, ids)
    cells = pages_json._cells(good, F.col("key") != "Totals")
    return cells.select("file_id", F.regexp_extract("key", r"(\d+)$", 1).cast("tinyint").alias("day_of_month"), "month", "ensemble_member", F.col("value").alias("rainfall"), "is_missing")


def ingest(spark: SparkSession, root: str, out: str, checkpoint: str, ids: str | None = None) -> StreamingQuery:
    """Adds the daily values of new pages to a table; each file counts once, restarts included.

    A batch is a folder that is overwritten as a whole, and ids are given once, so one that is repeated after a failure changes nothing. ``ids``: the
    table of page ids that the batch ingest uses too, by default beside the values."""

    def take(parsed: DataFrame, batch: int) -> None:
        daily_cells(parsed, ids or f"{out}/_ids").write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={batch}")

    return page_stream(spark, root).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, value: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Count, mean and maximum a tumbling window; events later than the watermark are left out. Also works on a batch."""
    return events.withWatermark(time, late).groupBy(F.window(time, width)).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.max(value).alias("max")).select(F.col("window.start").alias("start"), "n", "mean", "max")
