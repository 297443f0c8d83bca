"""Tables that change by batches: a batch brings whole keys, and of each key the rows of the newest batch that names it count.

Only what a batch brings is written. A batch is a folder that is overwritten as a whole, so one that is run again, as ``foreachBatch`` may, changes nothing.
A key that a batch names without rows is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables


def write(rows: DataFrame, keys: DataFrame, root: str, batch: int) -> None:
    """``keys``: all keys that the batch settles; ``rows``: the rows they have now. The keys come last: without them the rows are not seen."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/rows/batch={batch}")
    keys.distinct().write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/keys/batch={batch}")


def current(spark: SparkSession, root: str, columns: list[str], schema: str) -> DataFrame:
    """The rows that count. ``columns``: those of a key; ``schema``: that of the rows, which an empty table has too."""
    if not tables.exists(spark, f"{root}/keys"):
        return spark.createDataFrame([], schema)
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    newest = spark.read.parquet(f"{root}/keys").groupBy(*columns).agg(F.max("batch").alias("batch"))
    rows = spark.read.schema(f"{schema}, batch bigint").parquet(f"{root}/rows")
    return rows.join(newest.withColumn("batch", F.col("batch").cast("bigint")), [*columns, "batch"], "left_semi").select(*names)


def compact(spark: SparkSession, root: str, columns: list[str], schema: str, target: str) -> None:
    """The rows that count as batch 0 of another root."""
    rows = current(spark, root, columns, schema)
    write(rows, rows.select(*columns), target, 0)
