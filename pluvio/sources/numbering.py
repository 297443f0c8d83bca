"""Dense numbers for keys, which stay what they are: a table of keys and ids that only grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import stored
from . import tables


def dense(keys: DataFrame, column: str, start: int = 0) -> DataFrame:
    """Different values of ``column`` with ``id``: start + 1, start + 2, ... in their order, nulls left out.

    Ranges of keys are counted and each is numbered by itself; they are written, so that one that is computed again keeps its bounds."""
    spread = stored.stored(keys.where(F.col(column).isNotNull()).select(column).distinct().repartitionByRange(column).withColumn("part", F.spark_partition_id()), "keys")
    sizes = spread.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row a range
    number = F.row_number().over(Window.partitionBy("part").orderBy(column))
    return spread.join(F.broadcast(before), "part").select(column, (F.lit(start) + F.col("before") + number).cast("bigint").alias("id"))


def known(spark: SparkSession, root: str, column: str) -> DataFrame:
    """The table of ids below ``root``; empty before the first key."""
    schema = f"{column} string, id bigint"
    return spark.read.schema(schema).parquet(root) if tables.exists(spark, root) else spark.createDataFrame([], schema)


def assign(keys: DataFrame, column: str, root: str) -> DataFrame:
    """Ids of ``keys``: those that the table below ``root`` has stay, new keys follow in their order and are appended.

    The append is one commit, and keys that are there already are not numbered again, so a call that is repeated after a failure gives what the first
    would have given. One writer at a time."""
    spark = keys.sparkSession
    wanted = keys.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias(column)).distinct()
    have = known(spark, root, column)
    last = have.agg(F.max("id")).first()[0] or 0
    fresh = dense(wanted.join(have, column, "left_anti"), column, last)
    fresh.write.mode("append").option("compression", "zstd").parquet(root)
    return known(spark, root, column).join(wanted, column, "left_semi")
