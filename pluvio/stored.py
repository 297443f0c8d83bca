"""Intermediate tables in the cluster's shared folder: lineage is cut and a lost executor loses nothing."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the checkpoint folder that the session was given.

    Where neither is set a local session gets a folder of its own; on a cluster such a folder would be another one on every machine,
    so that is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that every machine of {master} can reach")
        found = "file://" + tempfile.mkdtemp(prefix="pluvio-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
    return found


class Kept:
    """A written table; ``release`` deletes it, and so does the end of the application."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(self._path)

    def release(self) -> None:
        self._fs.delete(self._path, True)


def keep(df: DataFrame, name: str) -> tuple[DataFrame, Kept]:
    """``df`` written and read back, and the handle that deletes it once nothing reads it any more."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/pluvio-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}"), Kept(spark, folder)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``keep`` for a table that a returned result still reads."""
    out, _KEPT[out] = keep(df, name)
    return out


_KEPT: weakref.WeakKeyDictionary[DataFrame, Kept] = weakref.WeakKeyDictionary()


def release(df: DataFrame) -> None:
    """Deletes the files of a table that ``stored`` gave, once nothing reads it any more."""
    _KEPT.pop(df).release()


def bucketed(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """``df`` written in buckets of a column, one file each, so that joins on it do not shuffle it any more.

    A table of the session's catalog whose files lie in the shared folder; they go when the application ends."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    folder = f"{shared_dir(spark)}/pluvio-{mark}"
    table = f"pluvio_{name}_{mark}"
    df.repartition(buckets, column).write.format("parquet").bucketBy(buckets, column).sortBy(column).option("compression", "zstd").option("path", f"{folder}/{name}").saveAsTable(table)
    Kept(spark, folder)
    return spark.table(table)
