"""Parquet tables under a root, session partitions, manifests, resolution of optional sources."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SCHEMAS


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there and holds something, on any file system that Spark reads."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and (fs.getFileStatus(p).isFile() or len(fs.listStatus(p)) > 0)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table by its declared schema; columns that older files lack come out null."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")


def read_files(spark: SparkSession, name: str, *paths: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(*paths)


def read_or_empty(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An optional table; where it is absent, its columns without rows."""
    return read(spark, root, name) if exists(spark, f"{root}/{name}") else spark.createDataFrame([], SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """The table's columns, cast; missing ones are null. Other columns go."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]))


def write(df: DataFrame, root: str, name: str, mode: str = "errorifexists", cluster: str | None = None) -> None:
    """zstd Parquet. ``cluster`` range-partitions and sorts by a column, so that later range filters skip row groups."""
    out = conform(df, name)
    if cluster:
        out = out.repartitionByRange(cluster).sortWithinPartitions(cluster)
    out.write.mode(mode).option("compression", "zstd").parquet(f"{root}/{name}")


def write_session(df: DataFrame, root: str, name: str, session_column: str) -> None:
    """Replaces the sessions that ``df`` holds and no other."""
    conform(df, name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(session_column).parquet(f"{root}/{name}")


def next_session(spark: SparkSession, root: str, name: str, session_column: str) -> int:
    """A number above those of the table, which is the caller's alone (``sessions.claim``): two writers never get the same."""
    from . import sessions

    held = (spark.read.parquet(f"{root}/{name}").agg(F.max(session_column)).first()[0] or 0) if exists(spark, f"{root}/{name}") else 0
    return sessions.claim(spark, root, name, held + 1)


def years(spark: SparkSession, root: str) -> list[int]:
    """Folders named by digits."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().isdigit())


def write_manifest(spark: SparkSession, path: str, facts: dict) -> None:
    """A small JSON file, in one piece, on any file system."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray((json.dumps(facts, indent=2, sort_keys=True) + "\n").encode()))
    out.close()


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))


def newest_sessions(df: DataFrame, *columns: str) -> DataFrame:
    """The rows of the newest combination of session columns, the first column first."""
    newest = df.agg(F.max(F.struct(*columns)).alias("s")).select("s.*")
    return df.join(F.broadcast(newest), list(columns), "left_semi")


def preferred(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The merged file of the newest sessions (``<root>/<name>/merged/session_meta<M>_qc<Q>.parquet``), or else the whole folder.

    Newest by the metadata session, then by the check's."""
    fs, p = _fs(spark, f"{root}/{name}/merged")
    found = []
    if fs.exists(p):
        for s in fs.listStatus(p):
            if m := re.fullmatch(r"session_meta(\d+)_qc(\d+)\.parquet", s.getPath().getName()):
                found.append((int(m[1]), int(m[2]), s.getPath().toString()))
    return read_files(spark, name, max(found)[2]) if found else read(spark, root, name)
