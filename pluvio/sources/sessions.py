"""Sessions that several writers may open at once: a number belongs to one writer, rows are staged apart, and a manifest makes them visible in one step."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SCHEMAS
from . import tables


def _create(spark: SparkSession, path: str, content: str) -> bool:
    """Whether this call made the file. The store refuses a second creation; where it does not do so at once, the content tells whose file it is."""
    fs, p = tables._fs(spark, path)
    try:
        out = fs.create(p, False)
        out.write(bytearray(content.encode()))
        out.close()
    except Exception as e:
        if not fs.exists(p):
            raise RuntimeError(f"{path} can't be created") from e
        return False
    return "\n".join(r.value for r in spark.read.text(path).collect()) == content


def claim(spark: SparkSession, root: str, name: str, least: int = 1) -> int:
    """The least number from ``least`` on, above all claimed ones, that nobody has; it is this caller's from now on, whether it is used or not."""
    folder = f"{root}/_claims/{name}"
    fs, p = tables._fs(spark, folder)
    taken = [int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()] if fs.exists(p) else []
    number, mark = max([least, *(n + 1 for n in taken)]), uuid.uuid4().hex
    while not _create(spark, f"{folder}/{number}", mark):
        number += 1
    return number


def stage(df: DataFrame, root: str, name: str, session: int) -> str:
    """Writes a session's rows to a folder of their own, which no reader looks at; gives the folder's name for ``publish``."""
    folder = f"session={session}/attempt={uuid.uuid4().hex}"
    tables.conform(df, name).write.option("compression", "zstd").parquet(f"{root}/{name}/{folder}")
    return folder


def publish(spark: SparkSession, root: str, name: str, session: int, folder: str) -> None:
    """From now on the session's rows are those of the folder. Published again, as after a rerun, the newer folder takes the older one's place.

    The manifest is written aside and renamed, so a reader finds the old one, or the new one, or neither, but no half of one."""
    fs, final = tables._fs(spark, f"{root}/{name}/_published/{session}.json")
    aside = f"{root}/{name}/_published/.{session}-{uuid.uuid4().hex}"
    tables.write_manifest(spark, aside, {"session": session, "folder": folder})
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(final).toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(tables._fs(spark, aside)[1]), fs.makeQualified(final), options)


def published(spark: SparkSession, root: str, name: str) -> dict[int, str]:
    """Sessions and their folders."""
    fs, p = tables._fs(spark, f"{root}/{name}/_published")
    found = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")] if fs.exists(p) else []
    facts = []
    for path in found:
        stream = fs.open(path)
        try:
            facts.append(json.loads(bytes(stream.readAllBytes())))
        finally:
            stream.close()
    return {f["session"]: f["folder"] for f in facts}


def read(spark: SparkSession, root: str, name: str, *wanted: int) -> DataFrame:
    """The rows of all published sessions, or of those named; what is staged or left over from failed attempts is not seen."""
    folders = [f"{root}/{name}/{folder}" for session, folder in sorted(published(spark, root, name).items()) if not wanted or session in wanted]
    return tables.read_files(spark, name, *folders) if folders else spark.createDataFrame([], SCHEMAS[name])


def run(df: DataFrame, root: str, name: str, column: str) -> int:
    """Claims a number, stages the rows under it and publishes them."""
    spark = df.sparkSession
    session = claim(spark, root, name)
    publish(spark, root, name, session, stage(df.withColumn(column, F.lit(session)), root, name, session))
    return session
