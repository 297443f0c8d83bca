"""WARC records and a Merkle fixity audit of replicas.

A replica is an ordered sequence of WARC records. Leaves are digests of records; ordered ranges of ``FANOUT`` leaves, then of nodes,
hash into their parent up to one root a file. Two replicas are compared root by root, and only the children of nodes that
differ are looked at, so an audit reads a path for each damaged record and nothing for an intact file.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mapped, materialize

FANOUT = 16
FILE_BYTES = 8 << 20  # records of a file, about
VERSION = "WARC/1.0"


def record_bytes(url: Column, page_id: Column, html: Column, date: str = "1970-01-01T00:00:00Z") -> Column:
    """A ``resource`` record as it stands in a file: header lines, a blank line, the block, two line ends."""
    block = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " "),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), block, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of a file's bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        yield at, head, data[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


def lay_out(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """file, page_id, length, digest, place, offset: pages as records of files, in order of their ids, as ``write_files`` puts them.

    A record's file is a hash of its id and digest, the number of files follows the bytes, and its offset is the sum of the lengths
    before it in the file. Null html is an empty block; rows with equal ids are ordered by digest."""
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), record_bytes(F.col("url"), F.col("page_id"), F.col("html")).alias("record"))
    total = pages.select(F.coalesce(F.sum(F.octet_length("html").cast("long") + 300), F.lit(0))).first()[0]
    files = max(1, -(-total // file_bytes))
    hashed = records.select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file").orderBy("page_id", "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = hashed.withColumn("file", F.pmod(F.xxhash64("page_id", "digest"), F.lit(files)).cast("int"))
    return placed.select("file", "page_id", "length", "digest", (F.row_number().over(order) - 1).cast("long").alias("place"), F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def write_files(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, damaged: Column | None = None) -> None:
    """Gzipped WARC files, a folder for each: a record is a row of text, and the line end that the writer adds is the record's last.

    With ``damaged``, a replica in which those records have one other byte, a digit of their date; its files hold the same records in the same places."""
    parts = F.col("url"), F.col("page_id"), F.col("html")
    total = pages.select(F.coalesce(F.sum(F.octet_length("html").cast("long") + 300), F.lit(0))).first()[0]
    files = max(1, -(-total // file_bytes))
    placed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(record_bytes(*parts), 256).alias("digest"), F.coalesce(F.lit(False) if damaged is None else damaged, F.lit(False)).alias("damaged"))
    placed = placed.withColumn("file", F.pmod(F.xxhash64("page_id", "digest"), F.lit(files)).cast("int")).repartition(files, "file").sortWithinPartitions("file", "page_id", "digest")
    record = record_bytes(*parts) if damaged is None else F.when(F.col("damaged"), record_bytes(*parts, date="1971-01-01T00:00:00Z")).otherwise(record_bytes(*parts))
    text = placed.select("file", record.alias("record")).select("file", F.expr("decode(substring(record, 1, octet_length(record) - 2), 'UTF-8')").alias("value"))
    # most of the work of a file is its packing: the fastest level, which any reader of gzip opens
    text.write.partitionBy("file").option("lineSep", "\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _opened(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Each file's path and bytes, unpacked one after the other."""
    for batch in it:
        for name, data in zip(batch.column(0), batch.column(1)):
            yield name.as_py(), gzip.decompress(data.as_py()) if name.as_py().endswith(".gz") else data.as_py()


def _page_id(head: dict[str, str]) -> int | None:
    name = head["WARC-Record-ID"][10:-1]
    return None if name == "none" else int(name)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, html and the place of every record of the WARC files below a path. A file is parsed in one task."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, data in _opened(it):
            rows = [(name, at, _page_id(h), h["WARC-Target-URI"], block.decode("utf-8")) for at, h, block in parse_records(data)]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["path", "offset", "page_id", "url", "html"])

    return _stored(spark, path).transform(mapped, run, "path string, offset long, page_id long, url string, html string")


def stored_leaves(spark: SparkSession, path: str) -> DataFrame:
    """file, page_id, length, digest, place, offset of every record of the WARC files below a path, as ``lay_out`` has them, but from the bytes that are stored.

    Offsets count the unpacked file. A file is read in one task, whose memory is the file's. A file that does not parse is an error that names the place; no file, no rows."""
    names, types = ("file", "page_id", "length", "digest", "place", "offset"), (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, data in _opened(it):
            file, rows = int(re.search(r"file=(\d+)", name)[1]), []
            found = [(at, _page_id(h)) for at, h, _ in parse_records(data)]
            for place, (at, page_id) in enumerate(found):
                end = found[place + 1][0] if place + 1 < len(found) else len(data)
                rows.append((file, page_id, end - at, hashlib.sha256(memoryview(data)[at:end]).hexdigest(), place, at))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)], names=list(names))

    return _stored(spark, path).transform(mapped, run, "file int, page_id long, length long, digest string, place long, offset long")


def tree(leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """file, level, node, digest, first, last: all nodes of the files' trees; level 0 are the records.

    ``leaves``: file, place, offset, length, digest. A node hashes its range of offsets and its children's digests in order, so
    a record that is lost, moved or added changes the path to the root as well. Each level is one aggregation by (file, node), of
    ``fanout`` children at most."""
    level = leaves.select("file", F.lit(0).alias("level"), F.col("place").alias("node"), "digest", F.col("offset").alias("first"), (F.col("offset") + F.col("length")).alias("last"))
    levels, top = [level], leaves.agg(F.max("place")).first()[0]
    depth = 0
    while top is not None and top > 0:
        depth, top = depth + 1, top // fanout
        kids = F.array_sort(F.collect_list(F.struct("node", "first", "last", "digest")))
        text = F.array_join(F.transform("kids", lambda k: F.concat_ws(":", k["first"], k["last"], k["digest"])), ",")
        level = (
            level.groupBy("file", F.floor(F.col("node") / fanout).alias("node")).agg(kids.alias("kids"), F.min("first").alias("first"), F.max("last").alias("last"))
            .select("file", F.lit(depth).alias("level"), "node", F.sha2(text.cast("binary"), 256).alias("digest"), "first", "last")
        )
        levels.append(level)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


def audit(mine: DataFrame, theirs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """file, place, mine, theirs: the records that differ; a digest is null where a replica has no such record.

    Trees are compared from the roots down: a level's candidates are the children of the nodes that differ above it."""
    height = max(mine.agg(F.max("level")).first()[0] or 0, theirs.agg(F.max("level")).first()[0] or 0)
    suspects = None
    for level in range(height, -1, -1):
        a = mine.where(F.col("level") == level).select("file", "node", F.col("digest").alias("mine"))
        b = theirs.where(F.col("level") == level).select("file", "node", F.col("digest").alias("theirs"))
        if suspects is not None:
            parent = F.floor(F.col("node") / fanout)
            a, b = (x.withColumn("up", parent).join(suspects, ["file", "up"], "left_semi").drop("up") for x in (a, b))
        differ = a.join(b, ["file", "node"], "full").where(~F.col("mine").eqNullSafe(F.col("theirs")))
        differ = materialize(differ, f"differ_{level}")
        suspects = differ.select("file", F.col("node").alias("up"))
    return differ.select("file", F.col("node").alias("place"), "mine", "theirs")

