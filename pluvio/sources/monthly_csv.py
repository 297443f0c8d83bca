"""Monthly station tables: CSV files whose cells are addressed by place.

Row 1 has the name; row 2 grid reference, longitude, latitude, elevation; row 3 the number; row 5 the years, rows 6 to 17 the months and row 18
the totals. One Arrow pass parses whole files; a file that does not parse gives an error row instead.
"""

from __future__ import annotations

import csv
import io
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import portable

SKIPPED_PREFIXES = ("TYRain_", "ERROR_", "MISFILED_")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
PARSED = (
    "source_path string, error string, station struct<station_file_id:string,station_folder:string,station_file_name:string,location_name:string,grid_reference:string,"
    "longitude:double,latitude:double,elevation_ft:int,station_number:string>, monthly array<struct<year:int,month:tinyint,rainfall_in:double>>, annual array<struct<year:int,total_in:double>>"
)


class TableError(ValueError):
    """A file that is no station table."""


def _number(cell: str) -> float | None:
    return None if cell.lower() in ("", "nan", "na", "n/a") else float(cell)


def parse(content: str, folder: str, stem: str) -> dict:
    """Station, monthly and annual values of one file's text."""
    grid = [[c.strip() for c in row] for row in csv.reader(io.StringIO(content.lstrip("﻿"), newline=""))]
    if len(grid) < 18:
        raise TableError(f"{len(grid)} rows; a station table has 18")
    at = lambda r, c: grid[r - 1][c - 1] if c <= len(grid[r - 1]) else ""
    years = {}
    for c, cell in enumerate(grid[4][1:], start=2):
        try:
            years[c] = int(cell)
        except ValueError:
            continue
    if not years:
        raise TableError("row 5 has no years")
    monthly = []
    for m, name in enumerate(MONTHS, start=1):
        label = at(5 + m, 1).lower()
        if label and name.lower() not in label:
            raise TableError(f"row {5 + m} says {at(5 + m, 1)!r} instead of {name}")
        monthly += [(y, m, v) for c, y in years.items() if (v := _number(at(5 + m, c))) is not None]
    annual = [(y, v) for c, y in years.items() if (v := _number(at(18, c))) is not None]
    height = at(2, 8)
    station = (f"{folder}/{stem}", folder, stem, at(1, 1) or None, at(2, 2) or None, _number(at(2, 4)), _number(at(2, 6)), int(float(height)) if height else None, at(3, 2) or None)
    return {"station": station, "monthly": monthly, "annual": annual}


def _parse_files(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keys = ("station_file_id", "station_folder", "station_file_name", "location_name", "grid_reference", "longitude", "latitude", "elevation_ft", "station_number")
    for files in it:
        out = []
        for path, content in zip(files["source_path"], files["content"]):
            folder, _, name = path.rpartition("/")
            try:
                p = parse(bytes(content).decode("utf-8"), folder.rpartition("/")[2], name.removesuffix(".csv"))
                if any(isinstance(v, float) and math.isinf(v) for v in p["station"]):
                    raise ValueError("a coordinate is infinite")
            except (TableError, ValueError) as e:
                out.append((path, str(e), None, [], []))
                continue
            out.append((path, None, dict(zip(keys, p["station"])), [dict(zip(("year", "month", "rainfall_in"), x)) for x in p["monthly"]], [dict(zip(("year", "total_in"), x)) for x in p["annual"]]))
        yield pd.DataFrame(out, columns=["source_path", "error", "station", "monthly", "annual"])


def discover(spark: SparkSession, root: str) -> DataFrame:
    """source_path (below root) and content of every CSV file below a root, but for the skipped prefixes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    kept = files.where(~F.array_contains(F.array(*(name.startswith(p) for p in SKIPPED_PREFIXES)), True))
    return kept.select(F.regexp_replace(F.expr("substring(path, instr(path, '" + root.rstrip("/").split("://")[-1].replace("'", "''") + "') + " + str(len(root.rstrip("/").split("://")[-1])) + ")"), "^/", "").alias("source_path"), "content")


def read(spark: SparkSession, root: str) -> DataFrame:
    return discover(spark, root).mapInPandas(portable(_parse_files), PARSED)


def tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """stations, monthly_rainfall, annual_totals and ingestion_file_errors of parsed files."""
    good = parsed.where("error is null")
    sid = F.col("station.station_file_id").alias("station_file_id")
    return {
        "stations": good.select("station.*", "source_path"),
        "monthly_rainfall": good.select(sid, F.explode("monthly").alias("m")).select("station_file_id", "m.*"),
        "annual_totals": good.select(sid, F.explode("annual").alias("a")).select("station_file_id", "a.*"),
        "ingestion_file_errors": parsed.where("error is not null").select("source_path", F.col("error").alias("error_message")),
    }
