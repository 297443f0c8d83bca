"""Station Exchange Format text: twelve ``name<TAB>value`` lines, a line of columns, then a line a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import compat, qc, text
from . import files
from .tables import years as _years

HEADER_LINES = 12


def write(docs: DataFrame, root: str) -> None:
    """One file a station-year: ``<root>/tsv/<year>/<station_id>.tsv``. ``docs``: year, station_id, content. Years that occur are replaced whole, once all is written."""
    files.write(docs.select(F.col("year").alias("folder"), F.col("station_id").alias("name"), "content"), f"{root}/tsv", ".tsv")


def _fields(texts: DataFrame, *kept: str) -> DataFrame:
    """A row a line with eight fields or more: ``head`` (a map), ``f`` (the fields), ``at`` (its place), and the columns kept."""
    lines = F.split("value", "\n")
    head = F.map_from_entries(F.transform(F.slice(lines, 1, HEADER_LINES), lambda s: F.struct(F.element_at(F.split(s, "\t", 2), 1), F.coalesce(F.get(F.split(s, "\t", 2), F.lit(1)), F.lit("")))))
    rows = texts.where(F.size(lines) > HEADER_LINES + 1).select(*kept, head.alias("head"), F.posexplode(F.slice(lines, HEADER_LINES + 2, F.size(lines))).alias("at", "line"))
    return rows.withColumn("f", F.split("line", "\t")).where(F.size("f") >= 8)


def _named(key: str) -> Column:
    return F.element_at("head", key)


def _part(i: int) -> Column:
    return F.trim(F.get("f", F.lit(i)))


def _checks() -> tuple[Column, Column]:
    return text.meta_value(_part(7), "qc1"), text.meta_value(_part(7), "qc2")


def observations(texts: DataFrame) -> DataFrame:
    """The ``observations`` table from files' whole text (column ``value``). Files without position, lines with fewer than eight fields
    and impossible dates are left out; NA is null."""
    q1, q2 = _checks()
    date = F.try_to_date(F.concat_ws("-", _part(0), _part(1), _part(2)), "y-M-d")
    out = _fields(texts).select(
        _named("ID").alias("station_id"), F.when(_named("Name") != "NA", _named("Name")).alias("location_name"), text.lenient_double(_named("Lat")).alias("latitude"), text.lenient_double(_named("Lon")).alias("longitude"),
        text.lenient_double(_named("Alt")).alias("altitude"), _part(0).try_cast("int").alias("year"), _part(1).try_cast("smallint").alias("month"), _part(2).try_cast("smallint").alias("day"), date.alias("obs_date"),
        text.lenient_double(_part(6)).alias("value_mm"), q1.alias("qc1"), q2.alias("qc2"),
    )
    return out.where("latitude is not null and longitude is not null and obs_date is not null").withColumn("passed", qc.trusted(F.col("qc1"), F.col("qc2")))


def days_of_year(spark: SparkSession, root: str, year: int) -> DataFrame:
    """What an animation of a year reads: month, day, station_id, location_name, latitude, longitude, value, is_error.

    Month and day are taken as they stand, so that a day that the calendar lacks stays; where they are no whole numbers the line goes. Of a
    station's lines for one day the last counts, files in the order of their names. A year without a folder has no rows; a file without
    position has none either, and one without ID goes by its name."""
    if year not in _years(spark, f"{root}/tsv"):
        return spark.createDataFrame([], "month int, day int, station_id string, location_name string, latitude double, longitude double, value double, is_error boolean")
    texts = files.read(spark, f"{root}/tsv/{year}", "*.tsv").withColumnRenamed("name", "file")
    q1, q2 = _checks()
    name, own = F.coalesce(_named("Name"), F.lit("")), F.regexp_replace("file", r"\.tsv$", "")
    out = _fields(texts, "file").select(
        _part(1).try_cast("int").alias("month"), _part(2).try_cast("int").alias("day"), F.coalesce(_named("ID"), own).alias("station_id"), F.when(~name.isin("", "NA"), name).alias("location_name"),
        text.lenient_double(_named("Lat")).alias("latitude"), text.lenient_double(_named("Lon")).alias("longitude"), text.lenient_double(_part(6)).alias("value"), (~qc.trusted(q1, q2)).alias("is_error"), "file", "at",
    ).where("latitude is not null and longitude is not null and month is not null and day is not null")
    return compat.latest(out, ("month", "day", "station_id"), F.struct("file", "at").desc()).drop("file", "at")
def read(spark: SparkSession, root: str, *years: int) -> DataFrame:
    """Observations of the years given, or of all."""
    wanted = years or _years(spark, f"{root}/tsv")
    return observations(files.read(spark, [f"{root}/tsv/{y}" for y in wanted], "*.tsv"))


def for_frames(obs: DataFrame) -> DataFrame:
    """What frames read: an observation that failed both checks is an error."""
    return obs.select("station_id", "obs_date", "latitude", "longitude", F.col("value_mm").alias("value"), (~F.col("passed")).alias("is_error"))
