"""Page transcriptions: one JSON object a page, with ``Day 1`` to ``Day 31`` and ``Totals``, twelve months of five members each.

All of it is DataFrame work. A member is a number, null or ``missing``: variants keep a number apart from its text in quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files, numbering
from ..functions import text

MONTHS, MEMBERS = 12, 5
_GRID = "map<string,array<struct<values:array<variant>>>>"
_KEY = r"^(Totals|Day ([1-9]|[12][0-9]|3[01]))$"


def discover(spark: SparkSession, root: str) -> DataFrame:
    """source_path, file_name (its stem) and content of every JSON file below a root."""
    found = files.read(spark, root, "*.json", below=True)
    return found.select("source_path", text.without_suffix(F.col("name")).alias("file_name"), F.col("value").alias("content"))


def _missing(v: Column) -> Column:
    return F.coalesce(F.lower(F.trim(v)) == "missing", F.lit(False))


def _told(v: Column) -> Column:
    """What a member is (number, text, nothing or other) and its digits or text, each looked up once: a page has hundreds of members."""
    with_type = F.transform(v, lambda x: F.struct(x.alias("v"), F.schema_of_variant(x).alias("t")))
    t = lambda c: c["t"]
    # true and false count as 1 and 0
    kind = lambda c: F.when(t(c).isNull() | (t(c) == "VOID"), "nothing").when(t(c) == "STRING", "text").when(t(c).isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | t(c).startswith("DECIMAL"), "number").otherwise("other")
    digits = lambda c: F.when(t(c) == "BOOLEAN", F.try_variant_get(c["v"], "$", "boolean").cast("int").cast("string")).when(t(c) != "VOID", F.try_variant_get(c["v"], "$", "string"))
    return F.transform(with_type, lambda c: F.struct(kind(c).alias("kind"), digits(c).alias("text")))


def parse(texts: DataFrame) -> DataFrame:
    """texts with ``grid`` and ``error``: null for a page that parses, else what is wrong with it.

    A number in quotes is no number; no text but ``missing`` (in any case, with blanks around it) is allowed."""
    typed = F.from_json("content", _GRID, {"mode": "PERMISSIVE"})
    told = lambda _, row: F.transform(row, lambda s: F.struct(_told(s["values"]).alias("values")))
    as_text = lambda _, row: F.transform(row, lambda s: F.struct(F.transform(s["values"], lambda c: c["text"]).alias("values")))
    parsed = texts.withColumn("typed", F.transform_values(typed, told)).withColumn("grid", F.transform_values("typed", as_text))
    slots = F.flatten(F.map_values("typed"))
    odd_key = F.exists(F.map_keys("typed"), lambda k: ~k.rlike(_KEY))
    odd_slots = F.exists(F.map_values("typed"), lambda v: v.isNull() | (F.size(v) != MONTHS))
    odd_members = F.exists(slots, lambda s: s.isNull() | s["values"].isNull() | (F.size(s["values"]) != MEMBERS))
    odd_value = F.exists(F.flatten(F.transform(slots, lambda s: s["values"])), lambda c: ~c["kind"].isin("nothing", "number") & ~((c["kind"] == "text") & _missing(c["text"])))
    error = (
        F.when(F.col("typed").isNull() | (F.size("typed") == 0), "no JSON object of months").when(odd_key, "unexpected key").when(odd_slots, f"a row without {MONTHS} months")
        .when(odd_members, f"a month without {MEMBERS} values").when(odd_value, "a value that is no number")
    )
    return parsed.withColumn("error", error).drop("typed")


def _cells(good: DataFrame, wanted: Column) -> DataFrame:
    slot = good.select("file_id", F.explode("grid").alias("key", "slots")).where(wanted).select("file_id", "key", F.posexplode("slots").alias("m", "slot"))
    cell = slot.select("file_id", "key", (F.col("m") + 1).cast("tinyint").alias("month"), F.posexplode("slot.values").alias("j", "v"))
    return cell.select("file_id", "key", "month", (F.col("j") + 1).cast("tinyint").alias("ensemble_member"), F.when(~_missing(F.col("v")), F.col("v").try_cast("double")).alias("value"), _missing(F.col("v")).cast("tinyint").alias("is_missing"))


def with_ids(parsed: DataFrame, ids: str | None = None) -> DataFrame:
    """file_id: 1, 2, ... over the pages that parse, in order of their paths; with a folder ``ids``, pages that its table knows keep their numbers and
    new ones follow, so that pages ingested in parts, or by a stream, have the ids that one ingest in that order would give them."""
    good = parsed.where("error is null")
    numbered = numbering.dense(good, "source_path") if ids is None else numbering.assign(good, "source_path", ids)
    return good.join(numbered.withColumnRenamed("id", "file_id"), "source_path")


def tables(parsed: DataFrame, ids: str | None = None) -> dict[str, DataFrame]:
    """ensemble_files, ensemble_daily_values, ensemble_monthly_totals and ensemble_ingestion_file_errors."""
    good = with_ids(parsed, ids)
    is_day = F.col("key") != "Totals"
    days = F.size(F.filter(F.map_keys("grid"), lambda k: k != "Totals")).cast("smallint")
    daily = _cells(good, is_day).withColumn("day_of_month", F.regexp_extract("key", r"(\d+)$", 1).cast("tinyint"))
    return {
        "ensemble_files": good.select("file_id", "file_name", "source_path", *(c.alias(n) for n, c in text.page_name_parts(F.col("file_name")).items()), days.alias("num_days")),
        "ensemble_daily_values": daily.select("file_id", "day_of_month", "month", "ensemble_member", F.col("value").alias("rainfall"), "is_missing"),
        "ensemble_monthly_totals": _cells(good, ~is_day).select("file_id", "month", "ensemble_member", F.col("value").alias("total"), "is_missing"),
        "ensemble_ingestion_file_errors": parsed.where("error is not null").select("source_path", F.col("error").alias("error_message")),
    }
