"""Domain tables from a star schema, so that every domain operator can be run and checked on it.

Each view is given twice, as a DataFrame and as SQL for the checks; the two say the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Q = F.col


def star(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def member_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ensemble_daily_values: a line item is a member's value of a page's day; a page is a supplier and year."""
    line = star(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_partkey", "l_linenumber", "l_discount", "l_tax", "l_quantity")
    return line.select(
        (Q("l_suppkey") * 10 + F.year("l_shipdate") - 1995).cast("bigint").alias("file_id"), (Q("l_partkey") % 2 + 1).cast("tinyint").alias("day_of_month"), F.month("l_shipdate").cast("tinyint").alias("month"),
        ((Q("l_linenumber") - 1) % 5 + 1).cast("tinyint").alias("ensemble_member"), F.when(Q("l_discount") != 0, F.round(Q("l_quantity") / 10, 2)).alias("rainfall"),
        F.when((Q("l_discount") == 0) & (Q("l_tax") >= 0.04), 1).otherwise(0).cast("tinyint").alias("is_missing"),
    )


def member_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ensemble_monthly_totals."""
    return member_days(spark, sf_dir).groupBy("file_id", "month", "ensemble_member").agg(F.round(F.sum("rainfall"), 2).alias("total"), F.min("is_missing").alias("is_missing"))


def pages(spark: SparkSession, sf_dir: str, totals: DataFrame | None = None) -> DataFrame:
    """ensemble_files; every page has totals, so ``totals`` that are at hand tell the pages."""
    ids = star(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate").select((Q("l_suppkey") * 10 + F.year("l_shipdate") - 1995).cast("bigint").alias("file_id")) if totals is None else totals.select("file_id")
    ids = ids.distinct()
    year = (Q("file_id") % 10 + 1995).cast("int")
    return ids.select("file_id", F.format_string("DRain_%d-%d_RainNos_Supplier_%d.json", year, year, "file_id").alias("file_name"), F.lit("").alias("source_path"), year.alias("year_start"), year.alias("year_end"), F.lit("Supplier").alias("descriptor"), Q("file_id").cast("string").alias("section_id"), F.lit(2).cast("smallint").alias("num_days"))


def monthly(spark: SparkSession, sf_dir: str, totals: DataFrame | None = None) -> DataFrame:
    """monthly_rainfall: the highest member total, half an inch more for every third page."""
    total = F.max("total") + F.when(Q("file_id") % 3 == 0, 0.5).otherwise(0.0)
    return (totals or member_months(spark, sf_dir)).groupBy("file_id", "month").agg(F.round(total, 2).alias("v")).where("v is not null").select(
        F.concat(F.lit("st/"), F.floor(Q("file_id") / 10).cast("string")).alias("station_file_id"), (Q("file_id") % 10 + 1995).cast("int").alias("year"), "month", Q("v").alias("rainfall_in"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = Q("s_suppkey")
    return star(spark, sf_dir, "supplier", "s_suppkey", "s_name").select(
        F.concat(F.lit("st/"), key.cast("string")).alias("station_file_id"), F.lit("st").alias("station_folder"), key.cast("string").alias("station_file_name"), Q("s_name").alias("location_name"), F.lit(None).cast("string").alias("grid_reference"),
        (F.lit(-2.0) + (key * 91 % 89) / F.lit(40.0)).alias("longitude"), (F.lit(51.0) + (key * 37 % 97) / F.lit(50.0)).alias("latitude"), (key % 900).cast("int").alias("elevation_ft"), key.cast("string").alias("station_number"), F.lit("").alias("source_path"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ensemble_metadata: every fifth page has no place, every seventh an approximate one."""
    p, s = pages(spark, sf_dir), stations(spark, sf_dir)
    kind = F.when(Q("file_id") % 5 == 0, F.lit(None).cast("string")).when(Q("file_id") % 7 == 0, "approximate").otherwise("exact")
    joined = p.join(s, F.concat(F.lit("st/"), F.floor(Q("file_id") / 10).cast("string")) == s["station_file_id"]).withColumn("match_type", kind)
    known = lambda c: F.when(Q("match_type").isNotNull(), c)
    name = F.concat(F.lit("Place "), (F.floor(Q("file_id") / 10) % 40).cast("string"))
    spot = lambda c, f: F.when(Q("match_type") == "exact", F.floor(Q("file_id") / 10) % 40 * f + F.lit(50.0 if c == "latitude" else -3.0)).when(Q("match_type") == "approximate", Q(c))
    return joined.select(
        "file_id", "file_name", F.when(Q("match_type") == "exact", name).alias("matched_location_name"), known((Q("file_id") % 10 + 1995).cast("bigint")).alias("matched_year"), spot("latitude", F.lit(0.125)).alias("matched_latitude"), spot("longitude", F.lit(0.0625)).alias("matched_longitude"),
        F.when(Q("match_type") == "exact", Q("elevation_ft").cast("double")).alias("matched_elevation_ft"), "match_type", F.lit(1).cast("bigint").alias("match_source_session_id"),
    )


def station_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ensemble_metadata at the stations' own places, for the neighbour statistics."""
    s = stations(spark, sf_dir)
    return pages(spark, sf_dir).join(s, F.concat(F.lit("st/"), F.floor(Q("file_id") / 10).cast("string")) == s["station_file_id"]).select(
        "file_id", "file_name", Q("location_name").alias("matched_location_name"), (Q("file_id") % 10 + 1995).cast("bigint").alias("matched_year"), Q("latitude").alias("matched_latitude"), Q("longitude").alias("matched_longitude"), Q("elevation_ft").cast("double").alias("matched_elevation_ft"), F.lit("exact").alias("match_type"), F.lit(1).cast("bigint").alias("match_source_session_id"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """observations: an order is a customer's reading of a day; status and priority stand for the two verdicts."""
    o = star(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    q1 = F.when(Q("o_orderkey") % 10 < 7, "pass").when(Q("o_orderkey") % 10 == 7, "review").otherwise("fail")
    q2 = F.when(Q("o_orderkey") % 10 < 8, "NA").when(Q("o_orderkey") % 3 == 0, "pass").when(Q("o_orderkey") % 3 == 1, "indeterminate").otherwise("fail")
    site = Q("o_custkey") % 50
    one = o.select(
        F.concat(F.lit("s"), site.cast("string")).alias("station_id"), F.concat(F.lit("Place "), (site % 17).cast("string")).alias("location_name"), (F.lit(50.0) + site % 20 * 0.25).alias("latitude"), (F.lit(-4.0) + site % 10 * 0.5).alias("longitude"), F.lit(None).cast("double").alias("altitude"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").cast("smallint").alias("month"), F.dayofmonth("o_orderdate").cast("smallint").alias("day"), F.to_date("o_orderdate").alias("obs_date"),
        F.when(Q("o_orderkey") % 23 != 0, F.round(Q("o_totalprice") % 61, 1)).alias("value_mm"), q1.alias("qc1"), q2.alias("qc2"), "o_orderkey",
    )
    return one.withColumn("passed", (Q("qc1") == "pass") | Q("qc2").isin("pass", "indeterminate"))


SQL = {
    "pmd": """select cast(l_suppkey*10 + year(l_shipdate) - 1995 as bigint) file_id, cast(l_partkey % 2 + 1 as tinyint) day_of_month, cast(month(l_shipdate) as tinyint) as month,
      cast((l_linenumber - 1) % 5 + 1 as tinyint) ensemble_member, case when l_discount <> 0 then round(l_quantity / 10, 2) end rainfall,
      cast(case when l_discount = 0 and l_tax >= 0.04 then 1 else 0 end as tinyint) is_missing from lineitem""",
    "pmm": "select file_id, month, ensemble_member, round(sum(rainfall), 2) total, min(is_missing) is_missing from pmd group by all",
    "pages": """select file_id, 'DRain_' || y || '-' || y || '_RainNos_Supplier_' || file_id || '.json' file_name from
      (select distinct cast(l_suppkey*10 + year(l_shipdate) - 1995 as bigint) file_id, year(l_shipdate) y from lineitem)""",
    "sm": """select 'st/' || (file_id // 10) station_file_id, cast(file_id % 10 + 1995 as int) as year, month, round(v, 2) rainfall_in, file_id from
      (select file_id, month, max(total) + case when file_id % 3 = 0 then 0.5 else 0.0 end v from pmm group by file_id, month) where v is not null""",
    "station": """select 'st/' || s_suppkey station_file_id, s_name location_name, -2.0::double + (s_suppkey*91 % 89) / 40.0::double longitude, 51.0::double + (s_suppkey*37 % 97) / 50.0::double latitude,
      cast(s_suppkey % 900 as int) elevation_ft, cast(s_suppkey as varchar) station_number from supplier""",
    "cons": "select file_id, month, day_of_month, median(coalesce(rainfall, 0.0)) consensus_value from pmd group by all",
    "meta": """select file_id, file_name, case when match_type = 'exact' then 'Place ' || (file_id // 10 % 40) end matched_location_name, case when match_type is not null then cast(file_id % 10 + 1995 as bigint) end matched_year,
      case match_type when 'exact' then (file_id // 10 % 40) * 0.125::double + 50.0::double when 'approximate' then latitude end matched_latitude,
      case match_type when 'exact' then (file_id // 10 % 40) * 0.0625::double - 3.0::double when 'approximate' then longitude end matched_longitude,
      case when match_type = 'exact' then cast(elevation_ft as double) end matched_elevation_ft, match_type from
      (select p.*, s.*, case when p.file_id % 5 = 0 then null when p.file_id % 7 = 0 then 'approximate' else 'exact' end match_type from pages p join station s on s.station_file_id = 'st/' || (p.file_id // 10))""",
    "smeta": """select file_id, file_name, cast(file_id % 10 + 1995 as bigint) as year, latitude lat, longitude lon from pages p join station s on s.station_file_id = 'st/' || (p.file_id // 10)""",
    "obs": """select *, qc1 = 'pass' or qc2 in ('pass', 'indeterminate') passed from (select 's' || (o_custkey % 50) station_id, 'Place ' || (o_custkey % 50 % 17) location_name, 50.0::double + (o_custkey % 50 % 20) * 0.25::double latitude, -4.0::double + (o_custkey % 50 % 10) * 0.5::double longitude,
      year(o_orderdate) as year, month(o_orderdate) as month, day(o_orderdate) as day, cast(o_orderdate as date) obs_date, case when o_orderkey % 23 <> 0 then round(o_totalprice % 61, 1) end value_mm,
      case when o_orderkey % 10 < 7 then 'pass' when o_orderkey % 10 = 7 then 'review' else 'fail' end qc1,
      case when o_orderkey % 10 < 8 then 'NA' when o_orderkey % 3 = 0 then 'pass' when o_orderkey % 3 = 1 then 'indeterminate' else 'fail' end qc2, o_orderkey from orders)""",
    "totals": "select file_id, month, sum(consensus_value) monthly_total from cons group by all",
    "qcr": """select c.file_id, c.month, c.day_of_month, case when abs(t.monthly_total - s.rainfall_in) <= 0.01 then 'pass' else 'fail' end qc_flag from cons c join totals t using (file_id, month)
      left join sm s on s.file_id = c.file_id and s.month = c.month""",
    "vec": """select station_file_id, year, file_id, list(coalesce(v, 0.0) order by m) raw, count(v) n_present from
      (select a.*, s.rainfall_in v from (select station_file_id, year, file_id, unnest(range(1, 13)) m from (select distinct station_file_id, year, file_id from sm)) a left join sm s on s.file_id = a.file_id and s.month = a.m) group by all""",
}
_NEEDS = {"pmm": ["pmd"], "sm": ["pmm"], "cons": ["pmd"], "meta": ["pages", "station"], "smeta": ["pages", "station"], "totals": ["cons"], "qcr": ["cons", "totals", "sm"], "vec": ["sm"]}


def with_views(*names: str, more: str = "") -> str:
    """``with ...`` over the named views and what they need, and over further ones."""
    order: list[str] = []

    def add(n: str) -> None:
        for m in _NEEDS.get(n, []):
            add(m)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "with " + ",\n".join([*(f"{n} as ({SQL[n]})" for n in order), *([more] if more else [])]) + "\n"
