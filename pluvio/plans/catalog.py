"""Named queries over the operators, each with the SQL that says the same.

Derived doubles are rounded where the order of a sum could show; ids and counts have one width on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import arrays, compat, geo, qc, text
from ..operators import analysis, assign, booster, consensus, export, frames, incremental, ingest, lookups, match, qc1, ranks, regional, registry, sampling, vectors
from ..sources import files, monthly_csv, numbering, pages_json, sef, sessions, tables
from .. import stored
from . import adapters as a

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
V = a.with_views


def query(sql: str | None = None, name: str | None = None):
    def keep(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            SQL[key] = sql
        return f

    return keep


def _r(c, n: int = 6):
    return F.round(c, n)


# --- consensus and the first check --------------------------------------------------------------------------------------------


@query(V("cons") + "select file_id, cast(month as int) as month, cast(day_of_month as int) day_of_month, round(consensus_value, 6) consensus_value from cons")
def daily_consensus(spark, sf):
    c = consensus.daily(a.member_days(spark, sf))
    return c.select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), _r("consensus_value").alias("consensus_value"))


@query(V("pmd") + "select file_id, cast(month as int) as month, cast(day_of_month as int) day_of_month, round(median(rainfall), 6) as value, round(max(rainfall) - min(rainfall), 6) spread, count(rainfall) members from pmd where rainfall is not null group by 1, 2, 3")
def map_consensus(spark, sf):
    c = consensus.daily_for_maps(a.member_days(spark, sf))
    return c.select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), _r("value").alias("value"), _r("spread").alias("spread"), "members")


@query(V("totals") + "select file_id, cast(month as int) as month, round(monthly_total, 6) monthly_total from totals")
def monthly_from_days(spark, sf):
    t = consensus.monthly_from_days(consensus.daily(a.member_days(spark, sf)))
    return t.select("file_id", F.col("month").cast("int").alias("month"), _r("monthly_total").alias("monthly_total"))


_RESULTS = """,
    top as (select file_id from pages where file_id % 4 <> 1),
    judged as (select c.file_id, cast(c.month as int) as month, cast(c.day_of_month as int) day_of_month, t.monthly_total, s.rainfall_in,
      case when k.file_id is null then 'non_exact_specifier' when s.rainfall_in is null then 'missing_rr_monthly_value' else 'exact_monthly_compare' end reason,
      coalesce(abs(t.monthly_total - s.rainfall_in) <= 3.0, false) ok
      from cons c join totals t using (file_id, month) left join top p on p.file_id = c.file_id left join sm s on s.file_id = p.file_id and s.month = c.month
      left join (select distinct file_id from sm where file_id % 4 <> 1) k on k.file_id = c.file_id)
"""


def _planted(spark, sf) -> DataFrame:
    """Best matches as planted: each page with its own station-year, but for every fourth."""
    p = a.pages(spark, sf).where(F.col("file_id") % 4 != 1)
    station_year = F.concat(F.lit("st/"), F.floor(F.col("file_id") / 10).cast("string"), F.lit("::"), (F.col("file_id") % 10 + 1995).cast("string"))
    return p.select(F.lit(1).cast("bigint").alias("session_id"), F.lit(1).cast("bigint").alias("query_rank"), F.concat(F.lit("ensemble_file::"), F.col("file_id").cast("string")).alias("ensemble_vector_id"), station_year.alias("rr_vector_id"), F.lit(12).cast("bigint").alias("exact_agreement_count"))


def _check(spark, sf, tolerance: float = 3.0) -> DataFrame:
    rr = stored.stored(a.monthly(spark, sf), "monthly_rainfall")  # read several times, as the chain's table
    keys = rr.select("station_file_id", "year").distinct().withColumn("rr_vector_id", F.concat_ws("::", "station_file_id", "year"))
    return qc1.results(consensus.daily(a.member_days(spark, sf)), qc1.eligible(_planted(spark, sf), 1), keys, rr, 1, tolerance)


@query(V("qcr", "pages") .rstrip() + _RESULTS + "select file_id, month, day_of_month, reason, case when ok and reason <> 'non_exact_specifier' then 'pass' else 'fail' end qc_flag, case when ok and reason <> 'non_exact_specifier' then 1.0 else 0.0 end::double qc_score, round(monthly_total, 6) monthly_total, round(rainfall_in, 6) rr_total from judged")
def monthly_check(spark, sf):
    r = _check(spark, sf)
    return r.select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), "reason", "qc_flag", "qc_score", _r("monthly_total").alias("monthly_total"), _r("rr_total").alias("rr_total"))


@query(V("qcr", "pages").rstrip() + _RESULTS + """, two as (select file_id, month, day_of_month, case when ok then 'pass' else 'fail' end f, case when ok then 1.0 else 0.0 end s from judged
      union all select file_id, month, day_of_month, case when file_id % 6 = 0 then 'review' else 'pass' end, 0.96 from judged)
    select file_id, month, day_of_month, round(avg(s)::double, 6) final_score, case when max((f = 'fail')::int) = 1 then 'fail' when max((f = 'review')::int) = 1 then 'review' else 'pass' end final_flag,
      case when max((f <> 'pass')::int) = 0 and avg(s) >= 0.95 then 1 else 0 end promoted_good from two group by all""")
def check_rollup(spark, sf):
    first = _check(spark, sf).select("qc_session_id", "file_id", "month", "day_of_month", "qc_flag", "qc_score")
    second = first.withColumn("qc_flag", F.when(F.col("file_id") % 6 == 0, "review").otherwise("pass")).withColumn("qc_score", F.lit(0.96))
    out = qc1.consolidate(first.unionByName(second))
    return out.select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), _r("final_score").alias("final_score"), "final_flag", "promoted_good")


@query(V("qcr") + "select qc_flag as final_flag, count(*) n from qcr group by 1")
def flag_counts(spark, sf):
    daily = consensus.daily(a.member_days(spark, sf))
    rr = a.monthly(spark, sf)
    pages = a.pages(spark, sf)
    keys = rr.select("station_file_id", "year").distinct().withColumn("rr_vector_id", F.concat_ws("::", "station_file_id", "year"))
    own = pages.select("file_id", F.concat(F.lit("st/"), F.floor(F.col("file_id") / 10).cast("string"), F.lit("::"), (F.col("file_id") % 10 + 1995).cast("string")).alias("rr_vector_id"))
    return qc1.results(daily, own, keys, rr, 1).groupBy(F.col("qc_flag").alias("final_flag")).agg(F.count(F.lit(1)).alias("n"))


# --- vectors and arrays ---------------------------------------------------------------------------------------------------------


@query(V("vec") + "select station_file_id || '::' || year rr_vector_id, cast(n_present as int) n_present, 1.0::double completeness, unnest(range(1, 13))::int as month, round(unnest(raw), 6) as value from vec")
def station_vectors(spark, sf):
    v = vectors.station_years(a.monthly(spark, sf), a.stations(spark, sf))
    return v.select("rr_vector_id", "n_present", F.col("completeness").cast("double").alias("completeness"), F.posexplode("raw_vector").alias("at", "v")).select("rr_vector_id", "n_present", "completeness", (F.col("at") + 1).alias("month"), _r("v").alias("value"))


_MEMBERS = """,
    mem as (select file_id, month, list(coalesce(total, 0.0) order by coalesce(total, 0.0)) v from pmm where is_missing = 0 or is_missing is null group by all),
    stat as (select file_id, month, list_median(v) value, case when len(v) >= 2 then list_median(v[len(v) - len(v) // 2 + 1 :]) - list_median(v[: len(v) // 2]) end iqr from mem)
"""


@query(V("pmm").rstrip() + _MEMBERS + "select file_id, month::int as month, round(value, 6) as value, round(iqr, 6) iqr from stat")
def page_months(spark, sf):
    v = vectors.pages(a.member_months(spark, sf), a.pages(spark, sf))
    rows = v.select("file_id", F.posexplode(F.arrays_zip("raw_vector", "monthly_iqr")).alias("at", "z")).where("z.raw_vector is not null")
    return rows.select("file_id", (F.col("at") + 1).alias("month"), _r("z.raw_vector").alias("value"), _r("z.monthly_iqr").alias("iqr"))


@query(V("pmm").rstrip() + _MEMBERS + """, f as (select file_id, list(value) vals, count(*) n, avg(iqr) uncertainty from stat group by file_id)
    select file_id, round(n / 12.0, 6)::double completeness, round(uncertainty, 6) uncertainty from f""")
def page_vectors(spark, sf):
    v = vectors.pages(a.member_months(spark, sf), a.pages(spark, sf))
    return v.select("file_id", _r("completeness").alias("completeness"), _r("uncertainty_score").alias("uncertainty"))


@query(V("vec") + """, s as (select station_file_id || '::' || year id, raw, list_median(raw) med, list_median(list_transform(raw, lambda x: abs(x - list_median(raw)))) mad, sqrt(list_sum(list_transform(raw, lambda x: (x - list_avg(raw)) * (x - list_avg(raw)))) / 11) sd from vec)
    select id rr_vector_id, unnest(range(1, 13))::int as month, round(unnest(list_transform(raw, lambda x: (x - med) / case when mad > 1e-9 then mad when sd > 1e-9 then sd else 1.0 end)), 6) as value from s""".replace("with ", "with ", 1))
def robust_vectors(spark, sf):
    v = vectors.station_years(a.monthly(spark, sf), a.stations(spark, sf))
    return v.select("rr_vector_id", F.posexplode("norm_vector").alias("at", "v")).select("rr_vector_id", (F.col("at") + 1).alias("month"), _r("v").alias("value"))


@query("""select vec_id, round(list_median(list_transform(embedding, lambda x: x::double)), 6) med, round(list_avg(list_transform(embedding, lambda x: x::double)), 6) mean, len(list_filter(embedding, lambda x: x = 0))::int zeros from embeddings""")
def array_statistics(spark, sf):
    e = a.star(spark, sf, "embeddings", "vec_id", "embedding").withColumn("v", F.col("embedding").cast("array<double>"))
    return e.select("vec_id", _r(arrays.median(F.col("v"))).alias("med"), _r(arrays.mean(F.col("v"))).alias("mean"), arrays.zeros(F.col("v")).alias("zeros"))


@query("""select x.vec_id, round(list_dot_product(x.embedding::double[], y.embedding::double[]) / sqrt(list_dot_product(x.embedding::double[], x.embedding::double[]) * list_dot_product(y.embedding::double[], y.embedding::double[])), 5) cosine from embeddings x join embeddings y on y.vec_id = x.vec_id + 1""")
def neighbour_cosine(spark, sf):
    e = a.star(spark, sf, "embeddings", "vec_id", "embedding").withColumn("v", F.col("embedding").cast("array<double>"))
    y = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    return e.join(y, "vec_id").select("vec_id", _r(arrays.cosine(F.col("v"), F.col("w")), 5).alias("cosine"))


# --- match and place ---------------------------------------------------------------------------------------------------------------

_MATCH = """,
    q as (select file_id, month, total from pmm where is_missing = 0 and total is not null),
    ov as (select file_id, count(distinct month) overlap from q group by 1 having count(distinct month) >= 10),
    st as (select station_file_id || '::' || year id, station_file_id, year, raw, list_median(raw) med, list_median(list_transform(raw, lambda x: abs(x - list_median(raw)))) mad,
      sqrt(list_sum(list_transform(raw, lambda x: (x - list_avg(raw)) * (x - list_avg(raw)))) / 11) sd from vec),
    rn as (select id, station_file_id, year, raw, list_transform(raw, lambda x: ((x - med) / case when mad > 1e-9 then mad when sd > 1e-9 then sd else 1.0 end)::float::double) norm from st),
    rr as (select id, unnest(range(1, 13)) m, cast(round_even(unnest(raw)::float * 100::float, 0) as int) c from rn),
    qc as (select distinct file_id, month, unnest([c - 1, c, c + 1]) c from (select file_id, month, cast(round_even(total::float * 100::float, 0) as int) c from q)),
    ex as (select qc.file_id, rr.id, count(*) exact from qc join rr on rr.m = qc.month and rr.c = qc.c group by all),
    mem as (select file_id, month, list(coalesce(total, 0.0) order by coalesce(total, 0.0)) v from pmm where is_missing = 0 or is_missing is null group by all),
    mm as (select file_id, month, list_median(v) value, case when len(v) >= 2 then list_median(v[len(v) - len(v) // 2 + 1 :]) - list_median(v[: len(v) // 2]) end iqr from mem),
    pl as (select file_id, avg(iqr) uncertainty, list(value) vals from mm group by 1),
    ps as (select *, list_median(vals) med, list_median(list_transform(vals, lambda x: abs(x - list_median(vals)))) mad,
      sqrt(list_sum(list_transform(vals, lambda x: (x - list_avg(vals)) * (x - list_avg(vals)))) / (len(vals) - 1)) sd from pl where len(vals) >= 2),
    pn as (select file_id, month, ((value - med) / case when mad > 1e-9 then mad when sd > 1e-9 then sd else 1.0 end)::float::double x from mm join ps using (file_id)),
    pv as (select file_id, uncertainty, list(x order by month) xs, list(month order by month) ms from pn join pl using (file_id) group by all),
    cs as (select pv.file_id, rn.id, uncertainty, xs, list_transform(ms, lambda m: norm[m]) ys from pv join ov using (file_id), rn),
    co as (select file_id, id, uncertainty, list_dot_product(xs, ys) dot, list_dot_product(xs, xs) * list_dot_product(ys, ys) sq from cs),
    mt as (select co.file_id, co.id, coalesce(exact, 0) exact, overlap, case when sq > 0 then dot / sqrt(sq) else '-infinity'::double end cosine, case when sq > 0 then dot / sqrt(sq) else '-infinity'::double end - 0.15 * coalesce(uncertainty, 0.0) adjusted
      from co join ov using (file_id) left join ex on ex.file_id = co.file_id and ex.id = co.id),
    tk as (select *, row_number() over (partition by file_id order by exact desc, round(adjusted, 9) desc, id) k from mt qualify k <= 10)
"""


def _page():
    return F.expr("cast(replace(ensemble_vector_id, 'ensemble_file::', '') as bigint)").alias("file_id")


def _match_tables(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Member totals, files and vectors of the station-years, as the chain's tables: each is read several times and made once."""
    totals = stored.stored(a.member_months(spark, sf), "member_months")
    files = stored.stored(a.pages(spark, sf, totals), "ensemble_files")
    return totals, files, stored.stored(vectors.station_years(a.monthly(spark, sf, totals), a.stations(spark, sf)), "rr_vectors")


def _matches(totals: DataFrame, files: DataFrame, years: DataFrame) -> DataFrame:
    return match.top_k(vectors.member_values(totals), vectors.pages(totals, files), years)


@query(V("pmm", "vec").rstrip() + _MATCH + "select file_id, k query_rank, id rr_vector_id, exact, overlap overlap_months, round(cosine, 6) cosine, round(adjusted, 6) adjusted from tk")
def best_matches(spark, sf):
    """All ten ranks of every page."""
    m = _matches(*_match_tables(spark, sf))
    return m.select(_page(), "query_rank", "rr_vector_id", F.col("exact_agreement_count").alias("exact"), "overlap_months", _r("cosine_similarity").alias("cosine"), _r("adjusted_score").alias("adjusted"))


@query(V("pmm", "vec").rstrip() + _MATCH + "select file_id, exact, overlap overlap_months from tk where k = 1")
def best_agreement(spark, sf):
    m = _matches(*_match_tables(spark, sf)).where("query_rank = 1")
    return m.select(_page(), F.col("exact_agreement_count").alias("exact"), "overlap_months")


@query(V("pmm", "vec").rstrip() + _MATCH + "select i::bigint exact_agreement_count, count(tk.file_id) n from range(13) t(i) left join tk on tk.exact = i and tk.k = 1 group by 1")
def agreement_histogram(spark, sf):
    return lookups.agreement_histogram(_matches(*_match_tables(spark, sf)), 1)


_PLACES = """,
    t3 as (select tk.file_id, tk.k, exact, rn.year, location_name, latitude, longitude, elevation_ft, len(list_filter(rn.raw, lambda x: x = 0)) zeros from tk join rn on rn.id = tk.id join station s on s.station_file_id = rn.station_file_id where k <= 3),
    w as (select file_id, list(row(exact, zeros, year, location_name, latitude, longitude, elevation_ft)::struct(x bigint, z bigint, y bigint, n varchar, la double, lo double, el int) order by k) r from t3 group by 1),
    kd as (select *, case when r[1].x >= 9 and r[1].z <= 3 then 'exact' when len(r) = 3 and r[1].y = r[2].y and r[2].y = r[3].y and
      greatest(sqrt(pow(r[1].la - r[2].la, 2) + pow(r[1].lo - r[2].lo, 2)), sqrt(pow(r[1].la - r[3].la, 2) + pow(r[1].lo - r[3].lo, 2)), sqrt(pow(r[2].la - r[3].la, 2) + pow(r[2].lo - r[3].lo, 2))) <= 1.0 then 'approximate' end match_type from w)
"""
_PLACE = """select p.file_id, case match_type when 'exact' then r[1].n end matched_location_name, case when match_type is not null then r[1].y end matched_year,
    round(case match_type when 'exact' then r[1].la when 'approximate' then (r[1].la + r[2].la + r[3].la) / 3 end, 6) matched_latitude, round(case match_type when 'exact' then r[1].lo when 'approximate' then (r[1].lo + r[2].lo + r[3].lo) / 3 end, 6) matched_longitude,
    case match_type when 'exact' then r[1].el::double end matched_elevation_ft, match_type from pages p left join kd using (file_id)"""


@query(V("pmm", "vec", "station", "pages").rstrip() + _MATCH.rstrip() + _PLACES + _PLACE)
def page_places(spark, sf):
    """All assignments, exact, approximate and none."""
    totals, files, years = _match_tables(spark, sf)
    out = assign.metadata(_matches(totals, files, years), years, a.stations(spark, sf), files, 1)
    return out.select("file_id", "matched_location_name", "matched_year", _r("matched_latitude").alias("matched_latitude"), _r("matched_longitude").alias("matched_longitude"), "matched_elevation_ft", "match_type")


@query(V("pmm", "vec", "station", "pages").rstrip() + _MATCH.rstrip() + _PLACES + _PLACE + " where match_type = 'exact'")
def exact_places(spark, sf):
    """Exact assignments only."""
    return page_places(spark, sf).where("match_type = 'exact'")


@query(V("sm", "pages") + """select station_file_id || '::' || year rr_vector_id, count(p.file_id) match_count, coalesce(string_agg(replace(p.file_name, '.json', ''), ',' order by p.file_name), '') specifiers
    from (select distinct station_file_id, year, file_id from sm) s left join (select file_id, file_name from pages where file_id % 4 <> 1) p on p.file_id = s.file_id group by 1""")
def match_counts(spark, sf):
    rr = vectors.station_years(a.monthly(spark, sf), a.stations(spark, sf))
    exact = a.pages(spark, sf).select("file_id", "file_name", F.lit("exact").alias("match_type"), F.lit(1).cast("bigint").alias("match_source_session_id"))
    return lookups.match_counts(rr, _planted(spark, sf), exact, 1).select("rr_vector_id", "match_count", F.coalesce(F.array_join("specifiers", ","), F.lit("")).alias("specifiers"))


# --- neighbours ---------------------------------------------------------------------------------------------------------------------

_PAIRS = """,
    d as (select t.file_id, n.file_id nb, t.year, 6371.0 * sqrt(pow(radians(n.lat - t.lat), 2) + pow(radians(n.lon - t.lon) * cos(radians((t.lat + n.lat) / 2)), 2)) km
      from smeta t join smeta n on n.year = t.year and n.file_id <> t.file_id and n.lat between t.lat - 0.4505 and t.lat + 0.4505)
"""


@query(V("smeta").rstrip() + _PAIRS + "select file_id, nb nb_file_id, round(km, 6) dist_km from d where km <= 50")
def station_pairs(spark, sf):
    m = regional.located(a.station_metadata(spark, sf), 1)
    return regional.station_pairs(m, m, digits=6).select("file_id", "nb_file_id", "dist_km")


_PASS = "p as (select file_id, month, day_of_month from cons where (file_id + month) % 3 <> 0)"


@query(V("smeta", "cons").rstrip() + _PAIRS + ", " + _PASS + """, r as (select d.file_id, c.month, c.day_of_month, d.km, c.consensus_value v from d join cons c on c.file_id = d.nb join p on p.file_id = c.file_id and p.month = c.month and p.day_of_month = c.day_of_month where km <= 50),
    g as (select file_id, month, day_of_month, count(*) n50, count(*) filter (where km <= 20) n20, median(v) m50, median(v) filter (where km <= 20) m20 from r group by all),
    md as (select r.file_id, r.month, r.day_of_month, median(abs(v - m50)) mad50, median(abs(v - m20)) filter (where km <= 20) mad20 from r join g using (file_id, month, day_of_month) group by all)
    select c.file_id, c.month::int as month, c.day_of_month::int day_of_month, coalesce(n20, 0) n_20km, round(m20, 6) median_20km, round(mad20, 6) mad_20km, coalesce(n50, 0) n_50km, round(m50, 6) median_50km, round(mad50, 6) mad_50km
    from cons c left join g using (file_id, month, day_of_month) left join md using (file_id, month, day_of_month)""")
def neighbour_stats(spark, sf):
    out = _regional(spark, sf)
    return out.select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), "n_20km", _r("median_20km").alias("median_20km"), _r("mad_20km").alias("mad_20km"), "n_50km", _r("median_50km").alias("median_50km"), _r("mad_50km").alias("mad_50km"))


def _regional(spark, sf) -> DataFrame:
    days = stored.stored(consensus.daily(a.member_days(spark, sf)), "daily_consensus")  # read several times, as the chain's table
    return regional.daily_stats(a.station_metadata(spark, sf), days, _status(spark, sf, days), 1, 1)


def _status(spark, sf, days: DataFrame | None = None) -> DataFrame:
    days = consensus.daily(a.member_days(spark, sf)) if days is None else days
    ok = (F.col("file_id") + F.col("month")) % 3 != 0
    return days.select(F.lit(1).cast("bigint").alias("qc_session_id"), "file_id", "month", "day_of_month", F.when(ok, "pass").when(F.col("file_id") % 2 == 0, "review").otherwise("fail").alias("final_flag"))


@query(V("cons") + "select count(*) as rows, 0::bigint near_above_far, 0::bigint negative_mad, 0::bigint negative_median, 0::bigint median_without_count from cons")
def neighbour_invariants(spark, sf):
    return regional.violations(_regional(spark, sf))


@query("""select a.s_suppkey, b.s_suppkey other, round(sqrt(pow((51.0 + (a.s_suppkey*37 % 97) / 50.0) - (51.0 + (b.s_suppkey*37 % 97) / 50.0), 2) + pow((a.s_suppkey*91 % 89) / 40.0 - (b.s_suppkey*91 % 89) / 40.0, 2)), 6) degrees from supplier a join supplier b on b.s_suppkey = a.s_suppkey + 1""")
def degrees_apart(spark, sf):
    s = a.stations(spark, sf).select(F.col("station_number").cast("bigint").alias("s_suppkey"), "latitude", "longitude")
    b = s.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("s_suppkey").alias("other"), F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"))
    return s.join(b, "s_suppkey").select("s_suppkey", "other", _r(geo.degrees_apart(F.col("latitude"), F.col("longitude"), F.col("lat2"), F.col("lon2"))).alias("degrees"))


# --- second check --------------------------------------------------------------------------------------------------------------------


@query(V("cons") + "select file_id, month::int as month, day_of_month::int day_of_month, case when z is null then 'indeterminate' when v between exp(z - e) - 1 and exp(z + e) - 1 then 'pass' else 'fail' end secondary_flag from (select *, consensus_value v, case when file_id % 9 <> 0 then ln(1 + (file_id % 30) / 10.0) end z, 0.5 e from cons)")
def secondary_verdicts(spark, sf):
    """The interval rule, on given predictions."""
    from ..operators import secondary

    rows = consensus.daily(a.member_days(spark, sf)).withColumn("n_50km", F.when(F.col("file_id") % 9 == 0, 0).otherwise(1)).withColumn("z", F.log1p((F.col("file_id") % 30) / 10.0)).withColumn("err", F.lit(0.25))
    return secondary.verdict(rows, 2.0).select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), "secondary_flag")


@query(V("cons") + """, r as (select abs(consensus_value - (file_id % 30) / 10.0::double) gap, (0.1::double + month / 10.0::double) err from cons), q as (select quantile_cont(gap / err, 0.99) k from r)
    select round(k, 6) k, round(avg((gap <= k * err)::int), 6) covered, count(*) n from r, q group by k""")
def secondary_calibration(spark, sf):
    """The factor that makes the interval cover 99 of 100 days, on given predictions."""
    from ..operators import secondary

    days = consensus.daily(a.member_days(spark, sf)).select(F.abs(F.col("consensus_value") - F.col("file_id") % 30 / 10.0).alias("gap"), (0.1 + F.col("month") / 10.0).alias("err"))
    days = stored.stored(days, "gaps")  # every pass of the quantile reads them
    k = secondary.calibrate(days, secondary.COVERAGE)
    return days.agg(F.round(F.lit(k), 6).alias("k"), _r(secondary.covered(k)).alias("covered"), F.count(F.lit(1)).alias("n"))


@query(None)
def secondary_scores(spark, sf):
    """Trains both regressors and scores the days that failed; trees have no SQL, so tests hold them against a slow version.

    40 trees of depth 5 and rate 0.1, a level of which is a job each; the operator's defaults are 400 of depth 6 and rate 0.05."""
    from ..operators import secondary

    stats = stored.stored(_regional(spark, sf), "regional_daily_stats")  # training reads it many times, as the chain's table
    trained = secondary.train(secondary.training_rows(stats, _status(spark, sf), 1), settings=booster.Settings(trees=40, depth=5, rate=0.1))
    return secondary.score(stats, _status(spark, sf), trained, 1)


@query(V("smeta", "cons").rstrip() + _PAIRS + ", " + _PASS + """, nb as (select distinct d.file_id, p.month, p.day_of_month from d join p on p.file_id = d.nb where km <= 50)
    select p.file_id, p.month::int as month, p.day_of_month::int day_of_month from p join nb using (file_id, month, day_of_month)""")
def training_rows(spark, sf):
    from ..operators import secondary

    stats = _regional(spark, sf)
    return secondary.training_rows(stats, _status(spark, sf), 1).select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"))


# --- export ------------------------------------------------------------------------------------------------------------------------------


def _secondary(spark, sf) -> DataFrame:
    """Two training sessions for every fifth page day; the second one says something else."""
    days = consensus.daily(a.member_days(spark, sf)).where(F.col("file_id") % 2 == 1)
    flag = F.when((F.col("file_id") + F.col("t")) % 3 == 0, "pass").when((F.col("file_id") + F.col("t")) % 3 == 1, "indeterminate").otherwise("fail")
    return days.select("file_id", (F.col("file_id") % 10 + 1995).cast("bigint").alias("matched_year"), "month", "day_of_month", F.explode(F.array(F.lit(1), F.lit(2))).alias("t")).select(F.lit(1).cast("bigint").alias("qc_session_id"), "file_id", "matched_year", "month", "day_of_month", F.col("t").cast("bigint").alias("train_session_id"), flag.alias("secondary_flag"))


_EXPORT = """,
    e as (select c.file_id, m.file_name, m.matched_year, c.month, c.day_of_month, c.consensus_value,
      case when match_type = 'exact' and matched_location_name is not null then 'loc:' || matched_location_name || '@' || cast(round(matched_latitude, 4) as varchar) || ',' || cast(round(matched_longitude, 4) as varchar) else 'file:' || c.file_id end group_key,
      case when (c.file_id + c.month) % 3 <> 0 then 'pass' when c.file_id % 2 = 0 then 'review' else 'fail' end q1,
      case when c.file_id % 2 = 1 then case (c.file_id + 2) % 3 when 0 then 'pass' when 1 then 'indeterminate' else 'fail' end end q2
      from cons c join meta m using (file_id) where matched_latitude is not null),
    k as (select *, case when q1 = 'pass' then 1 when q1 = 'fail' and q2 = 'pass' then 2 when q1 = 'review' then 3 when q1 = 'fail' and q2 = 'indeterminate' then 4 else 5 end qc_rank from e)
"""


def _export_rows(spark, sf) -> DataFrame:
    return export.joined(consensus.daily(a.member_days(spark, sf)), a.metadata(spark, sf), _status(spark, sf), _secondary(spark, sf), 1)


@query(V("cons", "meta").rstrip() + _EXPORT + "select matched_year, group_key, month::int as month, day_of_month::int day_of_month, file_id, qc_rank, q1 qc1_flag, q2 qc2_flag, round(consensus_value, 6) consensus_value from k qualify row_number() over (partition by matched_year, group_key, month, day_of_month order by qc_rank, file_id) = 1")
def merged_days(spark, sf):
    d = export.merged_days(_export_rows(spark, sf))
    return d.select("matched_year", "group_key", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), "file_id", "qc_rank", "qc1_flag", "qc2_flag", _r("consensus_value").alias("consensus_value"))


@query(V("cons", "meta").rstrip() + _EXPORT + """, f as (select matched_year, group_key, file_id, replace(any_value(file_name), '.json', '') id, count(*) filter (where q1 = 'pass') p from k group by all)
    select matched_year, group_key, count(*) n_sources, string_agg(id, ',' order by id) sources, arg_min(id, row(-p, file_id)) station_id from f group by all""")
def merged_stations(spark, sf):
    return export.merged_stations(_export_rows(spark, sf)).select("matched_year", "group_key", "n_sources", F.array_join("sources", ",").alias("sources"), "station_id")


_LINES = """,
    best as (select * from k qualify row_number() over (partition by matched_year, group_key, month, day_of_month order by qc_rank, file_id) = 1),
    body as (select matched_year, group_key, count(*) n, string_agg(concat_ws(chr(9), matched_year, month, day_of_month, 9, 0, '1day', printf('%.1f', consensus_value * 25.4),
      'qc1=' || q1 || '|qc2=' || coalesce(q2, 'NA') || '|source=' || replace(file_name, '.json', '')), chr(10) order by month, day_of_month) lines from best group by all),
    f as (select matched_year, group_key, file_id, replace(any_value(file_name), '.json', '') id, count(*) filter (where q1 = 'pass') p from k group by all),
    s as (select matched_year, group_key, count(*) n_sources, string_agg(id, ',' order by id) sources, arg_min(file_id, row(-p, file_id)) lead from f group by all)
"""


def _exchange(spark, sf) -> DataFrame:
    return export.documents(_export_rows(spark, sf), 1)


@query(V("cons", "meta").rstrip() + _EXPORT.rstrip() + _LINES + """select s.matched_year::int as year, replace(file_name, '.json', '') station_id, n::int n_observations,
      array_to_string(['SEF' || chr(9) || '1.0.0', 'ID' || chr(9) || replace(file_name, '.json', ''), 'Name' || chr(9) || coalesce(matched_location_name, 'NA'), 'Lat' || chr(9) || printf('%.4f', matched_latitude),
        'Lon' || chr(9) || printf('%.4f', matched_longitude), 'Alt' || chr(9) || coalesce(printf('%.1f', matched_elevation_ft * 0.3048), 'NA'), 'Source' || chr(9) || 'NA', 'Link' || chr(9) || 'NA',
        'Vbl' || chr(9) || 'rr', 'Stat' || chr(9) || 'sum', 'Units' || chr(9) || 'mm', 'Meta' || chr(9) || 'orig.units=in|match.type=' || match_type || '|qc.session=1|n.sources=' || n_sources || '|sources=' || sources,
        concat_ws(chr(9), 'Year', 'Month', 'Day', 'Hour', 'Minute', 'Period', 'Value', 'Meta'), lines, ''], chr(10)) as content
    from s join body using (matched_year, group_key) join meta on meta.file_id = s.lead""")
def exchange_files(spark, sf):
    """The whole text of every station-year's file."""
    return _exchange(spark, sf)


@query(V("cons", "meta").rstrip() + _EXPORT.rstrip() + _LINES + """select replace(l.file_name, '.json', '') station_id, l.matched_location_name location_name, b.matched_year::int as year, b.month::int as month, b.day_of_month::int as day,
      printf('%.1f', b.consensus_value * 25.4)::double value_mm, q1 qc1, coalesce(q2, 'NA') qc2, coalesce(q1 = 'pass' or q2 in ('pass', 'indeterminate'), false) passed
    from best b join s using (matched_year, group_key) join meta l on l.file_id = s.lead where try_cast(b.matched_year || '-' || b.month || '-' || b.day_of_month as date) is not null""")
def exchange_round_trip(spark, sf):
    """Every station-year's file written, and read back as observations."""
    root = f"{stored.shared_dir(spark)}/exchange-{uuid.uuid4().hex}"
    sef.write(_exchange(spark, sf), root)
    return sef.read(spark, root).select("station_id", "location_name", "year", F.col("month").cast("int").alias("month"), F.col("day").cast("int").alias("day"), "value_mm", "qc1", "qc2", "passed")


# --- analysis ------------------------------------------------------------------------------------------------------------------------------

_DAILY = """,
    good as (select *, passed and value_mm is not null ok from obs),
    peak as (select obs_date, station_id, location_name from good where ok qualify row_number() over (partition by obs_date order by value_mm desc, station_id) = 1),
    nat as (select obs_date, g.year, count(*) filter (where ok) n_stations_reporting, avg(value_mm) filter (where ok) mean_mm, max(value_mm) filter (where ok) max_mm,
      count(*) filter (where ok and value_mm >= 1) n_wet, count(*) filter (where ok and value_mm >= 10) n_ge10, count(*) filter (where ok and value_mm >= 25) n_ge25, count(*) filter (where ok and value_mm >= 50) n_ge50 from good g group by obs_date, g.year)
"""


@query(V("obs").rstrip() + _DAILY + "select nat.obs_date, nat.year::int as year, n_stations_reporting, round(mean_mm, 6) mean_mm, max_mm, p.station_id argmax_station_id, p.location_name argmax_location, n_wet, n_ge10, n_ge25, n_ge50 from nat left join peak p using (obs_date)")
def daily_national(spark, sf):
    d = analysis.daily_national(a.observations(spark, sf))
    return d.withColumn("mean_mm", _r("mean_mm"))


@query(V("obs") + "select year::int as year, count(*) n_obs, count(distinct station_id) n_stations, count(distinct latitude || ',' || longitude) n_unique_stations, round(100.0 * sum(passed::int) / count(*), 6)::double pct_passed from obs group by 1")
def coverage_by_year(spark, sf):
    return analysis.coverage(a.observations(spark, sf)).withColumn("pct_passed", _r(F.col("pct_passed").cast("double")))


@query(V("obs") + """select year::int as year, count(*) n_obs, round(100.0 * avg((lower(qc1) = 'pass')::int), 6) qc1_pass_pct, round(100.0 * avg((lower(qc1) = 'review')::int), 6) qc1_review_pct, round(100.0 * avg((lower(qc1) = 'fail')::int), 6) qc1_fail_pct,
    count(*) filter (where lower(qc2) <> 'na') n_qc2, round(100.0 * avg((lower(qc2) = 'pass')::int) filter (where lower(qc2) <> 'na'), 6) qc2_pass_pct, round(100.0 * avg(passed::int), 6) trusted_pct from obs group by 1""")
def qc_rates_by_year(spark, sf):
    d = analysis.qc_rates(a.observations(spark, sf))
    return d.select("year", "n_obs", "n_qc2", *(_r(F.col(c).cast("double")).alias(c) for c in ("qc1_pass_pct", "qc1_review_pct", "qc1_fail_pct", "qc2_pass_pct", "trusted_pct")))


@query(V("obs") + """, sm2 as (select station_id, year, month, max((lower(qc1) = 'pass')::int) q, max(passed::int) t from obs group by all)
    select make_date(year, month, 1) month_start, year::int as year, month::int as month, count(*) n_stations, round(100.0 * avg(q), 6) qc1_pass_pct, round(100.0 * avg(t), 6) trusted_pct from sm2 group by 1, 2, 3 having count(*) >= 10""")
def qc_by_month(spark, sf):
    d = analysis.monthly_qc(a.observations(spark, sf))
    return d.select("month_start", "year", F.col("month").cast("int").alias("month"), "n_stations", _r(F.col("qc1_pass_pct").cast("double")).alias("qc1_pass_pct"), _r(F.col("trusted_pct").cast("double")).alias("trusted_pct"))


@query(V("obs") + """select station_id, min(location_name) location_name, round(min(latitude), 3) lat, round(min(longitude), 3) lon, count(*) n_obs, round(100.0 * avg((lower(qc1) = 'pass')::int), 6) qc1_pass_pct, round(100.0 * avg(passed::int), 6) trusted_pct from obs group by 1 having count(*) >= 120""")
def qc_by_station(spark, sf):
    d = analysis.station_qc(a.observations(spark, sf))
    return d.select("station_id", "location_name", "lat", "lon", "n_obs", _r(F.col("qc1_pass_pct").cast("double")).alias("qc1_pass_pct"), _r(F.col("trusted_pct").cast("double")).alias("trusted_pct"))


@query(V("obs") + """, s as (select station_id, round(100.0 * avg((lower(qc1) = 'pass')::int), 6) qc1_pass_pct from obs group by 1 having count(*) >= 120) select * from s order by qc1_pass_pct, station_id limit 15""")
def worst_stations(spark, sf):
    d = analysis.station_qc(a.observations(spark, sf)).select("station_id", _r(F.col("qc1_pass_pct").cast("double")).alias("qc1_pass_pct"))
    return analysis.extremes_of(d, "qc1_pass_pct", "station_id", 15)


@query(V("obs").rstrip() + _DAILY + "select year::int as year, round(avg(mean_mm), 5) mean_daily_mm, round(sum(mean_mm), 4) annual_total_mm, sum(n_stations_reporting)::bigint station_days from nat group by 1")
def annual_summary(spark, sf):
    d = analysis.annual(analysis.daily_national(a.observations(spark, sf)))
    return d.select("year", _r("mean_daily_mm", 5).alias("mean_daily_mm"), _r("annual_total_mm", 4).alias("annual_total_mm"), "station_days")


@query(V("obs") + "select year::int as year, round(avg(value_mm) filter (where passed and value_mm >= 1), 6) sdii_mm, round(avg((passed and value_mm >= 1)::int) filter (where passed and value_mm is not null), 6) wet_fraction from obs group by 1")
def rain_intensity(spark, sf):
    d = analysis.intensity(a.observations(spark, sf))
    return d.select("year", _r("sdii_mm").alias("sdii_mm"), _r("wet_fraction").alias("wet_fraction"))


@query(V("obs").rstrip() + _DAILY + "select obs_date, n_stations_reporting, round(mean_mm, 2) mean_mm, round(max_mm, 1) max_mm from nat where year >= 1880 order by nat.mean_mm desc nulls last, obs_date limit 12")
def wettest_days(spark, sf):
    return analysis.wettest_days(analysis.daily_national(a.observations(spark, sf))).drop("argmax_location")


@query(V("obs") + "select obs_date, station_id, location_name, round(value_mm, 1) value_mm, round(latitude, 3) lat, round(longitude, 3) lon from obs where passed and value_mm is not null order by obs.value_mm desc, obs_date, station_id limit 12")
def extreme_station_days(spark, sf):
    return analysis.extreme_station_days(a.observations(spark, sf))


@query(V("obs").rstrip() + _DAILY + "select year::int as year, round(1000.0 * sum(n_ge10) / sum(n_stations_reporting), 6)::double ge10_rate, round(1000.0 * sum(n_ge25) / sum(n_stations_reporting), 6)::double ge25_rate, round(1000.0 * sum(n_ge50) / sum(n_stations_reporting), 6)::double ge50_rate from nat group by 1")
def extreme_rates(spark, sf):
    d = analysis.extreme_rates(analysis.daily_national(a.observations(spark, sf)))
    return d.select("year", *(_r(F.col(c).cast("double")).alias(c) for c in ("ge10_rate", "ge25_rate", "ge50_rate")))


@query(V("obs") + "select station_id, longitude, latitude, value_mm from obs where obs_date = date '1996-07-01' and passed and value_mm is not null")
def event_map(spark, sf):
    return analysis.event_map(a.observations(spark, sf), "1996-07-01")


@query(V("obs") + "select qc1, qc2, count(*) n from obs group by 1, 2")
def verdict_counts(spark, sf):
    return analysis.verdict_counts(a.observations(spark, sf))


@query(V("obs") + "select year::int as year, count(*) n_observations, sum(passed::int)::bigint n_passed, count(distinct station_id) n_stations, count(distinct obs_date) n_days from obs group by 1")
def parse_summary(spark, sf):
    return analysis.parse_summary(a.observations(spark, sf))


# --- files in ---------------------------------------------------------------------------------------------------------------------------------


def _page_texts(spark, sf) -> DataFrame:
    """folder, name, content: a JSON text a page, with two days and the totals; every eleventh page has a total in quotes and fails."""
    days = a.member_days(spark, sf).where("is_missing = 0").groupBy("file_id", "month", "day_of_month", "ensemble_member").agg(F.max("rainfall").alias("v"))
    slot = F.when(F.col("day_of_month") == 1, 0).otherwise(1) * 60 + (F.col("month") - 1) * 5 + F.col("ensemble_member") - 1
    cells = days.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct(slot.cast("int").alias("at"), F.coalesce(F.col("v").cast("string"), F.lit("null")).alias("t")))).alias("cells"))
    member = lambda at: F.coalesce(F.try_element_at("cells", at), F.lit('" Missing"'))
    month = lambda base: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda m: F.concat(F.lit('{"values":['), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda j: member((base + m * 5 + j).cast("int"))), ","), F.lit("]}"))), ",")
    total = F.when(F.col("file_id") % 11 == 0, F.lit('{"values":["1.5",1,1,1,1]}')).otherwise(F.lit('{"values":[1.5,true,null,"missing",2]}'))
    content = F.concat(F.lit('{"Day 1":['), month(F.lit(0)), F.lit('],"Day 2":['), month(F.lit(60)), F.lit('],"Totals":['), F.array_join(F.array_repeat(total, 12), ","), F.lit("]}"))
    return a.pages(spark, sf).join(cells, "file_id").select(F.col("year_start").alias("folder"), text.without_suffix(F.col("file_name")).alias("name"), content.alias("content"))


_PAGE_FILES = """,
    texts as (select p.file_id old, replace(p.file_name, '.json', '') id, (p.file_id % 10 + 1995)::int as y from pages p where p.file_id in (select file_id from pmd where is_missing = 0)),
    good as (select *, row_number() over (order by y, id || '.json') file_id from texts where old % 11 <> 0),
    cell as (select file_id, month, day_of_month, ensemble_member, max(rainfall) v from pmd where is_missing = 0 group by all)
"""


def _ingested(spark, sf) -> str:
    root = f"{stored.shared_dir(spark)}/pages-{uuid.uuid4().hex}"
    files.write(_page_texts(spark, sf), f"{root}/json", ".json")
    ingest.pages(spark, f"{root}/json", f"{root}/tables")
    return f"{root}/tables"


@query(V("pmd", "pages").rstrip() + _PAGE_FILES + """select good.file_id, g.d::int day_of_month, m.m::int as month, e.e::int ensemble_member, v rainfall, (cell.file_id is null)::int is_missing from good, range(1, 3) g(d), range(1, 13) m(m), range(1, 6) e(e)
    left join cell on cell.file_id = good.old and cell.month = m.m and cell.day_of_month = g.d and cell.ensemble_member = e.e""")
def page_ingest_days(spark, sf):
    """A JSON file a page, written and ingested: the daily values of the tables."""
    t = tables.read(spark, _ingested(spark, sf), "ensemble_daily_values")
    return t.select("file_id", *(F.col(c).cast("int").alias(c) for c in ("day_of_month", "month", "ensemble_member")), "rainfall", F.col("is_missing").cast("int").alias("is_missing"))


@query(V("pmd", "pages").rstrip() + _PAGE_FILES + """select 'page' kind, file_id, id as name, y as year_start, 2::int num_days, null as error_message from good
    union all select 'error', null, id, null, null, 'a value that is no number' from texts where old % 11 = 0""")
def page_ingest_files(spark, sf):
    """The pages of the same ingest, and those that failed."""
    root = _ingested(spark, sf)
    name = text.without_suffix(F.element_at(F.split("source_path", "/"), -1))
    good = tables.read(spark, root, "ensemble_files").select(F.lit("page").alias("kind"), "file_id", F.col("file_name").alias("name"), F.col("year_start").cast("int").alias("year_start"), F.col("num_days").cast("int").alias("num_days"), F.lit(None).cast("string").alias("error_message"))
    bad = spark.read.parquet(f"{root}/ensemble_ingestion_file_errors").select(F.lit("error").alias("kind"), F.lit(None).cast("bigint").alias("file_id"), name.alias("name"), F.lit(None).cast("int").alias("year_start"), F.lit(None).cast("int").alias("num_days"), "error_message")
    return good.unionByName(bad)


@query("""with s as (select s_suppkey k, s_name nm from supplier), c as (select k, nm, y.y, m.m, (k * 7 + y.y * 3 + m.m * 11) % 500 / 100.0::double v, (k + y.y + m.m) % 13 = 0 gap from s, range(1900, 1903) y(y), range(1, 13) m(m))
    select k::varchar station_number, nm location_name, round(51.0::double + k % 97 / 50.0::double, 6) latitude, y::int as year, m::int as month, v rainfall_in from c where not gap""")
def station_table_ingest(spark, sf):
    """A station table (CSV) for every supplier, written and ingested: its monthly values beside its place."""
    k = F.col("s_suppkey")
    value = lambda y, m: F.when((k + y + m) % 13 == 0, F.lit("n/a")).otherwise(((k * 7 + y * 3 + m * 11) % 500 / 100.0).cast("string"))
    months = [F.concat_ws(",", F.lit(name), *(value(F.lit(y), F.lit(m)) for y in (1900, 1901, 1902))) for m, name in enumerate(monthly_csv.MONTHS, 1)]
    place = F.concat(F.lit("Grid,SU 123 456,Lon,-1.5,Lat,"), (F.lit(51.0) + k % 97 / 50.0).cast("string"), F.lit(",Elev,"), (k % 900).cast("string"))
    content = F.concat_ws("\n", F.col("s_name"), place, F.concat(F.lit("Station,"), k.cast("string")), F.lit(""), F.lit("Year,1900,1901,1902"), *months, F.lit("Total,,,"), F.lit(""))
    root = f"{stored.shared_dir(spark)}/stations-{uuid.uuid4().hex}"
    files.write(a.star(spark, sf, "supplier", "s_suppkey", "s_name").select((k % 10).alias("folder"), k.cast("string").alias("name"), content.alias("content")), f"{root}/DATA", ".csv")
    ingest.monthly_tables(spark, f"{root}/DATA", f"{root}/tables")
    st, rain = tables.read(spark, f"{root}/tables", "stations"), tables.read(spark, f"{root}/tables", "monthly_rainfall")
    return rain.join(st, "station_file_id").select("station_number", "location_name", _r("latitude").alias("latitude"), F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), "rainfall_in")


# --- lookups, frames ------------------------------------------------------------------------------------------------------------------------


@query(V("pmd", "meta") + "select m.file_id, m.file_name, m.matched_location_name, m.matched_latitude, m.matched_longitude, round(v, 6) as value from meta m left join (select file_id, median(rainfall) v from pmd where month = 6 and day_of_month = 1 and rainfall is not null group by 1) d using (file_id) where matched_year = 1997 and matched_latitude is not null")
def map_of_date(spark, sf):
    return lookups.daily_for_date(a.member_days(spark, sf), a.metadata(spark, sf), 1997, 6, 1).withColumn("value", _r("value"))


@query(V("meta", "cons") + "select m.file_id, m.file_name, m.matched_location_name, m.matched_latitude, m.matched_longitude, case when c.file_id is null then 'no_qc' when (c.file_id + c.month) % 3 <> 0 then 'pass' when c.file_id % 2 = 0 then 'review' else 'fail' end qc_flag from meta m left join cons c on c.file_id = m.file_id and c.month = 3 and c.day_of_month = 2 where matched_year = 1998 and matched_latitude is not null")
def qc_of_date(spark, sf):
    return lookups.qc_for_date(a.metadata(spark, sf), _status(spark, sf), 1998, 3, 2, 1)


@query(V("smeta", "cons").rstrip() + _PAIRS + ", " + _PASS + """, g as (select d.file_id, median(c.consensus_value) v from d join cons c on c.file_id = d.nb join p using (file_id, month, day_of_month) where km <= 50 and month = 5 and day_of_month = 1 and year = 1996 group by 1)
    select c.file_id, s.file_name, round(v, 6) as value from cons c join smeta s using (file_id) left join g using (file_id) where year = 1996 and month = 5 and day_of_month = 1""".replace("join p using (file_id, month, day_of_month)", "join p on p.file_id = c.file_id and p.month = c.month and p.day_of_month = c.day_of_month").replace("and month = 5 and day_of_month = 1 and year = 1996", "and c.month = 5 and c.day_of_month = 1 and d.year = 1996"))
def neighbours_of_date(spark, sf):
    # the year and the day reach the scans of both sides
    one_day = (F.col("month") == 5) & (F.col("day_of_month") == 1)
    stats = regional.daily_stats(a.station_metadata(spark, sf).where("matched_year = 1996"), consensus.daily(a.member_days(spark, sf).where(one_day)), _status(spark, sf).where(one_day), 1, 1)
    return lookups.regional_for_date(stats, a.station_metadata(spark, sf), "median_50km", 1996, 5, 1).select("file_id", "file_name", _r("value").alias("value"))


@query(V("pages") + "select file_id, file_name from pages where file_name like 'DRain_1995-1995_RainNos_Supplier_1%'")
def pages_by_name(spark, sf):
    return lookups.find_pages(a.pages(spark, sf), "DRain_1995-1995_RainNos_Supplier_1").select("file_id", "file_name")


@query(V("obs") + """, fr as (select i frame, (date '1996-03-01' + (i // 4)::int)::date da, case when date '1996-03-01' + (i // 4)::int >= date '1996-03-06' then 0.0 else (i % 4) / 4.0 end step from range(21) t(i)),
    o as (select obs_date, station_id, arg_min(latitude, o_orderkey) latitude, arg_min(longitude, o_orderkey) longitude, arg_min(row(value_mm), o_orderkey)[1] v, arg_min(passed, o_orderkey) ok from obs group by all),
    x as (select frame, step, da, case when da >= date '1996-03-06' then da else (da + 1)::date end db from fr),
    ks as (select x.*, o.station_id from x join o on o.obs_date = x.da union select x.*, o.station_id from x join o on o.obs_date = x.db)
    select k.frame, k.station_id, coalesce(p.latitude, q.latitude) latitude, coalesce(p.longitude, q.longitude) longitude, coalesce(not p.ok, false) is_error,
      case when coalesce(not p.ok, false) then null else round(va + (vb - va) * k.step, 6)::double end as value
    from ks k left join o p on p.obs_date = k.da and p.station_id = k.station_id left join o q on q.obs_date = k.db and q.station_id = k.station_id,
      lateral (select coalesce(case when p.ok then p.v end, 0.0) va, coalesce(case when q.ok then q.v end, 0.0) vb) z""")
def frame_points(spark, sf):
    obs = a.observations(spark, sf).where((F.col("obs_date") >= F.lit(dt.date(1996, 3, 1))) & (F.col("obs_date") <= F.lit(dt.date(1996, 3, 6))))
    one = obs.groupBy("obs_date", "station_id").agg(F.min_by(F.struct("latitude", "longitude", F.col("value_mm").alias("value"), (~F.col("passed")).alias("is_error")), "o_orderkey").alias("r")).select("obs_date", "station_id", "r.*")
    p = frames.points(frames.plan(spark, dt.date(1996, 3, 1), dt.date(1996, 3, 6), 4), one)
    return p.withColumn("value", _r("value"))


_SPAN = "with s as (select min(o_orderdate)::date a, max(o_orderdate)::date b, (max(o_orderdate)::date - min(o_orderdate)::date)::int d from orders)"


def _span(spark, sf) -> tuple[dt.date, dt.date]:
    return a.star(spark, sf, "orders", "o_orderdate").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()


@query(_SPAN + """ select i::bigint frame, 'frame_' || lpad(i::varchar, 7, '0') || '.png' as name, (a + (i // 3)::int)::date day_a, case when i = 3 * d then b else (a + (i // 3)::int + 1)::date end day_b,
    case when i = 3 * d then 0.0 else round((i % 3) / 3.0, 6) end::double step from (select *, unnest(range(3 * d + 1)) i from s)""")
def frame_plan(spark, sf):
    """Three frames a day over all days of the orders."""
    return frames.plan(spark, *_span(spark, sf), 3).withColumn("step", _r("step"))


@query(_SPAN + ", f as (select 3 * d + 1 n from s) select i shard, i * (n // 7) + least(i, n % 7) first_index, i * (n // 7) + least(i, n % 7) + n // 7 + (i < n % 7)::int - 1 last_index from f, range(7) t(i)")
def frame_shards(spark, sf):
    """The same frames in seven blocks."""
    return frames.shards(spark, frames.total_frames(*_span(spark, sf), 3), 7)


# --- relational forms over the plain tables -------------------------------------------------------------------------------------------------


@query("select n_name, count(*) n_customers, round(sum(c_acctbal), 2) balance from customer join nation on n_nationkey = c_nationkey group by 1")
def join_group(spark, sf):
    c, n = a.star(spark, sf, "customer"), a.star(spark, sf, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("select c_custkey from customer where c_custkey in (select o_custkey from orders where o_totalprice > 300000)")
def semi_join(spark, sf):
    return a.star(spark, sf, "customer", "c_custkey").join(a.star(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)")
def anti_join(spark, sf):
    large = a.star(spark, sf, "orders", "o_custkey", "o_totalprice").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return a.star(spark, sf, "customer", "c_custkey").join(large, "c_custkey", "left_anti")


@query("select c_custkey, count(o_orderkey) n_orders from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'F' group by 1")
def left_join_counts(spark, sf):
    o = a.star(spark, sf, "orders").where("o_orderstatus = 'F'")
    return a.star(spark, sf, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"))


@query("select coalesce(x.k, y.k) k, x.n as a, y.n as b from (select s_nationkey k, count(*) n from supplier group by 1) x full join (select c_nationkey k, count(*) n from customer where c_acctbal > 9000 group by 1) y on x.k = y.k")
def full_join(spark, sf):
    x = a.star(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("a"))
    y = a.star(spark, sf, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("b"))
    return x.join(y, "k", "full_outer")


@query("select s_suppkey, s_name from supplier, (select min(s_acctbal) lo, avg(s_acctbal) hi from supplier) b where s_acctbal between lo and hi")
def box_join(spark, sf):
    s = a.star(spark, sf, "supplier")
    box = s.agg(F.min("s_acctbal").alias("lo"), F.avg("s_acctbal").alias("hi"))
    return s.join(F.broadcast(box), F.col("s_acctbal").between(F.col("lo"), F.col("hi"))).select("s_suppkey", "s_name")


@query("select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def latest_order(spark, sf):
    o = a.star(spark, sf, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return compat.latest(o, ["o_custkey"], F.struct("o_orderdate", "o_orderkey").desc()).drop("o_orderdate")


@query("select * from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as place from orders) where place <= 3")
def top_three(spark, sf):
    o = a.star(spark, sf, "orders", "o_custkey", "o_orderkey", "o_totalprice")
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return o.select("o_custkey", "o_orderkey", F.row_number().over(w).cast("bigint").alias("place")).where("place <= 3")


@query("select l_orderkey from lineitem where l_quantity > 45 union select o_orderkey from orders where o_totalprice > 400000")
def union_distinct(spark, sf):
    return a.star(spark, sf, "lineitem").where("l_quantity > 45").select("l_orderkey").union(a.star(spark, sf, "orders").where("o_totalprice > 400000").select("o_orderkey")).distinct()


@query("select l_orderkey, count(*) n from (select l_orderkey from lineitem where l_quantity > 48 union all select l_orderkey + 1000000 from lineitem where l_quantity < 3) group by 1")
def union_all_offset(spark, sf):
    line = a.star(spark, sf, "lineitem", "l_orderkey", "l_quantity")
    return line.where("l_quantity > 48").select("l_orderkey").unionAll(line.where("l_quantity < 3").select((F.col("l_orderkey") + 1000000).alias("l_orderkey"))).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderkey from orders where o_orderdate = (select max(o_orderdate) from orders)")
def newest_rows(spark, sf):
    o = a.star(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return o.join(F.broadcast(o.agg(F.max("o_orderdate").alias("o_orderdate"))), "o_orderdate", "left_semi").select("o_orderkey")


@query("select l_suppkey, round(quantile_cont(l_quantity, 0.9), 6) p90, round(median(l_extendedprice), 6) med, arg_max(l_orderkey, row(l_extendedprice, -l_orderkey)) top_order from lineitem group by 1")
def quantiles_and_arg_max(spark, sf):
    line = a.star(spark, sf, "lineitem")
    return line.groupBy("l_suppkey").agg(_r(F.percentile("l_quantity", 0.9)).alias("p90"), _r(F.median("l_extendedprice")).alias("med"), compat.arg_max(F.col("l_orderkey"), F.col("l_extendedprice"), F.col("l_orderkey"), F.lit(True)).alias("top_order"))


@query("select event_type, count(*) n, count(value) n_value, count(*) filter (where value > 50) n_high, round(avg(value) filter (where value > 50), 6) mean_high, count(distinct user_id) users from events group by 1 having count(*) >= 10")
def filtered_aggregates(spark, sf):
    e = a.star(spark, sf, "events")
    high = F.col("value") > 50
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_value"), F.count_if(high).alias("n_high"), _r(F.avg(F.when(high, F.col("value")))).alias("mean_high"), F.count_distinct("user_id").alias("users")).where("n >= 10")


@query("select cast(ts as date) as day, count(*) n, round(avg(value), 6) mean, max(value) as max from events group by 1")
def tumbling_days(spark, sf):
    from ..streaming import pages as streams

    w = streams.windowed(a.star(spark, sf, "events", "ts", "value"), "ts", "value")
    return w.select(F.to_date("start").alias("day"), "n", _r("mean").alias("mean"), "max")


@query("select event_id, json_extract_string(props, '$.page') page, json_extract_string(props, '$.k') k from events")
def json_fields(spark, sf):
    e = a.star(spark, sf, "events", "event_id", "props")
    return e.select("event_id", F.get_json_object("props", "$.page").alias("page"), F.get_json_object("props", "$.k").alias("k"))


@query("select s_suppkey, regexp_replace(s_name, '[^A-Za-z0-9._-]', '_', 'g') as id, lower(trim(s_name)) low, lpad(s_suppkey::varchar, 6, '0') padded, round(s_acctbal * 25.4, 4) mm, 'k=' || s_suppkey || '|qc1=pass' meta, 'pass' qc1, 'NA' qc2 from supplier")
def text_functions(spark, sf):
    s = a.star(spark, sf, "supplier")
    meta = F.concat(F.lit("k="), F.col("s_suppkey").cast("string"), F.lit("|qc1=pass"))
    return s.select("s_suppkey", text.safe_id(F.col("s_name")).alias("id"), F.lower(F.trim("s_name")).alias("low"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("padded"), F.round(F.col("s_acctbal") * 25.4, 4).alias("mm"), meta.alias("meta"), text.meta_value(meta, "qc1").alias("qc1"), text.meta_value(meta, "qc2").alias("qc2"))


@query(V("pages") + "select file_id, (file_id % 10 + 1995)::int year_start, 'Supplier' descriptor, file_id::varchar section_id from pages")
def page_name_parts(spark, sf):
    p = text.page_name_parts(text.without_suffix(F.col("file_name")))
    return a.pages(spark, sf).select("file_id", p["year_start"].alias("year_start"), p["descriptor"].alias("descriptor"), p["section_id"].alias("section_id"))


@query("select o_orderkey, try_cast(y || '-' || m || '-' || d as date) as day from (select o_orderkey, 1900 + o_orderkey % 100 y, 1 + o_orderkey % 12 m, 1 + o_orderkey % 31 d from orders)")
def valid_dates(spark, sf):
    k = F.col("o_orderkey")
    return a.star(spark, sf, "orders", "o_orderkey").select("o_orderkey", F.try_to_date(F.concat_ws("-", 1900 + k % 100, 1 + k % 12, 1 + k % 31), "y-M-d").alias("day"))


@query("select o_orderkey, case when q1 = 'pass' then 1 when q1 = 'fail' and q2 = 'pass' then 2 when q1 = 'review' then 3 when q1 = 'fail' and q2 = 'indeterminate' then 4 else 5 end rank, coalesce(q1 = 'pass' or q2 in ('pass', 'indeterminate'), false) trusted from (select o_orderkey, case o_orderkey % 4 when 0 then 'pass' when 1 then 'review' when 2 then 'fail' end q1, case o_orderkey % 5 when 0 then 'pass' when 1 then 'indeterminate' when 2 then 'fail' end q2 from orders)")
def verdict_ladder(spark, sf):
    k = F.col("o_orderkey")
    q1 = F.when(k % 4 == 0, "pass").when(k % 4 == 1, "review").when(k % 4 == 2, "fail")
    q2 = F.when(k % 5 == 0, "pass").when(k % 5 == 1, "indeterminate").when(k % 5 == 2, "fail")
    return a.star(spark, sf, "orders", "o_orderkey").select("o_orderkey", qc.trust_rank(q1, q2).alias("rank"), qc.trusted(q1, q2).alias("trusted"))


_EVENTS = [("1994-01-02", "flood", "before the record"), ("1996-03-04", "flood", "spring"), ("1999-08-15", "drought", "summer")]


@query(V("obs").rstrip() + _DAILY + """, t as (select year::int as year, sum(mean_mm) total from nat group by 1), e as (select * from (values (date '1994-01-02', 'flood', 'before the record'), (date '1996-03-04', 'flood', 'spring'), (date '1999-08-15', 'drought', 'summer')) v(event_date, kind, label))
    select event_date, year(event_date)::int as year, kind, label, round(total, 4) annual_total_mm from e left join t on t.year = year(event_date) where year(event_date) between (select min(year) from t) and (select max(year) from t)""")
def events_of_the_record(spark, sf):
    years = analysis.annual(analysis.daily_national(a.observations(spark, sf)))
    return analysis.events_in_range(years, _EVENTS).withColumn("annual_total_mm", _r("annual_total_mm", 4))


@query("select o_orderkey, o_totalprice from orders where o_totalprice between 1000 and 20000 and o_orderpriority = '1-URGENT'")
def bound_parameters(spark, sf):
    o = a.star(spark, sf, "orders")
    return spark.sql("select o_orderkey, o_totalprice from {o} where o_totalprice between :low and :high and o_orderpriority = :priority", args={"low": 1000, "high": 20000, "priority": "1-URGENT"}, o=o)


@query("select p_partkey, p_name from part where p_name like 'large%' or p_type like '%CONOM%'")
def name_patterns(spark, sf):
    p = a.star(spark, sf, "part")
    return p.where(F.col("p_name").like("large%") | F.col("p_type").contains("CONOM")).select("p_partkey", "p_name")


@query(V("vec") + "select station_file_id || '::' || year rr_vector_id, round(list_sum(raw), 4) total from vec")
def vectors_through_json(spark, sf):
    """Vectors at the compatibility edge: written as JSON text and read back."""
    v = vectors.station_years(a.monthly(spark, sf), a.stations(spark, sf)).select("rr_vector_id", F.to_json("raw_vector").alias("raw_vector_json"))
    back = F.from_json("raw_vector_json", "array<double>")
    return v.select("rr_vector_id", F.round(F.aggregate(back, F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query("""select k file_id, 1::int as month, arg_max(n, t) n, max(t) updated_at from (select s_suppkey k, s_nationkey::double n, 'a' t from supplier union all select s_suppkey, s_nationkey + 100.0, 'b' from supplier where s_suppkey % 3 = 0
    union all select s_suppkey, s_nationkey + 200.0, 'c' from supplier where s_suppkey % 6 = 0) group by 1""")
def upsert(spark, sf):
    """Features replaced by key: the newest of the new rows win, the others stay."""
    row = lambda add, at: a.star(spark, sf, "supplier").select(F.col("s_suppkey").cast("bigint").alias("file_id"), F.lit(1).alias("day_of_month"), F.lit(1).alias("month"), (F.col("s_nationkey") + add).cast("double").alias("n"), F.lit(at).alias("updated_at"))
    new = row(100.0, "b").where("file_id % 3 = 0").unionByName(row(200.0, "c").where("file_id % 6 = 0"))
    return registry.upsert_features(row(0.0, "a"), new).select("file_id", "month", "n", "updated_at")


@query(_SPAN + ", o as (select distinct (o_orderdate::date - a)::int i from orders, s where o_orderkey % 400 <> 3), f as (select unnest(range(d + 1)) i from s) select i::bigint frame from f where i not in (select i from o where o.i % 11 <> 5)")
def missing_frames(spark, sf):
    """A frame a day: those of which no order tells that they exist. Every eleventh day's are left out."""
    start, end = _span(spark, sf)
    o = a.star(spark, sf, "orders", "o_orderkey", "o_orderdate").where("o_orderkey % 400 <> 3").select(F.datediff(F.col("o_orderdate").cast("date"), F.lit(start)).cast("bigint").alias("frame"))
    existing = o.where("frame % 11 <> 5").select(F.format_string("frame_%07d.png", "frame").alias("name"))
    return frames.missing(frames.plan(spark, start, end, 1), existing).select("frame")


@query("select round(list_sort(list(l_quantity))[ceil(0.98 * count(*))::int], 6) ceiling from lineitem where l_quantity is not null")
def colour_ceiling(spark, sf):
    return lookups.colour_ceiling(a.star(spark, sf, "lineitem", "l_quantity"), "l_quantity").select(_r("ceiling").alias("ceiling"))


@query("select p_brand, p_size, count(*) n from part group by 1, 2 having count(*) > 1 union all select 'total', null, count(*) from part")
def duplicate_keys(spark, sf):
    """Keys that occur more than once, and the rows in all: a uniqueness check."""
    p = a.star(spark, sf, "part")
    twice = p.groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.unionByName(p.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("p_brand"), F.lit(None).cast("int").alias("p_size"), "n"))


@query("select o_orderkey, coalesce(x = y and y = z, false) same from (select o_orderkey, o_custkey % 3 x, o_orderkey % 3 y, case when o_orderkey % 7 <> 0 then o_orderkey // 4 % 3 end z from orders)")
def all_equal(spark, sf):
    k = F.col("o_orderkey")
    three = F.array(F.col("o_custkey") % 3, k % 3, F.when(k % 7 != 0, F.floor(k / 4) % 3))
    return a.star(spark, sf, "orders", "o_orderkey", "o_custkey").select("o_orderkey", arrays.all_equal(three).alias("same"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25 offset 50")
def part_by_offset(spark, sf):
    """The third part of 25 orders by price: the limit is the feature."""
    o = a.star(spark, sf, "orders", "o_orderkey", "o_totalprice").withColumn("down", -F.col("o_totalprice"))
    return compat.part_of(o, ("down", "o_orderkey"), 25, 50).drop("down")


@query("""with f as (select *, (row_number() over w = 1 or lag(event_type) over w is distinct from event_type)::int f from events window w as (partition by user_id order by ts, event_id)),
    r as (select *, sum(f) over (partition by user_id order by ts, event_id rows unbounded preceding) run from f)
    select user_id, run::bigint run, any_value(event_type) event_type, count(*) n, min(event_id) least_event_id from r group by user_id, run""")
def event_runs(spark, sf):
    """Stretches of a user's events of one type, cut where the type changes."""
    e = compat.runs(a.star(spark, sf, "events", "event_id", "ts", "user_id", "event_type"), ("user_id",), ("ts", "event_id"), "event_type")
    return e.groupBy("user_id", "run").agg(F.first("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("least_event_id"))


@query("""with c as (select l_linenumber, greatest(list_sort(list(l_extendedprice))[ceil(0.98 * count(*))::int], 1e-6) top from lineitem where l_extendedprice is not null group by 1)
    select l_orderkey, l_linenumber, round(sqrt(least(greatest(l_extendedprice, 0.0), top) / top), 6) shade from lineitem join c using (l_linenumber)""")
def colour_positions(spark, sf):
    """Prices on a colour scale that ends at the 98th percentile of their line number."""
    rows = a.star(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    tops = rows.where("l_extendedprice is not null").groupBy("l_linenumber").agg(F.percentile_approx("l_extendedprice", 0.98, 1_000_000).alias("top"))
    return rows.join(tops, "l_linenumber").select("l_orderkey", "l_linenumber", _r(lookups.colour_position(F.col("l_extendedprice"), F.col("top"))).alias("shade"))


@query(V("pmd") + "select file_id, month::int as month, array_to_string(list_sort(list(distinct day_of_month)), ',') as days_held, count(distinct day_of_month) n from pmd group by file_id, month")
def days_of_month(spark, sf):
    d = consensus.days_of_month(a.member_days(spark, sf))
    return d.select("file_id", F.col("month").cast("int").alias("month"), F.array_join(F.col("days").cast("array<string>"), ",").alias("days_held"), F.size("days").cast("bigint").alias("n"))


@query("select s_suppkey, s_name, case when s_suppkey % 3 = 0 then s_nationkey + 100 end::bigint place, case when s_suppkey % 3 = 0 then 'exact' end kind from supplier")
def places_reset(spark, sf):
    """A new assignment: each page's old place goes, and only the pages that it names get another."""
    s = a.star(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("bigint").alias("place"), F.lit("approximate").alias("kind"))
    new = s.where("s_suppkey % 3 = 0").select("s_suppkey", (F.col("place") + 100).alias("place"), F.lit("exact").alias("kind"))
    return assign.reassigned(s, new, "s_suppkey", "place", "kind")


# --- exact ranks, samples and counts of any size -----------------------------------------------------------------------------------------

_SHARES = (0.0, 0.01, 0.25, 0.5, 0.98, 0.99, 1.0)


@query(" union all ".join(f"select {s}::double as share, round(quantile_cont(l_extendedprice, {s}), 6) as between_ranks, round(quantile_disc(l_extendedprice, {s}), 6) as nearest_rank from lineitem" for s in _SHARES))
def exact_quantiles(spark, sf):
    """Ranks of all prices, by counting alone."""
    prices = a.star(spark, sf, "lineitem", "l_extendedprice")
    both = zip(_SHARES, ranks.quantiles(prices, "l_extendedprice", list(_SHARES)), ranks.quantiles(prices, "l_extendedprice", list(_SHARES), nearest=True))
    return spark.createDataFrame(list(both), "share double, between_ranks double, nearest_rank double").select("share", _r("between_ranks").alias("between_ranks"), _r("nearest_rank").alias("nearest_rank"))


_LANE = "('0x' || substr(md5(file_id || '|' || month || '|' || day_of_month || '|0'), 1, 13))::bigint"


@query(SQL["training_rows"].replace("select p.file_id, p.month::int as month", ", tr as (select p.file_id, p.month::int as month", 1) + f") select * from tr qualify row_number() over (order by {_LANE}, file_id, month, day_of_month) <= 1000")
def training_sample(spark, sf):
    """A thousand of the training rows, the same in every run and for any partitioning."""
    from ..operators import secondary

    days = stored.stored(consensus.daily(a.member_days(spark, sf)), "daily_consensus")
    stats = regional.daily_stats(a.station_metadata(spark, sf), days, _status(spark, sf, days), 1, 1)
    return secondary.training_rows(stats, _status(spark, sf, days), 1, max_rows=1000).select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"))


@query("""select l_orderkey, l_linenumber, l_partkey from lineitem qualify row_number() over (order by ('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|7'), 1, 13))::bigint, l_orderkey, l_linenumber, l_partkey) <= 5000""")
def keyed_sample(spark, sf):
    """Five thousand line items with the least keyed hashes."""
    return sampling.bottom_k(a.star(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], 5000, seed=7)


@query(V("obs") + """, ys as (select distinct year::int y from obs)
    select a.y first_year, b.y last_year, count(distinct station_id) n_stations from ys a join ys b on b.y >= a.y join obs on year between a.y and b.y group by all""")
def stations_by_span(spark, sf):
    """Different stations of every span of years, from bitmaps a year."""
    obs = a.observations(spark, sf)
    bitmaps = stored.stored(analysis.station_bitmaps(obs, numbering.dense(obs, "station_id")), "station_bitmaps")
    years = bitmaps.select(F.col("year").cast("int").alias("first_year")).distinct()
    last = bitmaps.agg(F.max("year").cast("int")).first()[0]
    spans = years.withColumn("last_year", F.explode(F.sequence("first_year", F.lit(last)))).join(years.withColumnRenamed("first_year", "last_year"), "last_year", "left_semi")
    return analysis.stations_of_spans(bitmaps, spans)


# --- batches, ids that stay, sessions side by side ------------------------------------------------------------------------------------------


def _scratch(spark, name: str) -> str:
    """A folder of the session's shared one, which goes when the application ends."""
    folder = f"{stored.shared_dir(spark)}/pluvio-{name}-{uuid.uuid4().hex}"
    stored.Kept(spark, folder)
    return folder


@query(SQL["monthly_check"])
def incremental_check(spark, sf):
    """The first check in three batches: half of the pages with every 97th cell wrong, the other half, then the wrong cells mended."""
    root, values = _scratch(spark, "check"), a.member_days(spark, sf)
    # every batch reads these, as the chain's tables
    rr, matched = stored.stored(a.monthly(spark, sf), "monthly_rainfall"), stored.stored(qc1.eligible(_planted(spark, sf), 1), "matched")
    keys = stored.stored(rr.select("station_file_id", "year").distinct().withColumn("rr_vector_id", F.concat_ws("::", "station_file_id", "year")), "station_years")
    numbered = values.withColumn("ensemble_member", (F.row_number().over(Window.partitionBy("file_id", "month", "day_of_month").orderBy("ensemble_member", "rainfall", "is_missing")) - 1).cast("tinyint"))
    numbered = stored.stored(numbered, "member_days")
    wrong = F.pmod(F.xxhash64(*incremental.CELL), F.lit(97)) == 0
    first = F.col("file_id") % 2 == 0
    batches = (
        numbered.where(first).withColumn("rainfall", F.when(wrong, 99.0).otherwise(F.col("rainfall"))), numbered.where(~first), numbered.where(first & wrong),
    )
    for n, batch in enumerate(batches):
        incremental.apply(batch, root, n, matched, keys, rr, 1, 3.0)
    r = incremental.verdicts(spark, root)
    return r.select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), "reason", "qc_flag", "qc_score", _r("monthly_total").alias("monthly_total"), _r("rr_total").alias("rr_total"))


@query(V("pages") + "select file_name as name, row_number() over (order by file_name) id from pages")
def page_ids_in_parts(spark, sf):
    """Page ids given in three parts, the second of which is given twice: as if all had come at once."""
    names, root = a.pages(spark, sf).select(F.col("file_name").alias("name")), _scratch(spark, "ids") + "/ids"
    for lower, upper in (("", "DRain_1995"), ("DRain_1995", "DRain_1998"), ("DRain_1995", "DRain_1998"), ("DRain_1995", "~")):
        numbering.assign(names.where((F.col("name") >= lower) & (F.col("name") < upper)), "name", root)
    return numbering.known(spark, root, "name")


@query(V("cons") + """select s.s::bigint qc_session_id, file_id, month::int as month, day_of_month::int day_of_month, case when s.s = 1 then 0.5 else 0.75 end::double final_score from cons, range(1, 4) s(s) where s.s <> 2 and file_id % 5 = s.s""")
def sessions_side_by_side(spark, sf):
    """Three sessions are opened before any has written; the second one's rows are staged and never published, the third is run again."""
    root, days = _scratch(spark, "sessions"), stored.stored(consensus.daily(a.member_days(spark, sf)), "daily_consensus")
    numbers = [sessions.claim(spark, root, "daily_qc_status") for _ in range(3)]
    rows = lambda n, score: days.where(F.col("file_id") % 5 == n).select(F.lit(n).alias("qc_session_id"), "file_id", "month", "day_of_month", F.lit(score).alias("final_score"))
    for n, score, shown in ((numbers[2], 0.25, True), (numbers[1], 1.0, False), (numbers[0], 0.5, True), (numbers[2], 0.75, True)):
        folder = sessions.stage(rows(n, score), root, "daily_qc_status", n)
        if shown:
            sessions.publish(spark, root, "daily_qc_status", n, folder)
    out = sessions.read(spark, root, "daily_qc_status")
    return out.select("qc_session_id", "file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), "final_score")


# --- tables, sessions and texts as they are stored ---------------------------------------------------------------------------------------


_ROUND_TRIP = """, trip as (select replace(l.file_name, '.json', '') station_id, l.matched_location_name location_name, l.matched_latitude lat, l.matched_longitude lon, b.matched_year::int as y, b.month::int m, b.day_of_month::int d,
      printf('%.1f', b.consensus_value * 25.4)::double value_mm, coalesce(q1 = 'pass' or q2 in ('pass', 'indeterminate'), false) passed
      from best b join s using (matched_year, group_key) join meta l on l.file_id = s.lead)"""


@query(V("cons", "meta").rstrip() + _EXPORT.rstrip() + _LINES.rstrip() + _ROUND_TRIP + """, obs as (select *, make_date(y, m, d) obs_date, y as year from trip)""" + _DAILY.rstrip() + """,
    named as (select obs_date, location_name from good where ok and location_name is not null qualify row_number() over (partition by obs_date order by value_mm desc, station_id) = 1)
    select nat.obs_date, nat.year::int as year, n_stations_reporting, round(mean_mm, 6) mean_mm, max_mm, p.station_id argmax_station_id, named.location_name argmax_location, n_wet, n_ge10, n_ge25, n_ge50 from nat left join peak p using (obs_date) left join named using (obs_date)""")
def analysis_build(spark, sf):
    """The exchange files built into the analysis set, a partition a year; one year is built again and nothing else changes."""
    root = _scratch(spark, "analysis")
    sef.write(_exchange(spark, sf), f"{root}/sef")
    ingest.sef_analysis(spark, f"{root}/sef", f"{root}/out")
    ingest.sef_analysis(spark, f"{root}/sef", f"{root}/out", 1996)
    d = tables.read(spark, f"{root}/out", "daily_national")
    return d.withColumn("mean_mm", _r("mean_mm"))


@query(V("cons", "meta").rstrip() + _EXPORT.rstrip() + _LINES.rstrip() + _ROUND_TRIP + "select y as year, m as month, case when m = 2 and d = 2 then 30 else d end as day, station_id, location_name, round(lat, 4)::double latitude, round(lon, 4)::double longitude, value_mm as value, not passed is_error from trip")
def animation_days(spark, sf):
    """Every year's files as the animation reads them: the second of February stands in the files as the thirtieth, and stays."""
    root = _scratch(spark, "animation")
    sef.write(_exchange(spark, sf).withColumn("content", F.regexp_replace("content", r"(?m)^(\d{4})\t2\t2\t", "$1\t2\t30\t")), root)
    out = None
    for year in tables.years(spark, f"{root}/tsv"):
        days = sef.days_of_year(spark, root, year).withColumn("year", F.lit(year))
        out = days if out is None else out.unionByName(days)
    return out


@query(V("qcr", "pages").rstrip() + _RESULTS + """, two as (select file_id, month, day_of_month, case when ok then 'pass' else 'fail' end f, case when ok then 1.0 else 0.0 end s from judged
      union all select file_id, month, day_of_month, case when file_id % 6 = 0 then 'review' else 'pass' end, 0.96 from judged),
    rolled as (select case when max((f = 'fail')::int) = 1 then 'fail' when max((f = 'review')::int) = 1 then 'review' else 'pass' end final_flag, case when max((f <> 'pass')::int) = 0 and avg(s) >= 0.95 then 1 else 0 end good from two group by file_id, month, day_of_month)
    select 1::bigint qc_session_id, 'completed' status, null::varchar as message, true finished, '{"tolerance": 3.0}' config_json, final_flag, count(*) n, sum(good)::bigint promoted from rolled group by final_flag
    union all select 2, 'failed', 'stopped', true, '{}', null, null, null union all select 3, 'running', null, false, '{"parent": 1}', null, null, null""")
def check_sessions(spark, sf):
    """Three sessions: the first one's rows are all wrong at first and inserted again, the second fails before it is consolidated, the third is open."""
    root = _scratch(spark, "registry")
    first = stored.stored(_check(spark, sf).drop("qc_session_id"), "first_check")
    rows = stored.stored(first.unionByName(first.withColumn("check_name", F.lit("other")).withColumn("qc_flag", F.when(F.col("file_id") % 6 == 0, "review").otherwise("pass")).withColumn("qc_score", F.lit(0.96))), "results")
    one, two = registry.start(spark, root, {"tolerance": 3.0}), registry.start(spark, root, {})
    registry.start(spark, root, {"parent": one}, parent=one)
    registry.insert_results(rows.withColumn("qc_flag", F.lit("fail")), root, one)
    registry.insert_results(rows, root, two)
    registry.complete(spark, root, two, "failed", "stopped")
    registry.insert_results(rows, root, one)
    registry.consolidate(spark, root, one)
    registry.complete(spark, root, one)
    told = tables.read(spark, root, "qc_sessions").select("qc_session_id", "status", "message", F.col("completed_at").isNotNull().alias("finished"), "config_json")
    return told.join(registry.flag_counts(tables.read(spark, root, "daily_qc_status")), "qc_session_id", "left")


@query(V("cons") + "select file_id, month::int as month, day_of_month::int day_of_month, round(consensus_value, 6) consensus_value, 10::bigint metadata_session_id, 3::bigint qc_session_id from cons where file_id % 3 = 1")
def newest_merged_file(spark, sf):
    """Neighbour tables of four pairs of sessions, three of them merged into files: the newest of these is read, by number and not by name."""
    root, days = _scratch(spark, "merged"), stored.stored(consensus.daily(a.member_days(spark, sf)), "daily_consensus")
    rows = lambda part, meta, qc: tables.conform(days.where(F.col("file_id") % 3 == part).withColumn("metadata_session_id", F.lit(meta)).withColumn("qc_session_id", F.lit(qc)), "regional_daily_stats")
    tables.write(rows(0, 1, 1), root, "regional_daily_stats")
    for part, meta, check in ((0, 2, 9), (1, 10, 3), (2, 10, 1)):
        rows(part, meta, check).write.parquet(f"{root}/regional_daily_stats/merged/session_meta{meta}_qc{check}.parquet")
    d = tables.preferred(spark, root, "regional_daily_stats")
    return d.select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), _r("consensus_value").alias("consensus_value"), "metadata_session_id", "qc_session_id")


@query(V("cons") + "select month::int as month, 'NA' secondary_flag, count(*) n, round(sum(consensus_value), 4) total from cons group by 1")
def absent_second_check(spark, sf):
    """Days beside a second check that was never run: its table is absent and counts as one without rows."""
    days = consensus.daily(a.member_days(spark, sf))
    second = tables.read_or_empty(spark, _scratch(spark, "absent"), "secondary_qc_status").select("file_id", "month", "day_of_month", "secondary_flag")
    flag = F.coalesce("secondary_flag", F.lit("NA"))
    return days.join(second, ["file_id", "month", "day_of_month"], "left").groupBy(F.col("month").cast("int").alias("month"), flag.alias("secondary_flag")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("consensus_value"), 4).alias("total"))


@query(V("pmd") + "select file_id, month::int as month, count(*) n, round(coalesce(sum(rainfall), 0), 4) total, sum(case when file_id % 2 = 0 then is_missing else 0 end)::bigint missing, file_id % 2 = 0 is_new from pmd group by file_id, month")
def tables_of_two_ages(spark, sf):
    """Daily values in two tables that are read as one list of files; the older one, of odd pages, was written without ``is_missing``.

    A table that is there is not overwritten unasked, and one that is overwritten is replaced."""
    root, days = _scratch(spark, "ages"), stored.stored(a.member_days(spark, sf), "member_days")
    new, old = days.where(F.col("file_id") % 2 == 0), days.where(F.col("file_id") % 2 == 1)
    tables.write(old, f"{root}/new", "ensemble_daily_values", cluster="file_id")
    try:
        tables.write(new, f"{root}/new", "ensemble_daily_values")
        raise AssertionError("a table was overwritten unasked")
    except AnalysisException:
        tables.write(new, f"{root}/new", "ensemble_daily_values", "overwrite", cluster="file_id")
    old.drop("is_missing").write.parquet(f"{root}/old/ensemble_daily_values")
    d = tables.read_files(spark, "ensemble_daily_values", *(f"{root}/{age}/ensemble_daily_values" for age in ("new", "old")))
    return d.groupBy("file_id", F.col("month").cast("int").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("rainfall"), F.lit(0.0)), 4).alias("total"), F.sum(F.coalesce("is_missing", F.lit(0))).alias("missing"), (F.max("is_missing").isNotNull()).alias("is_new"))


@query("""with t as (select l_returnflag, l_linenumber, case l_linenumber when 1 then l_quantity::varchar when 2 then ' ' || l_quantity || ' ' when 3 then 'NA' when 4 then ' na' when 5 then '' when 6 then 'about ' || l_quantity else 'nan' end v from lineitem),
    u as (select *, case when trim(v) <> '' and upper(trim(v)) <> 'NA' then try_cast(trim(v) as double) end x from t)
    select l_returnflag, l_linenumber::int l_linenumber, count(*) n, count(x) n_numbers, sum((x is null or isnan(x))::int)::bigint n_missing, round(sum(case when x is null or isnan(x) then 0 else x end), 2) total, max(case when x is null or isnan(x) then 'NA' else printf('%.1f', x) end) greatest_text from u group by 1, 2""")
def lenient_numbers(spark, sf):
    """Quantities as hands write them: plain, with blanks, NA, nothing, words, not a number."""
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("string")
    told = F.when(n == 1, q).when(n == 2, F.concat(F.lit(" "), q, F.lit(" "))).when(n == 3, "NA").when(n == 4, " na").when(n == 5, "").when(n == 6, F.concat(F.lit("about "), q)).otherwise("nan")
    t = a.star(spark, sf, "lineitem", "l_returnflag", "l_linenumber", "l_quantity").withColumn("x", text.lenient_double(told))
    return t.groupBy("l_returnflag", n.cast("int").alias("l_linenumber")).agg(
        F.count(F.lit(1)).alias("n"), F.count("x").alias("n_numbers"), F.sum(text.is_missing(F.col("x")).cast("long")).alias("n_missing"), F.round(F.sum(text.finite_or_zero(F.col("x"))), 2).alias("total"), F.max(text.decimals(F.col("x"), 1)).alias("greatest_text"))


@query(V("pmd", "pages").rstrip() + _PAGE_FILES + """, first as (select *, row_number() over (order by y, id || '.json') place from texts qualify place <= 100)
    select 'page' kind, row_number() over (order by place) file_id, id as name from first where old % 11 <> 0 union all select 'error', null, id from first where old % 11 = 0""")
def capped_page_ingest(spark, sf):
    """An ingest that is told to take a hundred files takes the first by path, those that fail included."""
    root = _scratch(spark, "capped")
    files.write(_page_texts(spark, sf), f"{root}/json", ".json")
    ingest.pages(spark, f"{root}/json", f"{root}/tables", max_files=100)
    name = text.without_suffix(F.element_at(F.split("source_path", "/"), -1))
    good = tables.read(spark, f"{root}/tables", "ensemble_files").select(F.lit("page").alias("kind"), "file_id", F.col("file_name").alias("name"))
    return good.unionByName(tables.read(spark, f"{root}/tables", "ensemble_ingestion_file_errors").select(F.lit("error").alias("kind"), F.lit(None).cast("bigint").alias("file_id"), name.alias("name")))


@query(V("vec") + "select station_file_id || '::' || year rr_vector_id, '[' || array_to_string([x::varchar for x in raw], ', ') || ']' raw_vector_json from vec")
def vectors_as_text(spark, sf):
    """Vectors as JSON text, number by number as other programs of the chain write them."""
    return vectors.station_years(a.monthly(spark, sf), a.stations(spark, sf)).select("rr_vector_id", text.json_list(F.col("raw_vector")).alias("raw_vector_json"))


@query(V("qcr", "pages").rstrip() + _RESULTS + """select file_id, month, day_of_month, '{' || case when reason = 'exact_monthly_compare' then '"absolute_difference": ' || abs(monthly_total - rainfall_in)::varchar || ', ' else '' end || '"monthly_total_consensus": ' || monthly_total::varchar
      || ', "reason": "' || reason || '", "rr_monthly_total": ' || coalesce(case when reason = 'exact_monthly_compare' then rainfall_in::varchar end, 'null') || ', "tolerance": 3.0}' details_json from judged""")
def check_details(spark, sf):
    """What the first check notes beside each verdict."""
    return _check(spark, sf).select("file_id", F.col("month").cast("int").alias("month"), F.col("day_of_month").cast("int").alias("day_of_month"), "details_json")
