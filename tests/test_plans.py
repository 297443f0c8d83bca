"""What the optimiser makes of the operators: filters in the scan, pruned columns and partitions, ranks cut before the shuffle."""

import re

from pyspark.sql import functions as F

from pluvio.functions import compat
from pluvio.operators import analysis, consensus, export, qc1, regional, vectors
from pluvio.plans import adapters as a
from pluvio.plans import catalog
from pluvio.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_page_range_reaches_the_scan(spark, tmp_path):
    tables.write(a.member_days(spark, SF), str(tmp_path), "ensemble_daily_values", cluster="file_id")
    t = tables.read(spark, str(tmp_path), "ensemble_daily_values")
    p = plan(consensus.daily(t, 10, 20))
    assert "GreaterThanOrEqual(file_id,10)" in p and "LessThanOrEqual(file_id,20)" in p
    assert re.search(r"ReadSchema: struct<file_id:bigint,day_of_month:tinyint,month:tinyint,rainfall:double>", p)
    assert p.count("\nExchange") <= 2 * 1 + 1


def test_years_prune_partitions(spark, tmp_path):
    obs = tables.conform(a.observations(spark, SF), "observations")
    obs.write.partitionBy("year").parquet(str(tmp_path / "o"))
    p = plan(analysis.intensity(spark.read.parquet(str(tmp_path / "o")).where("year = 1996")))
    assert "PartitionFilters" in p and re.search(r"ReadSchema: struct<value_mm:double,passed:boolean>", p)


def test_ranks_are_cut_before_the_shuffle(spark):
    o = a.star(spark, SF, "orders", "o_custkey", "o_orderkey")
    assert "WindowGroupLimit" in plan(compat.latest(o, ["o_custkey"], F.desc("o_orderkey")))
    assert "WindowGroupLimit" in plan(export.merged_days(a.metadata(spark, SF).join(consensus.daily(a.member_days(spark, SF)), "file_id").withColumn("group_key", F.lit("g")).withColumn("qc1_flag", F.lit("pass")).withColumn("qc2_flag", F.lit("NA"))))


def test_neighbours_need_no_cartesian_product(spark):
    m = regional.located(a.station_metadata(spark, SF), 1)
    p = plan(regional.station_pairs(m, m))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "Python" not in p


def test_a_median_of_a_day_needs_no_buffer_a_day(spark):
    p = plan(consensus.daily(a.member_days(spark, SF)))
    assert "ObjectHashAggregate" not in p and "SortAggregate" not in p and p.count("\nExchange") <= 1


def test_the_first_check_makes_its_days_once(spark):
    days = consensus.daily(a.member_days(spark, SF))
    matched = spark.createDataFrame([(1, "st/1::1995")], "file_id long, rr_vector_id string")
    keys = spark.createDataFrame([("st/1::1995", "st/1", 1995)], "rr_vector_id string, station_file_id string, year int")
    rain = spark.createDataFrame([("st/1", 1995, 1, 2.0)], "station_file_id string, year int, month int, rainfall_in double")
    p = qc1.results(days, matched, keys, rain, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in x for x in p.splitlines()) == 1


def test_a_quantile_reads_a_table(spark):
    p = catalog.QUERIES["secondary_calibration"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in p


def test_an_incremental_batch_reads_the_chains_tables(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(catalog.incremental, "apply", lambda values, root, n, *given: seen.extend(given[:3]))
    monkeypatch.setattr(catalog.incremental, "verdicts", lambda spark, root: spark.createDataFrame([], catalog.incremental.VERDICTS))
    catalog.QUERIES["incremental_check"](spark, SF)
    assert len(seen) == 9 and not any("l_shipdate" in d._jdf.queryExecution().optimizedPlan().toString() for d in seen)


def test_a_check_is_inserted_from_a_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(catalog.stored, "stored", lambda df, name, keep=catalog.stored.stored: (seen.append((name, df._jdf.queryExecution().optimizedPlan().toString())), keep(df, name))[1])
    catalog.QUERIES["check_sessions"](spark, SF)
    assert seen and not any("l_shipdate" in p for name, p in seen if name == "results")


def test_pages_are_placed_from_stored_vectors(spark):
    p = catalog.QUERIES["page_places"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in p and "l_quantity" not in p


def test_vectors_of_months_need_no_lists_and_no_lambdas(spark):
    totals = spark.createDataFrame([], "file_id long, month int, ensemble_member int, total double, is_missing int")
    monthly = spark.createDataFrame([], "station_file_id string, year int, month int, rainfall_in double")
    files = spark.createDataFrame([], "file_id long, file_name string, descriptor string, section_id string, year_start int, year_end int")
    stations = spark.createDataFrame([], "station_file_id string, location_name string, station_number string, latitude double, longitude double")
    assert "lambda" not in plan(vectors.pages(totals, files).select("file_id", "raw_vector", "monthly_iqr")).lower()
    assert "ObjectHashAggregate" not in plan(vectors.station_years(monthly, stations))
