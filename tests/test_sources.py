"""Files in, tables out, and back."""

import json

import pytest
from pyspark.sql import functions as F

from pluvio.functions import text
from pluvio.operators import export, ingest, registry
from pluvio.plans import catalog
from pluvio.schemas import SCHEMAS
from pluvio.sources import files, monthly_csv, pages_json, sef, tables

MONTHS = monthly_csv.MONTHS


def _csv(values=None, years="1901,1902", bom="﻿", label=None):
    values = values or {}
    lines = [bom + "MILL END,,,,,,,", "Grid,SU 123 456,Lon,-1.5,Lat,51.25,Elev,300.7", "Station,4321", "", f"Year,{years}"]
    lines += [f"{label if label and m == 'March' else m},{values.get(m, '1.0,nan')}" for m in MONTHS]
    return "\n".join([*lines, "Total,24.6,"]) + "\n"


def test_station_tables(spark, tmp_path):
    d = tmp_path / "DATA" / "Glos"
    d.mkdir(parents=True)
    (d / "mill.csv").write_text(_csv({"February": "0.95,", "March": "1.4,n/a"}), encoding="utf-8")
    (d / "short.csv").write_text("a,b\n" * 17)
    (d / "label.csv").write_text(_csv(label="Marsh"))
    (d / "years.csv").write_text(_csv(years="x,y"))
    (d / "number.csv").write_text(_csv({"May": "q,1"}))
    (d / "ERROR_x.csv").write_text("no")
    out = str(tmp_path / "out")
    facts = ingest.monthly_tables(spark, str(tmp_path / "DATA"), out)
    assert facts["status"] == "completed_with_errors" and facts["files_failed"] == 4 and facts["rows"]["stations"] == 1
    s = tables.read(spark, out, "stations").first()
    assert (s.station_file_id, s.location_name, s.longitude, s.latitude, s.elevation_ft, s.station_number, s.source_path) == ("Glos/mill", "MILL END", -1.5, 51.25, 300, "4321", "Glos/mill.csv")
    m = tables.read(spark, out, "monthly_rainfall")
    assert m.count() == 12 and m.where("month = 3").first().rainfall_in == 1.4 and m.where("year = 1902").count() == 0
    assert tables.read(spark, out, "annual_totals").first().total_in == 24.6
    assert tables.read_manifest(spark, f"{out}/_metadata/monthly_ingest.json")["files_found"] == 5
    with pytest.raises(Exception):
        ingest.monthly_tables(spark, str(tmp_path / "DATA"), out)


def _page(**change):
    cell = {"values": [0.1, 0.2, None, " Missing ", 0.12]}
    page = {"Day 1": [cell] * 12, "Day 31": [cell] * 12, "Totals": [cell] * 12}
    page.update(change)
    return json.dumps(page)


def test_pages(spark, tmp_path):
    good = {"DRain_1901-1910_RainNos_Glam_A-1.json": _page(), "b/other.json": _page(Totals=[{"values": [1, 2, 3, 4, 5]}] * 12)}
    bad = {"k.json": _page(Odd=[]), "s.json": _page(Totals=[{"values": [1] * 5}] * 11), "v.json": _page(Totals=[{"values": [1] * 4}] * 12), "n.json": _page(Totals=[{"values": ["x"] * 5}] * 12), "j.json": "{", "l.json": "[1]", "m.json": _page(Totals=[{"v": 1}] * 12)}
    for name, content in (good | bad).items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(content)
    out = str(tmp_path / "out")
    facts = ingest.pages(spark, str(tmp_path / "in"), out)
    assert facts["files_failed"] == len(bad)
    files = {r.file_name: r for r in tables.read(spark, out, "ensemble_files").collect()}
    assert sorted(r.file_id for r in files.values()) == [1, 2]
    f = files["DRain_1901-1910_RainNos_Glam_A-1"]
    assert (f.year_start, f.year_end, f.descriptor, f.section_id, f.num_days) == (1901, 1910, "Glam", "A-1", 2) and files["other"].year_start is None
    d = tables.read(spark, out, "ensemble_daily_values").where((F.col("file_id") == f.file_id) & (F.col("day_of_month") == 31) & (F.col("month") == 12)).orderBy("ensemble_member").collect()
    assert [(r.rainfall, r.is_missing) for r in d] == [(0.1, 0), (0.2, 0), (None, 0), (None, 1), (0.12, 0)]
    assert tables.read(spark, out, "ensemble_monthly_totals").count() == 120


def test_exchange_files_round_trip(spark, tmp_path):
    docs = catalog.QUERIES["exchange_files"](spark, "/root/testdata/sf0.001").cache()
    root = str(tmp_path / "sef")
    sef.write(docs, root)
    assert tables.years(spark, f"{root}/tsv") == sorted({r.year for r in docs.select("year").collect()})
    back = sef.read(spark, root)
    want = export.merged_days(catalog._export_rows(spark, "/root/testdata/sf0.001"))
    assert back.count() == want.count() == docs.agg(F.sum("n_observations")).first()[0]
    a = back.groupBy("year").agg(F.round(F.sum("value_mm"), 0).alias("mm"))
    b = want.groupBy(F.col("matched_year").cast("int").alias("year")).agg(F.sum(text.decimals(F.col("consensus_value") * 25.4, 1).cast("double")).alias("mm"))
    assert a.join(b, "year").where(F.abs(a["mm"] - b["mm"]) > 0.51).count() == 0
    ingest.sef_analysis(spark, root, str(tmp_path / "an"))
    ingest.sef_analysis(spark, root, str(tmp_path / "an"), tables.years(spark, f"{root}/tsv")[0])
    assert spark.read.parquet(str(tmp_path / "an/observations")).count() == back.count()
    assert sef.for_frames(back).where("is_error").count() == back.where("not passed").count()


def test_exchange_reader_skips_what_is_no_observation(spark):
    head = "\n".join(f"{k}\t{v}" for k, v in zip(export.HEADER, ("1.0.0", "X", "NA", "51.0", "-1.0", "NA", "s", "NA", "rr", "sum", "mm", "m")))
    lines = ["\t".join(export.COLUMNS), "1901\t4\t31\t9\t0\t1day\t1.0\tqc1=pass", "1901\t4\t30\t9\t0\t1day\tNA\tqc1=fail|qc2=fail", "1901\t4\t29\t9", "1901\t4\t28\t9\t0\t1day\t2.5\t"]
    df = spark.createDataFrame([(head + "\n" + "\n".join(lines) + "\n",), (head.replace("Lat\t51.0", "Lat\tNA") + "\n" + "\n".join(lines),), ("short",)], "value string")
    got = {r.day: r for r in sef.observations(df).collect()}
    assert set(got) == {28, 30} and got[30].value_mm is None and not got[30].passed and got[28].qc1 == "NA" and got[28].location_name is None


def test_sessions(spark, tmp_path):
    root = str(tmp_path / "qc")
    s1 = registry.start(spark, root, {"tolerance": 0.01})
    s2 = registry.start(spark, root, {})
    assert (s1, s2) == (1, 2)
    rows = spark.createDataFrame([(7, 1, 1, "pass", 1.0), (7, 1, 1, "review", 1.0), (7, 2, 1, "pass", 1.0)], "file_id long, day_of_month int, month int, qc_flag string, qc_score double")
    for _ in range(2):  # a second insert replaces the first
        registry.insert_results(rows, root, s1)
    got = {r.day_of_month: (r.final_flag, r.promoted_good) for r in registry.consolidate(spark, root, s1).collect()}
    assert got == {1: ("review", 0), 2: ("pass", 1)}
    registry.complete(spark, root, s1)
    assert {r.qc_session_id: r.status for r in tables.read(spark, root, "qc_sessions").collect()} == {1: "completed", 2: "running"}
    with pytest.raises(ValueError):
        registry.complete(spark, root, s1, "odd")
    with pytest.raises(Exception, match="unknown flag"):
        registry.insert_results(rows.withColumn("qc_flag", F.lit("odd")), root, s2)
    assert tables.read_or_empty(spark, root, "secondary_qc_status").count() == 0
    old = spark.createDataFrame([(1, 1, 1, 0.5, None, None, None, None, "a", "t1")], SCHEMAS["daily_qc_features"])
    new = spark.createDataFrame([(1, 1, 1, 0.7, None, None, None, None, "b", "t2"), (2, 1, 1, 0.1, None, None, None, None, "b", "t2")], SCHEMAS["daily_qc_features"])
    assert {(r.file_id, r.climatology_median) for r in registry.upsert_features(old, new).collect()} == {(1, 0.7), (2, 0.1)}


def test_streams(spark, tmp_path):
    from pluvio.streaming import pages as streams

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(_page())
    args = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    streams.ingest(spark, *args).awaitTermination()
    (tmp_path / "in" / "b.json").write_text(_page())
    (tmp_path / "in" / "bad.json").write_text("{")
    streams.ingest(spark, *args).awaitTermination()
    out = spark.read.parquet(args[1])
    assert out.count() == 240 and out.select("file_id").distinct().count() == 2


def test_numbers_in_quotes_are_refused(spark):
    import json

    def page(member):
        return json.dumps({"Totals": [{"values": [member, 1, None, " Missing ", 2.5]}] * 12})

    cases = {"plain": 1.5, "quoted": "1.5", "true": True, "word": "none", "nested": [1], "nothing": None}
    df = spark.createDataFrame([(f"/p/{k}.json", k, page(v)) for k, v in cases.items()], "source_path string, file_name string, content string")
    parsed = pages_json.parse(df)
    assert {r.file_name: r.error for r in parsed.collect()} == {k: None if k in ("plain", "true", "nothing") else "a value that is no number" for k in cases}
    t = pages_json.tables(parsed)["ensemble_monthly_totals"]
    first = {r.file_id: (r.total, r.is_missing) for r in t.where("month = 1 and ensemble_member = 1").collect()}
    assert first == {1: (None, 0), 2: (1.5, 0), 3: (1.0, 0)}
    assert {(r.total, r.is_missing) for r in t.where("ensemble_member = 4").collect()} == {(None, 1)}


def test_newest_merged_file_else_the_folder(spark, tmp_path):
    name, root = "regional_daily_stats", str(tmp_path)
    row = lambda meta, qc: tables.conform(spark.createDataFrame([(1, meta, qc)], "file_id long, metadata_session_id long, qc_session_id long"), name)
    row(1, 1).write.parquet(f"{root}/{name}")
    assert tables.preferred(spark, root, name).count() == 1
    for meta, qc in ((2, 9), (10, 3), (10, 1)):
        row(meta, qc).write.parquet(f"{root}/{name}/merged/session_meta{meta}_qc{qc}.parquet")
    got = tables.preferred(spark, root, name).first()
    assert (got.metadata_session_id, got.qc_session_id) == (10, 3)


def test_a_failed_export_leaves_the_old_files(spark, tmp_path):
    root = str(tmp_path / "sef")
    docs = spark.createDataFrame([(1901, "a", "one\n"), (1902, "b", "two\n")], "year int, station_id string, content string")
    sef.write(docs, root)
    with pytest.raises(Exception, match="broken"):
        sef.write(docs.withColumn("content", F.raise_error(F.lit("broken")).cast("string")), root)
    assert (tmp_path / "sef/tsv/1901/a.tsv").read_text() == "one\n"
    sef.write(docs.where("year = 1901").withColumn("station_id", F.lit("c")), root)
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()) == ["sef/tsv/1901/c.tsv", "sef/tsv/1902/b.tsv"]


def test_days_of_an_animation(spark, tmp_path):
    """Days that the calendar lacks stay, the last line of a day counts, files without position or year have no rows."""
    def sheet(name, lat, lines, where="Here"):
        head = ["SEF\t1.0.0", f"ID\t{name}", f"Name\t{where}", f"Lat\t{lat}", "Lon\t1.5", "Alt\tNA", "Source\tNA", "Link\tNA", "Vbl\trr", "Stat\tsum", "Units\tmm", "Meta\t"]
        return "\n".join([*head, "Year\tMonth\tDay\tHour\tMinute\tPeriod\tValue\tMeta", *lines, ""])

    line = lambda m, d, v, meta="qc1=pass|qc2=NA": f"1901\t{m}\t{d}\t9\t0\t1day\t{v}\t{meta}"
    docs = [("a", sheet("A", "50.0", [line(2, 30, 1.0), line(2, 30, 2.0, "qc1=fail|qc2=fail"), line("x", 1, 3.0), line(1, 1, "NA"), "1901\t1\t2"], "NA")), ("b", sheet("B", "NA", [line(1, 1, 1.0)])), ("c", sheet("A", "51.0", [line(1, 1, 4.0)])), ("d", "short")]
    sef.write(spark.createDataFrame([(1901, *d) for d in docs], "year int, station_id string, content string"), str(tmp_path))
    got = sorted((r.month, r.day, r.station_id, r.location_name, r.latitude, r.value, r.is_error) for r in sef.days_of_year(spark, str(tmp_path), 1901).collect())
    assert got == [(1, 1, "A", "Here", 51.0, 4.0, False), (2, 30, "A", None, 50.0, 2.0, True)]
    assert sef.days_of_year(spark, str(tmp_path), 1902).count() == 0
    assert sef.observations(spark.createDataFrame([(d[1],) for d in docs], "value string")).where("month = 2").count() == 0


def test_small_files_share_tasks(spark, tmp_path, monkeypatch):
    """Two hundred files count as eight hundred megabytes; they are read by two tasks, whole, with what is no letter."""
    monkeypatch.setattr(files, "LEAST_PARTS", 2)
    texts = {f"p{i}": f"{i}\r\né\n" * (i % 3 + 1) for i in range(200)}
    (tmp_path / "a").mkdir()
    for n, t in texts.items():
        (tmp_path / "a" / f"{n}.json").write_bytes(t.encode())
    (tmp_path / "a" / "other.txt").write_text("no page")
    found = pages_json.discover(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 2
    assert {r.file_name: r.content for r in found.collect()} == texts
    assert all(r.source_path.startswith("file:/") for r in found.collect())


def test_a_members_type_is_looked_up_once(spark):
    p = pages_json.parse(spark.createDataFrame([("a", "a", "{}")], "source_path string, file_name string, content string"))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("schemaOfVariant") + p.count("schema_of_variant") == 1


def test_first_files_are_known_before_any_is_parsed(spark, tmp_path):
    from pluvio.operators import ingest

    for i in range(30):
        (tmp_path / f"p{i:02}.json").write_text("{}")
    first = ingest.first_files(pages_json.parse(pages_json.discover(spark, str(tmp_path))), 7)
    p = first._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" not in p and "Sort" not in p.split("== Physical Plan ==")[1]
    assert sorted(r.file_name for r in first.collect()) == [f"p{i:02}" for i in range(7)]
    assert ingest.first_files(pages_json.parse(pages_json.discover(spark, str(tmp_path))), 0).count() == 0


def test_exchange_files_share_tasks(spark, tmp_path, monkeypatch):
    """Two hundred station-years of one year: both readers take them by two tasks, and every one is there."""
    monkeypatch.setattr(files, "LEAST_PARTS", 2)
    lines = ["SEF\t1.0.0", "ID\t%d", "Name\tA", "Lat\t51.0", "Lon\t-1.0", "Alt\tNA", "Source\tNA", "Link\tNA", "Vbl\trr", "Stat\tsum", "Units\tmm", "Meta\t", "Year\tMonth\tDay\tHour\tMinute\tPeriod\tValue\tMeta", "1996\t1\t2\t9\t0\t1day\t2.5\tqc1=pass|qc2=NA", ""]
    (tmp_path / "tsv" / "1996").mkdir(parents=True)
    for i in range(200):
        (tmp_path / "tsv" / "1996" / f"s{i}.tsv").write_text("\n".join(lines) % i)
    found = sef.read(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 2
    assert {r.station_id for r in found.collect()} == {str(i) for i in range(200)} == {r.station_id for r in sef.days_of_year(spark, str(tmp_path), 1996).collect()}


def test_files_are_listed_by_tasks_as_spark_lists_them(spark, tmp_path):
    """The driver has no state of a file, and paths, names and bytes are those of Spark's own reader."""
    root = tmp_path / "odd x%é"
    for p in ("a/x y.json", "a/é%20#?.json", "b/.h.json", "_c/z.json", "_d=1/q.json", "b/+&;,@!'()[]{}^`|\"<>.json", "top.json", "a/n.txt", "a/deep/er/u v .json"):
        (root / p).parent.mkdir(parents=True, exist_ok=True)
        (root / p).write_bytes(p.encode() + b"\xff\x00")
    rows = lambda df: sorted(map(tuple, df.selectExpr("source_path", "name", "hex(value)").collect()))
    for paths, below, n in ((str(root), True, 6), ([f"{root}/a", f"{root}/b"], True, 4), (f"{root}/a", False, 2), (f"{root}/_c", False, 1)):
        got = files.read(spark, paths, "*.json", below)
        assert got.inputFiles() == []
        bare = lambda found: [(p.replace("file:///", "file:/"), *r) for p, *r in found]
        want = rows(files._read_by_spark(spark, paths, "*.json", below))
        assert (rows(got) == want if isinstance(paths, str) else bare(rows(got)) == bare(want)) and got.count() == n
    plan = files.read(spark, str(root), "*.json", True).where("source_path < 'x'").select("source_path")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan  # texts are read only where they are asked for
