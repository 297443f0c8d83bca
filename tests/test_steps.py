"""The whole chain on invented files: twelve stations in two years, pages that transcribe them, some of them badly."""

import json
import random

from pyspark.sql import functions as F

from pluvio.__main__ import parser
from pluvio.plans import steps
from pluvio.sources import tables
from pluvio.sources.monthly_csv import MONTHS

DAYS = (1, 2, 3)


def _world(root):
    rnd = random.Random(11)
    for s in range(12):
        months = {y: [] for y in (1901, 1902)}
        for y in months:
            grid = {d: [{"values": []} for _ in range(12)] for d in DAYS}
            totals = []
            for m in range(12):
                day = [round(rnd.uniform(0.05, 1.5), 2) for _ in DAYS]
                total = round(sum(day), 2)
                months[y].append(total)
                for d, v in zip(DAYS, day):
                    wrong = s == 5 and m == 3
                    grid[d][m]["values"] = [v + 9 * wrong, v + 9 * wrong, v, None if wrong else v, v + 9 * wrong]
                totals.append({"values": [total, total, "missing", total, None if s % 4 == 3 else total]})
            page = {f"Day {d}": grid[d] for d in DAYS} | {"Totals": totals}
            p = root / "pages" / f"DRain_{y}-{y}_RainNos_Shire_{s}.json"
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(json.dumps(page))
        lines = [f"Town {s}", f"G,SU {s},Lon,{-1 + s * 0.02:.2f},Lat,{51 + s * 0.03:.2f},Elev,{100 + s}", f"N,{s}", "", "Year,1901,1902"]
        lines += [f"{n},{months[1901][i]},{months[1902][i]}" for i, n in enumerate(MONTHS)] + ["Total,1,2"]
        c = root / "csv" / "Shire" / f"town{s}.csv"
        c.parent.mkdir(parents=True, exist_ok=True)
        c.write_text("\n".join(lines) + "\n")


def test_the_chain(spark, tmp_path):
    _world(tmp_path)
    r = {n: str(tmp_path / n) for n in ("rr", "pg", "cmp", "con", "qc", "reg", "sec", "sef", "an")}
    assert steps.ingest_monthly(spark, str(tmp_path / "csv"), r["rr"])["rows"]["monthly_rainfall"] == 288
    assert steps.ingest_pages(spark, str(tmp_path / "pages"), r["pg"])["files_failed"] == 0
    assert steps.build_vectors(spark, r["rr"], r["pg"], r["cmp"])["rr_monthly_vectors"] == 24
    assert steps.run_match(spark, r["cmp"], top_k=3)["matches"] == 72
    assert steps.assign_metadata(spark, r["cmp"], r["pg"], r["rr"]) == {"session_id": 1, "exact": 24}
    meta = tables.read(spark, r["cmp"], "ensemble_metadata")
    assert meta.where("file_name like '%1901-1901%_7'").first().matched_location_name == "Town 7" and meta.where("matched_year = 1902").count() == 12
    assert steps.run_consensus(spark, r["pg"], r["con"])["rows"] == 24 * 12 * 3
    checked = steps.run_first_check(spark, r["con"], r["cmp"], r["rr"], r["qc"])
    assert checked == {"qc_session_id": 1, "pass": 24 * 36 - 6, "fail": 6}
    assert steps.run_regional(spark, r["con"], r["cmp"], r["qc"], r["reg"])["rows"] == 24 * 36
    trained = steps.train_second_check(spark, r["reg"], r["qc"], r["sec"], iterations=4, depth=3)
    assert trained["train_session_id"] == 1 and trained["k"] > 0
    scored = steps.score_second_check(spark, r["reg"], r["qc"], r["sec"])
    assert scored.get("fail", 0) + scored.get("pass", 0) + scored.get("indeterminate", 0) == 6 and scored.get("fail", 0) >= 4
    out = steps.export_sef(spark, r["sef"], r["con"], r["cmp"], r["qc"], r["sec"])
    assert out == {"stations": 24, "observations": 24 * 36}
    facts = steps.build_analysis(spark, r["sef"], r["an"])
    assert facts == {"observations": 24 * 36, "daily_national": 72}
    obs = spark.read.parquet(r["an"] + "/observations")
    assert obs.where("not passed").count() == scored.get("fail", 0) and obs.select("station_id").distinct().count() == 24
    assert spark.read.parquet(r["an"] + "/daily_national").where(F.col("n_stations_reporting") > 12).count() == 0
    assert tables.newest_sessions(meta, "match_source_session_id").count() == 24


def test_options_follow_the_parameters():
    p = parser().parse_args(["run-match", "--comparison-root", "x", "--top-k", "5", "--uncertainty-weight", "0.2"])
    assert (p.comparison_root, p.top_k, p.uncertainty_weight, p.max_pages) == ("x", 5, 0.2, None)
    p = parser().parse_args(["build-analysis", "--sef-root", "a", "--out-root", "b", "--year", "1901", "1902"])
    assert p.year == [1901, 1902] and parser().parse_args(["run-first-check", *"--consensus-root a --comparison-root b --rr-root c --qc-root d --require-exact-metadata".split()]).require_exact_metadata
