"""The whole chain over dataset roots: each step reads tables, writes tables and returns a few facts.

Sessions number the runs of match, first check and second check; a step without a session takes the newest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import compat
from ..operators import assign, booster, consensus, export, ingest, match, qc1, regional, registry, secondary, vectors
from ..schemas import SCHEMAS
from ..sources import sef, tables


def _now() -> str:
    return dt.datetime.now(dt.UTC).isoformat(timespec="seconds")


def _newest(spark: SparkSession, root: str, name: str, column: str, given: int | None) -> int:
    found = given if given is not None else compat.newest(tables.read(spark, root, name), column)
    if found is None:
        raise LookupError(f"{root}/{name} has no session")
    return found


def ingest_monthly(spark: SparkSession, source_root: str, dataset_root: str, max_files: int | None = None, overwrite: bool = False) -> dict:
    return ingest.monthly_tables(spark, source_root, dataset_root, max_files, overwrite)


def ingest_pages(spark: SparkSession, source_root: str, dataset_root: str, max_files: int | None = None, overwrite: bool = False) -> dict:
    return ingest.pages(spark, source_root, dataset_root, max_files, overwrite)


def build_vectors(spark: SparkSession, rr_root: str, page_root: str, comparison_root: str, overwrite: bool = True) -> dict:
    mode = "overwrite" if overwrite else "errorifexists"
    totals = tables.read(spark, page_root, "ensemble_monthly_totals")
    tables.write(vectors.station_years(tables.read(spark, rr_root, "monthly_rainfall"), tables.read(spark, rr_root, "stations")), comparison_root, "rr_monthly_vectors", mode)
    tables.write(vectors.pages(totals, tables.read(spark, page_root, "ensemble_files")), comparison_root, "ensemble_consensus_vectors", mode)
    tables.write(vectors.member_values(totals), comparison_root, "ensemble_member_monthly_values", mode)
    return {n: tables.read(spark, comparison_root, n).count() for n in ("rr_monthly_vectors", "ensemble_consensus_vectors", "ensemble_member_monthly_values")}


def run_match(spark: SparkSession, comparison_root: str, top_k: int = match.TOP_K, min_overlap: int = match.MIN_OVERLAP, uncertainty_weight: float = match.UNCERTAINTY_WEIGHT, max_pages: int | None = None, max_stations: int | None = None) -> dict:
    session, started = tables.next_session(spark, comparison_root, "similarity_sessions", "session_id"), _now()
    pages, rr = tables.read(spark, comparison_root, "ensemble_consensus_vectors"), tables.read(spark, comparison_root, "rr_monthly_vectors")
    if max_pages is not None:
        pages = pages.orderBy("ensemble_vector_id").limit(max_pages)
    if max_stations is not None:
        rr = rr.orderBy("rr_vector_id").limit(max_stations)
    members = tables.read(spark, comparison_root, "ensemble_member_monthly_values").join(pages.select("ensemble_vector_id"), "ensemble_vector_id", "left_semi")
    tables.write_session(match.top_k(members, pages, rr, top_k, min_overlap, uncertainty_weight, session), comparison_root, "similarity_matches", "session_id")
    written = tables.read(spark, comparison_root, "similarity_matches").where(F.col("session_id") == session).count()
    row = (session, started, _now(), comparison_root, top_k, min_overlap, uncertainty_weight, "exact_agreement", pages.count(), rr.count(), written, "success", None)
    tables.write_session(spark.createDataFrame([row], SCHEMAS["similarity_sessions"]), comparison_root, "similarity_sessions", "session_id")
    return {"session_id": session, "matches": written}


def assign_metadata(spark: SparkSession, comparison_root: str, page_root: str, rr_root: str, session_id: int | None = None) -> dict:
    session = _newest(spark, comparison_root, "similarity_sessions", "session_id", session_id)
    out = assign.metadata(tables.read(spark, comparison_root, "similarity_matches"), tables.read(spark, comparison_root, "rr_monthly_vectors"), tables.read(spark, rr_root, "stations"), tables.read(spark, page_root, "ensemble_files"), session)
    tables.write_session(out, comparison_root, "ensemble_metadata", "match_source_session_id")
    kinds = tables.read(spark, comparison_root, "ensemble_metadata").where(F.col("match_source_session_id") == session).groupBy("match_type").agg(F.count(F.lit(1)).alias("n")).collect()
    return {"session_id": session, **{str(r.match_type): r.n for r in kinds}}


def run_consensus(spark: SparkSession, page_root: str, consensus_root: str, start_file_id: int | None = None, end_file_id: int | None = None) -> dict:
    out = consensus.daily(tables.read(spark, page_root, "ensemble_daily_values"), start_file_id, end_file_id)
    tables.write(out, consensus_root, "daily_consensus", "overwrite", cluster="file_id")
    return {"rows": tables.read(spark, consensus_root, "daily_consensus").count()}


def run_first_check(spark: SparkSession, consensus_root: str, comparison_root: str, rr_root: str, qc_root: str, tolerance: float = qc1.TOLERANCE, similarity_session_id: int | None = None, promotion_threshold: float = qc1.PROMOTE, require_exact_metadata: bool = False) -> dict:
    matched_in = _newest(spark, comparison_root, "similarity_sessions", "session_id", similarity_session_id)
    session = registry.start(spark, qc_root, {"similarity_session_id": matched_in, "tolerance": tolerance}, threshold=promotion_threshold)
    metadata = tables.read(spark, comparison_root, "ensemble_metadata").where(F.col("match_source_session_id") == matched_in) if require_exact_metadata else None
    eligible = qc1.eligible(tables.read(spark, comparison_root, "similarity_matches"), matched_in, metadata)
    rows = qc1.results(tables.read(spark, consensus_root, "daily_consensus"), eligible, tables.read(spark, comparison_root, "rr_monthly_vectors"), tables.read(spark, rr_root, "monthly_rainfall"), session, tolerance, _now())
    registry.insert_results(rows, qc_root, session)
    status = registry.consolidate(spark, qc_root, session, promotion_threshold)
    counts = {r.final_flag: r.n for r in registry.flag_counts(status).collect()}
    registry.complete(spark, qc_root, session)
    return {"qc_session_id": session, **counts}


def run_regional(spark: SparkSession, consensus_root: str, comparison_root: str, qc_root: str, regional_root: str, metadata_session_id: int | None = None, qc_session_id: int | None = None, start_file_id: int | None = None, end_file_id: int | None = None) -> dict:
    meta = _newest(spark, comparison_root, "ensemble_metadata", "match_source_session_id", metadata_session_id)
    session = _newest(spark, qc_root, "qc_sessions", "qc_session_id", qc_session_id)
    out = regional.daily_stats(tables.read(spark, comparison_root, "ensemble_metadata"), tables.read(spark, consensus_root, "daily_consensus"), tables.read(spark, qc_root, "daily_qc_status"), meta, session, start_file_id, end_file_id, _now())
    tables.write(out, regional_root, "regional_daily_stats", "overwrite", cluster="file_id")
    facts = regional.violations(tables.read(spark, regional_root, "regional_daily_stats")).first().asDict()
    if any(v for k, v in facts.items() if k != "rows"):
        raise ValueError(f"neighbour statistics break their own rules: {facts}")
    return facts


def train_second_check(spark: SparkSession, regional_root: str, qc_root: str, secondary_root: str, qc_session_id: int | None = None, max_rows: int | None = None, coverage: float = secondary.COVERAGE, seed: int = 0, iterations: int = booster.Settings.trees, depth: int = booster.Settings.depth, rate: float = booster.Settings.rate) -> dict:
    session, started = _newest(spark, qc_root, "qc_sessions", "qc_session_id", qc_session_id), _now()
    rows = secondary.training_rows(tables.read(spark, regional_root, "regional_daily_stats"), tables.read(spark, qc_root, "daily_qc_status"), session, max_rows, seed)
    trained = secondary.train(rows, coverage, seed=seed, settings=booster.Settings(trees=iterations, depth=depth, rate=rate, seed=seed))
    number = tables.next_session(spark, secondary_root, "secondary_qc_sessions", "train_session_id")
    secondary.save(trained, f"{secondary_root}/models/session_{number:06d}")
    row = (number, session, started, _now(), "success", trained.k, coverage, trained.coverage_achieved, trained.n_train, trained.n_calib, trained.mae_inches, trained.r2_transformed, None)
    tables.write_session(spark.createDataFrame([row], SCHEMAS["secondary_qc_sessions"]), secondary_root, "secondary_qc_sessions", "train_session_id")
    return {"train_session_id": number, "k": trained.k, "coverage_achieved": trained.coverage_achieved, "n_train": trained.n_train}


def score_second_check(spark: SparkSession, regional_root: str, qc_root: str, secondary_root: str, train_session_id: int | None = None, qc_session_id: int | None = None) -> dict:
    number = _newest(spark, secondary_root, "secondary_qc_sessions", "train_session_id", train_session_id)
    session = _newest(spark, qc_root, "qc_sessions", "qc_session_id", qc_session_id)
    trained = secondary.load(spark, f"{secondary_root}/models/session_{number:06d}")
    out = secondary.score(tables.read(spark, regional_root, "regional_daily_stats"), tables.read(spark, qc_root, "daily_qc_status"), trained, session, number, _now())
    tables.write_session(out, secondary_root, "secondary_qc_status", "train_session_id")
    rows = tables.read(spark, secondary_root, "secondary_qc_status").where(F.col("train_session_id") == number).groupBy("secondary_flag").agg(F.count(F.lit(1)).alias("n")).collect()
    return {"train_session_id": number, **{r.secondary_flag: r.n for r in rows}}


def _export_rows(spark: SparkSession, consensus_root: str, comparison_root: str, qc_root: str, secondary_root: str | None, session: int, start_year: int | None, end_year: int | None) -> DataFrame:
    second = tables.read(spark, secondary_root, "secondary_qc_status") if secondary_root and tables.exists(spark, f"{secondary_root}/secondary_qc_status") else None
    return export.joined(tables.read(spark, consensus_root, "daily_consensus"), tables.read(spark, comparison_root, "ensemble_metadata"), tables.read(spark, qc_root, "daily_qc_status"), second, session, start_year, end_year)


def export_sef(spark: SparkSession, output_root: str, consensus_root: str, comparison_root: str, qc_root: str, secondary_root: str | None = None, qc_session_id: int | None = None, start_year: int | None = None, end_year: int | None = None, source: str = "NA", link: str = "NA", obs_hour: int = 9, obs_minute: int = 0) -> dict:
    session = _newest(spark, qc_root, "qc_sessions", "qc_session_id", qc_session_id)
    rows = _export_rows(spark, consensus_root, comparison_root, qc_root, secondary_root, session, start_year, end_year)
    if clash := export.clashes(export.merged_stations(rows)).limit(5).collect():
        raise ValueError(f"station-years that would share a file: {clash}")
    docs = export.documents(rows, session, source, link, obs_hour, obs_minute).persist()
    sef.write(docs, output_root)
    facts = docs.agg(F.count(F.lit(1)).alias("stations"), F.coalesce(F.sum("n_observations"), F.lit(0)).alias("observations")).first().asDict()
    docs.unpersist()
    tables.write_manifest(spark, f"{output_root}/_metadata/export.json", {"completed_at": _now(), "qc_session_id": session, **facts})
    return facts


def build_analysis(spark: SparkSession, sef_root: str, out_root: str, year: list[int] | None = None) -> dict:
    ingest.sef_analysis(spark, sef_root, out_root, *(year or []))
    return {n: spark.read.parquet(f"{out_root}/{n}").count() for n in ("observations", "daily_national")}


STEPS = {f.__name__.replace("_", "-"): f for f in (ingest_monthly, ingest_pages, build_vectors, run_match, assign_metadata, run_consensus, run_first_check, run_regional, train_second_check, score_second_check, export_sef, build_analysis)}
