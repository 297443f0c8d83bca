"""Explicit schemas of every table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "stations": "station_file_id string not null, station_folder string not null, station_file_name string not null, location_name string, grid_reference string, longitude double, latitude double, elevation_ft int, station_number string, source_path string not null",
    "monthly_rainfall": "station_file_id string not null, year int not null, month tinyint not null, rainfall_in double not null",
    "annual_totals": "station_file_id string not null, year int not null, total_in double not null",
    "ingestion_file_errors": "source_path string not null, error_message string not null",
    "ensemble_files": "file_id bigint not null, file_name string not null, source_path string not null, year_start int, year_end int, descriptor string, section_id string, num_days smallint not null",
    "ensemble_daily_values": "file_id bigint not null, day_of_month tinyint not null, month tinyint not null, ensemble_member tinyint not null, rainfall double, is_missing tinyint not null",
    "ensemble_monthly_totals": "file_id bigint not null, month tinyint not null, ensemble_member tinyint not null, total double, is_missing tinyint not null",
    "ensemble_ingestion_file_errors": "source_path string not null, error_message string not null",
    "rr_monthly_vectors": "rr_vector_id string, station_file_id string, year bigint, location_name string, station_number string, latitude double, longitude double, completeness double, n_present int, raw_vector array<double>, norm_vector array<double>",
    "ensemble_consensus_vectors": "ensemble_vector_id string, file_id bigint, file_name string, descriptor string, section_id string, year_start bigint, year_end bigint, completeness double, uncertainty_score double, monthly_iqr array<double>, raw_vector array<double>, norm_vector array<double>",
    "ensemble_member_monthly_values": "ensemble_vector_id string, month tinyint, ensemble_member tinyint, total double, is_missing tinyint",
    "similarity_sessions": "session_id bigint, started_at string, completed_at string, comparison_root string, top_k int, min_overlap int, uncertainty_weight double, ranking_method string, ensemble_queries bigint, rr_candidates bigint, matches_written bigint, status string, message string",
    "similarity_matches": "session_id bigint, query_rank bigint, ensemble_vector_id string, rr_vector_id string, overlap_months bigint, exact_agreement_count bigint, cosine_similarity double, adjusted_score double, ensemble_uncertainty double",
    "ensemble_metadata": "file_id bigint, file_name string, matched_location_name string, matched_year bigint, matched_latitude double, matched_longitude double, matched_elevation_ft double, match_type string, match_source_session_id bigint",
    "qc_sessions": "qc_session_id bigint, started_at string, completed_at string, status string, parent_qc_session_id bigint, config_json string, promotion_threshold double, message string",
    "daily_qc_results": "qc_session_id bigint, file_id bigint, day_of_month tinyint, month tinyint, check_name string, check_version string, qc_score double, qc_flag string, details_json string, created_at string",
    "daily_qc_status": "qc_session_id bigint, file_id bigint, day_of_month tinyint, month tinyint, final_score double, final_flag string, promoted_good int, promoted_at string",
    "daily_qc_features": "file_id bigint, day_of_month tinyint, month tinyint, climatology_median double, climatology_mad double, nearby_median double, nearby_mad double, temporal_delta double, feature_version string, updated_at string",
    "daily_consensus": "file_id bigint, month tinyint, day_of_month tinyint, consensus_value double",
    "regional_daily_stats": "file_id bigint, matched_year bigint, month tinyint, day_of_month tinyint, consensus_value double, n_20km bigint, median_20km double, mad_20km double, n_50km bigint, median_50km double, mad_50km double, metadata_session_id bigint, qc_session_id bigint, created_at string",
    "secondary_qc_sessions": "train_session_id bigint, qc_session_id bigint, started_at string, completed_at string, status string, k double, coverage_target double, coverage_achieved double, n_train bigint, n_calib bigint, mae_inches double, r2_transformed double, config_json string",
    "secondary_qc_status": "file_id bigint, matched_year bigint, month tinyint, day_of_month tinyint, consensus_value double, predicted_consensus double, predicted_abs_error double, expectation_lower double, expectation_upper double, secondary_flag string, train_session_id bigint, qc_session_id bigint, created_at string",
    "observations": "station_id string, location_name string, latitude double, longitude double, altitude double, year int, month smallint, day smallint, obs_date date, value_mm double, qc1 string, qc2 string, passed boolean",
    "daily_national": "obs_date date, year int, n_stations_reporting bigint, mean_mm double, max_mm double, argmax_station_id string, argmax_location string, n_wet bigint, n_ge10 bigint, n_ge25 bigint, n_ge50 bigint",
}

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(), "smallint": T.ShortType(), "tinyint": T.ByteType(),
    "date": T.DateType(), "boolean": T.BooleanType(), "array<double>": T.ArrayType(T.DoubleType()),
}


def _struct(ddl: str) -> T.StructType:
    """A schema from ``name type [not null], ...``; unlike StructType.fromDDL it needs no session."""
    fields = (f.split(" ", 2) for f in ddl.split(", "))
    return T.StructType([T.StructField(f[0], _TYPES[f[1]], nullable=len(f) == 2) for f in fields])


SCHEMAS: dict[str, T.StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}
