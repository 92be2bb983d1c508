"""Fixed schemas: the text form of bars and the log tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of bar files and of the append-only logs.
BAR_TEXT_COLUMNS = ["timestamp", "open", "high", "low", "close", "volume", "created_ts", "date"]
DOWNLOAD_LOG_COLUMNS = [
    "logged_at_utc", "date", "attempt_int", "status_str", "saved_bool", "expected_count_int", "bar_count_int",
    "missing_count_int", "extra_count_int", "duplicate_count_int", "missing_str", "extra_str", "error_code_int",
    "error_str", "request_seconds_float", "end_datetime_str", "duration_str", "ibapi_version_str",
]
INDEX_DOWNLOAD_LOG_COLUMNS = [
    "logged_at_utc", "symbol", "bar_kind", "label", "attempt_int", "status_str", "saved_bool", "bar_count_int",
    "expected_count_int", "missing_count_int", "extra_count_int", "duplicate_count_int", "first_bar_str", "last_bar_str",
    "missing_str", "extra_str", "error_code_int", "error_str", "request_seconds_float", "end_datetime_str", "duration_str",
    "ibapi_version_str", "server_version_int",
]
MERGE_LOG_COLUMNS = [
    "merged_at_utc", "date", "status_str", "bar_count_int", "missing_count_int", "bad_tick_count_int", "staging_file_str", "raw_file_str",
]
INDEX_MERGE_LOG_COLUMNS = [
    "merged_at_utc", "symbol", "bar_kind", "file_str", "decision_str", "status_str", "row_count_int", "missing_count_int",
    "conflict_minute_count_int", "staging_file_str", "raw_file_str",
]
ZONE_TYPES = {
    "qatar_timestamp": "timestamp", "ny_timestamp": "timestamp", "open": "double", "high": "double", "low": "double",
    "close": "double", "volume": "int", "stock_splits": "double",
}


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
