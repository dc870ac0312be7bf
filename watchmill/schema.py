"""Explicit schemas; nothing in the package infers one."""

from pyspark.sql import types as T

NETWORK_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("login_hour", T.IntegerType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("workspace_id", T.StringType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("ip_region", T.StringType()),
    T.StructField("user_region", T.StringType()),
    T.StructField("geo_mismatch", T.BooleanType()),
    T.StructField("impossible_travel", T.BooleanType()),
    T.StructField("action", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("failed_attempts_last_15m", T.IntegerType()),
    T.StructField("data_downloaded_mb", T.DoubleType()),
    T.StructField("role", T.StringType()),
    T.StructField("remote_worker", T.BooleanType()),
    T.StructField("base_login_hour", T.DoubleType()),
    T.StructField("login_hour_std_dev", T.DoubleType()),
    T.StructField("avg_daily_downloads_mb", T.DoubleType()),
    T.StructField("home_region", T.StringType()),
    T.StructField("is_shift_worker", T.BooleanType()),
    T.StructField("clumsiness_factor", T.DoubleType()),
    T.StructField("is_injected_anomaly", T.BooleanType()),
    T.StructField("anomaly_type", T.StringType()),
])

_LOG_COLUMNS = [
    "event_id", "timestamp", "login_hour", "user_id", "workspace_id", "source_ip", "ip_region", "user_region",
    "geo_mismatch", "impossible_travel", "action", "success", "failed_attempts_last_15m", "data_downloaded_mb",
    "is_injected_anomaly", "anomaly_type",
]
NETWORK_LOG = T.StructType([NETWORK_EVENT[name] for name in _LOG_COLUMNS])

USER_PROFILE = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("home_region", T.StringType()),
    T.StructField("base_login_hour", T.DoubleType()),
    T.StructField("login_hour_std_dev", T.DoubleType()),
    T.StructField("avg_daily_downloads_mb", T.DoubleType()),
    T.StructField("remote_worker", T.BooleanType()),
    T.StructField("is_shift_worker", T.BooleanType()),
    T.StructField("clumsiness_factor", T.DoubleType()),
    T.StructField("num_known_devices", T.IntegerType()),
    T.StructField("travel_probability", T.DoubleType()),
])

# column name in a parsed record -> type; the text fields come in this order
CONN_COLUMNS = {
    "ts": "double",
    "uid": "string",
    "orig_h": "string",
    "orig_p": "bigint",
    "resp_h": "string",
    "resp_p": "bigint",
    "proto": "string",
    "service": "string",
    "duration": "double",
    "orig_bytes": "bigint",
    "resp_bytes": "bigint",
    "conn_state": "string",
    "local_orig": "string",
    "local_resp": "string",
    "missed_bytes": "bigint",
    "history": "string",
    "orig_pkts": "bigint",
    "orig_ip_bytes": "bigint",
    "resp_pkts": "bigint",
    "resp_ip_bytes": "bigint",
}

FEATURE_COLUMNS = [
    "login_hour", "failed_attempts_last_15m", "data_downloaded_mb",
    "hour", "day_of_week", "is_weekend", "is_night",
    "login_time_deviation", "login_deviation_zscore", "login_deviation_squared", "extreme_time_deviation",
    "hour_sin", "hour_cos",
    "outside_business_hours", "non_tech_off_hours", "deep_night",
    "shift_worker_int", "off_hours_non_shift",
    "geo_mismatch_int", "impossible_travel_int", "from_home_region",
    "download_deviation", "download_ratio", "download_deviation_abs", "is_extreme_download",
    "has_failed_attempts", "high_failed_attempts", "very_high_failed", "success_int",
    "is_new_ip",
    "ip_hops_30m", "admin_actions_15m", "failed_30m",
    "time_since_last", "rapid_succession",
    "events_1h",
    "role_risk_score", "remote_worker_int",
    "admin_non_admin_role", "high_download_non_dev", "geo_not_travel", "geo_and_travel",
    "action_encoded", "ip_region_encoded", "user_region_encoded", "role_encoded",
]
assert len(FEATURE_COLUMNS) == 46
