"""What each query must return, as SQL over the given tables."""

from checks.inputs import COMMANDS, PROCESSES

PROFILES = """
profiles AS (
 SELECT concat('USR-', lpad(CAST(c.c_custkey AS VARCHAR), 5, '0')) AS user_id,
  CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'Admin' WHEN 'BUILDING' THEN 'Developer' WHEN 'AUTOMOBILE' THEN 'Finance'
       WHEN 'FURNITURE' THEN 'HR' ELSE 'Sales' END AS role,
  CASE n.n_regionkey WHEN 0 THEN 'South-America' WHEN 1 THEN 'US-East' WHEN 2 THEN 'Asia-Pacific'
       WHEN 3 THEN 'EU-Central' ELSE 'US-West' END AS home_region,
  CAST(7 + c.c_custkey % 5 AS DOUBLE) AS base_login_hour,
  CAST(1 + c.c_custkey % 3 AS DOUBLE) AS login_hour_std_dev,
  round(abs(c.c_acctbal) / 200.0, 2) AS avg_daily_downloads_mb,
  c.c_custkey % 3 = 0 AS remote_worker, c.c_custkey % 7 = 0 AS is_shift_worker, c.c_custkey AS custkey
 FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey)"""

NET_EVENTS = """
net_events AS (
 SELECT b.*, b.ip_region <> b.user_region AS geo_mismatch, epoch_us(b.ts) AS us, k * 0.25e0 AS latency_ms FROM (
 SELECT e.event_id, e.ts, concat('USR-', lpad(CAST(e.user_id AS VARCHAR), 5, '0')) AS user_id,
  concat('WS-', CAST(e.user_id % 20 AS VARCHAR)) AS workspace_id,
  concat('10.', CAST(e.user_id % 8 AS VARCHAR), '.0.', CAST(e.k % 3 AS VARCHAR)) AS source_ip,
  CASE WHEN e.k % 10 = 0 THEN CASE e.event_id % 5 WHEN 0 THEN 'South-America' WHEN 1 THEN 'US-East'
       WHEN 2 THEN 'Asia-Pacific' WHEN 3 THEN 'EU-Central' ELSE 'US-West' END ELSE p.home_region END AS ip_region,
  p.home_region AS user_region,
  CASE e.event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'write' WHEN 'purchase' THEN 'delete'
       WHEN 'signup' THEN 'admin' ELSE 'login' END AS action,
  e.event_type <> 'error' AS success,
  CAST(CASE WHEN e.k = 98 THEN 9 WHEN e.k >= 90 THEN e.k - 90 ELSE 0 END AS INT) AS failed_attempts_last_15m,
  CASE WHEN e.k = 95 THEN e.value * 10 ELSE e.value END AS data_downloaded_mb,
  CAST(extract(hour FROM e.ts) AS INT) AS login_hour,
  e.k >= 95 AS is_injected_anomaly,
  CASE e.k WHEN 95 THEN 'data_exfiltration' WHEN 96 THEN 'lateral_movement' WHEN 97 THEN 'privilege_escalation'
       WHEN 98 THEN 'brute_force' WHEN 99 THEN 'impossible_travel' ELSE 'None' END AS anomaly_type,
  e.k = 99 AS impossible_travel, e.k AS k,
  (e.k * 37 % 101) / 100.0e0 AS xgb_score, (e.k * 53 % 101) / 100.0e0 AS lgbm_score,
  (e.k * 71 % 101) / 100.0e0 AS rf_score, (e.k * 13 % 101) / 100.0e0 AS gb_score
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
 LEFT JOIN profiles p ON p.user_id = concat('USR-', lpad(CAST(e.user_id AS VARCHAR), 5, '0'))) b)"""

PRED = """
pred AS (
 SELECT *, is_threat AND threat_action IN ('BLOCK', 'CRITICAL_ALERT') AS high FROM (
 SELECT *, s >= 0.5 AS is_threat, round(s, 6) AS threat_score, round(s, 6) AS ensemble_score,
  CASE WHEN s < 0.3 THEN 'ALLOW' WHEN s < 0.6 THEN 'MONITOR' WHEN s < 0.85 THEN 'BLOCK' ELSE 'CRITICAL_ALERT' END
   AS threat_action,
  CASE WHEN anomaly_type IN ('data_exfiltration', 'bulk_download') THEN 'elasticsearch'
       WHEN anomaly_type IN ('lateral_movement', 'privilege_escalation') THEN 'kafka'
       WHEN action = 'admin' THEN 'database' ELSE 'elasticsearch' END AS service_at_risk
 FROM (SELECT *, 0.35e0*xgb_score + 0.30e0*lgbm_score + 0.20e0*rf_score + 0.15e0*gb_score AS s FROM net_events) z) y)"""

HISTORY = """
h0 AS (SELECT *, CAST(action = 'admin' AS INT) AS adm, CAST(NOT success AS INT) AS bad FROM net_events),
h1 AS (SELECT *, lag(source_ip) OVER w AS prev_ip, lag(us) OVER w AS prev_us FROM h0
       WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
h2 AS (SELECT *, CAST(prev_ip IS NOT NULL AND prev_ip <> source_ip AS INT) AS ip_changed,
       coalesce((us - prev_us) / 1e6, 0) AS time_since_last FROM h1),
hist AS (SELECT *, CAST(time_since_last < 60 AS INT) AS rapid_succession,
  CAST(us = min(us) OVER (PARTITION BY user_id, source_ip) AS INT) AS is_new_ip,
  CAST(sum(ip_changed) OVER m30 AS INT) AS ip_hops_30m, CAST(sum(adm) OVER m15 AS INT) AS admin_actions_15m,
  CAST(sum(bad) OVER m30 AS INT) AS failed_30m, CAST(count(*) OVER m60 AS INT) AS events_1h
 FROM h2 WINDOW
  m15 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 899999999 PRECEDING AND CURRENT ROW),
  m30 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 1799999999 PRECEDING AND CURRENT ROW),
  m60 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)),
serving AS (SELECT *, CAST(time_since_last < 60 AS INT) AS rapid_succession,
  CAST(source_ip = first_value(source_ip) OVER w AS INT) AS is_first_ip,
  CAST(least(10, sum(ip_changed) OVER w) AS INT) AS ip_hops_30m,
  CAST(least(20, sum(adm) OVER w) AS INT) AS admin_actions_15m,
  CAST(least(20, sum(bad) OVER w) AS INT) AS failed_30m, CAST(least(100, count(*) OVER w) AS INT) AS events_1h
 FROM h2 WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING))"""

FEATURES = """
f0 AS (SELECT n.*, p.role, p.home_region, p.base_login_hour, p.login_hour_std_dev, p.avg_daily_downloads_mb,
  p.remote_worker, p.is_shift_worker, CAST(extract(hour FROM n.ts) AS INT) AS hour,
  CAST(isodow(n.ts) - 1 AS INT) AS day_of_week FROM hist n JOIN profiles p USING (user_id)),
f1 AS (SELECT *, least(abs(login_hour - base_login_hour), 24 - abs(login_hour - base_login_hour)) AS dev,
  (hour < 6 OR hour > 20) AS off, data_downloaded_mb - avg_daily_downloads_mb AS extra,
  data_downloaded_mb / (avg_daily_downloads_mb + 0.01e0) AS ratio FROM f0),
feats AS (SELECT *,
  CAST(day_of_week >= 5 AS INT) AS is_weekend, CAST(hour < 6 OR hour > 22 AS INT) AS is_night,
  dev AS login_time_deviation, dev / (login_hour_std_dev + 0.1e0) AS login_deviation_zscore,
  dev * dev AS login_deviation_squared, CAST(dev / (login_hour_std_dev + 0.1e0) > 2.5 AS INT) AS extreme_time_deviation,
  sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
  CAST(off AS INT) AS outside_business_hours,
  CAST(off AND role NOT IN ('Admin', 'Developer') AS INT) AS non_tech_off_hours,
  CAST(hour BETWEEN 1 AND 5 AS INT) AS deep_night, CAST(is_shift_worker AS INT) AS shift_worker_int,
  CAST(off AND NOT is_shift_worker AS INT) AS off_hours_non_shift,
  CAST(geo_mismatch AS INT) AS geo_mismatch_int, CAST(impossible_travel AS INT) AS impossible_travel_int,
  CAST(ip_region = home_region AS INT) AS from_home_region,
  extra AS download_deviation, ratio AS download_ratio, abs(extra) AS download_deviation_abs,
  CAST(ratio > 5 AS INT) AS is_extreme_download, CAST(failed_attempts_last_15m > 0 AS INT) AS has_failed_attempts,
  CAST(failed_attempts_last_15m >= 5 AS INT) AS high_failed_attempts,
  CAST(failed_attempts_last_15m >= 8 AS INT) AS very_high_failed, CAST(success AS INT) AS success_int,
  CASE role WHEN 'Admin' THEN 4 WHEN 'Developer' THEN 3 WHEN 'Finance' THEN 2 ELSE 1 END AS role_risk_score,
  CAST(remote_worker AS INT) AS remote_worker_int,
  CAST(action = 'admin' AND role <> 'Admin' AS INT) AS admin_non_admin_role,
  CAST(ratio > 3 AND role <> 'Developer' AS INT) AS high_download_non_dev,
  CAST(geo_mismatch AND NOT impossible_travel AS INT) AS geo_not_travel,
  CAST(geo_mismatch AND impossible_travel AS INT) AS geo_and_travel,
  dense_rank() OVER (ORDER BY action) - 1 AS action_encoded,
  dense_rank() OVER (ORDER BY ip_region) - 1 AS ip_region_encoded,
  dense_rank() OVER (ORDER BY user_region) - 1 AS user_region_encoded,
  dense_rank() OVER (ORDER BY role) - 1 AS role_encoded FROM f1)"""

LEDGER = """
alerts AS (SELECT *, concat('ALR-', upper(left(sha256(CAST(event_id AS VARCHAR)), 32))) AS alert_id, us AS created_us
  FROM pred WHERE high),
decided AS (SELECT *, CASE event_id % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' ELSE 'pending' END AS status,
  CASE WHEN event_id % 3 < 2 THEN us + 600000000 END AS resolved_us,
  CASE WHEN event_id % 3 < 2 THEN concat('note ', CAST(event_id AS VARCHAR)) ELSE '' END AS admin_notes FROM alerts),
rot AS (
 SELECT sha256(concat(alert_id, '|user')) AS rotation_id, alert_id, event_id, 'user' AS rotation_type,
  user_id AS target, concat('admin_approved_', lower(threat_action), '_score_', printf('%.4f', threat_score)) AS reason,
  resolved_us AS at_us, threat_score AS trigger_score FROM decided WHERE status = 'approved'
 UNION ALL
 SELECT sha256(concat(alert_id, '|infrastructure')), alert_id, event_id, 'infrastructure', service_at_risk,
  concat('admin_approved_critical_score_', printf('%.4f', threat_score)), resolved_us, threat_score
 FROM decided WHERE status = 'approved' AND threat_action = 'CRITICAL_ALERT'),
uledger AS (SELECT p.user_id, p.role, p.home_region, coalesce(r.n, 0) AS rotation_count,
  CASE WHEN r.n IS NULL THEN 'active' ELSE 'rotated' END AS status,
  coalesce(r.reason, 'initial_provisioning') AS last_rotation_reason, r.trigger_score AS triggered_by_threat_score,
  r.at_us AS created_us
 FROM profiles p LEFT JOIN (
  SELECT target, reason, trigger_score, at_us, count(*) OVER (PARTITION BY target) AS n,
   row_number() OVER (PARTITION BY target ORDER BY at_us DESC, rotation_id DESC) AS rn
  FROM rot WHERE rotation_type = 'user') r ON r.target = p.user_id AND r.rn = 1),
leases AS (SELECT target AS service, concat('database/creds/backend-role/', left(rotation_id, 24)) AS lease_id,
  concat('v-', left(rotation_id, 12)) AS username, at_us AS issued_us, at_us + 3600000000 AS expires_us,
  reason AS rotation_reason FROM rot WHERE rotation_type = 'infrastructure' AND target <> 'kafka')"""

CONN = """
c0 AS (SELECT *, CASE lower(action) WHEN 'read' THEN 'http' WHEN 'write' THEN 'http' WHEN 'delete' THEN 'http'
   WHEN 'admin' THEN 'ssh' ELSE 'unknown' END AS service,
  CAST(floor(greatest(0, data_downloaded_mb * 1048576)) AS BIGINT) AS sent FROM net_events),
conn AS (SELECT us / 1e6 AS ts, CAST(event_id AS VARCHAR) AS uid, source_ip AS orig_h,
  concat('192.168.0.', CAST(100 + CAST(right(regexp_replace(workspace_id, '\\D', '', 'g'), 2) AS INT) % 100 AS VARCHAR))
   AS resp_h, CAST(CASE service WHEN 'ssh' THEN 22 ELSE 80 END AS BIGINT) AS resp_p, 'tcp' AS proto, service,
  round(greatest(0.01e0, least(3600.0e0, data_downloaded_mb * 0.15e0)), 6) AS duration,
  sent AS orig_bytes, CAST(floor(sent * 0.2e0) AS BIGINT) AS resp_bytes,
  CASE WHEN success THEN 'SF' ELSE 'REJ' END AS conn_state, CAST(0 AS BIGINT) AS missed_bytes, 'S' AS history,
  CAST(greatest(1, ceil(sent / 1500.0e0)) AS BIGINT) AS orig_pkts, sent AS orig_ip_bytes,
  CAST(greatest(1, ceil(floor(sent * 0.2e0) / 1500.0e0)) AS BIGINT) AS resp_pkts,
  CAST(floor(sent * 0.2e0) AS BIGINT) AS resp_ip_bytes, event_id, us, user_id, workspace_id, ip_region, user_region,
  action FROM c0)"""

EVALUATION = """
pos AS (SELECT *, CAST(is_injected_anomaly AS INT) AS y FROM pred),
pr0 AS (SELECT threat_score AS threshold, sum(y) AS p, count(*) - sum(y) AS n FROM pos GROUP BY 1),
pr1 AS (SELECT threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
  CAST(sum(p) OVER () AS BIGINT) AS p_all FROM pr0 WINDOW w AS (ORDER BY threshold DESC)),
pr AS (SELECT threshold, tp, fp, tp / (tp + fp) AS prec, tp / p_all AS rec,
  2 * (tp / (tp + fp) * (tp / p_all)) / (tp / (tp + fp) + tp / p_all + 1e-8) AS f1 FROM pr1),
best AS (SELECT * FROM pr ORDER BY f1 DESC, threshold LIMIT 1),
members AS (
 SELECT 'xgb' AS model, xgb_score AS score, 0.5e0 AS cut, y FROM pos UNION ALL
 SELECT 'lgbm', lgbm_score, 0.5e0, y FROM pos UNION ALL SELECT 'rf', rf_score, 0.5e0, y FROM pos UNION ALL
 SELECT 'gb', gb_score, 0.5e0, y FROM pos UNION ALL
 SELECT 'ensemble', threat_score, (SELECT threshold FROM best), y FROM pos),
cells AS (SELECT model, count(*) FILTER (y = 1 AND score >= cut) AS tp, count(*) FILTER (y = 0 AND score >= cut) AS fp,
  count(*) FILTER (y = 1 AND score < cut) AS fn, count(*) FILTER (y = 0 AND score < cut) AS tn FROM members GROUP BY 1)"""

GEO = """
geo AS (SELECT * FROM (VALUES ('US-East', 40.71e0, -74.01e0, 'New York'), ('US-West', 37.77e0, -122.42e0, 'San Francisco'),
  ('EU-Central', 50.11e0, 8.68e0, 'Frankfurt'), ('Asia-Pacific', 1.35e0, 103.82e0, 'Singapore'),
  ('South-America', -23.55e0, -46.63e0, 'São Paulo')) AS g(region, lat, lng, city))"""

_PARTS = [PROFILES, NET_EVENTS, PRED, HISTORY, FEATURES, LEDGER, CONN, EVALUATION, GEO]


def q(body: str, *more: str) -> str:
    """A query over the views above and over further ones of its own."""
    return "WITH " + ",".join([*_PARTS, *more]) + "\n" + body


def pct(score: str) -> str:
    """A percentage with one decimal, half up on the number's shortest decimal digits (ROUND_HALF_UP of its text)."""
    return f"CAST(round(CAST(CAST({score} * 100 AS VARCHAR) AS DECIMAL(38, 18)), 1) AS DOUBLE)"


_ROLL_COLS = "event_id, is_new_ip, ip_hops_30m, admin_actions_15m, failed_30m, events_1h, time_since_last"

SUSPICIOUS = " OR ".join(
    f"contains(lower(text), '{w}')"
    for w in ("powershell", "mimikatz", "net user", "whoami", "lateral", "domain_controller", "psexec", "wmic", "certutil")
)


def _f(columns: str, rounded: str = "") -> str:
    parts = [c for c in (f"event_id, {columns}" if columns else "event_id").split(", ")]
    parts += [f"round({c}, 9) AS {c}" for c in rounded.split(", ") if c]
    return q(f"SELECT {', '.join(parts)} FROM feats")


FEATURE_INTS = [
    "login_hour", "failed_attempts_last_15m", "hour", "day_of_week", "is_weekend", "is_night", "extreme_time_deviation",
    "outside_business_hours", "non_tech_off_hours", "deep_night", "shift_worker_int", "off_hours_non_shift",
    "geo_mismatch_int", "impossible_travel_int", "from_home_region", "is_extreme_download", "has_failed_attempts",
    "high_failed_attempts", "very_high_failed", "success_int", "is_new_ip", "ip_hops_30m", "admin_actions_15m",
    "failed_30m", "rapid_succession", "events_1h", "role_risk_score", "remote_worker_int", "admin_non_admin_role",
    "high_download_non_dev", "geo_not_travel", "geo_and_travel", "action_encoded", "ip_region_encoded",
    "user_region_encoded", "role_encoded",
]
FEATURE_REALS = [
    "data_downloaded_mb", "login_time_deviation", "login_deviation_zscore", "login_deviation_squared", "hour_sin",
    "hour_cos", "download_deviation", "download_ratio", "download_deviation_abs", "time_since_last",
]
ALL_FEATURES = ", ".join(
    [f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_INTS] + [f"round({c}, 6) AS {c}" for c in FEATURE_REALS]
)
ROUND_TRIP = (
    "event_id, us AS event_us, login_hour, user_id, workspace_id, source_ip, ip_region, user_region, geo_mismatch, "
    "impossible_travel, action, success, failed_attempts_last_15m, data_downloaded_mb, is_injected_anomaly, anomaly_type"
)
ROUND_TRIP_TEXT_ID = "CAST(event_id AS VARCHAR) AS " + ROUND_TRIP
CONN_COLS = (
    "ts, uid, orig_h, resp_h, resp_p, proto, service, duration, orig_bytes, resp_bytes, conn_state, missed_bytes, "
    "history, orig_pkts, orig_ip_bytes, resp_pkts, resp_ip_bytes"
)
PLAN_STATUS = (
    "CASE WHEN high THEN 'pending_admin_approval' WHEN is_threat AND threat_action = 'MONITOR' THEN 'monitoring' "
    "ELSE 'no_rotation_needed' END"
)
ROTATION_STATUS = (
    "CASE WHEN high AND threat_action = 'CRITICAL_ALERT' THEN 'pending_user_and_infra_rotation' "
    "WHEN high THEN 'pending_user_rotation' ELSE 'skipped' END"
)
FLOW_COUNT = "CASE WHEN is_threat AND s > 0.9 THEN 5 WHEN is_threat THEN 4 ELSE 1 END"
SRC_GEO = "coalesce(a.lat, 0) AS src_lat, coalesce(a.lng, 0) AS src_lng, coalesce(a.city, 'Unknown') AS src_city"


def _dst(col: str, server: str) -> str:
    return (
        f"CASE WHEN e.ip_region = e.user_region OR b.region IS NULL THEN {server} ELSE b.{col} END"
    )


DST_GEO = (
    f"{_dst('lat', '12.97e0')} AS dst_lat, {_dst('lng', '77.59e0')} AS dst_lng, {_dst('city', chr(39) + 'Bangalore' + chr(39))} AS dst_city"
)
GEO_JOIN = "LEFT JOIN geo a ON a.region = e.ip_region LEFT JOIN geo b ON b.region = e.user_region"
CLASS_OF = """
cls AS (SELECT 'Normal' AS class, tn AS hit, fn AS false_hit, fp AS miss FROM cells WHERE model = 'ensemble' UNION ALL
        SELECT 'Threat', tp, fp, fn FROM cells WHERE model = 'ensemble'),
cls1 AS (SELECT class, CASE WHEN hit + false_hit > 0 THEN hit / (hit + false_hit) ELSE 0 END AS p,
  CASE WHEN hit + miss > 0 THEN hit / (hit + miss) ELSE 0 END AS r, hit + miss AS support FROM cls),
cls2 AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM cls1),
rep AS (SELECT class, p, r, f, support FROM cls2 UNION ALL
 SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM cls2 UNION ALL
 SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(f * support) / sum(support), sum(support) FROM cls2)"""
TIME_RANK = """
ranked AS (SELECT *, row_number() OVER (ORDER BY us, event_id) AS rn, count(*) OVER () AS n,
  row_number() OVER (ORDER BY user_id, us, event_id) AS rn_user FROM net_events)"""
OFFSETS = """
offs AS (SELECT topic, part, min(event_id) AS earliest, max(event_id) + 1 AS latest,
  max(CASE WHEN ts < TIMESTAMP '2024-01-30 20:00:00' THEN event_id ELSE -1 END) AS committed
 FROM (SELECT event_id, ts, event_type AS topic, CAST(user_id % 3 AS INT) AS part FROM events) GROUP BY 1, 2),
lags AS (SELECT topic, part AS partition, committed, latest,
  CASE WHEN committed >= 0 THEN latest - committed ELSE 0 END AS lag, latest - earliest AS messages FROM offs)"""
RUNNING = """
run AS (SELECT event_id, us AS event_us, count(*) OVER w AS events, CAST(sum(CAST(is_threat AS INT)) OVER w AS BIGINT) AS threats
  FROM pred WINDOW w AS (ORDER BY us, event_id ROWS UNBOUNDED PRECEDING))"""
LEVEL = "CASE WHEN threats / events * 100 > 10 THEN 'CRITICAL' WHEN threats / events * 100 > 5 THEN 'ELEVATED' ELSE 'NOMINAL' END"
FLOWS = """
flows AS (
 SELECT event_id, 'threat_investigation' AS name, 'high' AS priority FROM pred WHERE is_threat UNION ALL
 SELECT event_id, 'credential_rotation', 'critical' FROM pred WHERE is_threat UNION ALL
 SELECT event_id, 'incident_notification', 'high' FROM pred WHERE is_threat UNION ALL
 SELECT event_id, 'forensic_snapshot', 'medium' FROM pred WHERE is_threat UNION ALL
 SELECT event_id, 'network_isolation', 'critical' FROM pred WHERE is_threat AND s > 0.9 UNION ALL
 SELECT event_id, 'baseline_update', 'low' FROM pred WHERE NOT is_threat)"""
STALE = """
old AS (SELECT user_id, CASE WHEN custkey % 7 = 0 THEN 'Employee' ELSE role END AS role, home_region
  FROM profiles WHERE custkey % 5 <> 0)"""


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}

    # --- sources and sinks ---
    o["a1_network_logs"] = q(f"SELECT {ROUND_TRIP_TEXT_ID} FROM net_events")
    o["a2_profiles"] = q("SELECT * EXCLUDE (custkey) FROM profiles")
    o["a1_network_logs_reordered"], o["a2_profiles_reordered"] = o["a1_network_logs"], o["a2_profiles"]
    o["a3_events_json"] = q(f"SELECT {ROUND_TRIP_TEXT_ID} FROM net_events")
    o["a4_conn_log"] = q(f"SELECT {CONN_COLS} FROM conn")
    o["a5_conn_stream"] = o["a5_conn_tail"] = o["a4_conn_log"]
    o["a6_event_stream"] = q(f"SELECT {ROUND_TRIP_TEXT_ID} FROM net_events")
    o["a7_network_event"] = q(
        "SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN k % 3 = 0 THEN '' ELSE source_ip END AS source_ip, "
        "CASE WHEN k = 98 THEN 0 ELSE failed_attempts_last_15m END AS failed_attempts_last_15m, "
        "CASE WHEN action = 'login' THEN TRUE ELSE success END AS success, 'None' AS anomaly_type, "
        "9.0e0 AS base_login_hour, '' AS role FROM net_events"
    )
    o["a8_bridge"] = "SELECT doc_id, lang, n_chars, 'docs' AS _es_index, CAST(doc_id AS VARCHAR) AS _es_id FROM documents"
    once = (
        "SELECT source_ip AS _es_id, event_id, action FROM (SELECT *, row_number() OVER (PARTITION BY source_ip "
        "ORDER BY event_id) AS rn FROM net_events) WHERE rn = 1"
    )
    o["a9_bridge_once"] = q(once)
    o["a10_alert_messages"] = q(
        "SELECT CAST(event_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS event_id, threat_score, "
        "threat_action AS action, user_id AS user_name, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at FROM pred WHERE is_threat"
    )
    o["a11_raw_messages"] = q("SELECT user_id AS key, CAST(event_id AS VARCHAR) AS event_id, source_ip, action FROM net_events")
    o["a12_audit_rows"] = q(
        "SELECT us AS event_us, event_id, 'pipeline_complete' AS pipeline_stage, threat_action AS action_taken, threat_score, "
        "is_threat, source_ip, '0.0.0.0' AS destination_ip, user_id AS user_name, 'unknown' AS event_type, '' AS process_name FROM pred"
    )
    o["a13_threat_rows"] = q(
        "SELECT us AS event_us, event_id, threat_score, threat_action, anomaly_type AS attack_type, source_ip, ip_region, "
        "user_id AS user_name, action, xgb_score, lgbm_score, ensemble_score, high AS vault_rotation_triggered, "
        "high AND threat_action = 'CRITICAL_ALERT' AS infra_rotation_pending, FALSE AS credentials_rotated FROM pred WHERE is_threat"
    )
    o["a14_conn_daily"] = q(
        "SELECT strftime(make_timestamp(us), '%Y-%m-%d') AS event_date, count(*) AS n, CAST(sum(orig_bytes) AS BIGINT) AS sent "
        "FROM conn GROUP BY 1"
    )
    o["a15_conn_messages"] = q("SELECT uid AS key, resp_h, CAST(orig_bytes AS VARCHAR) AS orig_bytes, 'kafka-direct' AS output FROM conn")
    o["a16_test_events"] = q(
        "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at, user_id, anomaly_type, data_downloaded_mb "
        "FROM ranked WHERE rn > floor(n * 0.8)", TIME_RANK,
    )
    o["a17_profile_export"] = o["a2_profiles"]
    o["a19_report"] = q(
        "SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, CAST(support AS BIGINT) AS support, "
        "round((SELECT threshold FROM best), 6) AS threshold FROM rep", CLASS_OF,
    )
    metrics = (
        "SELECT count(*) AS total_requests, count(*) FILTER (is_threat) AS total_threats, "
        "count(*) FILTER (threat_action = 'ALLOW') AS total_allowed, count(*) FILTER (threat_action = 'MONITOR') AS total_monitored, "
        "count(*) FILTER (threat_action = 'BLOCK') AS total_blocked, count(*) FILTER (threat_action = 'CRITICAL_ALERT') AS total_critical, "
        "sum(latency_ms) AS total_latency_ms, round(sum(latency_ms) / count(*), 2) AS avg_latency_ms FROM pred"
    )
    o["a20_merge_metrics"] = q(metrics)

    # --- connection records ---
    o["b1_convert_conn"] = q(
        "SELECT uid, ts, CAST(NULL AS VARCHAR) AS local_orig, orig_bytes, CASE WHEN action = 'admin' THEN NULL ELSE duration END "
        "AS duration, CASE WHEN action = 'login' THEN NULL ELSE resp_bytes END AS resp_bytes FROM conn"
    )
    o["b2_normalise_conn"] = q(
        "SELECT uid, orig_h AS id_orig_h, resp_h AS id_resp_h, resp_p AS id_resp_p, orig_bytes AS source_bytes, "
        "orig_pkts AS source_packets, resp_bytes AS destination_bytes, resp_pkts AS destination_packets, "
        "conn_state AS zeek_conn_state, proto, service FROM conn"
    )
    o["b3_tag_conn"] = q(
        "SELECT uid, 'zeek' AS event_module, 'zeek.conn' AS event_dataset, 'event' AS event_kind, 'live-replay' AS pipeline_source FROM conn"
    )
    o["b4_conn_records"] = q(f"SELECT {CONN_COLS}, local_orig, local_resp FROM (SELECT *, CAST(NULL AS VARCHAR) AS local_orig, CAST(NULL AS VARCHAR) AS local_resp FROM conn)")
    o["b5_safe_numbers"] = q(
        "SELECT doc_id, coalesce(TRY_CAST(part AS BIGINT), -1) AS as_int, coalesce(TRY_CAST(part AS DOUBLE), -1.0e0) AS as_float "
        "FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang ELSE CAST(n_chars AS VARCHAR) END AS part FROM documents)"
    )
    o["b6_service_of"] = q("SELECT uid, service FROM conn")
    o["b7_resp_ip"] = q(
        "SELECT event_id, resp_h, CASE WHEN source_ip = '' THEN '' ELSE '192.168.0.101' END AS resp_h_no_digits "
        "FROM (SELECT c.event_id, c.resp_h, c.orig_h AS source_ip FROM conn c)"
    )
    o["b8_ports"] = q(
        "SELECT event_id, resp_p, 49152 + h % 1000 AS orig_p, 49152 + h % 16384 AS orig_p_of_more FROM "
        "(SELECT event_id, resp_p, CAST('0x' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM conn)")
    o["b9_epoch_ts"] = q("SELECT uid, ts FROM conn")
    o["b10_duration"] = q("SELECT uid, duration FROM conn")
    o["b11_bytes"] = q("SELECT uid, orig_bytes, resp_bytes FROM conn")
    o["b12_packets"] = q("SELECT uid, orig_pkts, resp_pkts FROM conn")
    o["b13_conn_state"] = q("SELECT uid, conn_state FROM conn")
    o["b14_enrich_conn"] = q("SELECT uid, resp_h, orig_bytes, user_id, workspace_id, ip_region, user_region, action FROM conn")
    o["b15_guess_service"] = (
        "SELECT doc_id, CASE " + " ".join(
            f"WHEN contains(lower(text), '{k}') THEN '{v}'" for k, v in (
                ("chrome", "http"), ("firefox", "http"), ("edge", "http"), ("outlook", "smtp"), ("thunderbird", "smtp"),
                ("powershell", "smb"), ("cmd", "smb"), ("ssh", "ssh"), ("sshd", "ssh"), ("dns", "dns"), ("nslookup", "dns"))
        ) + " ELSE 'unknown' END AS service FROM documents"
    )
    def chosen(words):
        return "list_extract([" + ", ".join("NULL" if w is None else f"'{w}'" for w in words) + f"], CAST(k % {len(words)} + 1 AS INT))"

    o["b15_guess_service_hosts"] = q(
        o["b15_guess_service"].replace("doc_id", "event_id").replace("FROM documents", f"FROM (SELECT event_id, {chosen(PROCESSES)} AS text FROM net_events)"))
    command_lines = f"(SELECT event_id, {chosen(COMMANDS)} AS text FROM net_events)"
    o["b17_is_suspicious_commands"] = q(f"SELECT event_id, coalesce({SUSPICIOUS}, FALSE) AS suspicious FROM {command_lines}")
    o["b18_ids_alerts_commands"] = q(
        f"SELECT event_id, 'ET POLICY Suspicious Process Activity Detected' AS msg FROM {command_lines} WHERE {SUSPICIOUS}")
    o["b16_classify_event"] = (
        "SELECT event_id, CASE event_type WHEN 'view' THEN 'network' WHEN 'click' THEN 'process' WHEN 'purchase' THEN 'file' "
        "WHEN 'signup' THEN 'authentication' ELSE 'network' END AS category FROM events"
    )
    o["b17_is_suspicious"] = f"SELECT doc_id, ({SUSPICIOUS}) AS suspicious FROM documents"
    o["b18_ids_alerts"] = (
        f"SELECT doc_id AS event_id, 'ET POLICY Suspicious Process Activity Detected' AS msg FROM documents WHERE {SUSPICIOUS}"
    )
    o["b19_to_ecs"] = (
        "SELECT event_id, 'filebeat' AS agent_type, '8.15.0' AS agent_version, '8.0' AS ecs_version, "
        "CASE event_type WHEN 'view' THEN 'network' WHEN 'click' THEN 'process' WHEN 'purchase' THEN 'file' "
        "WHEN 'signup' THEN 'authentication' ELSE 'network' END AS event_category, 'event' AS event_kind, "
        "'security' AS event_module, concat('HOST-', CAST(user_id % 20 AS VARCHAR)) AS host_name, "
        "'Windows Server 2022' AS host_os, TRUE AS geo_enriched FROM events"
    )
    o["b20_source_geo"] = q(f"SELECT event_id, {SRC_GEO} FROM net_events e {GEO_JOIN}")
    o["b21_dest_geo"] = q(f"SELECT event_id, {DST_GEO} FROM net_events e {GEO_JOIN}")
    o["b22_geo_arcs"] = q(
        "SELECT event_id, src_lat AS start_lat, src_lng AS start_lng, dst_lat AS end_lat, dst_lng AS end_lng, is_threat, "
        'user_id AS user_name, src_city AS source_city, dst_city AS dest_city, threat_score FROM '
        f"(SELECT e.*, {SRC_GEO}, {DST_GEO} FROM pred e {GEO_JOIN})"
    )
    o["b23_event_summary"] = q(
        "SELECT event_id, user_id AS user_name, source_ip, ip_region, action, anomaly_type, geo_mismatch, CASE WHEN high THEN "
        "concat('ALR-', upper(left(sha256(CAST(event_id AS VARCHAR)), 32))) END AS alert_id FROM pred"
    )
    o["b24_masks"] = (
        "SELECT c_custkey, concat(left(c_name, 4), '****', right(c_name, 4)) AS edges, concat(left(c_name, 8), '****') AS prefix, "
        "CASE WHEN length(c_mktsegment) > 8 THEN concat(left(c_mktsegment, 4), '****', right(c_mktsegment, 4)) ELSE '****' END AS short_edges, "
        "CASE WHEN length(c_mktsegment) > 8 THEN concat(left(c_mktsegment, 8), '****') ELSE '****' END AS short_prefix FROM customer"
    )
    o["b25_display"] = q(
        "SELECT rotation_id, CASE WHEN length(reason) > 25 THEN concat(left(reason, 25), '…') ELSE reason END AS short_reason, "
        f"{pct('trigger_score')} AS score_pct FROM rot"
    )
    o["b26_rotation_reason"] = q("SELECT rotation_id, reason FROM rot")
    o["b27_round_scores"] = q(
        "SELECT event_id, round(s, 6) AS ensemble_score, round(xgb_score, 6) AS xgb_score, round(lgbm_score, 6) AS lgbm_score, "
        "round(latency_ms, 2) AS latency_ms FROM pred"
    )

    # --- features ---
    o["c0_passthrough"] = _f("login_hour, failed_attempts_last_15m", "data_downloaded_mb")
    o["c1_calendar"] = _f("hour, day_of_week, is_weekend, is_night")
    o["c2_login_deviation"] = _f("extreme_time_deviation", "login_time_deviation, login_deviation_zscore, login_deviation_squared")
    o["c3_hour_circle"] = _f("", "hour_sin, hour_cos")
    o["c4_off_hours"] = _f("outside_business_hours, non_tech_off_hours, deep_night")
    o["c5_shift"] = _f("shift_worker_int, off_hours_non_shift")
    o["c6_geo"] = _f("geo_mismatch_int, impossible_travel_int, from_home_region")
    o["c7_download"] = _f("is_extreme_download", "download_deviation, download_ratio, download_deviation_abs")
    o["c8_failures"] = _f("has_failed_attempts, high_failed_attempts, very_high_failed, success_int")
    o["c9_new_ip"] = q("SELECT h.event_id, h.is_new_ip, s.is_first_ip FROM hist h JOIN serving s USING (event_id)")
    o["c10_ip_changed"] = q("SELECT event_id, prev_ip, ip_changed FROM hist")
    for key, col in (("c11_ip_hops_30m", "ip_hops_30m"), ("c12_admin_actions_15m", "admin_actions_15m"),
                     ("c13_failed_30m", "failed_30m"), ("c15_events_1h", "events_1h")):
        o[key] = q(f"SELECT h.event_id, h.{col}, s.{col} AS serving_{col} FROM hist h JOIN serving s USING (event_id)")
    o["c14_time_since_last"] = q("SELECT event_id, time_since_last, rapid_succession FROM hist")
    o["c16_role_risk"] = _f("role_risk_score, remote_worker_int")
    o["c17_combinations"] = _f("admin_non_admin_role, high_download_non_dev, geo_not_travel, geo_and_travel")
    o["c18_encoders"] = _f("action_encoded, ip_region_encoded, user_region_encoded, role_encoded")
    o["c18_encoders_unknown"] = q(
        "SELECT event_id, coalesce(code, 0) AS action_encoded, coalesce(code, -1) AS action_or_unknown FROM net_events LEFT JOIN "
        "(SELECT action, row_number() OVER (ORDER BY action) - 1 AS code FROM (SELECT DISTINCT action FROM net_events WHERE "
        "action NOT IN ('admin', 'write'))) USING (action)"
    )
    o["c19_feature_matrix"] = q(f"SELECT event_id, {ALL_FEATURES} FROM feats")
    o["c20_zero_on_error"] = q(
        "SELECT event_id, (k % 10 = 3) AS feature_error, CASE WHEN k % 10 = 3 THEN 0 ELSE data_downloaded_mb END AS data_downloaded_mb, "
        "CASE WHEN k % 10 = 3 THEN 0 ELSE CAST(success_int AS DOUBLE) END AS success_int, "
        "CASE WHEN k % 10 = 3 THEN 0 ELSE CAST(hour AS DOUBLE) END AS hour FROM feats"
    )
    o["c20_error_reasons"] = q(
        "SELECT event_id, k % 20 BETWEEN 1 AND 8 AS feature_error, CASE WHEN k % 20 BETWEEN 1 AND 4 THEN 'login_hour' "
        "WHEN k % 20 BETWEEN 5 AND 8 THEN 'data_downloaded_mb' END AS failed, CASE k % 20 WHEN 1 THEN 'not a value' "
        "WHEN 2 THEN 'out of range' WHEN 3 THEN 'overflow' WHEN 4 THEN 'missing' WHEN 5 THEN 'overflow' WHEN 6 THEN 'out of range' "
        "WHEN 7 THEN 'not a value' WHEN 8 THEN 'missing' END AS reason, "
        "CASE WHEN k % 20 BETWEEN 1 AND 8 THEN 0 ELSE CAST(hour AS DOUBLE) END AS hour, "
        "CASE WHEN k % 20 BETWEEN 1 AND 8 THEN 0 ELSE CAST(login_hour AS DOUBLE) END AS login_hour FROM feats"
    )
    o["c21_features"] = o["c19_feature_matrix"]
    o["c21_features_hot_users"] = o["c19_feature_matrix"]
    serving_cols = ("ip_hops_30m", "admin_actions_15m", "failed_30m", "events_1h")
    replaced = ", ".join(
        f"CAST(s.{c} AS DOUBLE) AS {c}" if c in serving_cols else f"CAST(s.is_first_ip AS DOUBLE) AS {c}" if c == "is_new_ip"
        else f"CAST(f.{c} AS DOUBLE) AS {c}" for c in FEATURE_INTS
    )
    o["c21_features_serving"] = q(
        f"SELECT f.event_id, {replaced}, " + ", ".join(f"round(f.{c}, 6) AS {c}" for c in FEATURE_REALS)
        + " FROM feats f JOIN serving s USING (event_id)"
    )

    # --- joins ---
    o["d1_logs_profiles"] = q("SELECT e.event_id, p.role, p.home_region, p.avg_daily_downloads_mb FROM net_events e LEFT JOIN profiles p USING (user_id)")
    o["d2_profile_defaults"] = q(
        "SELECT e.event_id, coalesce(p.role, 'Sales') AS role, coalesce(p.home_region, e.user_region) AS home_region, "
        "coalesce(p.base_login_hour, 9.0) AS base_login_hour, coalesce(p.login_hour_std_dev, 2.0) AS login_hour_std_dev, "
        "coalesce(p.avg_daily_downloads_mb, 50.0) AS avg_daily_downloads_mb, coalesce(p.remote_worker, FALSE) AS remote_worker, "
        "coalesce(p.is_shift_worker, FALSE) AS is_shift_worker FROM net_events e LEFT JOIN (SELECT * FROM profiles WHERE custkey % 4 <> 1) p USING (user_id)"
    )
    o["d3_first_seen_join"] = q("SELECT event_id, is_new_ip FROM hist")
    o["d4_alert_lookup"] = q("SELECT alert_id, event_id, threat_score, status FROM decided WHERE resolved_us IS NOT NULL")
    o["d5_ledger_profiles"] = q(
        "SELECT p.user_id, CASE WHEN custkey % 2 = 0 AND custkey % 6 <> 0 THEN concat('old ', role) ELSE role END AS role, home_region, "
        "CAST(CASE WHEN custkey % 2 = 0 THEN custkey % 9 ELSE 0 END AS BIGINT) AS rotation_count, "
        "CASE WHEN custkey % 2 = 0 THEN 'active' ELSE 'unknown' END AS status FROM profiles p"
    )
    o["d6_provisioning"] = q(
        "SELECT p.user_id, p.role, p.home_region, CASE WHEN l.user_id IS NULL THEN 'create' WHEN l.role = p.role AND l.home_region = p.home_region "
        "THEN 'skip' ELSE 'update' END AS step FROM profiles p LEFT JOIN old l USING (user_id)", STALE,
    )
    o["d7_not_sent"] = "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"

    # --- aggregates and evaluation ---
    o["e1_metrics"] = q(metrics)
    o["e2_attack_types"] = q("SELECT coalesce(anomaly_type, 'unknown') AS attack_type, count(*) AS n FROM pred WHERE is_threat GROUP BY 1")
    o["e3_threats_by_action"] = q("SELECT threat_action, count(*) AS n FROM pred WHERE is_threat GROUP BY 1")
    o["e4_threats_by_attack"] = q("SELECT anomaly_type AS attack_type, count(*) AS n FROM pred WHERE is_threat GROUP BY 1 ORDER BY n DESC, attack_type LIMIT 20")
    o["e5_index_counts"] = q("SELECT 'audit' AS table_name, count(*) AS rows FROM pred UNION ALL SELECT 'threats', count(*) FROM pred WHERE is_threat UNION ALL SELECT 'documents', count(*) FROM documents")
    o["e6_admin_stats"] = q(
        "SELECT count(*) AS total_alerts_created, count(*) FILTER (status = 'approved') AS total_approved, count(*) FILTER (status = 'rejected') AS total_rejected, "
        "count(*) FILTER (status = 'pending') AS pending_count, count(*) FILTER (status = 'pending' AND threat_action = 'CRITICAL_ALERT') AS critical_pending, "
        "count(*) AS total_alerts, (SELECT count(*) FROM pred WHERE NOT high AND NOT (is_threat AND threat_action = 'MONITOR')) AS total_auto_allowed FROM decided"
    )
    o["e7_auto_allowed"] = q("SELECT count(*) AS total_auto_allowed FROM pred WHERE NOT high AND NOT (is_threat AND threat_action = 'MONITOR')")
    o["e8_health_blocked"] = q("SELECT count(*) FILTER (threat_action IN ('BLOCK', 'CRITICAL_ALERT')) AS total_threats_blocked FROM pred")
    o["e9_threat_level"] = q(
        f"SELECT threats / events * 100 AS threat_percent, {LEVEL} AS threat_level, least(threats / events * 100 * 5, 100.0) AS level_fill "
        "FROM (SELECT count(*) AS events, count(*) FILTER (is_threat) AS threats FROM pred)"
    )
    o["e10_safe_rates"] = q(
        "SELECT (count(*) - count(*) FILTER (is_threat)) / count(*) * 100 AS safe_rate_loaded, count(*) FILTER (NOT is_threat) / count(*) * 100 AS safe_rate_live FROM pred"
    )
    o["e11_offset_lag"] = q("SELECT topic, partition, committed, latest, lag, messages FROM lags", OFFSETS)
    o["e11_running_rows"] = "SELECT CAST(4 AS BIGINT) AS batches, count(*) AS input_rows FROM events"
    o["e11_lag_summary"] = q(
        "SELECT CAST(sum(lag) AS BIGINT) AS total_lag, CAST(sum(messages) AS BIGINT) AS total_messages, count(*) FILTER (lag > 10) AS warned_partitions, "
        "CASE WHEN sum(lag) > 50 THEN 'high' WHEN sum(lag) > 10 THEN 'raised' ELSE 'ok' END AS lag_level FROM lags", OFFSETS,
    )
    o["e12_rotation_counts"] = q("SELECT rotation_type, target, count(*) AS rotation_count FROM rot GROUP BY 1, 2")
    o["e13_first_seen"] = q("SELECT user_id, source_ip, min(us) AS first_seen_us FROM net_events GROUP BY 1, 2")
    o["e14_class_balance"] = q(
        "SELECT CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part, count(*) AS rows, round(avg(CAST(is_injected_anomaly AS INT)), 9) AS anomaly_rate FROM ranked GROUP BY 1", TIME_RANK,
    )
    o["e15_dataset_rows"] = "SELECT 'logs' AS table_name, count(*) AS rows FROM events UNION ALL SELECT 'profiles', count(*) FROM customer"
    o["e16_pr_curve"] = q("SELECT threshold, tp, fp, round(prec, 9) AS precision, round(rec, 9) AS recall, round(f1, 9) AS f1 FROM pr")
    o["e17_best_threshold"] = q("SELECT threshold, tp, fp, round(f1, 9) AS f1 FROM best")
    o["e18_confusion"] = q("SELECT tp, fp, fn, tn FROM cells WHERE model = 'ensemble'")
    o["e19_model_quality"] = q(
        "SELECT model, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(p, 9) AS precision, round(r, 9) AS recall, "
        "round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1 FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, "
        "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM cells)"
    )
    o["e20_roc_auc"] = q(
        "SELECT model, round((sum(CASE WHEN y = 1 THEN mid END) - sum(y) * (sum(y) + 1) / 2.0e0) / (sum(y) * (count(*) - sum(y))), 9) AS roc_auc FROM "
        "(SELECT model, y, r0 + (c - 1) / 2.0e0 AS mid FROM (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY score) AS r0, "
        "count(*) OVER (PARTITION BY model, score) AS c FROM members)) GROUP BY model"
    )
    o["e21_class_report"] = q(
        "SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, CAST(support AS BIGINT) AS support FROM rep", CLASS_OF,
    )
    o["e22_windowed_metrics"] = q(
        "SELECT us - us % 300000000 AS window_us, count(*) AS total_events, count(*) FILTER (threat_action IN ('BLOCK', 'CRITICAL_ALERT')) AS blocked_events, "
        "count(*) FILTER (threat_action = 'MONITOR') AS monitored_events, count(*) FILTER (threat_action = 'ALLOW') AS allowed_events, "
        "round(sum(latency_ms) / count(*), 2) AS avg_latency, count(DISTINCT CASE WHEN high THEN user_id END) AS high_risk_users FROM pred GROUP BY 1"
    )

    # --- lists, splits, windows ---
    o["g1_alerts_filtered"] = q("SELECT alert_id, event_id, threat_action, status, created_us FROM decided WHERE status = 'pending' ORDER BY created_us DESC, alert_id DESC LIMIT 100")
    o["g1_alerts_critical"] = q("SELECT alert_id, event_id, threat_action, status FROM decided WHERE threat_action = 'CRITICAL_ALERT' ORDER BY created_us DESC, alert_id DESC LIMIT 100")
    o["g2_audit_log"] = q("SELECT alert_id, CASE status WHEN 'approved' THEN 'approve' ELSE 'reject' END AS action, user_id, threat_score, resolved_us AS at_us, admin_notes FROM decided WHERE status <> 'pending' ORDER BY resolved_us DESC, alert_id DESC LIMIT 50")
    o["g3_recent_threats"] = q("SELECT event_id, threat_action, threat_score, user_id AS user_name FROM pred WHERE is_threat ORDER BY us DESC, event_id DESC LIMIT 20")
    o["g4_users_by"] = q("SELECT user_id, role, home_region FROM profiles WHERE lower(role) = 'developer' AND lower(home_region) = 'us-east'")
    o["g5_search_users"] = q("SELECT user_id, role, status FROM uledger WHERE contains(lower(user_id), 'usr-0000') AND role = 'Sales' AND status = 'rotated'")
    o["g6_latest_rotated"] = q("SELECT user_id, role, rotation_count, last_rotation_reason, created_us FROM uledger WHERE status = 'rotated' ORDER BY created_us DESC, user_id LIMIT 1")
    o["g7_threat_feed"] = q(
        "SELECT event_id, CASE WHEN threat_score > 0.9 THEN 'critical' ELSE 'high' END AS severity, CASE WHEN anomaly_type = 'None' THEN 'BLOCK' ELSE anomaly_type END AS label, "
        "user_id AS user_name, source_ip, " + pct("threat_score") + " AS score_pct FROM (SELECT * FROM pred WHERE is_threat ORDER BY us DESC, event_id DESC LIMIT 20)"
    )
    o["g7_feed_kept"] = o["g7_threat_feed"].replace("LIMIT 20", "LIMIT 30")
    o["g8_globe_points"] = q(
        "SELECT NULL AS event_id, 12.97e0 AS lat, 77.59e0 AS lng, FALSE AS is_threat, TRUE AS is_server UNION ALL "
        "SELECT event_id, coalesce(src_lat, 0), coalesce(src_lng, 0), is_threat, FALSE FROM "
        f"(SELECT e.*, {SRC_GEO}, {DST_GEO} FROM (SELECT * FROM pred ORDER BY us DESC, event_id DESC LIMIT 99) e {GEO_JOIN})")
    o["g8_log_rows"] = q(
        "SELECT event_id, threat_action, user_id AS user_name, source_ip, " + pct("threat_score")
        + " AS score_pct FROM (SELECT * FROM pred ORDER BY us DESC, event_id DESC LIMIT 50)")
    o["f9_no_bundle"] = q(
        "SELECT event_id, FALSE AS is_threat, 0.0e0 AS threat_score, 0.5e0 AS threshold, 'ALLOW' AS threat_action, 'skipped' AS rotation_status, "
        "CAST(1 AS INT) AS n_workflows FROM net_events")
    o["g8_newest_arcs"] = q("SELECT event_id, is_threat, threat_score FROM pred ORDER BY us DESC, event_id DESC LIMIT 80")
    o["g9_sorted"] = q("SELECT event_id, user_id, us AS event_us FROM net_events")
    o["g10_batches"] = q("SELECT workspace_id, count(*) AS events, count(*) <= 100 AS accepted FROM net_events GROUP BY 1")
    o["g11_high_severity"] = q("SELECT event_id, threat_action, threat_score FROM pred WHERE high")
    o["g12_split_time"] = q("SELECT event_id, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM ranked", TIME_RANK)
    timeless = """
timed AS (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN us END AS us FROM net_events),
placed AS (SELECT *, row_number() OVER (ORDER BY us NULLS LAST, event_id) AS rn, CAST(floor(count(*) OVER () * 0.8) AS BIGINT) AS cut,
  row_number() OVER (ORDER BY user_id, us NULLS LAST, event_id) AS rn_user FROM timed)"""
    o["g12_split_null_times"] = q("SELECT event_id, CASE WHEN rn <= cut AND us IS NOT NULL THEN 'train' ELSE 'test' END AS part FROM placed", timeless)
    o["g12_split_user_null_times"] = q(
        "SELECT event_id, CASE WHEN rn_user <= cut AND (us IS NOT NULL OR user_id < (SELECT user_id FROM placed WHERE rn_user = cut)) "
        "THEN 'train' ELSE 'test' END AS part FROM placed", timeless)
    o["g12_split_user_order"] = q("SELECT event_id, CASE WHEN rn_user <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM ranked", TIME_RANK)
    o["w1_prev_ip"] = q("SELECT event_id, prev_ip FROM hist")
    o["w2_time_gap"] = q("SELECT event_id, time_since_last FROM hist")
    for key, cols in (("w3_rolling_15m", "admin_actions_15m"), ("w4_rolling_30m", "ip_hops_30m, failed_30m"), ("w5_rolling_60m", "events_1h"),
                      ("w6_first_seen", "is_new_ip")):
        o[key] = q(f"SELECT event_id, {cols} FROM hist")
    o["w7_first_ip"] = q("SELECT event_id, is_first_ip FROM serving")
    o["w8_capped_counters"] = q("SELECT event_id, ip_hops_30m, admin_actions_15m, failed_30m, events_1h FROM serving")
    o["w8_capped_hot_users"] = q("SELECT event_id, is_first_ip, ip_hops_30m, admin_actions_15m, failed_30m, events_1h, time_since_last FROM serving")
    o["w4_rolling_hot_users"] = q(f"SELECT {_ROLL_COLS} FROM hist")
    o["w9_rotation_number"] = q("SELECT rotation_id, row_number() OVER (PARTITION BY rotation_type, target ORDER BY at_us, rotation_id) AS rotation_number FROM rot")
    o["w10_previous_lease"] = q("SELECT lease_id, lag(lease_id) OVER (PARTITION BY service ORDER BY issued_us, lease_id) AS previous_lease FROM leases")
    o["w11_running_level"] = q(f"SELECT event_id, event_us, events, threats, round(threats / events * 100, 9) AS threat_percent, {LEVEL} AS threat_level FROM run", RUNNING)
    o["w11_level_by_hour"] = q(
        f"SELECT bucket_us, events, threats, round(threats / events * 100, 9) AS threat_percent, {LEVEL} AS threat_level FROM (SELECT bucket_us, CAST(sum(n) OVER w AS BIGINT) AS events, CAST(sum(t) OVER w AS BIGINT) AS threats "
        "FROM (SELECT us - us % 3600000000 AS bucket_us, count(*) AS n, count(*) FILTER (is_threat) AS t FROM pred GROUP BY 1) WINDOW w AS (ORDER BY bucket_us))"
    )

    # --- scoring and response ---
    dropped = (
        "action,anomaly_type,avg_daily_downloads_mb,base_login_hour,event_flag,event_id,failed_action,geo_mismatch,"
        "home_region,impossible_travel,ip_changed,ip_region,is_admin_action,is_injected_anomaly,is_shift_worker,"
        "login_hour_std_dev,prev_ip,remote_worker,role,source_ip,success,timestamp,user_id,user_region,"
        "workspace_id")
    o["f1_feature_columns"] = q(
        f"SELECT event_id, CAST(is_injected_anomaly AS INT) AS label, '{dropped}' AS dropped, {ALL_FEATURES} FROM feats")
    o["f3_f6_facts"] = (
        "SELECT unnest(['xgb', 'lgbm', 'rf', 'gb', 'ensemble']) AS model, CAST(count(*) - floor(count(*) * 0.8) AS BIGINT) AS rows, "
        "CAST(0 AS BIGINT) AS outside, TRUE AS better, 1.0e0 AS weights FROM events")
    from checks.training_queries import LEAF_FEATURES, SPLIT_FEATURES

    def gradients(p, w, features):
        """Views of one row per event and feature, with first and second derivatives at the starting score."""
        numbers = ", ".join(f"CAST(f.{c} AS DOUBLE)" for c in features)
        names = ", ".join(f"'{c}'" for c in features)
        return (
            "marked AS (SELECT f.event_id, CAST(e.is_injected_anomaly AS INT) AS y, [" + numbers + "] AS vs FROM feats f JOIN net_events e USING (event_id))",
            f"odds AS (SELECT {p} AS p, {w} AS w FROM (SELECT CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM marked))",
            "slopes AS (SELECT event_id, vs, CASE WHEN y = 1 THEN w ELSE 1 END * (p - y) AS g, CASE WHEN y = 1 THEN w ELSE 1 END * p * (1 - p) AS h FROM marked, odds)",
            f"slope_cells AS (SELECT event_id, g, h, unnest(vs) AS v, unnest([{names}]) AS feature, unnest(range({len(features)})) AS f FROM slopes)",
        )

    def pulled(g, h):
        return f"(pow(greatest(abs({g}) - 0.1e0, 0), 2) / ({h} + 1))"

    def best(name, nodes, hessian, rows):
        """View of the best split of each node of ``nodes`` (node, event_id)."""
        return (
            f"{name}_bins AS (SELECT node, f, feature, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM slope_cells JOIN {nodes} USING (event_id) GROUP BY ALL)",
            f"{name}_cuts AS (SELECT node, f, feature, v, sum(g) OVER w AS g, sum(h) OVER w AS h, sum(n) OVER w AS n, sum(g) OVER a AS ga, sum(h) OVER a AS ha, sum(n) OVER a AS na "
            f"FROM {name}_bins WINDOW w AS (PARTITION BY node, f ORDER BY v ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY node, f))",
            f"{name} AS (SELECT * FROM (SELECT *, {pulled('g', 'h')} + {pulled('(ga - g)', '(ha - h)')} - {pulled('ga', 'ha')} AS gain FROM {name}_cuts "
            f"WHERE h >= {hessian} AND ha - h >= {hessian} AND n >= {rows} AND na - n >= {rows}) WHERE gain > 0.000001 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 5) DESC, f, v) = 1)",
        )

    def leaf(g, h):
        return f"round(-sign({g}) * greatest(abs({g}) - 0.1e0, 0) / ({h} + 1), 4)"

    everything = "everything AS (SELECT 0 AS node, event_id FROM marked)"
    o["f3_first_split"] = q(
        f"SELECT 1 AS nr, feature, v AS threshold, round(gain, 2) AS gain, {leaf('g', 'h')} AS left_value, {leaf('(ga - g)', '(ha - h)')} AS right_value FROM root",
        *gradients("0.5e0", "neg / pos", SPLIT_FEATURES), everything, *best("root", "everything", 3, 1))
    o["f4_leaf_order"] = q(
        "SELECT 1 AS nr, feature, v AS threshold, round(gain, 2) AS gain FROM root UNION ALL "
        "SELECT 2, feature, v, round(gain, 2) FROM (SELECT * FROM lower_ ORDER BY gain DESC LIMIT 1)",
        *gradients("pos / (pos + neg)", "neg / pos", LEAF_FEATURES), everything, *best("root", "everything", 0.001, 10),
        "halves AS (SELECT CASE WHEN c.v <= r.v THEN 1 ELSE 2 END AS node, event_id FROM slope_cells c JOIN root r USING (f))", *best("lower_", "halves", 0.001, 10))
    o["f7_ensemble"] = q("SELECT event_id, round(s, 9) AS ensemble FROM pred")
    o["f8_is_threat"] = q("SELECT event_id, is_threat FROM pred")
    o["f9_without_model"] = q("SELECT event_id, FALSE AS is_threat, 0.0e0 AS ensemble_score, 0.0e0 AS xgb_score, 0.0e0 AS lgbm_score, 0.5e0 AS threshold, 'ALLOW' AS threat_action FROM net_events")
    o["f10_actions"] = q("SELECT threat_action, count(*) AS n, CAST(sum(CASE WHEN is_injected_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomalies FROM pred GROUP BY 1")
    o["f11_affected_service"] = q("SELECT event_id, service_at_risk AS service FROM pred")
    o["f12_rotation_plan"] = q(
        f"SELECT event_id, {PLAN_STATUS} AS status, high AS user_rotation, high AND threat_action = 'CRITICAL_ALERT' AS infra_rotation, "
        "CASE WHEN high AND threat_action = 'CRITICAL_ALERT' THEN service_at_risk END AS affected_service, "
        "CASE WHEN high AND threat_action = 'CRITICAL_ALERT' THEN 'CRITICAL_ALERT: both user and infrastructure credentials will be rotated on admin approval' "
        "WHEN high THEN 'BLOCK: user credentials will be rotated on admin approval' "
        "WHEN is_threat AND threat_action = 'MONITOR' THEN 'MONITOR-level threat: logged for observation, no rotation triggered' END AS reason FROM pred"
    )
    o["f13_rotation_status"] = q(f"SELECT event_id, {ROTATION_STATUS} AS rotation_status FROM pred")
    o["f14_workflows"] = q("SELECT event_id, name, 'triggered' AS status, priority FROM flows", FLOWS)
    o["f15_distribution"] = q(
        "SELECT event_id, target, 'push' AS method, 'TLS 1.3' AS encryption FROM pred, (SELECT unnest(['database-cluster', 'api-gateway', 'service-mesh', 'load-balancer']) AS target) WHERE is_threat"
    )
    prediction = (
        f"SELECT event_id, is_threat, threat_score, threat_action, xgb_score, lgbm_score, {FLOW_COUNT} AS n_workflows, {PLAN_STATUS} AS plan_status, "
        f"{ROTATION_STATUS} AS rotation_status, src_lat, src_city, dst_lat, dst_city, CASE WHEN is_threat THEN concat('INC-', upper(left(sha256(CAST(event_id AS VARCHAR)), 32))) END AS incident_id, "
        f"user_id AS user_name, us AS event_us FROM (SELECT e.*, {SRC_GEO}, {DST_GEO} FROM pred e {GEO_JOIN})"
    )
    o["f16_predict"] = q(prediction)
    o["f17_predict_batch"] = o["f16_predict"]

    vector = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in FEATURE_INTS + FEATURE_REALS) + "]"
    o["f2_neighbours"] = q(
        "SELECT id, nr, round(distance, 3) AS distance FROM (SELECT a.id, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v)) AS nr, "
        "list_distance(a.v, b.v) AS distance FROM minority a JOIN minority b ON a.id <> b.id) WHERE nr <= 5",
        f"\nminority AS MATERIALIZED (SELECT CAST(event_id AS VARCHAR) AS id, {vector} AS v FROM feats WHERE is_injected_anomaly)",
    )
    o["f2_smote"] = (
        "SELECT 0 AS label, count(*) AS n, 0 AS outside FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) < 95 UNION ALL "
        "SELECT 1, CAST(floor(0.3 * count(*)) AS BIGINT), 0 FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) < 95"
    )
    o["a18_bundle_reload"] = "SELECT count(*) - CAST(floor(count(*) * 0.8) AS BIGINT) AS rows, 0 AS different FROM events"

    # --- ledger ---
    o["h1_created_alerts"] = q("SELECT alert_id, event_id, user_id, created_us, threat_score, threat_action FROM alerts")
    o["h2_first_decisions"] = q("SELECT alert_id, CASE status WHEN 'approved' THEN 'approve' ELSE 'reject' END AS decision, resolved_us AS at_us FROM decided WHERE status <> 'pending'")
    o["h3_current_alerts"] = q("SELECT alert_id, status, resolved_us, admin_notes, threat_action FROM decided")
    o["h3_ledger_stream"] = o["h3_ledger_start"] = o["h3_current_alerts"]
    o["h4_audit_rows"] = q("SELECT alert_id, CASE status WHEN 'approved' THEN 'approve' ELSE 'reject' END AS action, user_id, threat_score, resolved_us AS at_us, admin_notes FROM decided WHERE status <> 'pending'")
    o["h5_rotations"] = q("SELECT rotation_id, alert_id, rotation_type, target, reason, at_us, trigger_score, TRUE AS success FROM rot")
    o["h5_rotations_stream"] = o["h5_rotations"]
    o["h6_rotation_result"] = q(
        "SELECT alert_id, user_id AS rotated_user, CASE WHEN threat_action = 'CRITICAL_ALERT' THEN service_at_risk END AS affected_service, threat_action, threat_action = 'CRITICAL_ALERT' AS has_infra FROM decided WHERE status = 'approved'"
    )
    o["h7_user_ledger"] = q("SELECT * FROM uledger")
    o["h8_active_leases"] = q(
        "SELECT service, lease_id, username, issued_us, expires_us, rotation_reason, greatest((expires_us - moment) // 1000000, 0) AS seconds_remaining, (expires_us - moment) // 1000000 <= 0 AS expired FROM "
        "(SELECT *, epoch_us(TIMESTAMP '2024-01-30 12:00:00') AS moment, row_number() OVER (PARTITION BY service ORDER BY issued_us DESC, lease_id DESC) AS rn FROM leases "
        "WHERE issued_us <= epoch_us(TIMESTAMP '2024-01-30 12:00:00')) WHERE rn = 1"
    )
    o["h9_revocations"] = q(
        "SELECT service, lease_id, lag(lease_id) OVER w AS previous_lease, lead(issued_us) OVER w IS NOT NULL AS revoked, lead(issued_us) OVER w AS revoked_us FROM leases WINDOW w AS (PARTITION BY service ORDER BY issued_us, lease_id)"
    )
    o["h10_service_routes"] = q(
        "SELECT target AS service, CASE WHEN target = 'kafka' THEN 'vault_kv_rotation' ELSE 'vault_database_engine' END AS mechanism, "
        "CASE WHEN target <> 'kafka' THEN 'backend-role' END AS role, count(*) AS rotations FROM rot WHERE rotation_type = 'infrastructure' GROUP BY 1, 2, 3"
    )
    o["h11_approval_message"] = q(
        "SELECT alert_id, concat('User credentials rotated for ', user_id, '.', CASE WHEN threat_action <> 'CRITICAL_ALERT' THEN '' WHEN service_at_risk = 'kafka' THEN ' Kafka credentials rotated in Vault and reconnected.' "
        "ELSE concat(' Infrastructure credentials rotated for ''', service_at_risk, '''.') END) AS message FROM decided WHERE status = 'approved'"
    )
    o["h11_decision_answers"] = q(
        "SELECT decision_id, alert_id, success, message FROM ("
        "SELECT concat(CAST(event_id AS VARCHAR), '-1') AS decision_id, alert_id, TRUE AS success, concat('Alert ', status) AS message FROM decided WHERE status <> 'pending' UNION ALL "
        "SELECT concat(CAST(event_id AS VARCHAR), '-2'), alert_id, FALSE, concat('Alert already resolved as: ', status) FROM decided WHERE status <> 'pending' AND event_id % 6 = 0)"
    )

    # --- streams that must equal the batch ---
    o["s1_scored_stream"] = q("SELECT CAST(event_id AS VARCHAR) AS event_id, is_threat, threat_action, threat_score FROM pred")
    o["s2_serving_state"] = q("SELECT CAST(event_id AS VARCHAR) AS event_id, is_first_ip, ip_hops_30m, admin_actions_15m, failed_30m, events_1h, time_since_last, rapid_succession FROM serving")
    o["s3_exact_state"] = q("SELECT CAST(event_id AS VARCHAR) AS event_id, is_new_ip, ip_hops_30m, admin_actions_15m, failed_30m, events_1h, time_since_last, rapid_succession FROM hist")
    o["s2_history_start"], o["s3_history_start"] = o["s2_serving_state"], o["s3_exact_state"]
    o["s4_late_rows"] = q(
        "SELECT a.event_id, coalesce(a.us <= (SELECT max(b.us) FROM arr b WHERE b.batch < 3) // 1000 * 1000 - 600000000, FALSE) AND a.batch = 3 AS late FROM arr a",
        "\narr AS MATERIALIZED (SELECT event_id, us, CASE WHEN k % 10 = 0 THEN 3 ELSE CAST(floor(event_id * 4 / (max(event_id) OVER () + 1)) AS INT) END AS batch FROM net_events)",
    )
    o["s4_intake"] = q(
        "SELECT place, count(*) AS n FROM (SELECT CASE WHEN k % 20 = 7 THEN 'poison' WHEN k % 20 = 3 THEN 'blank' WHEN k % 20 = 5 THEN 'timeless' "
        "WHEN batch = 3 AND us <= (SELECT max(b.us) FROM arr b WHERE b.batch < 3 AND k % 20 NOT IN (3, 5, 7)) // 1000 * 1000 - 600000000 "
        "THEN 'late' ELSE 'scored' END AS place FROM arr) GROUP BY 1",
        "\narr AS MATERIALIZED (SELECT event_id, us, k, CASE WHEN k % 10 = 0 THEN 3 ELSE CAST(floor(event_id * 4 / (max(event_id) OVER () + 1)) AS INT) END AS batch FROM net_events)",
    )
    o["s5_bridge_stream"] = q("SELECT DISTINCT source_ip AS _es_id FROM net_events")
    o["s6_incremental_metrics"] = q(metrics)
    o["s7_fan_out"] = q("SELECT 'events' AS channel, count(*) AS n FROM pred UNION ALL SELECT 'alerts', count(*) FROM pred WHERE is_threat")
    o["s8_poison_messages"] = q("SELECT count(*) FILTER (k % 20 <> 7) AS good, count(*) FILTER (k % 20 = 7) AS poison FROM net_events")
    o["s9_resume"] = q("SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(1 AS BIGINT) AS times FROM net_events")
    o["s10_windowed_stream"] = o["e22_windowed_metrics"]
    return o
