"""These must equal the ones of the system whose results are matched."""

# --- score cut-offs, member weights, default threshold -----------------------
ALLOW_BELOW = 0.3
MONITOR_BELOW = 0.6
BLOCK_BELOW = 0.85
MEMBER_WEIGHTS = {"xgb": 0.35, "lgbm": 0.30, "rf": 0.20, "gb": 0.15}
DEFAULT_THRESHOLD = 0.5
ISOLATE_ABOVE = 0.9

# --- defaults of a network event ---------------------------------------------
EVENT_DEFAULTS = {
    "event_id": "",
    "timestamp": None,
    "login_hour": 0,
    "user_id": "",
    "workspace_id": "",
    "source_ip": "",
    "ip_region": "",
    "user_region": "",
    "geo_mismatch": False,
    "impossible_travel": False,
    "action": "",
    "success": True,
    "failed_attempts_last_15m": 0,
    "data_downloaded_mb": 0.0,
    "role": "",
    "remote_worker": False,
    "base_login_hour": 9.0,
    "login_hour_std_dev": 2.0,
    "avg_daily_downloads_mb": 50.0,
    "home_region": "",
    "is_shift_worker": False,
    "clumsiness_factor": 0.0,
    "is_injected_anomaly": False,
    "anomaly_type": "None",
}

# --- defaults of a user profile when the user is unknown ---------------------
PROFILE_DEFAULTS = {
    "role": "Sales",
    "base_login_hour": 9.0,
    "login_hour_std_dev": 2.0,
    "avg_daily_downloads_mb": 50.0,
    "remote_worker": False,
    "is_shift_worker": False,
}

# --- feature constants --------------------------------------------------------
ROLE_RISK = {"Admin": 4, "Developer": 3, "Finance": 2, "HR": 1, "Sales": 1}
TECH_ROLES = ["Admin", "Developer"]
ENCODED_COLUMNS = ["action", "ip_region", "user_region", "role"]
# no features
DROPPED_COLUMNS = [
    "event_id", "timestamp", "user_id", "workspace_id", "source_ip",
    "is_injected_anomaly", "anomaly_type", "first_seen_ip", "prev_ip",
    "geo_mismatch", "impossible_travel", "success", "remote_worker",
    "action", "ip_region", "user_region", "role",
    "base_login_hour", "login_hour_std_dev", "avg_daily_downloads_mb",
    "clumsiness_factor", "num_known_devices",
    "event_flag", "ip_changed", "is_admin_action", "failed_action",
    "home_region", "travel_probability", "is_shift_worker",
]
HOPS_SECONDS = 30 * 60
ADMIN_SECONDS = 15 * 60
FAILED_SECONDS = 30 * 60
EVENTS_SECONDS = 60 * 60
HOPS_CAP = 10
ADMIN_CAP = 20
FAILED_CAP = 20
EVENTS_CAP = 100

# --- regions ------------------------------------------------------------------
REGION_GEO = {
    "US-East": (40.71, -74.01, "New York"),
    "US-West": (37.77, -122.42, "San Francisco"),
    "EU-Central": (50.11, 8.68, "Frankfurt"),
    "Asia-Pacific": (1.35, 103.82, "Singapore"),
    "South-America": (-23.55, -46.63, "São Paulo"),
}
SERVER_GEO = (12.97, 77.59, "Bangalore")
NO_GEO = (0.0, 0.0, "Unknown")

# --- connection records -------------------------------------------------------
CONN_FIELDS = [
    "ts", "uid", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "proto", "service", "duration",
    "orig_bytes", "resp_bytes", "conn_state", "local_orig", "local_resp", "missed_bytes", "history",
    "orig_pkts", "orig_ip_bytes", "resp_pkts", "resp_ip_bytes",
]
CONN_TYPES = [
    "double", "string", "addr", "port", "addr", "port", "string", "string", "double", "count", "count",
    "string", "bool", "bool", "count", "string", "count", "count", "count", "count",
]
ACTION_SERVICE = {"read": "http", "write": "http", "delete": "http", "admin": "ssh"}
SSH_PORT = 22
OTHER_PORT = 80
FIRST_CLIENT_PORT = 49152
CLIENT_PORTS = 1000
MORE_CLIENT_PORTS = 16384
SERVER_NET = "192.168.0."
SERVER_HOST_BASE = 100
SECONDS_PER_MB = 0.15
SHORTEST_CONN = 0.01
LONGEST_CONN = 3600.0
BYTES_PER_MB = 1024 * 1024
RESPONSE_SHARE = 0.2
PACKET_BYTES = 1500
CONN_TAGS = {"event_module": "zeek", "event_dataset": "zeek.conn", "event_kind": "event"}
REPLAY_TAGS = {**CONN_TAGS, "pipeline_source": "live-replay"}
DIRECT_TAGS = {**REPLAY_TAGS, "pipeline_output": "kafka-direct"}

# --- host records ---------------------------------------------------------------
SUSPICIOUS_WORDS = [
    "powershell", "mimikatz", "net user", "whoami", "lateral", "domain_controller", "psexec", "wmic", "certutil",
]
SUSPICIOUS_MESSAGE = "ET POLICY Suspicious Process Activity Detected"
PROCESS_SERVICE = {
    "chrome": "http", "firefox": "http", "edge": "http", "outlook": "smtp", "thunderbird": "smtp",
    "powershell": "smb", "cmd": "smb", "ssh": "ssh", "sshd": "ssh", "dns": "dns", "nslookup": "dns",
}
EVENT_CATEGORY = {
    "network_connection": "network",
    "process_start": "process",
    "file_access": "file",
    "authentication": "authentication",
    "dns_query": "network",
    "registry_change": "configuration",
}
AGENT_TYPE = "filebeat"
AGENT_VERSION = "8.15.0"
ECS_VERSION = "8.0"
HOST_OS = "Windows Server 2022"

# --- response -------------------------------------------------------------------
THREAT_WORKFLOWS = [
    ("threat_investigation", "triggered", "high"),
    ("credential_rotation", "triggered", "critical"),
    ("incident_notification", "triggered", "high"),
    ("forensic_snapshot", "triggered", "medium"),
]
ISOLATION_WORKFLOW = ("network_isolation", "triggered", "critical")
CALM_WORKFLOW = ("baseline_update", "triggered", "low")
DISTRIBUTION_TARGETS = ["database-cluster", "api-gateway", "service-mesh", "load-balancer"]
DISTRIBUTION_METHOD = "push"
DISTRIBUTION_ENCRYPTION = "TLS 1.3"
EXFILTRATION = ["data_exfiltration", "bulk_download"]
MOVEMENT = ["lateral_movement", "privilege_escalation"]
CRITICAL_PLAN_REASON = "CRITICAL_ALERT: both user and infrastructure credentials will be rotated on admin approval"
BLOCK_PLAN_REASON = "BLOCK: user credentials will be rotated on admin approval"
MONITOR_MESSAGE = "MONITOR-level threat: logged for observation, no rotation triggered"
INFRA_ROLES = {
    "backend": "backend-role",
    "database": "backend-role",
    "elasticsearch": "backend-role",
    "readonly": "readonly-role",
}
OTHER_INFRA_ROLE = "backend-role"
LEASE_SECONDS = {"backend-role": 3600, "readonly-role": 1800}

# --- lists and reports ----------------------------------------------------------
BATCH_LIMIT = 100
ALERT_LIST = 100
AUDIT_LIST = 50
RECENT_THREATS = 20
ATTACK_BUCKETS = 20
FEED_KEPT = 30
ARCS_KEPT = 80
POINTS_KEPT = 100
LOG_KEPT = 50
LAG_HIGH = 50
LAG_RAISED = 10
LEVEL_CRITICAL_PERCENT = 10
LEVEL_ELEVATED_PERCENT = 5
REASON_CHARS = 25

# --- training ---------------------------------------------------------------------
SPLIT_RATIO = 0.80
SMOTE_RATIO = 0.3
SEED = 42
F1_EPSILON = 1e-8
