"""Filtered and newest-first lists."""

from pyspark.sql import Column, DataFrame, functions as F

from watchmill import fixed_values as V
from watchmill.functions import decision as D
from watchmill.operators.report import newest


def severity_filter(severity: str | None, action: Column) -> Column:
    wanted = {"critical": ["CRITICAL_ALERT"], "high": ["BLOCK", "CRITICAL_ALERT"], "medium": ["MONITOR"]}
    return action.isin(wanted[severity]) if severity in wanted else F.lit(True)


def alert_list(
    alerts: DataFrame, status: str | None = None, severity: str | None = None, limit: int = V.ALERT_LIST
) -> DataFrame:
    kept = alerts.filter(severity_filter(severity, F.col("threat_action")))
    if status:
        kept = kept.filter(F.col("status") == status)
    return newest(kept, "created_us", limit, "alert_id")


def audit_list(audit: DataFrame, limit: int = V.AUDIT_LIST) -> DataFrame:
    return newest(audit, "at_us", limit, "alert_id")


def recent_threats(threats: DataFrame, limit: int = V.RECENT_THREATS) -> DataFrame:
    return newest(threats, "event_time", limit)


def users_by(users: DataFrame, role: str | None = None, region: str | None = None) -> DataFrame:
    if role:
        users = users.filter(F.lower("role") == role.lower())
    if region:
        users = users.filter(F.lower("home_region") == region.lower())
    return users


def search_users(users: DataFrame, text: str = "", role: str = "", status: str = "") -> DataFrame:
    if text:
        users = users.filter(F.contains(F.lower("user_id"), F.lit(text.lower())))
    if role:
        users = users.filter(F.col("role") == role)
    if status:
        users = users.filter(F.col("status") == status)
    return users


def high_severity(pred: DataFrame) -> DataFrame:
    return pred.filter(D.is_high_severity(F.col("is_threat"), F.col("threat_action")))


def by_user_and_time(df: DataFrame) -> DataFrame:
    return df.orderBy("user_id", "timestamp", "event_id")


def by_time(df: DataFrame) -> DataFrame:
    return df.orderBy("timestamp", "event_id")


def check_batch(events: DataFrame, limit: int = V.BATCH_LIMIT) -> DataFrame:
    """A request may hold at most ``limit`` events; looks at ``limit + 1`` rows at most."""
    if events.limit(limit + 1).count() > limit:
        raise ValueError(f"a batch may hold at most {limit} events")
    return events


def batch_admission(events: DataFrame, batch: str, limit: int = V.BATCH_LIMIT) -> DataFrame:
    """The same rule for many batches at once."""
    sizes = events.groupBy(batch).agg(F.count("*").alias("events"))
    return sizes.withColumn("accepted", F.col("events") <= limit)
