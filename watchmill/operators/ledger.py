"""Alerts as an append-only log: created events and decisions, folded into the current state."""

from pyspark.sql import Column, DataFrame, functions as F

from watchmill.functions import decision as D
from watchmill.functions.display import infra_reason, rotation_reason
from watchmill.operators.lists import high_severity


def event_data(df: DataFrame) -> Column:
    """What an alert keeps of its event."""
    names = [
        "source_ip", "ip_region", "action", "anomaly_type", "geo_mismatch", "login_hour", "failed_attempts_last_15m",
        "data_downloaded_mb", "impossible_travel",
    ]
    return F.struct(F.col("user_id").alias("user"), *names)


def create_alerts(pred: DataFrame) -> DataFrame:
    """One pending alert per high-severity prediction; the id follows from the event, so retries repeat it."""
    return high_severity(pred).select(
        D.alert_id(F.col("event_id")).alias("alert_id"),
        "event_id",
        "user_id",
        F.unix_micros("timestamp").alias("created_us"),
        "threat_score",
        "threat_action",
        "xgb_score",
        "lgbm_score",
        "ensemble_score",
        "anomaly_type",
        "action",
        event_data(pred).alias("event_data"),
    )


def first_decisions(decisions: DataFrame) -> DataFrame:
    """The first decision per alert; later ones have no effect.

    An aggregate, not a window: repeated decisions are combined before the shuffle.
    """
    chosen = F.min_by(F.struct("decision", "at_us", "admin_notes", "decision_id"), F.struct("at_us", "decision_id"))
    return decisions.groupBy("alert_id").agg(chosen.alias("d")).select("alert_id", "d.*")


def status_of(decision: str) -> Column:
    """What an alert with this first decision is."""
    return F.when(F.col(decision) == "approve", "approved").when(F.col(decision) == "reject", "rejected").otherwise("pending")


def current_alerts(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    return alerts.join(first_decisions(decisions), "alert_id", "left").select(
        *alerts.columns,
        status_of("decision").alias("status"),
        F.col("at_us").alias("resolved_us"),
        F.coalesce("admin_notes", F.lit("")).alias("admin_notes"),
    )


def audit_log(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row per decision that had an effect."""
    return first_decisions(decisions).join(alerts, "alert_id").select(
        F.col("decision").alias("action"), "alert_id", "user_id", "threat_score", "at_us", "admin_notes"
    )


def alert_by_id(alerts: DataFrame, ids: DataFrame) -> DataFrame:
    return alerts.join(ids, "alert_id")


def admin_stats(current: DataFrame, auto_allowed: DataFrame) -> DataFrame:
    """Both inputs are aggregated to one row and stacked, so nothing is joined."""
    zero = F.lit(0).cast("bigint")
    pending = F.col("status") == "pending"
    alerts = current.agg(
        F.count("*").alias("total_alerts_created"),
        F.count_if(F.col("status") == "approved").alias("total_approved"),
        F.count_if(F.col("status") == "rejected").alias("total_rejected"),
        F.count_if(pending).alias("pending_count"),
        F.count_if(pending & (F.col("threat_action") == "CRITICAL_ALERT")).alias("critical_pending"),
        F.count("*").alias("total_alerts"),
    ).withColumn("total_auto_allowed", zero)
    free = auto_allowed.select(*[
        F.col(c) if c == "total_auto_allowed" else zero.alias(c) for c in alerts.columns
    ])
    return alerts.unionByName(free).agg(*[F.sum(c).alias(c) for c in alerts.columns])


def rotations(current: DataFrame) -> DataFrame:
    """Rotations that approvals lead to: the user always, the service at risk for a critical alert."""
    score = F.col("threat_score")
    critical = F.col("threat_action") == "CRITICAL_ALERT"
    user = F.struct(
        F.lit("user").alias("rotation_type"), F.col("user_id").alias("target"),
        rotation_reason(F.col("threat_action"), score).alias("reason"),
    )
    infra = F.struct(
        F.lit("infrastructure").alias("rotation_type"),
        D.affected_service(F.col("anomaly_type"), F.col("action")).alias("target"),
        infra_reason(score).alias("reason"),
    )
    both = F.when(critical, F.array(user, infra)).otherwise(F.array(user))
    rows = current.filter(F.col("status") == "approved").withColumn("r", F.explode(both))
    return rows.select(
        F.sha2(F.concat_ws("|", "alert_id", "r.rotation_type"), 256).alias("rotation_id"),
        "alert_id", "r.rotation_type", "r.target", "r.reason",
        F.col("resolved_us").alias("at_us"), score.alias("trigger_score"), F.lit(True).alias("success"),
    )


def rotation_results(current: DataFrame) -> DataFrame:
    """Approved alerts with what their approval did, in one struct."""
    critical = F.col("threat_action") == "CRITICAL_ALERT"
    service = F.when(critical, D.affected_service(F.col("anomaly_type"), F.col("action")))
    result = F.struct(
        F.struct(
            F.lit(True).alias("success"), F.col("user_id"),
            rotation_reason(F.col("threat_action"), F.col("threat_score")).alias("reason"),
        ).alias("user_rotation"),
        F.when(
            critical,
            F.struct(
                F.lit(True).alias("success"), service.alias("service"),
                infra_reason(F.col("threat_score")).alias("reason"),
            ),
        ).alias("infra_rotation"),
        service.alias("affected_service"),
        F.col("threat_action"),
    )
    return current.filter(F.col("status") == "approved").withColumn("rotation_result", result)


def approval_message(results: DataFrame) -> DataFrame:
    """The answer to an approval."""
    infra = F.col("rotation_result.infra_rotation")
    service = F.col("rotation_result.affected_service")
    user_part = F.concat(F.lit("User credentials rotated for "), F.col("user_id"), F.lit("."))
    infra_part = (
        F.when(infra.isNull(), F.lit(None).cast("string"))
        .when(infra["success"] & (service == "kafka"), F.lit("Kafka credentials rotated in Vault and reconnected."))
        .when(infra["success"], F.concat(F.lit("Infrastructure credentials rotated for '"), service, F.lit("'.")))
        .otherwise(F.concat(F.lit("Infrastructure rotation attempted for '"), service, F.lit("' but failed.")))
    )
    return results.withColumn("message", F.concat_ws(" ", user_part, infra_part))


def decision_answers(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    """What each decision, also a late or an unknown one, is told. Of equal ones at one time, one succeeds."""
    first = first_decisions(decisions).select("alert_id", F.col("decision").alias("valid"), F.col("decision_id").alias("valid_id"))
    known = alerts.select("alert_id", F.lit(True).alias("known"))
    rows = decisions.join(first, "alert_id").join(known, "alert_id", "left")
    effective = F.col("known") & (F.col("decision_id") == F.col("valid_id"))
    done = F.when(F.col("valid") == "approve", "approved").otherwise("rejected")
    message = (
        F.when(F.col("known").isNull(), F.concat(F.lit("Alert "), F.col("alert_id"), F.lit(" not found")))
        .when(effective, F.concat(F.lit("Alert "), done))
        .otherwise(F.concat(F.lit("Alert already resolved as: "), done))
    )
    return rows.select(
        "decision_id", "alert_id", "decision", F.coalesce(effective, F.lit(False)).alias("success"),
        message.alias("message"),
    )
