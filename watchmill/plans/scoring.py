"""From scored events to full prediction records."""

from pyspark.sql import DataFrame, functions as F

from watchmill import fixed_values as V
from watchmill.functions import decision as D
from watchmill.functions.geo import dest_geo, source_geo

MEMBER_COLUMNS = {"xgb": "xgb_score", "lgbm": "lgbm_score", "rf": "rf_score", "gb": "gb_score"}
SCORES = ["xgb_score", "lgbm_score", "ensemble_score", "threshold"]


def without_model(events: DataFrame) -> DataFrame:
    """What scoring gives when there is no model: nothing is a threat."""
    zeros = {c: F.lit(0.0) for c in [*MEMBER_COLUMNS.values(), "ensemble_score", "threat_score"]}
    return events.withColumns({
        **zeros,
        "threshold": F.lit(V.DEFAULT_THRESHOLD),
        "is_threat": F.lit(False),
        "threat_action": D.determine_action(F.lit(0.0)),
        "workflows": D.workflows(F.lit(False), F.lit(0.0)),
    })


def decide(scored: DataFrame, threshold: float = V.DEFAULT_THRESHOLD, weights: dict[str, float] = V.MEMBER_WEIGHTS) -> DataFrame:
    """Member scores -> ensemble score, threat flag, action. Decisions use the exact score, rows keep 6 decimals."""
    score = D.ensemble({name: F.col(column) for name, column in MEMBER_COLUMNS.items()}, weights)
    rows = scored.withColumn("exact_score", score)
    exact = F.col("exact_score")
    return rows.withColumns({
        "is_threat": D.is_threat(exact, threshold),
        "threat_action": D.determine_action(exact),
        "workflows": D.workflows(D.is_threat(exact, threshold), exact),
        "ensemble_score": F.round(exact, 6),
        "threat_score": F.round(exact, 6),
        "threshold": F.round(F.lit(threshold), 6),
        **{c: F.round(c, 6) for c in MEMBER_COLUMNS.values()},
    }).drop("exact_score")


def respond(decided: DataFrame) -> DataFrame:
    """Add places, plan and summary."""
    threat, action = F.col("is_threat"), F.col("threat_action")
    high = D.is_high_severity(threat, action)
    return decided.withColumns({
        "source_geo": source_geo(F.col("ip_region")),
        "destination_geo": dest_geo(F.col("ip_region"), F.col("user_region")),
        "rotation_plan": D.rotation_plan(threat, action, F.col("anomaly_type"), F.col("action")),
        "rotation_status": D.rotation_status(threat, action),
        "distribution": D.distribution(threat),
        "incident_id": D.incident_id(threat, F.col("event_id")),
        "event_summary": F.struct(
            F.col("user_id").alias("user"), "source_ip", "ip_region", "action", "anomaly_type", "geo_mismatch",
            F.when(high, D.alert_id(F.col("event_id"))).alias("alert_id"),
        ),
    })


def predict_scored(scored: DataFrame, threshold: float = V.DEFAULT_THRESHOLD) -> DataFrame:
    """Events that carry member scores -> prediction records. A projection: no shuffle, so order is kept too."""
    return respond(decide(scored, threshold))


PREDICTION = [
    "event_id", "is_threat", "threat_score", "threat_action", *SCORES, "source_geo", "destination_geo", "workflows",
    "rotation_plan", "rotation_status", "distribution", "incident_id", "timestamp", "event_summary",
]


def predict_batch(scored: DataFrame, threshold: float = V.DEFAULT_THRESHOLD) -> DataFrame:
    return predict_scored(scored, threshold).select(*PREDICTION)
