import pytest
from pyspark.sql import functions as F

from watchmill import fixed_values as V
from watchmill.functions import decision as D
from watchmill.functions import display as P
from watchmill.functions import geo as G
from watchmill.plans.scoring import predict_batch, without_model

ACTIONS = [
    (0.0, "ALLOW"), (0.1, "ALLOW"), (0.29, "ALLOW"), (0.3, "MONITOR"), (0.45, "MONITOR"), (0.59, "MONITOR"),
    (0.6, "BLOCK"), (0.7, "BLOCK"), (0.84, "BLOCK"), (0.85, "CRITICAL_ALERT"), (0.95, "CRITICAL_ALERT"),
    (1.0, "CRITICAL_ALERT"),
]


def test_actions(spark):
    rows = spark.createDataFrame(ACTIONS, "score double, want string")
    assert rows.filter(D.determine_action(F.col("score")) != F.col("want")).count() == 0


def test_actions_rise_with_the_score(spark):
    order = F.array_position(F.array(*map(F.lit, ["ALLOW", "MONITOR", "BLOCK", "CRITICAL_ALERT"])), D.determine_action(F.col("s")))
    levels = [r[0] for r in spark.range(0, 1001).select((F.col("id") / 1000).alias("s")).orderBy("s").select(order).collect()]
    assert levels == sorted(levels) and set(levels) == {1, 2, 3, 4}


@pytest.mark.parametrize("anomaly, action, want", [
    ("data_exfiltration", "read", "elasticsearch"), ("bulk_download", "admin", "elasticsearch"),
    ("lateral_movement", "read", "kafka"), ("privilege_escalation", "admin", "kafka"), ("None", "admin", "database"),
    ("None", "read", "elasticsearch"), (None, None, "elasticsearch"),
])
def test_affected_service(spark, anomaly, action, want):
    row = spark.createDataFrame([(anomaly, action)], "a string, b string")
    assert row.select(D.affected_service(F.col("a"), F.col("b"))).first()[0] == want


def test_workflows_and_incident(spark):
    rows = spark.createDataFrame([(True, 0.7), (False, 0.2), (True, 0.95), (True, 0.9)], "t boolean, s double")
    found = rows.select(
        F.transform(D.workflows(F.col("t"), F.col("s")), lambda w: w["name"]).alias("w"),
        D.incident_id(F.col("t"), F.lit("e1")).alias("i"), F.size(D.distribution(F.col("t"))).alias("d"),
    ).collect()
    assert [len(r["w"]) for r in found] == [4, 1, 5, 4]
    assert "network_isolation" in found[2]["w"] and found[1]["w"] == ["baseline_update"]
    assert [r["i"] is not None for r in found] == [True, False, True, True]
    assert [r["d"] for r in found] == [4, 0, 4, 4]


def test_severity_needs_flag_and_action(spark):
    rows = spark.createDataFrame(
        [(True, "BLOCK"), (False, "BLOCK"), (True, "MONITOR"), (False, "ALLOW")], "t boolean, a string"
    )
    t, a = F.col("t"), F.col("a")
    found = rows.select(D.is_high_severity(t, a), D.is_auto_allowed(t, a), D.rotation_status(t, a)).collect()
    assert [r[0] for r in found] == [True, False, False, False]
    assert [r[1] for r in found] == [False, True, False, True]
    assert [r[2] for r in found] == ["pending_user_rotation", "skipped", "skipped", "skipped"]


def test_places(spark):
    rows = spark.createDataFrame(
        [("US-East", "US-East"), ("US-East", "EU-Central"), ("Mars", "Mars"), ("Mars", "Venus"), ("US-West", "")], "i string, u string"
    )
    found = rows.select(G.source_geo(F.col("i"))["city"], G.dest_geo(F.col("i"), F.col("u"))["city"]).collect()
    assert [tuple(r) for r in found] == [
        ("New York", "Bangalore"), ("New York", "Frankfurt"), ("Unknown", "Bangalore"), ("Unknown", "Bangalore"),
        ("San Francisco", "Bangalore"),
    ]


def test_masks_and_texts(spark):
    row = spark.range(1).select(
        P.mask_edges(F.lit("abcdefghij")), P.mask_edges(F.lit("abcdefgh")), P.mask_prefix(F.lit("abcdefghij")),
        P.mask_prefix(F.lit("short")), P.short_reason(F.lit("x" * 26)), P.short_reason(F.lit("x" * 25)),
        P.short_reason(F.lit(None).cast("string")), P.rotation_reason(F.lit("BLOCK"), F.lit(0.7)), P.score_pct(F.lit(0.1234)),
    ).first()
    assert tuple(row) == (
        "abcd****ghij", "****", "abcdefgh****", "****", "x" * 25 + "…", "x" * 25, "—", "admin_approved_block_score_0.7000", 12.3,
    )


def test_no_model_means_no_threat(spark):
    row = without_model(spark.createDataFrame([("e",)], "event_id string")).first()
    assert (row["is_threat"], row["ensemble_score"], row["xgb_score"], row["lgbm_score"], row["threshold"]) == (False, 0, 0, 0, 0.5)


def test_weights_and_cut_offs():
    assert abs(sum(V.MEMBER_WEIGHTS.values()) - 1) < 1e-12
    assert 0 <= V.ALLOW_BELOW < V.MONITOR_BELOW < V.BLOCK_BELOW <= 1


def test_prediction_of_a_critical_event(spark):
    event = spark.createDataFrame(
        [("e1", "u1", "10.0.0.1", "US-East", "EU-Central", "admin", "lateral_movement", True, 1.0, 1.0, 0.9, 0.9)],
        "event_id string, user_id string, source_ip string, ip_region string, user_region string, action string, "
        "anomaly_type string, geo_mismatch boolean, xgb_score double, lgbm_score double, rf_score double, gb_score double",
    ).withColumn("timestamp", F.lit("2025-06-15 10:00:00").cast("timestamp"))
    p = predict_batch(event).first()
    assert p["threat_action"] == "CRITICAL_ALERT" and p["threat_score"] == pytest.approx(0.965)
    assert p["rotation_plan"]["affected_service"] == "kafka" and p["rotation_status"] == "pending_user_and_infra_rotation"
    assert p["event_summary"]["alert_id"].startswith("ALR-") and len(p["workflows"]) == 5
