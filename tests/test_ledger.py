import pytest
from pyspark.sql import functions as F

from watchmill.operators import credentials, ledger, lists, report

ALERTS = [("A1", "u1", 100, 0.7, "BLOCK", "None", "read"), ("A2", "u2", 200, 0.9, "CRITICAL_ALERT", "lateral_movement", "read"),
          ("A3", "u1", 300, 0.95, "CRITICAL_ALERT", "None", "admin"), ("A4", "u3", 400, 0.65, "BLOCK", "None", "read")]
DECISIONS = [("A1", "d1", "approve", 10, "ok"), ("A1", "d2", "reject", 20, "no"), ("A2", "d3", "approve", 30, ""),
             ("A3", "d5", "approve", 41, "late"), ("A3", "d4", "reject", 40, "no"), ("XX", "d6", "approve", 50, "")]


@pytest.fixture()
def alerts(spark):
    return spark.createDataFrame(ALERTS, "alert_id string, user_id string, created_us long, threat_score double, threat_action string, anomaly_type string, action string")


@pytest.fixture()
def decisions(spark):
    return spark.createDataFrame(DECISIONS, "alert_id string, decision_id string, decision string, at_us long, admin_notes string")


def test_the_first_decision_wins(alerts, decisions):
    state = {r["alert_id"]: (r["status"], r["resolved_us"], r["admin_notes"]) for r in ledger.current_alerts(alerts, decisions).collect()}
    assert state == {"A1": ("approved", 10, "ok"), "A2": ("approved", 30, ""), "A3": ("rejected", 40, "no"), "A4": ("pending", None, "")}
    assert sorted(r["alert_id"] for r in ledger.audit_log(alerts, decisions).collect()) == ["A1", "A2", "A3"]


def test_answers_to_decisions(alerts, decisions):
    got = {r["decision_id"]: (r["success"], r["message"]) for r in ledger.decision_answers(alerts, decisions).collect()}
    assert got["d1"] == (True, "Alert approved") and got["d2"] == (False, "Alert already resolved as: approved")
    assert got["d5"] == (False, "Alert already resolved as: rejected") and got["d6"] == (False, "Alert XX not found")


def test_rotations_and_ledger(spark, alerts, decisions):
    rot = ledger.rotations(ledger.current_alerts(alerts, decisions))
    assert sorted((r["rotation_type"], r["target"]) for r in rot.collect()) == [("infrastructure", "kafka"), ("user", "u1"), ("user", "u2")]
    people = spark.createDataFrame([("u1", "HR", "US-East"), ("u9", "HR", "US-East")], "user_id string, role string, home_region string")
    users = {r["user_id"]: (r["rotation_count"], r["status"], r["last_rotation_reason"]) for r in credentials.user_ledger(people, rot).collect()}
    assert users == {"u1": (1, "rotated", "admin_approved_block_score_0.7000"), "u9": (0, "active", "initial_provisioning")}
    messages = {r["alert_id"]: r["message"] for r in ledger.approval_message(ledger.rotation_results(ledger.current_alerts(alerts, decisions))).collect()}
    assert messages["A1"] == "User credentials rotated for u1."
    assert messages["A2"].endswith("Kafka credentials rotated in Vault and reconnected.")


def test_stats(spark, alerts, decisions):
    free = spark.createDataFrame([(7,)], "total_auto_allowed long")
    row = ledger.admin_stats(ledger.current_alerts(alerts, decisions), free).first().asDict()
    assert row == {"total_alerts_created": 4, "total_approved": 2, "total_rejected": 1, "pending_count": 1, "critical_pending": 0,
                   "total_alerts": 4, "total_auto_allowed": 7}


def test_lists(alerts, decisions):
    now = ledger.current_alerts(alerts, decisions)
    assert [r["alert_id"] for r in lists.alert_list(now, severity="high").collect()] == ["A4", "A3", "A2", "A1"]
    assert [r["alert_id"] for r in lists.alert_list(now, severity="critical", limit=1).collect()] == ["A3"]
    assert lists.alert_list(now, severity="medium").count() == 0 and lists.alert_list(now, severity="odd").count() == 4
    assert [r["alert_id"] for r in lists.alert_list(now, status="pending").collect()] == ["A4"]


def hours(n):
    return n * 3_600_000_000


def test_lease_chain_over_hours(spark):
    rows = [("db", "l1", 0), ("db", "l2", 5), ("db", "l3", hours(3)), ("es", "l4", hours(1)), ("db", "l5", hours(3) + 1)]
    leases = spark.createDataFrame(rows, "service string, lease_id string, issued_us long").withColumns({
        "username": F.lit("v"), "expires_us": F.col("issued_us") + hours(1), "rotation_reason": F.lit("r"),
    })
    got = {r["lease_id"]: (r["previous_lease"], r["revoked"], r["revoked_us"]) for r in credentials.revocations(leases).collect()}
    assert got == {"l1": (None, True, 5), "l2": ("l1", True, hours(3)), "l3": ("l2", True, hours(3) + 1), "l4": (None, False, None),
                   "l5": ("l3", False, None)}
    active = {r["service"]: (r["lease_id"], r["seconds_remaining"], r["expired"]) for r in credentials.active_leases(leases, F.lit(hours(2))).collect()}
    assert active == {"db": ("l2", 0, True), "es": ("l4", 0, True)}
    active = credentials.active_leases(leases, F.lit(hours(1) + 10)).filter("service = 'es'").first()
    assert active["seconds_remaining"] == 3599 and not active["expired"]


def test_rotation_numbers(spark):
    rows = [("user", "u", at, f"r{i}") for i, at in enumerate([0, 0, 7, hours(2), hours(2) + 1, hours(9)])]
    got = credentials.rotation_numbers(spark.createDataFrame(rows, "rotation_type string, target string, at_us long, rotation_id string"))
    assert {r["rotation_id"]: r["rotation_number"] for r in got.collect()} == {f"r{i}": i + 1 for i in range(6)}


def test_offset_lag_ignores_unknown_positions(spark):
    rows = [("t", 0, 0, 100, 90), ("t", 1, 0, 100, -1), ("t", 2, -1, -1, 5)]
    lags = report.offset_lag(spark.createDataFrame(rows, "topic string, partition int, earliest long, latest long, committed long"))
    assert [(r["lag"], r["messages"]) for r in lags.orderBy("partition").collect()] == [(10, 100), (0, 100), (0, 0)]
    assert report.lag_summary(lags).first()["lag_level"] == "ok"


def test_offsets_of_a_running_query():
    from types import SimpleNamespace

    from watchmill.streaming.jobs import offsets_of

    source = {"startOffset": '{"t": {"0": 5}}', "endOffset": '{"t": {"0": 8, "1": 3}}', "latestOffset": '{"t": {"0": 20}}'}
    rows = offsets_of(SimpleNamespace(lastProgress={"sources": [source, {"endOffset": None}]}))
    assert rows == [
        {"topic": "t", "partition": 0, "earliest": 5, "latest": 20, "committed": 8},
        {"topic": "t", "partition": 1, "earliest": 0, "latest": 3, "committed": 3},
    ]
    assert offsets_of(SimpleNamespace(lastProgress=None)) == []


def test_one_of_equal_decisions_succeeds(spark, alerts):
    twice = [("A1", "d1", "approve", 5, ""), ("A1", "d2", "approve", 5, "")]
    rows = spark.createDataFrame(twice, "alert_id string, decision_id string, decision string, at_us long, admin_notes string")
    assert {r["decision_id"]: r["success"] for r in ledger.decision_answers(alerts, rows).collect()} == {"d1": True, "d2": False}
