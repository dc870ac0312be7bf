from datetime import datetime

import pytest
from pyspark.sql import functions as F

from watchmill import schema as S
from watchmill.operators import encode, features
from watchmill.operators.projection import to_network_event
from watchmill.plans import training

EVENT = {
    "event_id": "e1", "timestamp": datetime(2025, 6, 14, 23, 30), "user_id": "user_1", "workspace_id": "ws_1",
    "source_ip": "192.168.1.1", "ip_region": "US-East", "user_region": "US-East", "action": "admin", "login_hour": 23,
    "data_downloaded_mb": 300.0, "failed_attempts_last_15m": 6, "success": False, "geo_mismatch": True, "impossible_travel": False,
}


def one(spark, profile=None, mode="exact", **changes):
    event = to_network_event(spark.createDataFrame([{**EVENT, **changes}]))
    people = spark.createDataFrame([profile] if profile else [], S.USER_PROFILE)
    codes = encode.fit_encoders(features.attach_profile(event, people))
    return features.engineer_features(event, people, codes, mode, None)


def test_unknown_user_gets_the_defaults(spark):
    row = features.feature_matrix(one(spark), ["event_id"]).first()
    assert list(row.asDict()) == ["event_id", *S.FEATURE_COLUMNS]
    want = {
        "hour": 23, "day_of_week": 5, "is_weekend": 1, "is_night": 1, "login_time_deviation": 10.0,
        "login_deviation_squared": 100.0, "extreme_time_deviation": 1, "outside_business_hours": 1, "non_tech_off_hours": 1,
        "deep_night": 0, "off_hours_non_shift": 1, "from_home_region": 1, "download_deviation": 250.0, "is_extreme_download": 1,
        "has_failed_attempts": 1, "high_failed_attempts": 1, "very_high_failed": 0, "success_int": 0, "is_new_ip": 1,
        "time_since_last": 0, "rapid_succession": 1, "events_1h": 1, "failed_30m": 1, "admin_actions_15m": 1,
        "role_risk_score": 1, "admin_non_admin_role": 1, "high_download_non_dev": 1, "geo_not_travel": 1, "geo_and_travel": 0,
    }
    assert {k: row[k] for k in want} == want
    assert row["login_deviation_zscore"] == pytest.approx(10 / 2.1)
    assert row["download_ratio"] == pytest.approx(300 / 50.01)


def test_profile_changes_the_features(spark):
    profile = ("user_1", "Admin", "EU-Central", 22.0, 1.0, 500.0, True, True, 0.1, 3, 0.2)
    row = one(spark, profile).first()
    assert (row["role_risk_score"], row["admin_non_admin_role"], row["shift_worker_int"], row["remote_worker_int"]) == (4, 0, 1, 1)
    assert (row["from_home_region"], row["non_tech_off_hours"], row["off_hours_non_shift"]) == (0, 0, 0)
    assert row["login_time_deviation"] == 1.0


def test_midnight_distance_wraps(spark):
    assert one(spark, login_hour=1).first()["login_time_deviation"] == 8.0
    assert one(spark, login_hour=22).first()["login_time_deviation"] == 11.0


def test_unknown_role_has_risk_one(spark):
    profile = ("user_1", "Pilot", None, None, None, None, None, None, None, None, None)
    row = one(spark, profile).first()
    assert row["role_risk_score"] == 1 and row["base_login_hour"] == 9.0 and row["home_region"] == "US-East"


def test_encoders_sort_by_bytes_and_unknown_is_zero(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("B",), ("é",), (None,)], "action string")
    codes = encode.fit_encoders(rows, ["action"])
    assert {r["category"]: r["code"] for r in codes.collect()} == {"B": 0, "a": 1, "b": 2, "é": 3}
    more = spark.createDataFrame([("zz",), ("a",), (None,)], "action string")
    assert [r["action_encoded"] for r in encode.apply_encoders(more, codes, ["action"]).collect()] == [0, 1, 0]
    assert [r["action_encoded"] for r in encode.apply_encoders(more, codes, ["action"], unknown=-1).collect()] == [-1, 1, -1]


def test_wide_columns_are_ranked_over_ranges(spark):
    rows = spark.createDataFrame([(f"u{i % 37}é", f"v{i % 23}", None if i % 2 else "w", "x") for i in range(300)], "user string, host string, role string, one string")
    columns = ["user", "host", "role", "one"]
    codes = encode.fit_encoders(rows, columns, most=10)
    got = sorted((r["feature"], r["category"], r["code"]) for r in codes.collect())
    values = {"user": [f"u{i}é" for i in range(37)], "host": [f"v{i}" for i in range(23)], "role": ["w"], "one": ["x"]}
    assert got == sorted((c, v, i) for c in columns for i, v in enumerate(sorted(values[c])))
    assert got == sorted((r["feature"], r["category"], r["code"]) for r in encode.fit_encoders(rows, columns).collect())


def test_one_wide_column_leaves_the_others_broadcast(spark):
    rows = spark.range(60).select(F.concat(F.lit("u"), "id").alias("user"), F.concat(F.lit("r"), (F.col("id") % 2)).alias("role"))
    codes = encode.fit_encoders(rows, ["user", "role"])
    done = encode.apply_encoders(rows, codes, ["user", "role"], most=20)
    logical = done._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Join LeftOuter") == 2 and logical.count("rightHint=(strategy=broadcast)") == 1
    want = {u: i for i, u in enumerate(sorted(f"u{i}" for i in range(60)))}
    assert all(r["user_encoded"] == want[r["user"]] and r["role_encoded"] == int(r["role"][1]) for r in done.collect())


def test_zero_vector_on_error(spark):
    rows = one(spark).withColumn("login_hour", F.lit(None).cast("int"))
    row = features.zero_on_error(rows).first()
    assert row["feature_error"] and all(row[c] == 0 for c in S.FEATURE_COLUMNS)


def test_missing_column_and_null_are_zero(spark):
    row = features.feature_matrix(spark.createDataFrame([(1, None)], "hour int, is_night int"), []).first()
    assert row["hour"] == 1.0 and row["is_night"] == 0.0 and row["role_encoded"] == 0.0


def reason(spark, profile=None, **changes):
    raw = to_network_event(spark.createDataFrame([{**EVENT, **changes}]))
    event = features.checked_inputs(raw)
    people = spark.createDataFrame([profile] if profile else [], S.USER_PROFILE)
    codes = encode.fit_encoders(features.attach_profile(event, people))
    row = features.zero_on_error(features.engineer_features(event, people, codes, "exact", None)).first()
    assert row["feature_error"] == (row["feature_reason"] is not None)
    assert not row["feature_error"] or all(row[c] == 0 for c in S.FEATURE_COLUMNS)
    return row["feature_reason"] and tuple(row["feature_reason"])


def test_a_feature_that_overflows_is_named(spark):
    calm = {"user_id": "user_1", "avg_daily_downloads_mb": 0.0, "role": "Admin", "base_login_hour": 9.0, "login_hour_std_dev": 2.0}
    calm = tuple(calm.get(f.name) for f in S.USER_PROFILE.fields)
    assert reason(spark, calm, data_downloaded_mb=1.7e308) == ("download_ratio", "overflow")
    assert reason(spark, calm, data_downloaded_mb=1.7e300) is None


def test_the_first_bad_field_is_named(spark):
    raw = spark.createDataFrame([
        ("2025-06-14 23:30:00", "23", "1.5", "1", "true"), ("soon", "x", "1", "0", "true"), ("2025-06-14 23:30:00", " ", "1", "0", "true"),
        ("2025-06-14 23:30:00", "5", "1", "99999999999", "true"), ("2025-06-14 23:30:00", "5", "inf", "0", "perhaps"),
        ("2025-06-14 23:30:00", "5", "1", None, "perhaps"), (None, "x", None, None, None),
    ], "timestamp string, login_hour string, data_downloaded_mb string, failed_attempts_last_15m string, success string")
    rows = features.checked_inputs(raw).collect()
    assert [r["input_error"] and tuple(r["input_error"]) for r in rows] == [
        None, ("timestamp", "not a value"), ("login_hour", "not a value"), ("failed_attempts_last_15m", "overflow"),
        ("data_downloaded_mb", "overflow"), ("success", "not a value"), ("timestamp", "missing")]
    assert rows[0]["login_hour"] == 23 and rows[1]["timestamp"] is None and rows[6]["login_hour"] is None


def test_codes_are_fitted_without_the_joined_rows(spark, monkeypatch):
    """Ids with several profiles, users without one, profiles without events, a profile without a role, an event without a user."""
    users = ["user_1"] * 30 + ["user_2"] * 30 + ["user_3", "user_4", None]
    event = to_network_event(spark.createDataFrame([
        {**EVENT, "event_id": f"e{i}", "user_id": user, "ip_region": f"R{i % 4}", "action": ["admin", "read"][i % 2]} for i, user in enumerate(users)]))

    def profile(user, role):
        return tuple({"user_id": user, "role": role}.get(f.name) for f in S.USER_PROFILE.fields)

    people = spark.createDataFrame([
        *[profile("user_1", role) for role in ("Admin", "HR", "Guest", "HR")], profile("user_2", None), profile("user_3", "Finance"),
        profile("nobody", "Owner")], S.USER_PROFILE)
    codes = encode.fit_encoders(features.attach_profile(event, people))
    want = sorted(tuple(r) for r in codes.select("feature", "category", "code").collect())
    assert [c for f, c, _ in want if f == "role"] == ["Admin", "Finance", "Guest", "HR", "Sales"]
    joined, attach = [], features.attach_profile
    monkeypatch.setattr(features, "attach_profile", lambda events, profiles: joined.append(events.count()) or attach(events, profiles))
    _, found = training.training_table(event.withColumn("is_injected_anomaly", F.lit(False)), people)
    assert sorted(tuple(r) for r in found.select("feature", "category", "code").collect()) == want
    assert joined[0] == 5
