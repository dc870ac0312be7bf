import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from watchmill.operators import rolling
from watchmill.operators.keys import hot_keys, small_or_same

START = datetime(2025, 6, 15, 10)
SCHEMA = "event_id long, timestamp timestamp, user_id string, source_ip string, action string, success boolean"


def frame(spark, rows):
    return rolling.event_inputs(spark.createDataFrame(rows, SCHEMA))


def random_rows(n, seed, users=("a", "b", "c")):
    """Ties, gaps of days, missing addresses, a blank user, and one user with most of the rows."""
    rng = random.Random(seed)
    rows, at = [], START
    for i in range(n):
        at += timedelta(seconds=rng.choice([0, 0, 1, 59, 60, 300, 900, 1800, 3600, 200_000]))
        user = "a" if rng.random() < 0.6 else rng.choice([*users, "", None])
        ip = rng.choice(["1.1.1.1", "1.1.1.2", "1.1.1.3", None])
        rows.append((i, at, user, ip, rng.choice(["admin", "read"]), rng.random() < 0.7))
    return rows


def brute_force(rows):
    """Row by row, from the definitions."""
    by_user, result = {}, {}
    for event_id, at, user, ip, action, success in sorted(rows, key=lambda r: (r[2] or "", r[1], r[0])):
        past = by_user.setdefault(user or "", [])
        prev = past[-1] if past else None
        now = {"at": at, "ip": ip, "changed": int(prev is not None and prev["ip"] is not None and prev["ip"] != ip),
               "admin": int(action == "admin"), "failed": int(not success)}
        past.append(now)
        def total(what, seconds):
            return sum(p[what] if what else 1 for p in past if p["at"] > at - timedelta(seconds=seconds))
        known = [p["ip"] for p in past if p["ip"] is not None]
        gap = (at - prev["at"]).total_seconds() if prev else 0.0
        result[event_id] = {
            "prev_ip": prev["ip"] if prev else None, "time_since_last": gap, "rapid_succession": int(gap < 60),
            "ip_hops_30m": total("changed", 1800), "admin_actions_15m": total("admin", 900), "failed_30m": total("failed", 1800),
            "events_1h": total(None, 3600), "is_first_ip": int(ip == (known[0] if known else None)),
            "capped": (min(10, sum(p["changed"] for p in past)), min(20, sum(p["admin"] for p in past)),
                       min(20, sum(p["failed"] for p in past)), min(100, len(past))),
        }
    for event_id, at, user, ip, *_ in rows:
        first = min(r[1] for r in rows if (r[2] or "") == (user or "") and r[3] == ip)
        result[event_id]["is_new_ip"] = int(at == first)
    return result


@pytest.fixture()
def whole_ranges(spark):
    """Keep small range partitions apart, as large ones would be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot_rows, slice_seconds", [(None, 600), (20, 600), (9, 37), (9, 100_000), (0, None)])
def test_exact_history_equals_brute_force(spark, whole_ranges, seed, hot_rows, slice_seconds):
    rows = random_rows(120, seed)
    want = brute_force(rows)
    names = ["prev_ip", "time_since_last", "rapid_succession", "ip_hops_30m", "admin_actions_15m", "failed_30m", "events_1h", "is_new_ip"]
    got = rolling.with_history(frame(spark, rows), "exact", hot_rows, slice_seconds).collect()
    assert len(got) == len(rows)
    for r in got:
        assert {n: r[n] for n in names} == {n: want[r["event_id"]][n] for n in names}, r["event_id"]


@pytest.mark.parametrize("hot_rows, slice_seconds", [(None, 1000), (9, 1000), (20, 1000), (0, None)])
def test_serving_history_equals_brute_force(spark, whole_ranges, hot_rows, slice_seconds):
    rows = random_rows(150, 3)
    want = brute_force(rows)
    for r in rolling.with_history(frame(spark, rows), "serving", hot_rows, slice_seconds).collect():
        w = want[r["event_id"]]
        assert tuple(r[c] for c in rolling.COUNTERS) == w["capped"]
        assert (r["is_first_ip"], r["time_since_last"]) == (w["is_first_ip"], w["time_since_last"])


def test_windows_are_left_open_and_ties_count_in_order(spark):
    minutes = [0, 10, 10, 30, 40]
    rows = [(i, START + timedelta(minutes=m), "u", "1.1.1.1", "read", False) for i, m in enumerate(minutes)]
    got = rolling.with_history(frame(spark, rows), "exact", None).orderBy("event_id")
    assert [r["failed_30m"] for r in got.collect()] == [1, 2, 3, 3, 2]
    frame_ = pd.DataFrame({"t": [START + timedelta(minutes=m) for m in minutes], "x": 1})
    assert frame_.rolling("30min", on="t")["x"].sum().tolist() == [1, 2, 3, 3, 2]


def test_ordinary_users_cost_one_exchange(spark):
    rows = frame(spark, random_rows(50, 5))
    plan = rolling.history_parts(rows, "exact", None)[0][0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 2


def test_hot_keys(spark):
    rows = spark.range(100).select(F.when(F.col("id") < 40, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert [r["k"] for r in hot_keys(rows, "k", 10).collect()] == ["hot"]
    assert hot_keys(rows, "k", 40) is None


def test_small_tables_become_local(spark):
    small = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()
    assert small_or_same(small, 2) is small
    assert sorted(small_or_same(small, 3).collect()) == sorted(small.collect())


def test_a_crowded_moment_is_cut_too(spark, whole_ranges):
    """One user, one microsecond: time cannot cut this, the order can."""
    rows = [(i, START, "u", f"1.1.1.{i % 3}", "admin", True) for i in range(40)]
    assert rolling._crowded(frame(spark, rows), 600, 10)
    got = rolling.with_history(frame(spark, rows), "exact", 10).orderBy("event_id").collect()
    assert [r["events_1h"] for r in got] == list(range(1, 41)) and [r["ip_changed"] for r in got] == [0] + [1] * 39
    assert all(r["is_new_ip"] == 1 for r in got)


@pytest.mark.parametrize("mode, hot_rows", [("exact", None), ("exact", 0), ("serving", None), ("serving", 0)])
def test_rows_without_a_time_are_kept_without_history(spark, mode, hot_rows):
    rows = [(1, START, "u", "1.1.1.1", "read", True), (2, None, "u", "1.1.1.2", "read", True), (3, START, "u", "1.1.1.1", "read", True)]
    got = {r["event_id"]: (r["events_1h"], r["prev_ip"], r["ip_changed"]) for r in rolling.with_history(frame(spark, rows), mode, hot_rows).collect()}
    assert got == {1: (1, None, 0), 2: (None, None, None), 3: (2, "1.1.1.1", 0)}


@pytest.mark.parametrize("mode", ["exact", "serving"])
def test_hot_users_read_the_source_once_more(spark, tmp_path, mode):
    frame(spark, random_rows(80, 6)).drop("event_us", "is_admin_action", "failed_action", "event_flag").write.parquet(str(tmp_path / "source"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # the plan's text names whole folders
    rows = rolling.event_inputs(spark.read.parquet(str(tmp_path / "source")))
    physical = rolling.with_history(rows, mode, 1)._jdf.queryExecution().executedPlan().toString()
    assert sum(f"{tmp_path.name}/source" in line for line in physical.splitlines() if "FileScan" in line) == 1
