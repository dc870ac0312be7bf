import random
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from tests.test_rolling import SCHEMA, START, frame, random_rows
from watchmill.operators import bridge, report, rolling
from watchmill.streaming import jobs, progress, state, totals


def slices(spark, batches, path, schema=SCHEMA):
    """One file per batch, in this order."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(stream, sink, checkpoint, mode="append"):
    jobs.run(stream, sink, str(checkpoint), mode).awaitTermination()


def events(n, seed):
    """No nulls: what the event projection gives."""
    return [(i, at, user or "", ip or "", action, ok) for i, at, user, ip, action, ok in random_rows(n, seed)]


def collected(spark, path, columns):
    return {r["event_id"]: tuple(r[c] for c in columns) for r in spark.read.parquet(path).collect()}


EXACT = [*rolling.COUNTERS, "is_new_ip", "time_since_last", "rapid_succession"]


def test_exact_state_equals_the_batch_in_any_arrival_order(spark, tmp_path):
    """Events arrive up to 9 minutes late; the watermark waits 10."""
    rng = random.Random(4)
    rows, at = [], START
    for i in range(150):
        at += timedelta(seconds=rng.choice([0, 1, 30, 120, 600, 1800]))
        rows.append((i, at, rng.choice(["a", "a", "b"]), rng.choice(["1.1.1.1", "1.1.1.2", "1.1.1.3"]), rng.choice(["admin", "read"]), rng.random() < 0.6))
    arrival = sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.random() * 540))
    closing = (10_000, at + timedelta(hours=3), "z", "9.9.9.9", "read", True)
    stream = slices(spark, [arrival[i::1][:30] for i in range(0, 150, 30)] + [[closing]], str(tmp_path / "in"))
    out = str(tmp_path / "out")
    finish(state.exact_history(stream), jobs.table_sink(out), tmp_path / "cp")
    want = rolling.with_history(frame(spark, rows), "exact", None).collect()
    assert collected(spark, out, EXACT) == {r["event_id"]: tuple(r[c] for c in EXACT) for r in want}


def test_serving_state_equals_the_batch(spark, tmp_path):
    rows = sorted(events(160, 6), key=lambda r: (r[1], r[0]))
    columns = [*rolling.COUNTERS, "is_first_ip", "time_since_last", "rapid_succession"]
    # rows with one time stay together: their order inside a batch is by id, across batches by arrival
    stream = slices(spark, [rows[i:i + 40] for i in range(0, 160, 40)], str(tmp_path / "in"))
    out = str(tmp_path / "out")
    finish(state.serving_history(stream), jobs.table_sink(out), tmp_path / "cp")
    want = rolling.with_history(frame(spark, rows), "serving", None).collect()
    assert collected(spark, out, columns) == {r["event_id"]: tuple(r[c] for c in columns) for r in want}


def test_out_of_order_arrival_gives_negative_gaps_in_serving_state(spark, tmp_path):
    later = (1, START + timedelta(minutes=5), "u", "1.1.1.1", "read", True)
    earlier = (2, START, "u", "1.1.1.1", "read", True)
    out = str(tmp_path / "out")
    finish(state.serving_history(slices(spark, [[later], [earlier]], str(tmp_path / "in"))), jobs.table_sink(out), tmp_path / "cp")
    got = collected(spark, out, ["time_since_last", "rapid_succession", "events_1h"])
    assert got == {1: (0.0, 1, 1), 2: (-300.0, 1, 2)}


def test_late_rows_go_to_a_side_table(spark, tmp_path):
    def row(i, minutes):
        return (i, START + timedelta(minutes=minutes), "u", "1.1.1.1", "read", True)

    stream = slices(spark, [[row(1, 60)], [row(2, 55), row(3, 10), row(4, 70)], [row(5, 61), row(6, 59)]], str(tmp_path / "in"))
    good, late = str(tmp_path / "good"), str(tmp_path / "late")
    finish(stream, jobs.late_sink(good, late, 600), tmp_path / "cp")
    assert {r["event_id"] for r in spark.read.parquet(late).collect()} == {3, 6}
    assert {r["event_id"] for r in spark.read.parquet(good).collect()} == {1, 2, 4, 5}


def test_rows_that_are_on_time_survive_the_stateful_job(spark, tmp_path):
    """The job behind the late filter loses nothing of what the filter let through."""
    rng = random.Random(8)
    rows = [(i, START + timedelta(seconds=60 * i + rng.randrange(-1500, 1500)), "u", "1.1.1.1", "read", True) for i in range(100)]
    good, late, out = (str(tmp_path / n) for n in ("good", "late", "out"))
    finish(slices(spark, [rows[i:i + 20] for i in range(0, 100, 20)], str(tmp_path / "in")), jobs.late_sink(good, late, 600), tmp_path / "cp1")
    passed = spark.read.parquet(good)
    assert passed.count() + spark.read.parquet(late).count() == 100
    closing = spark.createDataFrame([(999, START + timedelta(days=1), "z", "", "read", True)], SCHEMA)
    closing.coalesce(1).write.parquet(f"{good}/batch_id=99")
    schema = passed.drop("batch_id").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(good).drop("batch_id")
    finish(state.exact_history(stream), jobs.table_sink(out), tmp_path / "cp2")
    assert {r["event_id"] for r in spark.read.parquet(out).collect()} == {r["event_id"] for r in passed.collect()}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        jobs.write_batch(spark.range(5), path, 3)
    jobs.write_batch(spark.range(2), path, 4)
    assert spark.read.parquet(path).count() == 7


def test_bridge_forgets_ids_only_after_the_delay(spark, tmp_path):
    docs = [[("a", START), ("b", START), ("a", START)], [("a", START + timedelta(minutes=1)), ("c", START + timedelta(minutes=1))]]
    stream = slices(spark, docs, str(tmp_path / "in"), "_es_id string, at timestamp")
    out = str(tmp_path / "out")
    finish(bridge.bridge_stream(stream, time="at", within="1 hour"), jobs.table_sink(out), tmp_path / "cp")
    assert sorted(r["_es_id"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_metrics_add_up_over_batches(spark, tmp_path):
    rows = spark.range(100).select(
        (F.col("id") % 2 == 0).alias("is_threat"), F.lit("BLOCK").alias("threat_action"), (F.col("id") * 0.5).alias("latency_ms")
    )
    sink = totals.metrics_sink(str(tmp_path / "m"))
    for i in range(4):
        sink(rows.filter(F.col("latency_ms").between(i * 12.5, i * 12.5 + 12)), i)
    assert totals.read_metrics(spark, str(tmp_path / "m")).collect() == report.pipeline_metrics(rows).collect()


@pytest.mark.parametrize("mode", ["exact", "serving"])
def test_a_stream_that_starts_with_history_equals_the_batch(spark, tmp_path, mode):
    """Some users have no past, some only a past, and one has the cut in the middle of an hour."""
    rows = sorted(events(150, 11), key=lambda r: (r[1], r[0]))
    cut = next(i for i in range(75, 150) if rows[i][1] > rows[i - 1][1])
    past, coming = rows[:cut], rows[cut:] + [(800, rows[-1][1] + timedelta(minutes=1), "new", "3.3.3.3", "admin", False)]
    past += [(900, START, "gone", "2.2.2.2", "read", True)]
    closing = (10_000, coming[-1][1] + timedelta(hours=3), "z", "9.9.9.9", "read", True)
    half = len(coming) // 2
    stream = slices(spark, [coming[:half], coming[half:], [closing]], str(tmp_path / "in"))
    out = str(tmp_path / "out")
    if mode == "exact":
        done = state.exact_history(stream, start=state.exact_start(spark.createDataFrame(past, SCHEMA)))
        columns = EXACT
    else:
        done = state.serving_history(stream, start=state.serving_start(spark.createDataFrame(past, SCHEMA)))
        columns = [*rolling.COUNTERS, "is_first_ip", "time_since_last", "rapid_succession"]
    finish(done, jobs.table_sink(out), tmp_path / "cp")
    ids = {r[0] for r in coming}
    want = rolling.with_history(frame(spark, past + coming), mode, None).filter(F.col("event_id").isin(*ids)).collect()
    got = collected(spark, out, columns)
    got.pop(10_000, None)
    assert got == {r["event_id"]: tuple(r[c] for c in columns) for r in want}


class Kept:
    """State in memory that counts the events written to it."""

    def __init__(self):
        self.values, self.written = {}, 0

    def updateValue(self, key, value):
        self.values[key] = value
        self.written += max([len(v) for v in value if isinstance(v, list)], default=0)

    def update(self, value):
        self.values[()] = value

    def get(self):
        return self.values.get(())

    def getValue(self, key):
        return self.values.get(key)

    def containsKey(self, key):
        return key in self.values

    def removeKey(self, key):
        del self.values[key]

    def keys(self):
        return list(self.values)

    def iterator(self):
        return list(self.values.items())


def test_a_timer_writes_only_the_minutes_it_fills(spark):
    """One user with an event each second for two hours, in batches of 100 seconds."""
    states = {}

    class Handle:
        def getMapState(self, name, *_):
            return states.setdefault(name, Kept())

        getValueState = getMapState

        def registerTimer(self, _):
            pass

    class Now:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    row = T.StructType([T.StructField(n, T.LongType()) for n in ("event_id", "event_us")] + [T.StructField("source_ip", T.StringType())] + [
        T.StructField(n, T.IntegerType()) for n in ("is_admin_action", "failed_action", "event_flag")])
    job, seen, n = state.ExactHistory(row, ["event_id", *rolling.COUNTERS]), [], 7200
    job.init(Handle())
    for a in range(0, n, 100):
        ids = pd.Series(range(a, a + 100))
        pdf = pd.DataFrame({"event_id": ids, "event_us": ids * 1_000_000, "source_ip": "a", "is_admin_action": 1, "failed_action": 0, "event_flag": 1})
        list(job.handleInputRows(("u",), iter([pdf]), Now(0)))
        seen += [r for out in job.handleExpiredTimer(("u",), Now((a + 70) * 1000), None) for r in out.itertuples(index=False)]
    assert [r.event_id for r in seen] == list(range(n - 29))
    assert all(r.events_1h == min(r.event_id + 1, 3600) and r.admin_actions_15m == min(r.event_id + 1, 900) for r in seen)
    # a minute is met by three batches at most: the last hour, 3600 events, is not written 72 times
    assert states["rows"].written <= 3 * n and states["waiting"].written <= 4 * n
    assert len(states["totals"].values) <= 62 and set(states["rows"].values) <= set(states["totals"].values)
    list(job.handleExpiredTimer(("u",), Now(2 * n * 1000), None))
    list(job.handleExpiredTimer(("u",), Now(2 * n * 1000), None))
    assert not states["totals"].values and not states["rows"].values and not states["waiting"].values


def test_metrics_stay_in_few_folders(spark, tmp_path):
    """More batches than slots, each batch repeated at some time, and ranges that were not written to their end."""
    import shutil

    rows = spark.range(26 * 4).select(
        (F.col("id") % 3 == 0).alias("is_threat"), F.lit("MONITOR").alias("threat_action"), (F.col("id") * 0.25).alias("latency_ms"),
        F.floor(F.col("id") / 4).alias("batch"))
    path = tmp_path / "m"
    sink = totals.metrics_sink(str(path), half=3)
    for i in range(26):
        sink(rows.filter(F.col("batch") == i), i)
        if i % 5 == 4:
            for again in (i, max(i - 4, 0), 0):
                sink(rows.filter(F.col("batch") == again), again)
        if i == 12:
            # the job died when it closed a range: its folder is gone, the batch runs again
            newest = max(path.glob("ranges/range=*"), key=lambda p: spark.read.parquet(str(p)).first()["upto"])
            shutil.rmtree(newest)
            want = report.pipeline_metrics(rows.filter("batch <= 12")).collect()
            assert totals.read_metrics(spark, str(path)).collect() == want
            sink(rows.filter(F.col("batch") == i), i)
            assert totals.read_metrics(spark, str(path)).collect() == want
    assert totals.read_metrics(spark, str(path)).collect() == report.pipeline_metrics(rows).collect()
    assert len(list(path.glob("*/*"))) <= 2 * 3 + 2


def test_a_query_reads_its_own_progress(spark, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "progress")).follow()
    try:
        rows = events(40, 3)
        stream = slices(spark, [rows[:25], rows[25:]], str(tmp_path / "in"))
        job = jobs.run(stream, jobs.table_sink(str(tmp_path / "out")), str(tmp_path / "cp"))
        job.awaitTermination()
        log.wait(job)
    finally:
        log.leave()
    table = progress.read_progress(spark, str(tmp_path / "progress"))
    assert {(r["batch_id"], r["input_rows"]) for r in table.collect()} == {(0, 25), (1, 15)}
    rate = progress.rates(table).first()
    assert (rate["batches"], rate["input_rows"]) == (2, 40) and rate["processed_rate"] > 0
    assert progress.running_lag(table).collect() == []


def test_lag_from_progress(spark):
    def row(batch, start, end, latest):
        return ("q", "r", None, batch, f"2024-01-01T00:00:0{batch}Z", 0, "broker", start, end, latest, 5, 1.0, 2.0)

    table = spark.createDataFrame([
        row(0, None, '{"t":{"0":1}}', '{"t":{"0":9}}'),
        row(1, '{"t":{"0":1}}', '{"t":{"0":6,"1":4}}', '{"t":{"0":9}}'),
    ], progress.PROGRESS)
    got = {tuple(r) for r in progress.running_lag(table).select("topic", "partition", "committed", "latest", "lag", "messages").collect()}
    assert got == {("t", 0, 6, 9, 3, 8), ("t", 1, 4, 4, 0, 4)}


def test_a_state_call_takes_many_waiting_rows(spark):
    """One row a minute for 2,000 minutes, in two arrivals that interleave: chunks are written, not minutes."""
    states, calls = {}, []

    class Counted(Kept):
        def updateValue(self, key, value):
            calls.append(key)
            super().updateValue(key, value)

    class Handle:
        def getMapState(self, name, *_):
            return states.setdefault(name, Counted())

        getValueState = getMapState

        def registerTimer(self, _):
            pass

    class Now:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    row = T.StructType([T.StructField(n, T.LongType()) for n in ("event_id", "event_us")] + [T.StructField("source_ip", T.StringType())] + [
        T.StructField(n, T.IntegerType()) for n in ("is_admin_action", "failed_action", "event_flag")])
    job, minute = state.ExactHistory(row, ["event_id", "time_since_last", *rolling.COUNTERS]), 60_000_000
    job.init(Handle())
    for first in (0, 1):
        ids = pd.Series(range(first, 2000, 2)).sample(frac=1, random_state=3)
        pdf = pd.DataFrame({"event_id": ids, "event_us": ids * minute, "source_ip": "a", "is_admin_action": 1, "failed_action": 0, "event_flag": 1})
        list(job.handleInputRows(("u",), iter([pdf[:300], pdf[300:]]), Now(0)))
    assert len(calls) <= 20 and all(len(v[0]) <= 512 for v in states["waiting"].values.values())
    out = [list(job.handleExpiredTimer(("u",), Now(upto * 60_000), None)) for upto in (999, 2100)]
    got = pd.concat([pdf for frames in out for pdf in frames])
    assert got["event_id"].tolist() == list(range(2000)) and (got["time_since_last"].iloc[1:] == 60).all()
    assert got["events_1h"].tolist() == [min(i + 1, 60) for i in range(2000)] and not states["waiting"].values


def test_a_bucket_of_users_is_one_call(spark):
    """Three users, one of them unnamed, in two calls: each has the counters of a user alone, and one state entry."""
    states = {}

    class Handle:
        def getMapState(self, name, *_):
            return states.setdefault(name, Kept())

        getValueState = getMapState

    job = state.ServingHistory(["event_id", "time_since_last", "is_first_ip", "ip_changed", *rolling.COUNTERS])
    job.init(Handle())
    start = pd.DataFrame([("a", None, None, 5_000_000, 1, 19, 2, 99)], columns=["user_id", *job.STATE.names])
    job.handleInitialState((7,), start, None)
    rows = pd.DataFrame({
        "event_id": range(9), "event_us": [9_000_000, 1, 2, 8_000_000, 70_000_002, 2, 9_000_000, 3, 80_000_000],
        "user_id": ["a", "b", None, "a", "b", "b", "a", None, None], "source_ip": ["x", None, "x", "y", "y", "z", "y", "y", "x"],
        "is_admin_action": 1, "failed_action": 0, "event_flag": 1})
    got = pd.concat([f for part in (rows[:7], rows[7:]) for f in job.handleInputRows((7,), iter([part[:4], part[4:]]), None)])
    got = {r[0]: r[1:] for r in got.itertuples(index=False, name=None)}
    # gap, first address, change, hops, admin actions, failures, events
    assert got == {
        3: (3.0, 1, 0, 1, 20, 2, 100), 0: (1.0, 0, 1, 2, 20, 2, 100), 6: (0.0, 1, 1, 3, 20, 2, 100),
        1: (0.0, 0, 0, 0, 1, 0, 1), 5: (1e-6, 1, 0, 0, 2, 0, 2), 4: (70.0, 0, 1, 1, 3, 0, 3),
        2: (0.0, 1, 0, 0, 1, 0, 1), 7: (1e-6, 0, 1, 1, 2, 0, 2), 8: (79.999997, 1, 1, 2, 3, 0, 3)}
    assert set(states["history"].values) == {("a",), ("b",), (None,)}


def test_a_user_without_id_has_a_history(spark, tmp_path):
    rows = [(i, START + timedelta(minutes=i), None if i % 2 else "u", "1.1.1.1", "read", True) for i in range(6)]
    out = str(tmp_path / "out")
    finish(state.serving_history(slices(spark, [rows[:3], rows[3:]], str(tmp_path / "in"))), jobs.table_sink(out), tmp_path / "cp")
    assert sorted((r["event_id"], r["user_id"], r["events_1h"]) for r in spark.read.parquet(out).collect()) == [
        (i, None if i % 2 else "u", i // 2 + 1) for i in range(6)]
