"""What the work and the memory of a task depend on, in plans and on rows made here."""

import time

import pytest
from pyspark.sql import functions as F

from checks import inputs as I
from checks import queries as Q
from checks import stream_queries as SQ
from watchmill.functions import conn as C
from watchmill.operators import keys
from watchmill.sources import driver_tables as T
from watchmill.sources import sinks
from watchmill.streaming import jobs


@pytest.fixture()
def tables(spark, tmp_path):
    """Ten customers, two of them with ids that are equal after five digits, and forty events; one user is not a customer."""
    keys = [1, 2, 3, 4, 5, 6, 7, 8, 123450, 123451]
    rows = {
        "customer": [(k, f"c{k}", k % 2, 10.0 * k, "BUILDING") for k in keys],
        "nation": [(0, "a", 1), (1, "b", 2)],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, T.TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    users = [1, 2, 123450, 9]
    events = spark.range(40).select(
        F.col("id").alias("event_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id") * 7)).alias("ts"),
        F.element_at(F.array(*[F.lit(u) for u in users]), (F.col("id") % 4 + 1).cast("int")).cast("bigint").alias("user_id"),
        F.lit("view").alias("event_type"), F.col("id").cast("double").alias("value"),
        F.concat(F.lit('{"k": '), F.col("id").cast("string"), F.lit("}")).alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_a_text_without_digits_costs_no_more_than_one_with(spark):
    rows = spark.range(0, 400_000, 1, 1)

    def seconds(prefix, digits):
        text = F.concat(F.lit(prefix), F.when(F.col("id") >= 0, F.lit(digits)).otherwise(F.col("id").cast("string")))
        started = time.process_time(), time.time()
        rows.select(C.resp_ip(text).alias("ip")).write.format("noop").mode("overwrite").save()
        return time.time() - started[1]

    seconds("a-", "7")
    with_digits, without = min(seconds("read-", "12") for _ in range(3)), min(seconds("read-", "xx") for _ in range(3))
    assert without < 2 * with_digits + 0.1


def test_resp_ip_of_odd_texts(spark):
    texts = ["WS-7", "WS-12", "a1b2c3", "read", "", None, "x100", "٣", "00", "-"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(C.resp_ip(F.col("t"))).collect()
    assert [r[0] and int(r[0].rpartition(".")[2]) - 100 for r in got] == [7, 12, 23, 1, 1, 1, 0, 1, 0, 1]


@pytest.mark.parametrize("name", ["a11_raw_messages", "a15_conn_messages"])
def test_a_message_is_parsed_once(spark, tables, name):
    df = Q.QUERIES[name](spark, tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate json_tuple") == 1 and "get_json_object(value" not in plan
    assert df.count() == 50 and all(r[1] is not None for r in df.collect())


def test_many_rows_get_tasks_by_their_number(spark, tables, monkeypatch):
    names = ["c9_new_ip", "c6_geo", "d1_logs_profiles"]
    plain = {n: rows_of(Q.QUERIES[n](spark, tables)) for n in names}
    history = I.exact(spark, tables)
    assert "REPARTITION_BY_NUM" not in history._jdf.queryExecution().executedPlan().toString()
    for module, name, value in ((T, "SMALL_ROWS", 2), (T, "TASK_CUSTOMERS", 1), (keys, "MERGED_ROWS", 10), (keys, "TASK_ROWS", 5)):
        monkeypatch.setattr(module, name, value)
    # ten customers; fifty joined events, five in a task
    assert T.profiles(spark, tables).rdd.getNumPartitions() == 10
    plan = I.exact(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and "10), REPARTITION_BY_NUM" in plan
    assert {n: rows_of(Q.QUERIES[n](spark, tables)) for n in names} == plain
    # ten events have two profiles, by which they meet twice more
    assert len(plain["c9_new_ip"]) == 70 and len(plain["c6_geo"]) == 70


def test_daily_files_are_bounded_by_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_ROWS", 100)
    day = F.when(F.col("id") % 10 == 0, F.lit("2024-01-02")).when(F.col("id") != 7, F.lit("2024-01-01")).cast("date")
    rows = spark.range(2000).select("id", F.create_map(F.lit("k"), F.col("id")).alias("m"), day.alias("event_date"))
    far = spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit(None).cast("map<string,long>").alias("m"), F.date_from_unix_date(F.lit(9_000_000)).alias("event_date"))
    path = str(tmp_path / "daily")
    sinks._write_daily(rows.unionByName(far), path)
    back = spark.read.parquet(path)
    sizes = back.groupBy(F.input_file_name().alias("file")).count().collect()
    # 18 files' worth and 2 files' worth by hash, one for the row without a day, one far away
    assert max(r["count"] for r in sizes) < 200 and len(sizes) <= 22
    assert back.count() == 2001 and back.select("id").distinct().count() == 2001
    assert back.filter("event_date = '2024-01-02'").count() == 200 and back.filter("event_date is null").count() == 1
    sinks._write_daily(rows.limit(0), str(tmp_path / "none"))


def test_few_small_files_of_events_are_dealt_over_all_cores(spark, tables, monkeypatch):
    """A stream's events and the messages made of them become more by the join with the profiles."""
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(SQ, "replay", lambda spark, parts, build, *_: build(parts[0].coalesce(1)))
    assert SQ.replay_events(spark, tables, lambda events: events).rdd.getNumPartitions() == cores > 1
    rows, arrival = SQ.late_arrivals(spark, tables)
    part = rows.filter(arrival == SQ.SLICES - 1)
    assert part.rdd.getNumPartitions() == cores
    plan = part._jdf.queryExecution().optimizedPlan().toString()
    # the slice is cut before the join, and what it is cut by is not made of joined rows
    assert plan.index("Join") < plan.index("Filter")


def test_what_follows_from_the_event_is_made_before_the_join(spark, tables):
    for name, made in (("c3_hour_circle", "SIN("), ("c6_geo", "AS impossible_travel_int")):
        plan = Q.QUERIES[name](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index(made) and made not in plan[: plan.index("Join")]
    assert "round(" not in Q.QUERIES["c3_hour_circle"](spark, tables)._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    # an event is once there for each pair of its user's profiles
    assert Q.QUERIES["c3_hour_circle"](spark, tables).count() == 70


def test_rounded_equals_round(spark):
    import random

    rng = random.Random(5)
    values = [None, 0.0, -0.0, float("nan"), float("inf"), -float("inf"), 1e15 + 0.5, 2.0**60, 144.0, 999.9999999995, 1e-10, -1e-10, 5e-10, 4.9e-10, 1e300]
    values += [(rng.randrange(10**11) * 10 + 5) / 1e10 * s for s in (1, -1) for _ in range(2000)]
    values += [rng.uniform(-2, 2) * 10 ** rng.randrange(-12, 8) for _ in range(6000)]
    values += [(2 * rng.randrange(10**6) + 1) / 2.0 ** rng.randrange(1, 24) for _ in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "a double").select("a", F.col("a").alias("b"), F.col("a").cast("float").alias("f"))
    for digits in (6, 9):
        got = Q.rounded(rows, "b", digits=digits).select("b", F.round("a", digits).alias("a")).collect()
        assert [repr(r[0]) for r in got] == [repr(r[1]) for r in got]
    assert Q.rounded(rows, "f").schema["f"].dataType.typeName() == "float"
    plan = Q.rounded(rows, "b")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan


def test_a_batch_that_fans_out_is_kept_nowhere(spark, tmp_path, monkeypatch):
    """The alerts come from the written batch: nothing is persisted, and the batch is computed once."""
    rows = spark.createDataFrame([(i, i % 3 == 0, 0.5, "BLOCK", "u") for i in range(30)], "event_id int, is_threat boolean, threat_score double, threat_action string, user_id string")
    rows = rows.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    monkeypatch.setattr(type(rows), "persist", lambda *a: pytest.fail("a batch in memory"))
    seen = []
    jobs.fan_out_sink(str(tmp_path / "all"), str(tmp_path / "alerts"), [lambda df, nr: seen.append((df.count(), nr))])(rows, 4)
    assert spark.read.parquet(str(tmp_path / "all")).count() == 30 and spark.read.parquet(str(tmp_path / "alerts")).count() == 10
    assert seen == [(30, 4)]
