import random

import pytest
from pyspark.sql import functions as F

from watchmill.operators import evaluate, ordering


def table(spark, n=500, seed=1):
    """Half of all rows share one microsecond, and one user has most rows."""
    rng = random.Random(seed)
    rows = [
        (f"{i:04d}", 1_700_000_000_000_000 + (5 if rng.random() < 0.5 else rng.randrange(10**10)), "u1" if rng.random() < 0.6 else f"u{rng.randrange(9)}")
        for i in rng.sample(range(n), n)
    ]
    return spark.createDataFrame(rows, "event_id string, event_us long, user_id string"), rows


@pytest.mark.parametrize("ratio", [0.0, 0.001, 0.25, 0.8, 1.0])
@pytest.mark.parametrize("method, key", [("time", lambda r: (r[1], r[0])), ("user", lambda r: (r[2], r[1], r[0]))])
def test_split_is_positional(spark, ratio, method, key):
    df, rows = table(spark)
    first, second = ordering.split(df, ratio, method)
    k = int(len(rows) * ratio)
    assert {r["event_id"] for r in first.collect()} == {r[0] for r in sorted(rows, key=key)[:k]}
    assert second.count() == len(rows) - k


def test_a_large_tie_is_split_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordering, "TOP_ROWS", 3)
    df, rows = table(spark)
    first, _ = ordering.split(df, 0.3)
    assert {r["event_id"] for r in first.collect()} == {r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))[:150]}


def test_running_totals(spark):
    df, rows = table(spark)
    got = ordering.running_totals(df.withColumn("one", F.lit(1)), ["event_us", "event_id"], ["one"])
    order = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    assert {r["event_id"]: r["one_upto"] for r in got.collect()} == {e: i + 1 for i, e in enumerate(order)}


def scores(spark, n=300, seed=2):
    rng = random.Random(seed)
    rows = [(round(rng.random() ** 3, 2), rng.random() < 0.3) for _ in range(n)]
    return spark.createDataFrame(rows, "s double, y boolean"), rows


def test_threshold_maximises_f1(spark):
    df, rows = scores(spark)
    def f1(t):
        tp = sum(y for s, y in rows if s >= t)
        fp = sum(not y for s, y in rows if s >= t)
        p, r = tp / (tp + fp), tp / sum(y for _, y in rows)
        return 2 * p * r / (p + r + 1e-8)
    best = max(sorted({s for s, _ in rows}), key=f1)
    curve = evaluate.pr_curve(df, "s", "y")
    assert curve.count() == len({s for s, _ in rows})
    assert evaluate.best_threshold_value(curve) == best


def test_roc_auc_counts_pairs(spark):
    df, rows = scores(spark)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    both = df.withColumns({"a": F.col("s"), "b": 1 - F.col("s")})
    got = {r["model"]: r["roc_auc"] for r in evaluate.roc_auc(both, ["a", "b"], "y").collect()}
    assert got["a"] == pytest.approx(want) and got["b"] == pytest.approx(1 - want)


def test_no_scores_and_no_positives(spark):
    empty = spark.createDataFrame([], "s double, y boolean")
    assert evaluate.best_threshold_value(evaluate.pr_curve(empty, "s", "y")) == 0.5
    calm = spark.createDataFrame([(0.2, False), (0.4, False)], "s double, y boolean")
    assert evaluate.roc_auc(calm, ["s"], "y").first()["roc_auc"] is None
    cells = evaluate.confusion(calm, F.col("s") >= 0.3, "y")
    assert tuple(evaluate.quality(cells).first()) == (0.5, 0.0, 0.0, 0.0)
    assert {r["class"]: r["support"] for r in evaluate.class_report(cells).collect()}["Threat"] == 0


@pytest.mark.parametrize("method", ["time", "user"])
@pytest.mark.parametrize("ratio", [0.0, 0.5, 0.8, 1.0])
def test_split_keeps_rows_without_a_time(spark, method, ratio):
    rows = [(f"e{i:03}", None if i % 5 == 0 else i // 3, None if i % 11 == 0 else f"u{i % 4}") for i in range(100)]
    df = spark.createDataFrame(rows, "event_id string, event_us long, user_id string")
    first, second = ([r["event_id"] for r in part.collect()] for part in ordering.split(df, ratio, method))
    assert sorted(first + second) == [r[0] for r in rows]
    late = {r[0] for r in rows if (r[1] is None and method == "time") or (r[2] is None and method == "user")}
    assert late <= set(second) and len(first) <= int(100 * ratio)
    if ratio <= 0.8 and method == "time":
        assert len(first) == int(100 * ratio)


def test_roc_auc_of_very_many_rows(spark):
    """Products of 10 and 100 thousand million pass the range of bigint."""
    hist = spark.createDataFrame([("a", 0.2, 0, 10**11), ("a", 0.7, 10**10, 10**11), ("b", 0.5, 10**10, 2 * 10**11)], "model string, score double, pos long, neg long")
    got = {r["model"]: r["roc_auc"] for r in evaluate.histogram_auc(hist, ["a", "b"]).collect()}
    assert got["a"] == pytest.approx(0.75) and got["b"] == pytest.approx(0.5)


@pytest.mark.parametrize("method", ["time", "user"])
def test_split_on_the_stored_time_reaches_the_scan(spark, tmp_path, method):
    df, _ = table(spark, 300, 4)
    df = df.withColumn("timestamp", F.when(F.col("event_us") % 11 != 0, F.timestamp_micros("event_us"))).drop("event_us")
    df.write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).withColumn("event_us", F.unix_micros("timestamp"))
    plain, pushed = ordering.split(rows, 0.7, method), ordering.split(rows, 0.7, method, "timestamp")
    for a, b in zip(plain, pushed):
        assert sorted(r["event_id"] for r in a.collect()) == sorted(r["event_id"] for r in b.collect())
    column = "timestamp" if method == "time" else "user_id"
    for part, sign in zip(pushed, ("LessThanOrEqual", "GreaterThanOrEqual")):
        plan = part._jdf.queryExecution().toString()
        assert f"{sign}({column}," in plan.split("PushedFilters")[-1]
