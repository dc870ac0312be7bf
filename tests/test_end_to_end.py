"""Train small members on the smallest tables, then score batch and stream with the saved bundle."""

from pyspark.sql import functions as F

from checks import inputs as I
from checks.stream_queries import sliced
from watchmill import fixed_values as V
from watchmill.plans import training
from watchmill.plans.scoring import decide
from watchmill.session import fresh_path
from watchmill.sources import sinks
from watchmill.streaming import jobs
from watchmill.streaming.scoring import event_rows, predict_stream

SF_DIR = "/root/testdata/sf0.001"


def test_stream_and_batch_agree_with_one_bundle(spark, tmp_path):
    rows, people = I.events_and_profiles(spark, SF_DIR)
    result = training.train(rows, people, training.Sizes(2, 2, 2, 2))
    bundle = result.bundle
    assert 0 < bundle.threshold <= 1 and {r["model"] for r in result.quality.collect()} == {"ensemble", *V.MEMBER_WEIGHTS}
    balance = {r["part"]: r["rows"] for r in result.balance.collect()}
    assert balance == {"train": 800, "test": 200}

    log = I.log_events(spark, SF_DIR)
    batch = decide(training.score_events(event_rows(log), people, bundle), bundle.threshold, bundle.weights)
    want = {r["event_id"]: (r["is_threat"], r["threat_action"], r["threat_score"]) for r in batch.collect()}

    end = log.orderBy(F.desc("timestamp")).limit(1).withColumns({
        "timestamp": F.col("timestamp") + F.expr("INTERVAL 2 HOURS"), "user_id": F.lit("nobody"),
    })
    path = fresh_path(spark, "log-slices")
    numbered = log.withColumn("event_id", F.col("event_id").cast("bigint"))
    for part in sliced(numbered):
        part.coalesce(1).write.mode("append").parquet(path)
    end.withColumn("event_id", F.lit(-1).cast("bigint")).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(numbered.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out, alerts = str(tmp_path / "out"), str(tmp_path / "alerts")
    predictions = predict_stream(event_rows(stream), people, bundle)
    columns = ["event_id", "timestamp", "user_id", "is_threat", "threat_action", "threat_score"]
    jobs.run(predictions.select(*columns), jobs.fan_out_sink(out, alerts), str(tmp_path / "cp")).awaitTermination()
    got = {r["event_id"]: (r["is_threat"], r["threat_action"], r["threat_score"]) for r in spark.read.parquet(out).collect()}
    assert got == want
    assert spark.read.parquet(alerts).count() == sum(threat for threat, _, _ in want.values())


def test_audit_and_threat_tables_are_daily(spark, tmp_path):
    pred = I.predictions(spark, SF_DIR)
    sinks.append_by_date(sinks.audit_rows(pred), str(tmp_path / "audit"))
    audit = spark.read.parquet(str(tmp_path / "audit"))
    assert audit.count() == 1000 and audit.select("event_date").distinct().count() == 30
    plan = audit.filter("event_date = date'2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
