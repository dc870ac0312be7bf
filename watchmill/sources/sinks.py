"""Batch sinks. Streaming jobs call the same functions from ``foreachBatch``."""

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from watchmill.functions import decision as D
from watchmill.operators.keys import LOCAL_ROWS

# rows of a file of the daily tables
FILE_ROWS = 1_000_000
_IP = r"^(\d{1,3}\.){3}\d{1,3}$|^[0-9A-Fa-f:]*:[0-9A-Fa-f:]+$"


# the JSON writer's own format stops at milliseconds
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def as_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns), JSON_TIME)


def valid_ip(ip: Column) -> Column:
    """Malformed addresses become null instead of failing the row."""
    return F.when(ip.rlike(_IP), ip)


def _present(df: DataFrame, name: str, default: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in df.columns else F.lit(default)


def raw_messages(df: DataFrame) -> DataFrame:
    """Broker rows: the user is the key, so one user's events stay in order on one partition."""
    return df.select(F.col("user_id").alias("key"), as_json("*").alias("value"))


def alert_messages(pred: DataFrame) -> DataFrame:
    body = F.struct(
        "event_id", "threat_score", F.col("threat_action").alias("action"), F.col("user_id").alias("user"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    return pred.filter("is_threat").select(F.col("event_id").cast("string").alias("key"), F.to_json(body).alias("value"))


def audit_rows(pred: DataFrame) -> DataFrame:
    details = [c for c in ("user_id", "source_ip", "ip_region", "action", "anomaly_type") if c in pred.columns]
    return pred.select(
        F.col("timestamp").alias("event_time"),
        "event_id",
        F.lit("pipeline_complete").alias("pipeline_stage"),
        F.col("threat_action").alias("action_taken"),
        "threat_score",
        "is_threat",
        valid_ip(_present(pred, "source_ip", "0.0.0.0")).alias("source_ip"),
        valid_ip(_present(pred, "destination_ip", "0.0.0.0")).alias("destination_ip"),
        _present(pred, "user_id", "unknown").alias("user"),
        _present(pred, "event_type", "unknown").alias("event_type"),
        _present(pred, "process_name", "").alias("process_name"),
        F.to_json(F.struct(*details)).alias("details"),
    )


def threat_rows(pred: DataFrame) -> DataFrame:
    high = D.is_high_severity(F.col("is_threat"), F.col("threat_action"))
    return pred.filter("is_threat").select(
        F.col("timestamp").alias("event_time"),
        "event_id",
        "threat_score",
        "threat_action",
        F.coalesce("anomaly_type", F.lit("unknown")).alias("attack_type"),
        valid_ip(F.col("source_ip")).alias("source_ip"),
        "ip_region",
        F.col("user_id").alias("user"),
        "action",
        "xgb_score",
        "lgbm_score",
        "ensemble_score",
        high.alias("vault_rotation_triggered"),
        (high & (F.col("threat_action") == "CRITICAL_ALERT")).alias("infra_rotation_pending"),
        F.lit(False).alias("credentials_rotated"),
    )


def with_event_date(df: DataFrame, time: str = "event_time") -> DataFrame:
    return df.withColumn("event_date", F.to_date(time))


def _write_daily(df: DataFrame, path: str) -> None:
    """Daily folders, so that a reader's date filter skips the others.

    A first pass counts the days' rows. A day goes to as few tasks as files of ``FILE_ROWS`` need, so that what a task holds
    does not depend on how well the rows compress. For very many days Spark gathers and splits them by their bytes.
    """
    day = F.unix_date("event_date")
    days = df.groupBy(day.alias("day")).count().select("day", F.ceil(F.col("count") / FILE_ROWS).alias("files"))
    head = days.limit(LOCAL_ROWS + 1).collect()
    if len(head) > LOCAL_ROWS:
        rows = df.hint("rebalance", "event_date")
    else:
        firsts = accumulate((r["files"] for r in head), initial=0)
        places = df.sparkSession.createDataFrame([(*r, at) for r, at in zip(head, firsts)], "day int, files long, first long")
        # what can be hashed
        names = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        place = F.coalesce(F.col("first") + F.pmod(F.xxhash64(*names), F.col("files")), F.lit(0)).cast("int")
        placed = df.join(F.broadcast(places), day.eqNullSafe(F.col("day")), "left").withColumn("place", place)
        rows = placed.repartitionById(max(1, sum(r["files"] for r in head)), F.col("place")).select(*df.columns)
    rows.write.mode("append").partitionBy("event_date").parquet(path)


def append_by_date(df: DataFrame, path: str, time: str = "event_time") -> None:
    _write_daily(with_event_date(df, time), path)


def write_conn(conn: DataFrame, path: str) -> None:
    """Daily folders by the record's own time; ``event_date`` is ``yyyy-MM-dd``."""
    dated = conn.withColumn("event_date", F.to_date(F.timestamp_micros((F.col("ts") * 1_000_000).cast("bigint"))))
    _write_daily(dated, path)


def export_profiles(profiles: DataFrame, path: str) -> None:
    profiles.write.mode("overwrite").json(path)


def write_network_logs(events: DataFrame, path: str, compression: str | None = None) -> None:
    """``compression`` is a codec of Spark's text writers, such as ``gzip``; readers know it by the files' names."""
    text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    events.withColumn("timestamp", text).write.mode("overwrite").csv(path, header=True, compression=compression)
