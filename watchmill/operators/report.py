"""Numbers for dashboards."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchmill import fixed_values as V
from watchmill.functions import decision as D
from watchmill.functions.display import score_pct
from watchmill.operators.ordering import running_totals

_COUNTS = {
    "total_allowed": "ALLOW", "total_monitored": "MONITOR", "total_blocked": "BLOCK",
    "total_critical": "CRITICAL_ALERT",
}


def metric_sums(latency: str = "latency_ms") -> list[Column]:
    """Additive parts of the pipeline metrics: they can be summed again over batches."""
    return [
        F.count("*").alias("total_requests"),
        F.count_if("is_threat").alias("total_threats"),
        *[F.count_if(F.col("threat_action") == action).alias(name) for name, action in _COUNTS.items()],
        F.coalesce(F.sum(latency), F.lit(0.0)).alias("total_latency_ms"),
    ]


def finish_metrics(sums: DataFrame) -> DataFrame:
    average = F.col("total_latency_ms") / F.greatest("total_requests", F.lit(1))
    return sums.withColumn("avg_latency_ms", F.round(average, 2))


def pipeline_metrics(pred: DataFrame) -> DataFrame:
    return finish_metrics(pred.agg(*metric_sums()))


def health_blocked(metrics: DataFrame) -> DataFrame:
    return metrics.select((F.col("total_blocked") + F.col("total_critical")).alias("total_threats_blocked"))


def attack_types(pred: DataFrame) -> DataFrame:
    kind = F.coalesce("anomaly_type", F.lit("unknown")).alias("attack_type")
    return pred.filter("is_threat").groupBy(kind).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "attack_type")


def attack_type_map(counts: DataFrame) -> DataFrame:
    """The counts as one map, for the edge; there is one entry per kind of attack."""
    pairs = F.collect_list(F.struct("attack_type", "n"))
    return counts.agg(F.map_from_entries(pairs).alias("attack_types"))


def threats_by_action(threats: DataFrame) -> DataFrame:
    return threats.groupBy("threat_action").agg(F.count("*").alias("n"))


def threats_by_attack(threats: DataFrame, buckets: int = V.ATTACK_BUCKETS) -> DataFrame:
    return threats.groupBy("attack_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "attack_type").limit(buckets)


def auto_allowed(pred: DataFrame) -> DataFrame:
    free = D.is_auto_allowed(F.col("is_threat"), F.col("threat_action"))
    return pred.agg(F.count_if(free).alias("total_auto_allowed"))


def _percent(threats: Column, total: Column) -> Column:
    return F.when(total > 0, threats / total * 100).otherwise(F.lit(0.0))


def _level(percent: Column) -> Column:
    return (
        F.when(percent > V.LEVEL_CRITICAL_PERCENT, "CRITICAL")
        .when(percent > V.LEVEL_ELEVATED_PERCENT, "ELEVATED")
        .otherwise("NOMINAL")
    )


def threat_level(pred: DataFrame) -> DataFrame:
    sums = pred.agg(F.count_if("is_threat").alias("threats"), F.count("*").alias("total"))
    percent = _percent(F.col("threats"), F.col("total"))
    return sums.select(
        percent.alias("threat_percent"), _level(percent).alias("threat_level"),
        F.least(percent * 5, F.lit(100.0)).alias("level_fill"),
    )


def running_threat_level(pred: DataFrame) -> DataFrame:
    """The level after each event in time order."""
    ones = pred.select(
        F.unix_micros("timestamp").alias("event_us"), "event_id", F.col("is_threat").cast("int").alias("threats"),
        F.lit(1).alias("total"),
    )
    rows = running_totals(ones, ["event_us", "event_id"], ["threats", "total"])
    percent = _percent(F.col("threats_upto"), F.col("total_upto"))
    return rows.select(
        "event_id", "event_us", F.col("total_upto").alias("events"), F.col("threats_upto").alias("threats"),
        percent.alias("threat_percent"), _level(percent).alias("threat_level"),
    )


def running_threat_level_by(pred: DataFrame, width: str = "1 hour") -> DataFrame:
    """The level at the end of each time bucket: counts first, then a running sum over one row per bucket."""
    counts = pred.groupBy(F.window("timestamp", width).alias("w")).agg(
        F.count_if("is_threat").alias("threats"), F.count("*").alias("total")
    )
    upto = Window.orderBy("w").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = counts.select(
        F.unix_micros("w.start").alias("bucket_us"), F.sum("threats").over(upto).alias("threats"),
        F.sum("total").over(upto).alias("events"),
    )
    percent = _percent(F.col("threats"), F.col("events"))
    return rows.select("*", percent.alias("threat_percent"), _level(percent).alias("threat_level"))


def safe_rates(pred: DataFrame) -> DataFrame:
    """Both definitions in use: not a threat, and allowed; 100 if there is no event."""
    sums = pred.agg(
        F.count("*").alias("total"), F.count_if("is_threat").alias("threats"), F.count_if(~F.col("is_threat")).alias("ok")
    )
    total = F.col("total")
    return sums.select(
        F.when(total > 0, (total - F.col("threats")) / total * 100).otherwise(F.lit(100.0)).alias("safe_rate_loaded"),
        F.when(total > 0, F.col("ok") / total * 100).otherwise(F.lit(100.0)).alias("safe_rate_live"),
    )


def offset_lag(offsets: DataFrame) -> DataFrame:
    """Lag and messages per partition from ``(topic, partition, earliest, latest, committed)``."""
    seen = (F.col("committed") >= 0) & (F.col("latest") >= 0)
    lag = F.when(seen, F.col("latest") - F.col("committed")).otherwise(F.lit(0))
    held = (F.col("earliest") >= 0) & (F.col("latest") >= 0)
    messages = F.when(held, F.col("latest") - F.col("earliest")).otherwise(F.lit(0))
    return offsets.select("topic", "partition", "committed", "latest", lag.alias("lag"), messages.alias("messages"))


def lag_summary(lags: DataFrame) -> DataFrame:
    sums = lags.agg(
        F.sum("lag").alias("total_lag"), F.sum("messages").alias("total_messages"),
        F.count_if(F.col("lag") > V.LAG_RAISED).alias("warned_partitions"),
    )
    level = F.when(F.col("total_lag") > V.LAG_HIGH, "high").when(F.col("total_lag") > V.LAG_RAISED, "raised")
    return sums.withColumn("lag_level", level.otherwise("ok"))


def user_windows(pred: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Counts per tumbling window and user; batch and stream."""
    high = D.is_high_severity(F.col("is_threat"), F.col("threat_action"))
    return pred.groupBy(F.window("timestamp", width).alias("w"), "user_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("threat_action").isin("BLOCK", "CRITICAL_ALERT")).alias("blocked"),
        F.count_if(F.col("threat_action") == "MONITOR").alias("monitored"),
        F.count_if(F.col("threat_action") == "ALLOW").alias("allowed"),
        F.sum("latency_ms").alias("latency"),
        F.max(high).alias("risky"),
    )


def window_totals(per_user: DataFrame) -> DataFrame:
    """Totals per window; a user with many events is one row here."""
    return per_user.groupBy("w").agg(
        F.sum("n").alias("total_events"), F.sum("blocked").alias("blocked_events"),
        F.sum("monitored").alias("monitored_events"), F.sum("allowed").alias("allowed_events"),
        F.round(F.sum("latency") / F.sum("n"), 2).alias("avg_latency"),
        F.count_if("risky").alias("high_risk_users"),
    ).select(F.unix_micros("w.start").alias("window_us"), "*").drop("w")


def windowed_metrics(pred: DataFrame, width: str = "5 minutes") -> DataFrame:
    return window_totals(user_windows(pred, width))


def _point_or_server(col: str, axis: int) -> Column:
    return F.coalesce(F.nullif(F.col(col), F.lit(0.0)), F.lit(V.SERVER_GEO[axis]))


def geo_arcs(pred: DataFrame) -> DataFrame:
    return pred.select(
        "event_id",
        "timestamp",
        F.col("source_geo.lat").alias("start_lat"),
        F.col("source_geo.lng").alias("start_lng"),
        _point_or_server("destination_geo.lat", 0).alias("end_lat"),
        _point_or_server("destination_geo.lng", 1).alias("end_lng"),
        "is_threat",
        F.col("user_id").alias("user"),
        F.coalesce(F.nullif(F.col("source_geo.city"), F.lit("")), F.lit("Unknown")).alias("source_city"),
        F.coalesce(F.nullif(F.col("destination_geo.city"), F.lit("")), F.lit(V.SERVER_GEO[2])).alias("dest_city"),
        F.coalesce("threat_score", F.lit(0.0)).alias("threat_score"),
    )


def globe_points(pred: DataFrame, kept: int = V.POINTS_KEPT) -> DataFrame:
    """The server's point and the newest source points, ``kept`` in all."""
    points = newest(pred, "timestamp", kept - 1).select(
        "event_id",
        F.coalesce("source_geo.lat", F.lit(0.0)).alias("lat"),
        F.coalesce("source_geo.lng", F.lit(0.0)).alias("lng"),
        "is_threat",
        F.lit(False).alias("is_server"),
    )
    server = pred.sparkSession.range(1).select(
        F.lit(None).cast(pred.schema["event_id"].dataType).alias("event_id"), F.lit(V.SERVER_GEO[0]).alias("lat"),
        F.lit(V.SERVER_GEO[1]).alias("lng"), F.lit(False).alias("is_threat"), F.lit(True).alias("is_server"),
    )
    return server.unionByName(points)


def log_rows(pred: DataFrame, kept: int = V.LOG_KEPT) -> DataFrame:
    """The newest lines of the live log."""
    return newest(pred, "timestamp", kept).select(
        "event_id", "threat_action", F.coalesce(F.nullif(F.col("event_summary.user"), F.lit("")), F.lit("unknown")).alias("user"),
        F.coalesce(F.nullif(F.col("event_summary.source_ip"), F.lit("")), F.lit("--")).alias("source_ip"),
        score_pct(F.col("threat_score")).alias("score_pct"),
    )


def threat_feed(threats: DataFrame, shown: int = V.RECENT_THREATS) -> DataFrame:
    """Newest threats with severity and label."""
    plain = F.coalesce(F.col("attack_type"), F.lit("")).isin("", "None")
    return newest(threats, "event_time", shown).select(
        "event_id",
        F.when(F.col("threat_score") > V.ISOLATE_ABOVE, "critical").otherwise("high").alias("severity"),
        F.when(plain, "BLOCK").otherwise(F.col("attack_type")).alias("label"),
        F.coalesce(F.nullif(F.col("user"), F.lit("")), F.lit("unknown")).alias("user"),
        F.coalesce(F.nullif(F.col("source_ip"), F.lit("")), F.lit("--")).alias("source_ip"),
        score_pct(F.col("threat_score")).alias("score_pct"),
    )


def newest(df: DataFrame, time: str, n: int, key: str = "event_id") -> DataFrame:
    """The n latest rows: each task keeps its own n, no global sort."""
    return df.orderBy(F.desc(time), F.desc(key)).limit(n)
