"""Streaming jobs: where batches go, and how a repeated batch changes nothing.

Every batch is written to its own folder, named by its id, with overwrite: if a batch runs again after a
failure, it replaces what it wrote before.
"""

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from watchmill.operators import report
from watchmill.operators.projection import blank_users, named_users
from watchmill.sources import sinks
from watchmill.sources.streams import good_messages, poison_messages

Sink = Callable[[DataFrame, int], None]


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def run(
    stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "append", every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a job. ``every=None`` works off what there is and ends; otherwise it is the trigger interval.

    The checkpoint holds the source position, so a restarted job goes on where it stopped. It also fixes the
    number of state partitions of its first start; choose it for the users and the cores to come.
    """
    writer = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    conf = stream.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions or before))
    try:
        return writer.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def table_sink(path: str) -> Sink:
    return lambda df, batch_id: write_batch(df, path, batch_id)


def fan_out_sink(events_path: str, alerts_path: str, extra: list[Sink] | None = None) -> Sink:
    """All predictions to one table, threats to another; the batch is computed once. What follows the table reads it there, so
    no task keeps a batch."""
    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch(df, events_path, batch_id)
        there = df.sparkSession.read.schema(df.schema).parquet(f"{events_path}/batch_id={batch_id}")
        write_batch(sinks.alert_messages(there), alerts_path, batch_id)
        for more in extra or []:
            more(there, batch_id)

    return sink


def quarantine_sink(good_path: str, poison_path: str) -> Sink:
    """Readable messages to one table, the text of the others to a second."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            write_batch(good_messages(df), good_path, batch_id)
            write_batch(poison_messages(df), poison_path, batch_id)
        finally:
            df.unpersist()

    return sink


def late_sink(on_time_path: str, late_path: str, delay_seconds: int) -> Sink:
    """Split a stream before a stateful job would drop late rows without a word.

    Late is what lies more than the delay before the newest event of the batches before, which is also what
    Spark's watermark means. A row without a time can wait for no watermark and goes to the late ones, in every batch.
    """
    seen = f"{late_path}-newest"

    def sink(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            late = _is_late(df, seen, batch_id, delay_seconds)
            write_batch(df.filter(~late), on_time_path, batch_id)
            write_batch(df.filter(late), late_path, batch_id)
        finally:
            df.unpersist()

    return sink


def _is_late(df: DataFrame, seen: str, batch_id: int, delay_seconds: int) -> Column:
    """Whether a row has no time or one behind the watermark; keeps the newest time so far, a row per batch, of which
    only the last is read."""
    spark, newest = df.sparkSession, None
    if batch_id > 0:
        newest = spark.read.parquet(f"{seen}/batch_id={batch_id - 1}").first()["newest"]
    upto = F.greatest(F.max(F.unix_micros("timestamp")), F.lit(newest).cast("long"))
    write_batch(df.agg(upto.alias("newest")), seen, batch_id)
    border = None if newest is None else newest // 1000 * 1000 - delay_seconds * 1_000_000
    late = F.lit(False) if border is None else F.unix_micros("timestamp") <= border
    return F.col("timestamp").isNull() | F.coalesce(late, F.lit(False))


SIDE_TABLES = ("poison", "blank", "timeless", "late")


def intake_sink(folder: str, delay_seconds: int) -> Sink:
    """What comes before a stateful job: of parsed messages (``parse_events``) only those go to ``events`` that
    it can take; the others go to a side table each, so that every message is in one table.

    The scoring job (``predict_stream``) follows the folder ``events``.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            write_batch(poison_messages(df), f"{folder}/poison", batch_id)
            good = good_messages(df)
            write_batch(blank_users(good), f"{folder}/blank", batch_id)
            named = named_users(good)
            write_batch(named.filter(F.col("timestamp").isNull()), f"{folder}/timeless", batch_id)
            timed = named.filter(F.col("timestamp").isNotNull())
            late = _is_late(timed, f"{folder}/newest", batch_id, delay_seconds)
            write_batch(timed.filter(late), f"{folder}/late", batch_id)
            write_batch(timed.filter(~late), f"{folder}/events", batch_id)
        finally:
            df.unpersist()

    return sink


def rollup_stream(pred: DataFrame, delay: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts per window and user; run it in update mode."""
    return report.user_windows(pred.withWatermark("timestamp", delay), width)


def read_rollups(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of each window and user, added up per window."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in ("w", "user_id", "batch_id")]
    newest = rows.groupBy("w", "user_id").agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return report.window_totals(newest.select("w", "user_id", "v.*"))


def offsets_of(query: StreamingQuery) -> list[dict]:
    """Per source and partition: earliest, latest and processed offset of a broker source's last batch."""
    progress = query.lastProgress
    rows = []
    for source in (progress or {}).get("sources", []):
        parts = {name: source.get(name) for name in ("startOffset", "endOffset", "latestOffset")}
        parts = {k: json.loads(v) if isinstance(v, str) else v for k, v in parts.items()}
        for topic, ends in (parts["endOffset"] or {}).items() if isinstance(parts["endOffset"], dict) else []:
            if not isinstance(ends, dict):
                continue
            for part, committed in ends.items():
                start = ((parts["startOffset"] or {}).get(topic) or {}).get(part, 0)
                latest = ((parts["latestOffset"] or {}).get(topic) or {}).get(part, committed)
                rows.append({
                    "topic": topic, "partition": int(part), "earliest": start, "latest": latest, "committed": committed,
                })
    return rows
