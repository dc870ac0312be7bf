"""Streaming operators, run over the whole events table in several micro-batches, read back as tables."""

import os
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks import inputs as I
from checks.queries import CODEC, CONN_COLUMNS, COUNTERS, add, as_read, conn_log, query, repeated_docs
from watchmill.operators import bridge, conn_etl, rolling
from watchmill.operators import ledger as batch_ledger
from watchmill.plans.scoring import decide
from watchmill.session import fresh_path, prepare
from watchmill.sources import driver_tables as T
from watchmill.sources import sinks, streams
from watchmill.streaming import jobs, ledger, progress, state, totals

SLICES = 4


def slice_of(table: DataFrame):
    """Which quarter of the event ids a row lies in: ids rise with time, so the slices arrive in time order."""
    total = table.agg(F.max("event_id")).first()[0] + 1
    return F.floor(F.col("event_id") * SLICES / F.lit(total))


def sliced(table: DataFrame) -> list[DataFrame]:
    part = slice_of(table)
    return [table.filter(part == i) for i in range(SLICES)]


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of the events table over all cores: a slice of it lies in few small files, and each of its rows becomes as many
    as its user has profiles."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def closing_row(table: DataFrame) -> DataFrame:
    """A later row of no user: with it the watermark passes all others."""
    return table.orderBy(F.desc("ts")).limit(1).withColumns({
        "ts": F.col("ts") + F.expr("INTERVAL 2 HOURS"), "user_id": F.lit(-1).cast("bigint"),
    })


def finish(spark, stream, sink=None, mode="append", checkpoint=None, path=None):
    """Run to the end; the path of the table if there is no other sink."""
    path, checkpoint = path or fresh_path(spark, "out"), checkpoint or fresh_path(spark, "checkpoint")
    cores = spark.sparkContext.defaultParallelism
    jobs.run(stream, sink or jobs.table_sink(path), checkpoint, mode, state_partitions=cores).awaitTermination()
    return path


def replay(spark, parts: list[DataFrame], build, sink=None, mode="append") -> str:
    """Feed one part after the other to one job, which stops and resumes in between.

    Each part is one micro-batch, into however many files its tasks write it.
    """
    files, path, checkpoint = (fresh_path(spark, n) for n in ("arrivals", "out", "checkpoint"))
    for part in parts:
        part.write.mode("append").parquet(files)
        stream = build(spark.readStream.schema(part.schema).parquet(files))
        finish(spark, stream, sink, mode, checkpoint, path)
    return path


def replay_events(spark, d, build, sink=None, mode="append", closing=False, first=0) -> str:
    """The events table as network events, from its slice ``first`` on."""
    table = T.table(prepare(spark), d, "events")
    people = T.profiles(spark, d, spread=False)

    def events(rows):
        return build(T.net_events(spark, d, dealt(rows), people).withColumn("latency_ms", F.col("k") * F.lit(0.25)))

    return replay(spark, sliced(table)[first:] + ([closing_row(table)] if closing else []), events, sink, mode)


@query
def a5_conn_stream(spark, d):
    stream = conn_etl.convert_conn(streams.stream_conn_log(spark, conn_log(spark, d)))
    return spark.read.parquet(finish(spark, stream)).select(*CONN_COLUMNS)


def log_bytes(folder: str):
    """The bytes of a written log, block by block."""
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            with open(f"{folder}/{name}", "rb") as file:
                while block := file.read(1 << 20):
                    yield block


@query
def a5_conn_tail(spark, d):
    """One log that grows: quarters are appended, cut within a line, and it is rotated once; the job resumes after each."""
    source, grown = (fresh_path(spark, n).removeprefix("file:") for n in ("conn", "tail"))
    spark.read.text(conn_log(spark, d)).write.text(source)
    os.makedirs(grown)
    log, out, checkpoint = f"{grown}/conn.log", fresh_path(spark, "out"), fresh_path(spark, "checkpoint")
    size, done, written = sum(os.path.getsize(f"{source}/{n}") for n in os.listdir(source) if n.startswith("part-")), 0, 0

    def caught_up():
        finish(spark, conn_etl.convert_conn(streams.tail_conn_log(spark, log)), checkpoint=checkpoint, path=out)

    for block in log_bytes(source):
        while block:
            until = size * (done + 1) // SLICES
            part, block = block[: until - written], block[until - written :]
            with open(log, "ab") as file:
                file.write(part)
            written += len(part)
            if written == until:
                done += 1
                if done == 2:  # a log is rotated at the end of a line
                    line, newline, block = block.partition(b"\n")
                    with open(log, "ab") as file:
                        file.write(line + newline)
                    written += len(line + newline)
                    os.rename(log, f"{log}.1")
                else:
                    caught_up()
    return spark.read.parquet(out).select(*CONN_COLUMNS)


@query
def a6_event_stream(spark, d):
    path = fresh_path(spark, "messages")
    sinks.raw_messages(I.log_events(spark, d)).select("value").write.text(path, compression=CODEC)
    return as_read(spark.read.parquet(finish(spark, streams.stream_events(spark, "files", path))))


@query
def a20_merge_metrics(spark, d):
    """A batch that runs twice counts once."""
    path = fresh_path(spark, "metrics")
    sink = totals.metrics_sink(path, half=2)

    def twice(df, batch_id):
        sink(df, batch_id)
        sink(df, batch_id)

    replay_events(spark, d, decide, twice)
    return totals.read_metrics(spark, path)


@query
def e11_running_rows(spark, d):
    """A job that is followed by a listener: what its progress table says of its batches and rows."""
    path = fresh_path(spark, "progress")
    log = progress.ProgressLog(spark, path).follow()
    try:
        files, out, checkpoint = (fresh_path(spark, n) for n in ("arrivals", "out", "checkpoint"))
        for part in sliced(T.table(prepare(spark), d, "events")):
            part.write.mode("append").parquet(files)
            stream = spark.readStream.schema(part.schema).parquet(files)
            job = jobs.run(stream, jobs.table_sink(out), checkpoint)
            job.awaitTermination()
            log.wait(job)
    finally:
        log.leave()
    return progress.rates(progress.read_progress(spark, path)).select("batches", "input_rows")


@query
def s1_scored_stream(spark, d):
    rows = spark.read.parquet(replay_events(spark, d, decide))
    return rows.select(F.col("event_id").cast("string").alias("event_id"), "is_threat", "threat_action", "threat_score")


STATE_INPUT = ["event_id", "timestamp", "user_id", "source_ip", "action", "success"]


def state_output(df, first):
    return df.select(
        F.col("event_id").cast("string").alias("event_id"), first, *COUNTERS, "time_since_last", "rapid_succession"
    )


@query
def s2_serving_state(spark, d):
    path = replay_events(spark, d, lambda events: state.serving_history(events.select(*STATE_INPUT)))
    return state_output(spark.read.parquet(path), "is_first_ip")


@query
def s3_exact_state(spark, d):
    path = replay_events(spark, d, lambda events: state.exact_history(events.select(*STATE_INPUT)), closing=True)
    return state_output(spark.read.parquet(path), "is_new_ip")


def past_events(spark, d):
    """The first half of the events, which a job that starts with history does not read as a stream."""
    table = T.table(prepare(spark), d, "events")
    return T.net_events(spark, d, table.filter(slice_of(table) < SLICES // 2)).select(*STATE_INPUT)


def with_past(spark, d, path, mode, first):
    past = rolling.with_history(rolling.event_inputs(past_events(spark, d)), mode)
    return state_output(past, first).unionByName(state_output(spark.read.parquet(path), first))


@query
def s2_history_start(spark, d):
    """The batch job over one half of the events, the stream over the other: together as one run over all."""
    start = state.serving_start(past_events(spark, d))
    path = replay_events(spark, d, lambda events: state.serving_history(events.select(*STATE_INPUT), start), first=SLICES // 2)
    return with_past(spark, d, path, "serving", "is_first_ip")


@query
def s3_history_start(spark, d):
    start = state.exact_start(past_events(spark, d))
    path = replay_events(
        spark, d, lambda events: state.exact_history(events.select(*STATE_INPUT), start=start), closing=True, first=SLICES // 2)
    return with_past(spark, d, path, "exact", "is_new_ip")


def ledger_state(spark, d, first=0):
    """The alerts after the log has come in slices, cut by entry: about half of the decisions come before their alert.

    Slices before ``first`` are history."""
    alerts = I.alerts(spark, d)
    decisions = I.decisions_on(alerts)
    path = fresh_path(spark, "log")
    cut = F.pmod(F.xxhash64("alert_id", "decision_id"), F.lit(SLICES))
    ledger.ledger_log(alerts, decisions).withColumn("slice", cut).write.parquet(path)
    log = spark.read.parquet(path)
    parts = [log.filter(F.col("slice") == i).drop("slice") for i in range(SLICES)]
    before = ledger.ledger_start(log.filter(F.col("slice") < first)) if first else None
    changes = spark.read.parquet(replay(spark, parts[first:], lambda rows: ledger.ledger_changes(rows, before)))
    return ledger.latest(changes, alerts.schema, before)


CURRENT_ALERT = ["alert_id", "status", "resolved_us", "admin_notes", "threat_action"]


@query
def h3_ledger_stream(spark, d):
    return ledger_state(spark, d).select(*CURRENT_ALERT)


@query
def h3_ledger_start(spark, d):
    """One half of the log is history, the other comes as a stream."""
    return ledger_state(spark, d, SLICES // 2).select(*CURRENT_ALERT)


@query
def h5_rotations_stream(spark, d):
    return batch_ledger.rotations(ledger_state(spark, d))


def late_arrivals(spark, d):
    """The events, and in which slice each comes: a tenth of them in the last."""
    table = T.table(prepare(spark), d, "events")
    return I.events(spark, d, table=dealt(table)), F.when(F.col("k") % 10 == 0, SLICES - 1).otherwise(slice_of(table))


@query
def s4_late_rows(spark, d):
    """A tenth of the events comes last; what is then behind the watermark lands in the side table."""
    table, arrival = late_arrivals(spark, d)
    table = table.select("event_id", "timestamp", "k")
    good, late = (fresh_path(spark, n) for n in ("good", "late"))
    parts = [table.filter(arrival == i) for i in range(SLICES)]
    replay(spark, parts, lambda rows: rows, jobs.late_sink(good, late, 600))
    return spark.read.parquet(good).select("event_id", F.lit(False).alias("late")).unionByName(
        spark.read.parquet(late).select("event_id", F.lit(True).alias("late"))
    )


@query
def s4_intake(spark, d):
    """Unreadable, blank, timeless and late messages each in a side table, the others scored: nothing is lost."""
    table, arrival = late_arrivals(spark, d)
    folder = fresh_path(spark, "intake")
    fields = F.struct(
        "event_id", F.when(F.col("k") % 20 != 5, F.col("timestamp")).alias("timestamp"),
        F.when(F.col("k") % 20 != 3, F.col("user_id")).otherwise(" ").alias("user_id"), "source_ip", "action", "success")
    message = F.to_json(fields, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    value = F.when(F.col("k") % 20 == 7, F.left(message, F.lit(25))).otherwise(message)
    parts = [table.filter(arrival == i).select(value.alias("value")) for i in range(SLICES)]
    replay(spark, parts, streams.parse_events, jobs.intake_sink(folder, 600))
    taken = spark.read.parquet(f"{folder}/events")
    history = state.serving_history(spark.readStream.schema(taken.drop("batch_id").schema).parquet(f"{folder}/events/*"))
    counts = [spark.read.parquet(finish(spark, history)).agg(F.lit("scored").alias("place"), F.count("*").alias("n"))]
    counts += [spark.read.parquet(f"{folder}/{name}").agg(F.lit(name).alias("place"), F.count("*").alias("n")) for name in jobs.SIDE_TABLES]
    return reduce(DataFrame.unionByName, counts)


@query
def s5_bridge_stream(spark, d):
    return spark.read.parquet(replay(spark, sliced(repeated_docs(spark, d)), bridge.bridge_stream)).select("_es_id")


@query
def s6_incremental_metrics(spark, d):
    path = fresh_path(spark, "metrics")
    replay_events(spark, d, decide, totals.metrics_sink(path))
    return totals.read_metrics(spark, path)


@query
def s7_fan_out(spark, d):
    events, alerts = fresh_path(spark, "all"), fresh_path(spark, "alerts")
    replay_events(spark, d, decide, jobs.fan_out_sink(events, alerts))
    both = spark.read.parquet(events).select(F.lit("events").alias("channel")).unionByName(
        spark.read.parquet(alerts).select(F.lit("alerts").alias("channel"))
    )
    return both.groupBy("channel").agg(F.count("*").alias("n"))


@query
def s8_poison_messages(spark, d):
    path, good, poison = (fresh_path(spark, n) for n in ("messages", "good", "poison"))
    rows = I.events(spark, d)
    text = sinks.as_json("event_id", "timestamp", "user_id", "action")
    cut = F.when(rows["k"] % 20 == 7, F.left(text, F.lit(25))).otherwise(text)
    rows.select(cut.alias("value")).write.text(path, compression=CODEC)
    finish(spark, streams.parse_events(streams.stream_json_values(spark, "files", path)), jobs.quarantine_sink(good, poison))
    both = spark.read.parquet(good).select(F.lit(1).alias("g")).unionByName(
        spark.read.parquet(poison).select(F.lit(0).alias("g"))
    )
    return both.agg(F.count_if(F.col("g") == 1).alias("good"), F.count_if(F.col("g") == 0).alias("poison"))


@query
def s9_resume(spark, d):
    """After every slice the job stops; the next run starts where it ended, so each event comes once."""
    rows = spark.read.parquet(replay_events(spark, d, lambda events: events.select("event_id")))
    return rows.groupBy(F.col("event_id").cast("string").alias("event_id")).agg(F.count("*").alias("times"))


@query
def s10_windowed_stream(spark, d):
    path = replay_events(spark, d, lambda events: jobs.rollup_stream(decide(events)), mode="update")
    return jobs.read_rollups(spark, path)
