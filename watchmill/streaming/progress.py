"""Progress of running queries as a table: rows, rates and offsets of every batch."""

import threading

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from watchmill.operators import report

PROGRESS = (
    "query_id string, run_id string, name string, batch_id long, at string, source int, description string, "
    "start_offset string, end_offset string, latest_offset string, input_rows long, input_rate double, processed_rate double"
)


class ProgressLog(StreamingQueryListener):
    """Appends each batch's progress to the table ``path``, a row per source.

    A folder per run and batch, written over if it comes again. ``follow`` adds the listener to the session.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ends: dict[str, threading.Event] = {}
        self.failure: Exception | None = None

    def follow(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def leave(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [
            (str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, i, s.description, s.startOffset, s.endOffset, s.latestOffset,
             s.numInputRows, s.inputRowsPerSecond, s.processedRowsPerSecond)
            for i, s in enumerate(p.sources)
        ]
        try:
            table = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
            table.write.mode("overwrite").parquet(f"{self.path}/run={p.runId}/batch={p.batchId}")
        except Exception as e:  # told to whoever waits: an error in a listener stops no query
            self.failure = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def _end(self, run_id) -> threading.Event:
        return self.ends.setdefault(str(run_id), threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the ended query's last progress is written: the listener runs beside the query."""
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError(f"no end of the run {query.runId} within {seconds} s")
        if self.failure is not None:
            raise self.failure


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("run", "batch")


def rates(progress: DataFrame) -> DataFrame:
    """Per query and source: batches, rows, and the rates of its newest batch."""
    place = F.struct("at", "batch_id")
    return progress.groupBy("query_id", "source").agg(
        F.count_distinct("batch_id").alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.max_by("input_rate", place).alias("input_rate"), F.max_by("processed_rate", place).alias("processed_rate"))


def partition_offsets(progress: DataFrame) -> DataFrame:
    """Per topic and partition of a broker's sources, the offsets of the newest batch: what ``report.offset_lag`` takes.

    Sources with offsets of another form have no rows. A batch without an earliest offset begins at 0, one without a
    latest offset has read all.
    """
    newest = Window.partitionBy("query_id", "source").orderBy(F.desc("at"), F.desc("batch_id"))
    rows = progress.withColumn("n", F.row_number().over(newest)).filter("n = 1")
    offsets = "map<string,map<string,bigint>>"
    rows = rows.select(*[F.from_json(f"{name}_offset", offsets).alias(name) for name in ("start", "end", "latest")])
    rows = rows.select("start", "latest", F.explode("end").alias("topic", "parts"))
    rows = rows.select("start", "latest", "topic", F.explode("parts").alias("partition", "committed"))

    def at(name):
        return F.try_element_at(F.try_element_at(F.col(name), F.col("topic")), F.col("partition"))

    return rows.select(
        "topic", F.expr("try_cast(partition AS int)").alias("partition"), F.coalesce(at("start"), F.lit(0)).alias("earliest"),
        F.coalesce(at("latest"), F.col("committed")).alias("latest"), "committed",
    )


def running_lag(progress: DataFrame) -> DataFrame:
    """Lag and messages per partition of the queries that wrote the progress."""
    return report.offset_lag(partition_offsets(progress))
