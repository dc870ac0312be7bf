"""Running totals of a stream in a bounded number of folders.

Each batch writes one row of sums to the slot of its id in a ring of ``2 * half`` slots. Every ``half`` batches the closed
batches are added up to one row, the range ``[0, upto)``, in the one of two folders that does not hold the range before.
Readers take the newest range and the slots from its end on. Nothing is deleted: a folder is written anew only when a
range that holds its batches is complete, so a job that dies in between loses nothing.
"""

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from watchmill.operators import report
from watchmill.streaming.jobs import Sink

HALF = 32
SUMS = [
    "total_requests", "total_threats", "total_allowed", "total_monitored", "total_blocked", "total_critical",
    "total_latency_ms",
]


def _added(rows: DataFrame) -> DataFrame:
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(rows.schema[c].dataType).alias(c) for c in SUMS])


def _newest_range(spark: SparkSession, path: str) -> Row:
    return spark.read.parquet(f"{path}/ranges").orderBy(F.desc("upto")).first()


def _upto(spark: SparkSession, path: str, newest: Row, end: int | None = None) -> DataFrame:
    """The newest range and the batches after it, before ``end`` if it is given."""
    closed = spark.read.parquet(f"{path}/ranges/range={newest['range']}")
    rows = spark.read.parquet(f"{path}/slots").filter(F.col("batch_id") >= newest["upto"])
    rows = rows if end is None else rows.filter(F.col("batch_id") < end)
    return _added(closed.select(*SUMS).unionByName(rows.select(*SUMS)))


def metrics_sink(path: str, half: int = HALF) -> Sink:
    """One row of sums per batch; a batch that comes again counts once, also when its range is closed.

    The path belongs to one checkpoint, whose batch ids begin with 0.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if batch_id == 0:
            nothing = _added(df.agg(*report.metric_sums()).filter(F.lit(False)))
            nothing.withColumn("upto", F.lit(0)).write.mode("ignore").parquet(f"{path}/ranges/range=0")
        newest = _newest_range(spark, path)
        if batch_id < newest["upto"]:
            return
        if batch_id % half == 0 and batch_id > newest["upto"]:
            rows = _upto(spark, path, newest, batch_id).withColumn("upto", F.lit(batch_id))
            rows.write.mode("overwrite").parquet(f"{path}/ranges/range={1 - newest['range']}")
        row = df.agg(*report.metric_sums()).withColumn("batch_id", F.lit(batch_id))
        row.write.mode("overwrite").parquet(f"{path}/slots/slot={batch_id % (2 * half)}")

    return sink


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Sums over all batches so far."""
    return report.finish_metrics(_upto(spark, path, _newest_range(spark, path)))
