"""Sizes of keys and of small tables, looked at before a plan depends on them."""

from pyspark.sql import DataFrame, functions as F

# more rows than this under one key are spread over many tasks
HOT_ROWS = 5_000_000
# at most this many rows are broadcast
SMALL_ROWS = 200_000
# more rows than this get a number of tasks that follows from theirs: tasks that Spark merges by shuffled bytes hold any
# number of rows that are alike
MERGED_ROWS = 4_000_000
TASK_ROWS = 500_000
# at most this many rows become part of a plan
LOCAL_ROWS = 10_000


def _head(df: DataFrame, max_rows: int):
    """All rows if there are at most ``max_rows``, else None. Reads no more than ``max_rows + 1``."""
    head = df.limit(max_rows + 1).toArrow()
    return head if head.num_rows <= max_rows else None


def small_or_same(df: DataFrame, max_rows: int = LOCAL_ROWS) -> DataFrame:
    """A computed table as a broadcast copy if it has at most ``max_rows`` rows, else unchanged.

    The bounded read computes it once, instead of once for the count and once for every join.
    """
    head = _head(df, max_rows)
    return df if head is None else F.broadcast(df.sparkSession.createDataFrame(head, schema=df.schema))


def broadcast_if_small(df: DataFrame, sized_by: DataFrame | None = None, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Mark for broadcast if the table, or the one that bounds its size, has at most ``max_rows`` rows."""
    bound = df if sized_by is None else sized_by
    return F.broadcast(df) if bound.count() <= max_rows else df


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, which has so many rows, by its keys in tasks of about ``TASK_ROWS``; few rows stay as they are."""
    if rows <= MERGED_ROWS:
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // TASK_ROWS)), *keys)


def key_sizes(df: DataFrame, key: str, max_rows: int = HOT_ROWS) -> tuple[int, DataFrame | None]:
    """The number of rows, and the ``hot_keys``: one pass over the data if no key is hot."""
    sizes = df.groupBy(key).count()
    rows, most = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    return rows, hot_keys(df, key, max_rows) if most > max_rows else None


def hot_keys(df: DataFrame, key: str, max_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, or None if there is none.

    The count is combined before the shuffle; the result has at most ``rows / max_rows`` rows.
    """
    hot = df.groupBy(key).count().filter(F.col("count") > max_rows).select(key)
    head = _head(hot, LOCAL_ROWS)
    if head is None:
        return hot
    return F.broadcast(df.sparkSession.createDataFrame(head, schema=hot.schema)) if head.num_rows else None
