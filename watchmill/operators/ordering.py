"""Positions in a global order without ever sorting the table into one task."""

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchmill.session import checkpointed

# a tie of this many rows is sorted as a top-k; a larger one by range partitions
TOP_ROWS = 1_000_000
# before every time there is
NO_TIME = -(1 << 63)


def bucketed_totals(df: DataFrame, bucket: str, order: list[Column], sums: list[str]) -> DataFrame:
    """Running totals ``<c>_upto`` and grand totals ``<c>_all`` in a global order.

    ``bucket`` is a column whose values follow that order and of which there are few: the window over all
    buckets has one row per bucket, the one inside a bucket is partitioned by it.
    """
    per = df.groupBy(bucket).agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.select(
        bucket,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in sums],
    )
    inside = Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumns({f"{c}_in": F.sum(c).over(inside) for c in sums}).join(per, bucket)
    rows = rows.withColumns({f"{c}_upto": F.col(f"{c}_before") + F.col(f"{c}_in") for c in sums})
    return rows.drop(*[f"{c}_{part}" for c in sums for part in ("before", "in")])


def running_totals(df: DataFrame, order: list[str], sums: list[str]) -> DataFrame:
    """Running totals ``<c>_upto`` in the global order of ``order``, which must be unique.

    The table is range-partitioned on the full order, so no value can make a partition large; the partition
    sums, one row each, carry the totals on. Written out in between, because a second sampling of the
    ranges could cut elsewhere.
    """
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    return bucketed_totals(ranged, "part", [F.col(c) for c in order], sums).drop("part", *[f"{c}_all" for c in sums])


@dataclass(frozen=True)
class SplitPoint:
    """The last row of the first part: values of the ordering columns. None: the first part is empty."""

    columns: tuple[str, ...]
    values: tuple | None

    def with_stored_time(self, time: str) -> "SplitPoint":
        """The same point on the stored timestamp in place of its microseconds: such a literal reaches the scan."""
        if self.values is None or NO_TIME in self.values:
            return self
        at = self.columns.index("event_us")
        stored = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=self.values[at])
        return SplitPoint(
            (*self.columns[:at], time, *self.columns[at + 1 :]), (*self.values[:at], stored, *self.values[at + 1 :]))

    def reach(self) -> Column:
        """A plain bound of the first part on the leading column, for the scan."""
        return F.lit(False) if self.values is None else F.col(self.columns[0]) <= F.lit(self.values[0])

    def before_or_at(self) -> Column:
        if self.values is None:
            return F.lit(False)
        terms = []
        for i, name in enumerate(self.columns):
            same = [F.col(c) == F.lit(v) for c, v in zip(self.columns[:i], self.values)]
            last = i == len(self.columns) - 1
            here = F.col(name) <= F.lit(self.values[i]) if last else F.col(name) < F.lit(self.values[i])
            terms.append(reduce(lambda a, b: a & b, [*same, here]))
        return reduce(lambda a, b: a | b, terms)


def _step(df: DataFrame, key: Column, k: int) -> tuple[object, int]:
    """Of a small histogram over ``key``: the value in which the k-th row lies, and its place in there."""
    counts = df.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = counts.withColumn("upto", upto).filter(F.col("upto") >= k).orderBy("key").limit(1).first()
    return found["key"], k - (found["upto"] - found["n"])


def _kth_time(df: DataFrame, us: str, k: int) -> tuple[int, int]:
    """The k-th smallest time, by hour, then second, then microsecond: three histograms of bounded size."""
    rows = df
    for width in (3_600_000_000, 1_000_000, 1):
        value, k = _step(rows, F.floor(F.col(us) / F.lit(width)), k)
        rows = rows.filter((F.col(us) >= value * width) & (F.col(us) < (value + 1) * width))
    return value, k


def _kth_key(df: DataFrame, key: str, k: int) -> object:
    """The k-th smallest of unique keys."""
    keys = df.select(key)
    if k <= TOP_ROWS:
        return keys.orderBy(key).limit(k).agg(F.max(key)).first()[0]
    ranked = running_totals(keys.withColumn("one", F.lit(1)), [key], ["one"])
    return ranked.filter(F.col("one_upto") == k).first()[key]


def time_split_point(df: DataFrame, ratio: float, us: str = "event_us", key: str = "event_id") -> SplitPoint:
    """Where the first ``floor(n * ratio)`` rows end in time order. Reads two columns; sorts nothing large.

    Rows without a time come last: they count, but the point never lies among them.
    """
    n, timed = df.agg(F.count("*"), F.count(us)).first()
    k = min(int(n * ratio), timed)
    if k == 0:
        return SplitPoint((us, key), None)
    value, rest = _kth_time(df.select(us, key).filter(F.col(us).isNotNull()), us, k)
    return SplitPoint((us, key), (value, _kth_key(df.filter(F.col(us) == value), key, rest)))


def user_split_point(
    df: DataFrame, ratio: float, user: str = "user_id", us: str = "event_us", key: str = "event_id"
) -> SplitPoint:
    """The same in the order of user, then time; of each user, rows without a time come last, and so do rows
    without a user. The point lies at a row with both."""
    n, known = df.agg(F.count("*"), F.count(user)).first()
    k = min(int(n * ratio), known)
    if k == 0:
        return SplitPoint((user, us, key), None)
    users = df.filter(F.col(user).isNotNull()).groupBy(user).agg(F.count("*").alias("n"), F.count(us).alias("timed"))
    totals = running_totals(users, [user], ["n"])
    found = totals.filter(F.col("n_upto") >= k).orderBy(user).limit(1).first()
    k = min(k - (found["n_upto"] - found["n"]), found["timed"])
    if k == 0:
        return SplitPoint((user, us, key), (found[user], NO_TIME, None))
    one = df.filter((F.col(user) == found[user]) & F.col(us).isNotNull())
    value, rest = _kth_time(one.select(us, key), us, k)
    return SplitPoint((user, us, key), (found[user], value, _kth_key(one.filter(F.col(us) == value), key, rest)))


def split(df: DataFrame, ratio: float, method: str = "time", time: str | None = None) -> tuple[DataFrame, DataFrame]:
    """First and second part of the rows, every row in one of them. The point is a literal, so each part is a filter.

    A row that cannot be compared with the point, as it has no time, is in the second part; by user, an earlier
    user's row without a time is in the first. ``time`` names the stored timestamp that ``event_us`` is computed from:
    the filters are then on it, and the scan skips row groups of the other part.
    """
    point = time_split_point(df, ratio) if method == "time" else user_split_point(df, ratio)
    if time is not None:
        point = point.with_stored_time(time)
    first = F.coalesce(point.before_or_at(), F.lit(False))
    if time is None or point.values is None:
        return df.filter(first), df.filter(~first)
    lead = F.col(point.columns[0])
    return df.filter(point.reach() & first), df.filter(((lead >= F.lit(point.values[0])) | lead.isNull()) & ~first)


def export_test_events(events: DataFrame, ratio: float) -> DataFrame:
    """The later part in time, ready for JSON: ISO times, no nulls."""
    tail = split(events.withColumn("event_us", F.unix_micros("timestamp")), ratio, time="timestamp")[1].drop("event_us")
    tail = tail.withColumns({
        "timestamp": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "anomaly_type": F.coalesce("anomaly_type", F.lit("None")),
    })
    return tail.na.fill("")
