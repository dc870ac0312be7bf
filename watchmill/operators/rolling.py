"""Per-user history: previous event, rolling counts, first address.

All sums are differences of running totals. A total up to the current row minus a total up to ``t - W`` is
the sum over ``(t - W, t]``; both frames only ever grow, so a user with n events costs O(n) and not
O(n * events per window) as a sliding frame would. Rows with equal times count in ``event_id`` order.

A user may hold a large part of all rows. Such users are cut into time slices that different tasks handle;
slice totals, one row per user and slice, carry the history over from slice to slice. If one user's events even
crowd into one slice, range partitions of the full order take the place of the time slices.

Rows without a time come last in their user's order and get no history.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchmill import fixed_values as V
from watchmill.operators.keys import HOT_ROWS, key_sizes, spread
from watchmill.session import checkpointed, written

MICROS = 1_000_000
SLICE_SECONDS = 600

# counter -> (column that is summed, window in seconds, cap in serving mode)
COUNTERS = {
    "ip_hops_30m": ("ip_changed", V.HOPS_SECONDS, V.HOPS_CAP),
    "admin_actions_15m": ("is_admin_action", V.ADMIN_SECONDS, V.ADMIN_CAP),
    "failed_30m": ("failed_action", V.FAILED_SECONDS, V.FAILED_CAP),
    "events_1h": ("event_flag", V.EVENTS_SECONDS, V.EVENTS_CAP),
}


_COMMON = ["prev_ip", "prev_us", "ip_changed", "time_since_last", "rapid_succession", *COUNTERS]
OUTPUTS = {"exact": [*_COMMON, "is_new_ip"], "serving": [*_COMMON, "is_first_ip"]}


def event_inputs(df: DataFrame) -> DataFrame:
    """The numbers that history is made of."""
    return df.withColumns({
        "event_us": F.unix_micros("timestamp"),
        "is_admin_action": (F.col("action") == "admin").cast("int"),
        "failed_action": 1 - F.col("success").cast("int"),
        "event_flag": F.lit(1),
    })


def _ip_changed(prev_ip: Column, ip: Column) -> Column:
    return (prev_ip.isNotNull() & ~prev_ip.eqNullSafe(ip)).cast("int")


def _gap_seconds(prev_us: Column) -> Column:
    return F.coalesce((F.col("event_us") - prev_us) / F.lit(MICROS), F.lit(0.0))


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("time_since_last", _gap_seconds(F.col("prev_us"))).withColumn(
        "rapid_succession", (F.col("time_since_last") < 60).cast("int")
    )


# ---- ordinary users: one exchange on the user ---------------------------------------------------------------


def _plain(df: DataFrame, mode: str) -> DataFrame:
    time = F.asc_nulls_last("event_us")
    arrival = Window.partitionBy("user_id").orderBy(time, "event_id")
    upto = arrival.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clock = Window.partitionBy("user_id").orderBy(time)

    df = df.withColumns({"prev_ip": F.lag("source_ip").over(arrival), "prev_us": F.lag("event_us").over(arrival)})
    df = df.withColumn("ip_changed", _ip_changed(F.col("prev_ip"), F.col("source_ip")))
    totals = {f"{name}_total": F.sum(what).over(upto) for name, (what, _, _) in COUNTERS.items()}
    if mode == "serving":
        df = df.withColumns({**totals, "first_ip": F.first("source_ip", ignorenulls=True).over(upto)})
        df = df.withColumns({
            name: F.least(F.lit(cap), F.col(f"{name}_total")).cast("int") for name, (_, _, cap) in COUNTERS.items()
        })
        df = df.withColumn("is_first_ip", F.col("source_ip").eqNullSafe(F.col("first_ip")).cast("int"))
    else:
        df = df.withColumns(totals)
        df = df.withColumns({
            name: (
                F.col(f"{name}_total")
                - F.coalesce(
                    F.sum(what).over(clock.rangeBetween(Window.unboundedPreceding, -seconds * MICROS)), F.lit(0)
                )
            ).cast("int")
            for name, (what, seconds, _) in COUNTERS.items()
        })
        first_seen = F.min("event_us").over(Window.partitionBy("user_id", "source_ip"))
        df = df.withColumn("is_new_ip", (F.col("event_us") == first_seen).cast("int"))
    timed = F.col("event_us").isNotNull()
    return _finish(df).withColumns({c: F.when(timed, F.col(c)) for c in OUTPUTS[mode]})


# ---- users with very many rows: one exchange on user and time slice -----------------------------------------


def _sliced(df: DataFrame, order: list[str], seconds: int | None) -> DataFrame:
    """Number the slices so that they follow the order within each user.

    Without a width the slices are range partitions, written out because a second sampling could cut elsewhere.
    """
    if seconds is None:
        return checkpointed(df.repartitionByRange("user_id", *order).withColumn("slice", F.spark_partition_id()))
    return df.withColumn("slice", F.floor(F.col(order[0]) / F.lit(seconds * MICROS)))


def _crowded(df: DataFrame, seconds: int, max_rows: int) -> bool:
    """Whether one user and time slice alone has too many rows for a task."""
    slices = _sliced(df.select("user_id", "event_us"), ["event_us"], seconds)
    return not slices.groupBy("user_id", "slice").count().filter(F.col("count") > max_rows).isEmpty()


def _carried_last(df: DataFrame) -> DataFrame:
    """Per user and slice, the last event before the slice."""
    last = df.groupBy("user_id", "slice").agg(
        F.max_by(F.struct("source_ip", "event_us"), F.struct("event_us", "event_id")).alias("last")
    )
    by_slice = Window.partitionBy("user_id").orderBy("slice")
    return last.select("user_id", "slice", F.lag("last").over(by_slice).alias("carried"))


def _carried_sums(df: DataFrame, sums: list[str]) -> DataFrame:
    """Per user and slice, the totals of all slices before it."""
    totals = df.groupBy("user_id", "slice").agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.partitionBy("user_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "user_id", "slice", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums]
    )


def _running(df: DataFrame, order: list[str], sums: list[str]) -> DataFrame:
    """Running totals ``<c>_upto`` per user over any number of slices."""
    within = Window.partitionBy("user_id", "slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = df.withColumns({f"{c}_within": F.sum(c).over(within) for c in sums})
    joined = local.join(_carried_sums(df, sums), ["user_id", "slice"], "left")
    joined = joined.withColumns({f"{c}_upto": F.col(f"{c}_before") + F.col(f"{c}_within") for c in sums})
    return joined.drop(*[f"{c}_{part}" for c in sums for part in ("within", "before")])


def _split(df: DataFrame, mode: str, seconds: int | None) -> DataFrame:
    df = _sliced(df, ["event_us", "event_id"], seconds)
    arrival = Window.partitionBy("user_id", "slice").orderBy("event_us", "event_id")
    df = df.withColumn("in_slice", F.lag(F.struct("source_ip", "event_us")).over(arrival))
    df = df.join(_carried_last(df), ["user_id", "slice"], "left")
    df = df.withColumn("prev", F.coalesce("in_slice", "carried"))
    df = df.withColumns({"prev_ip": F.col("prev.source_ip"), "prev_us": F.col("prev.event_us")})
    df = df.withColumn("ip_changed", _ip_changed(F.col("prev_ip"), F.col("source_ip")))
    # read five times from here on
    df = written(df.drop("in_slice", "carried", "prev"), "hot-previous")
    if mode == "serving":
        done = _split_serving(df)
    else:
        done = _split_exact(df, seconds)
    return _finish(done.drop("slice"))


def _split_serving(df: DataFrame) -> DataFrame:
    sums = [what for what, _, _ in COUNTERS.values()]
    df = _running(df, ["event_us", "event_id"], sums)
    df = df.withColumns({
        name: F.least(F.lit(cap), F.col(f"{what}_upto")).cast("int") for name, (what, _, cap) in COUNTERS.items()
    })
    # one row per user: the first address there is, and when it came
    first = df.filter(F.col("source_ip").isNotNull()).groupBy("user_id").agg(
        F.min(F.struct("event_us", "event_id", "source_ip")).alias("first")
    )
    df = df.join(first, "user_id", "left")
    known = F.struct("event_us", "event_id") >= F.struct("first.event_us", "first.event_id")
    first_ip = F.when(known, F.col("first.source_ip"))
    df = df.withColumn("is_first_ip", F.col("source_ip").eqNullSafe(first_ip).cast("int"))
    return df.drop("first", *[f"{c}_upto" for c in sums])


def _split_exact(df: DataFrame, seconds: int | None) -> DataFrame:
    """Every event adds its counts when it happens and takes them back when it leaves the window.

    The running total of both, taken at an event, is that event's rolling sum.
    """
    sums = list(COUNTERS)
    arrive = df.withColumns({
        "at": F.col("event_us"),
        "arrives": F.lit(1),
        **{name: F.col(what) for name, (what, _, _) in COUNTERS.items()},
    })
    spans = sorted({span for _, span, _ in COUNTERS.values()})
    leaving = [
        F.struct(
            (F.col("event_us") + span * MICROS).alias("at"),
            *[(-F.col(what) if s == span else F.lit(0)).alias(name) for name, (what, s, _) in COUNTERS.items()],
        )
        for span in spans
    ]
    leave = df.select("user_id", "event_id", F.explode(F.array(*leaving)).alias("x")).select(
        "user_id", "event_id", "x.*", F.lit(0).alias("arrives")
    )
    order = ["at", "arrives", "event_id"]
    both = arrive.drop("slice").unionByName(leave, allowMissingColumns=True)
    both = _running(_sliced(both, order, seconds), order, sums)
    df = both.filter("arrives = 1").drop("at", "arrives", *sums)
    df = df.withColumns({name: F.col(f"{name}_upto").cast("int") for name in sums})
    df = df.drop(*[f"{name}_upto" for name in sums])

    # a match also on time: a frequent address is spread over its times
    seen = df.groupBy("user_id", "source_ip").agg(F.min("event_us").alias("seen_us")).select(
        F.col("user_id").alias("seen_user"), F.col("source_ip").alias("seen_ip"), "seen_us"
    )
    first = (
        (F.col("user_id") == F.col("seen_user"))
        & (F.col("event_us") == F.col("seen_us"))
        & F.col("source_ip").eqNullSafe(F.col("seen_ip"))
    )
    df = df.join(seen, first, "left").withColumn("is_new_ip", F.col("seen_us").isNotNull().cast("int"))
    return df.drop("seen_user", "seen_ip", "seen_us")


# ---- all together ---------------------------------------------------------------------------------------------

def _timeless(df: DataFrame, mode: str) -> DataFrame:
    types = {"prev_ip": "string", "prev_us": "bigint", "time_since_last": "double"}
    return df.withColumns({c: F.lit(None).cast(types.get(c, "int")) for c in OUTPUTS[mode]})


def history_parts(
    df: DataFrame, mode: str = "exact", hot_rows: int | None = HOT_ROWS, slice_seconds: int | None = SLICE_SECONDS
) -> list[tuple[DataFrame, DataFrame | None]]:
    """The rows with history in parts that need different joins later: (ordinary users, None), (hot ones, their keys)."""
    keep = [*df.columns, *OUTPUTS[mode]]
    df = df.withColumn("user_id", F.coalesce("user_id", F.lit("")))
    rows, hot = (0, None) if hot_rows is None else key_sizes(df, "user_id", hot_rows)
    if hot is None:
        parts = [(_plain(spread(df, rows, "user_id"), mode), None)]
    else:
        many = written(df.join(hot, "user_id", "left_semi"), "hot-users")
        timed, timeless = many.filter(F.col("event_us").isNotNull()), many.filter(F.col("event_us").isNull())
        if slice_seconds is not None and _crowded(timed, slice_seconds, max(hot_rows, 1)):
            slice_seconds = None
        parts = [
            (_plain(spread(df.join(hot, "user_id", "left_anti"), rows, "user_id"), mode), None),
            (_split(timed, mode, slice_seconds), hot),
            (_timeless(timeless, mode), hot),
        ]
    return [(rows.select(*keep), keys) for rows, keys in parts]


def with_history(
    df: DataFrame, mode: str = "exact", hot_rows: int | None = HOT_ROWS, slice_seconds: int | None = SLICE_SECONDS
) -> DataFrame:
    """Add the history columns of ``OUTPUTS[mode]`` to rows prepared by ``event_inputs``.

    ``hot_rows=None`` skips the look for users with very many rows.
    """
    parts = history_parts(df, mode, hot_rows, slice_seconds)
    return reduce(DataFrame.unionByName, [rows for rows, _ in parts])
