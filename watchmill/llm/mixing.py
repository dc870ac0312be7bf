"""Operator 1: mix sources to target weights by entropy balancing.

Every document gets a rate; of all rates that meet the word targets of their sources and stay at or below the
highest allowed, those nearest to "once each" in relative entropy are wanted. The convex dual has one multiplier
per source, ``rate = min(most, exp(multiplier * size / mean size))``, and is solved by Newton steps, each one
aggregate over a histogram of (source, size). Rates become whole copies by systematic rounding along the sizes.
"""

import math

from pyspark.sql import DataFrame, Window, functions as F

from watchmill.llm.common import packed, word_count
from watchmill.operators.ordering import running_totals
from watchmill.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# documents of one source and size that are ranked in one group
SLICE = 4096
STEPS = 80


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count("text").alias("size"))


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sid, source, source_size, n_docs, target``: shares by weight, cut at ``most`` times a source's size.

    Sources rank by code point, null last. What the cut leaves is shared again by weight, until none is above:
    the open ones then all have the same words per weight, found by a few aggregates over the sources.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    per = per.withColumns({"absent": F.col("source").isNull(), "one": F.lit(1)})
    ranked = running_totals(per, ["absent", "source"], ["one"])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("one_upto") - 1) % len(weights) + 1).cast("int"))
    ranked = written(ranked.select(
        F.col("one_upto").alias("sid"), "source", "source_size", "n_docs", weight.alias("weight"),
        (F.col("source_size") * most).alias("cap")), "sources")
    all_size, all_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (all_size or 0)
    level, closed = (total / all_weight if all_weight else 0.0), -1
    while True:
        shut = F.col("cap") <= F.lit(level) * F.col("weight")
        n, taken, left = ranked.agg(
            F.count_if(shut), F.sum(F.when(shut, F.col("cap"))), F.sum(F.when(~shut, F.col("weight")))).first()
        if n == closed or not left:
            break
        level, closed = (total - (taken or 0)) / left, n
    aim = F.when(F.col("cap") <= F.lit(level) * F.col("weight"), F.col("cap")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("sid", "source", "source_size", "n_docs", aim.cast("double").alias("target"))


def _rate(most: int):
    feature = F.col("size") * F.col("n_docs") / F.col("source_size")
    tilt = F.least(F.lit(math.log(most)), F.col("multiplier") * feature)
    return F.when(F.col("full"), F.lit(float(most))).when(F.col("size") == 0, F.lit(1.0)).otherwise(F.exp(tilt))


def multipliers(cells: DataFrame, aims: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """Newton's method on the dual, for all sources at once; a step that leaves the known interval halves it instead.

    Ends when every source is within half a word or a billionth of its target.
    """
    state = aims.select(
        "sid", "source_size", "n_docs", "target", (F.col("target") >= F.col("source_size") * most).alias("full"),
        F.lit(0.0).alias("multiplier"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    for _ in range(steps):
        rate, feature = _rate(most), F.col("size") * F.col("n_docs") / F.col("source_size")
        words = F.col("n") * F.col("size") * rate
        open_ = F.col("multiplier") * feature < math.log(most)
        exact = "decimal(38,9)"  # sums that do not depend on the order of the rows, so that reruns agree
        sums = cells.join(state, "sid").filter(~F.col("full") & (F.col("size") > 0)).groupBy("sid").agg(
            F.sum(words.cast(exact)).cast("double").alias("words"), F.sum(F.when(open_, words * feature).otherwise(0.0).cast(exact)).cast("double").alias("slope"))
        both = state.join(sums, "sid", "left").withColumn("gap", F.col("words") - F.col("target"))
        low, high = F.when(F.col("gap") < 0, F.col("multiplier")).otherwise(F.col("lo")), F.when(F.col("gap") > 0, F.col("multiplier")).otherwise(F.col("hi"))
        newton = F.when(F.col("slope") > 0, F.col("multiplier") - F.col("gap") / F.col("slope"))
        inside = newton.isNotNull() & (low.isNull() | (newton > low)) & (high.isNull() | (newton < high))
        spread = F.when(low.isNull(), F.least(high * 2, F.lit(-1.0))).when(high.isNull(), F.greatest(low * 2, F.lit(1.0))).otherwise((low + high) / 2)
        done = F.coalesce(F.abs("gap") <= F.greatest(F.lit(0.5), F.col("target") * 1e-9), F.lit(True))
        state = written(both.select(
            "sid", "source_size", "n_docs", "target", "full",
            F.when(done, F.col("multiplier")).when(inside, newton).otherwise(spread).alias("multiplier"),
            low.alias("lo"), high.alias("hi"), done.alias("done")), "newton")
        if not state.filter("NOT done").limit(1).count():
            break
        state = state.drop("done")
    return state


def _copies(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Whole copies per document: a cell of one source and size gets its due number of extra copies, the documents
    with the smallest hashes receive them. Ranks are taken in slices of the hash, so no group is large."""
    slices = F.ceil(F.col("n") / SLICE).cast("long")
    h = F.xxhash64("doc_id", "source", "size")
    placed = rows.join(cells.select("sid", "size", "n", "rate", "whole", "extra"), ["sid", "size"]).withColumns(
        {"h": h, "slice": F.pmod(F.shiftrightunsigned(h, 20), slices)})
    sums = placed.groupBy("sid", "size", "slice").agg(F.count("*").alias("in_slice"))
    before = F.sum("in_slice").over(Window.partitionBy("sid", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("sid", "size", "slice", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("sid", "size", "slice").orderBy("h", "doc_id"))
    ranked = placed.withColumn("rank", rank).join(sums, ["sid", "size", "slice"])
    extra = (F.col("rank") + F.col("before") <= F.col("extra")).cast("long")
    return ranked.withColumn("copies", F.col("whole") + extra)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` for every row of ``docs``.

    The words taken of a source differ from its target by less than about its longest document. Null text: size 0,
    one copy of nothing. Null source: a source of its own, last. Repeated rows are mixed one by one. An empty
    table gives no rows; other columns are ignored. The hash of (doc_id, source, size) decides, so reruns agree.
    """
    rows = written(sized(docs), "sized")
    aims = targets(rows, weights, share, most)
    keyed = rows.join(aims.select("sid", F.col("source").alias("of")), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    cells = written(keyed.groupBy("sid", "size").agg(F.count("*").alias("n")), "cells")
    solved = multipliers(cells, aims, most).select("sid", "source_size", "n_docs", "target", "full", "multiplier")
    rated = cells.join(solved, "sid").withColumn("rate", _rate(most)).withColumn("whole", F.floor("rate").cast("long"))
    due = F.sum((F.col("rate") - F.col("whole")) * F.col("n")).over(
        Window.partitionBy("sid").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rated = rated.withColumn("due", F.floor(due + 0.5))
    step = F.col("due") - F.coalesce(F.lag("due").over(Window.partitionBy("sid").orderBy("size")), F.lit(0))
    rated = written(rated.withColumn("extra", step), "rated")
    out = _copies(keyed, rated).join(aims.select("sid", "source_size", "target"), "sid")
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is to be taken.

    Rows that agree in doc_id, source and size cannot be told apart by the plan: what it takes of them all is dealt to
    them one by one, in an order of hashes of their texts, so that no copy is lost.
    """
    plan = mix(docs, weights, share, most).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("due"), F.count("*").alias("n"))
    plan = written(plan, "mix-plan")
    row = F.monotonically_increasing_id()
    keyed = packed(
        docs, id=F.col("doc_id").cast("long"), of=F.col("source").cast("string"), words=word_count("text"), h=F.xxhash64(F.col("text").cast("string"), row))
    on = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("of").eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    alone = keyed.join(plan.filter("n = 1"), on).select("row", F.col("due").alias("copies"))
    shared = plan.filter("n > 1")
    if shared.limit(1).count():
        alone = alone.union(_dealt(keyed.join(shared, on)))
    times = F.array_repeat(F.lit(1), F.col("copies").cast("int"))
    return alone.select("row", F.explode(times)).select("row.*")


def _dealt(rows: DataFrame) -> DataFrame:
    """``row, copies``: the ``due`` copies of each group of ``n`` rows, as evenly as whole numbers allow.

    Ranks are taken in slices of the hash, so no group is large.
    """
    group = ["doc_id", "source", "size"]
    placed = written(rows.withColumn("slice", F.pmod("h", F.ceil(F.col("n") / SLICE))), "mix-shared")
    sums = placed.groupBy(*group, "slice").agg(F.count("*").alias("in_slice"))
    before = F.sum("in_slice").over(Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*[F.col(c).alias(f"of_{c}") for c in [*group, "slice"]], F.coalesce(before, F.lit(0)).alias("before"))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy(*group, "slice").orderBy("h")))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in [*group, "slice"]]
    whole, over = F.floor(F.col("due") / F.col("n")), F.pmod("due", "n")
    return ranked.join(sums, same).select("row", (whole + (F.col("rank") + F.col("before") <= over).cast("long")).alias("copies"))
