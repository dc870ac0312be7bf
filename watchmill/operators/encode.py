"""Categories as numbers: the rank of a value among the sorted distinct ones."""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from watchmill import fixed_values as V
from watchmill.operators.keys import LOCAL_ROWS, SMALL_ROWS, small_or_same
from watchmill.operators.ordering import running_totals
from watchmill.session import checkpointed


def _pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """The different ``(feature, category)`` of some columns in one pass over the data."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").distinct().filter(F.col("category").isNotNull())


def fit_encoders(df: DataFrame, columns: list[str] = V.ENCODED_COLUMNS, most: int = SMALL_ROWS) -> DataFrame:
    """``(feature, category, code)`` for all columns in one pass over the data.

    A column of more than ``most`` values is ranked over range partitions, so that no task has all of them.
    """
    return _ranked(_pairs(df, columns), most)


def fit_on_sides(
    events: DataFrame, people: DataFrame, of_people: list[str], columns: list[str] = V.ENCODED_COLUMNS, most: int = SMALL_ROWS,
) -> DataFrame:
    """``fit_encoders`` of a join from its two sides: columns ``of_people`` from one, the others from the other.

    Several profiles may share an id, so the join may have many times the rows of its sides."""
    theirs = [c for c in columns if c in of_people]
    sides = [_pairs(df, names) for df, names in ((events, [c for c in columns if c not in theirs]), (people, theirs)) if names]
    return _ranked(reduce(DataFrame.unionByName, sides), most)


def _ranked(distinct: DataFrame, most: int) -> DataFrame:
    distinct = checkpointed(distinct)
    # one row per encoded column
    wide = {r["feature"]: r["n"] for r in distinct.groupBy("feature").agg(F.count("*").alias("n")).collect() if r["n"] > most}
    rank = F.row_number().over(Window.partitionBy("feature").orderBy("category"))
    if not wide:
        return distinct.withColumn("code", rank - 1)
    narrow = distinct.filter(~F.col("feature").isin(*wide)).withColumn("code", (rank - 1).cast("bigint"))
    ranked = running_totals(distinct.filter(F.col("feature").isin(*wide)).withColumn("one", F.lit(1)), ["feature", "category"], ["one"])
    codes, before = [], 0
    for feature in sorted(wide):
        codes.append(F.when(F.col("feature") == feature, F.col("one_upto") - 1 - before))
        before += wide[feature]
    return narrow.unionByName(ranked.select("feature", "category", F.coalesce(*codes).alias("code")))


def _lookups(codes: DataFrame, columns: list[str], most: int) -> dict[str, DataFrame]:
    """Per column a table that has its codes; those of a column with few come as a broadcast copy, however many others have."""
    all_few = small_or_same(codes, most)
    if all_few is not codes:
        return {c: all_few for c in columns}
    return {c: small_or_same(codes.filter(F.col("feature") == c), most) for c in columns}


def apply_encoders(
    df: DataFrame, codes: DataFrame, columns: list[str] = V.ENCODED_COLUMNS, unknown: int = 0, most: int = LOCAL_ROWS,
) -> DataFrame:
    """Add ``<column>_encoded``; a value that was not seen when fitting gets ``unknown``."""
    for c, lookup in _lookups(codes, columns, most).items():
        one = lookup.filter(F.col("feature") == c).select(F.col("category").alias(c), F.col("code").alias("one_code"))
        df = df.join(one, c, "left").withColumn(f"{c}_encoded", F.coalesce("one_code", F.lit(unknown))).drop("one_code")
    return df
