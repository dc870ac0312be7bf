"""How good scores are. All measures come from one histogram of scores, rounded to 6 decimals as stored.

The histogram has at most 1,000,001 rows however many events there are; it is combined before the shuffle.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from watchmill import fixed_values as V
from watchmill.operators.ordering import bucketed_totals


def score_histogram(df: DataFrame, score: str, label: str) -> DataFrame:
    positive = F.col(label).cast("int")
    return df.groupBy(F.round(score, 6).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )


def _descending(histogram: DataFrame) -> DataFrame:
    """Counts of scores at or above each score."""
    bucket = F.floor((1 - F.col("score")) * 1000)
    return bucketed_totals(histogram.withColumn("bucket", bucket), "bucket", [F.col("score").desc()], ["pos", "neg"])


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """For each distinct score s: precision, recall and F1 of calling everything with score >= s a threat."""
    rows = _descending(score_histogram(df, score, label))
    tp, fp, all_pos = F.col("pos_upto"), F.col("neg_upto"), F.col("pos_all")
    precision = tp / (tp + fp)
    recall = F.when(all_pos > 0, tp / all_pos).otherwise(F.lit(1.0))
    return rows.select(
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        precision.alias("precision"),
        recall.alias("recall"),
        (2 * (precision * recall) / (precision + recall + F.lit(V.F1_EPSILON))).alias("f1"),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """One row: the threshold with the highest F1, the lowest one on ties."""
    return curve.orderBy(F.col("f1").desc(), "threshold").limit(1)


def best_threshold_value(curve: DataFrame) -> float:
    best = best_threshold(curve).first()
    return V.DEFAULT_THRESHOLD if best is None else best["threshold"]


def confusion(df: DataFrame, predicted: Column, label: str, *by: str) -> DataFrame:
    actual = F.col(label).cast("boolean")
    cells = {"tp": actual & predicted, "fp": ~actual & predicted, "fn": actual & ~predicted, "tn": ~actual & ~predicted}
    return df.groupBy(*by).agg(*[F.count_if(c).alias(name) for name, c in cells.items()])


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    both = precision + recall
    return F.when(both > 0, 2 * precision * recall / both).otherwise(F.lit(0.0))


def quality(cells: DataFrame, *by: str) -> DataFrame:
    """Accuracy, precision, recall, F1 from the four cells; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return cells.select(
        *by,
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )


def long_scores(df: DataFrame, members: list[str], label: str) -> DataFrame:
    """One row per event and member, so that all members are measured in one pass."""
    stacked = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in members])
    return df.select(F.col(label).alias("label"), F.explode(stacked).alias("s")).select("label", "s.*")


def model_quality(df: DataFrame, thresholds: dict[str, float], label: str) -> DataFrame:
    rows = long_scores(df, list(thresholds), label)
    cut = reduce(lambda c, kv: c.when(F.col("model") == kv[0], F.lit(kv[1])), thresholds.items(), F)
    return quality(confusion(rows, F.col("score") >= cut, "label", "model"), "model")


def roc_auc(df: DataFrame, members: list[str], label: str) -> DataFrame:
    """Per member, the share of (threat, normal) pairs in the right order; ties count half.

    Per member a histogram, then coarse score buckets that carry the totals.
    """
    rows = long_scores(df, members, label)
    positive = F.col("label").cast("int")
    hist = rows.groupBy("model", F.round("score", 6).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )
    return histogram_auc(hist, members)


def histogram_auc(hist: DataFrame, members: list[str]) -> DataFrame:
    """The same from counts ``pos`` and ``neg`` per ``model`` and ``score``."""
    rank = reduce(lambda c, im: c.when(F.col("model") == im[1], im[0]), enumerate(members), F)
    hist = hist.withColumn("bucket", rank * 1001 + F.floor(F.col("score") * 1000))
    hist = bucketed_totals(hist, "bucket", [F.col("score").asc()], ["pos", "neg"])
    # totals run over all members; what came before a member's first row is taken off again
    per = hist.groupBy("model").agg(
        F.sum("pos").alias("all_pos"),
        F.sum("neg").alias("all_neg"),
        F.min(F.col("neg_upto") - F.col("neg")).alias("base"),
        F.sum(F.col("pos").cast("double") * (F.col("neg_upto") - F.col("neg") + F.col("neg") / 2)).alias("raw"),
    )
    # products of counts pass the range of bigint at scale
    pairs = F.col("all_pos").cast("double") * F.col("all_neg")
    won = F.col("raw") - F.col("base").cast("double") * F.col("all_pos")
    return per.select("model", F.when(pairs > 0, won / pairs).alias("roc_auc"))


def class_report(cells: DataFrame) -> DataFrame:
    """Per class and averaged: precision, recall, F1, support."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def one(name, hit, false_hit, miss):
        precision, recall = _ratio(hit, hit + false_hit), _ratio(hit, hit + miss)
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            _f1(precision, recall).alias("f1"), (hit + miss).alias("support"),
        )

    classes = cells.select(one("Normal", tn, fn, fp).alias("a"), one("Threat", tp, fp, fn).alias("b"))
    measures = ("precision", "recall", "f1")
    support = F.col("a.support") + F.col("b.support")
    macro = F.struct(
        F.lit("macro avg").alias("class"),
        *[((F.col(f"a.{m}") + F.col(f"b.{m}")) / 2).alias(m) for m in measures],
        support.alias("support"),
    )
    weighted = F.struct(
        F.lit("weighted avg").alias("class"),
        *[
            _ratio(F.col(f"a.{m}") * F.col("a.support") + F.col(f"b.{m}") * F.col("b.support"), support).alias(m)
            for m in measures
        ],
        support.alias("support"),
    )
    return classes.select(F.explode(F.array("a", "b", macro, weighted)).alias("r")).select("r.*")


def class_balance(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Size and anomaly rate of both parts."""
    parts = train.select(F.lit("train").alias("part"), label).unionByName(
        test.select(F.lit("test").alias("part"), label)
    )
    return parts.groupBy("part").agg(
        F.count("*").alias("rows"), F.avg(F.col(label).cast("int")).alias("anomaly_rate")
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; with parquet the counts come from the file footers."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
