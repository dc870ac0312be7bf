"""Masking, rounding and text for people."""

from pyspark.sql import Column, functions as F

from watchmill import fixed_values as V


def mask_edges(secret: Column) -> Column:
    return F.when(
        F.length(secret) > 8, F.concat(F.left(secret, F.lit(4)), F.lit("****"), F.right(secret, F.lit(4)))
    ).otherwise("****")


def mask_prefix(secret: Column) -> Column:
    return F.when(F.length(secret) > 8, F.concat(F.left(secret, F.lit(8)), F.lit("****"))).otherwise("****")


def short_reason(reason: Column) -> Column:
    text = F.coalesce(F.nullif(reason, F.lit("")), F.lit("—"))
    return F.when(
        F.length(text) > V.REASON_CHARS, F.concat(F.left(text, F.lit(V.REASON_CHARS)), F.lit("…"))
    ).otherwise(text)


def score_pct(score: Column) -> Column:
    return F.round(F.coalesce(score, F.lit(0.0)) * 100, 1)


def rotation_reason(threat_action: Column, score: Column) -> Column:
    return F.concat(
        F.lit("admin_approved_"), F.lower(threat_action), F.lit("_score_"), F.format_string("%.4f", score)
    )


def infra_reason(score: Column) -> Column:
    return F.concat(F.lit("admin_approved_critical_score_"), F.format_string("%.4f", score))


def round_scores(columns: list[str]) -> dict[str, Column]:
    return {name: F.round(F.col(name), 6) for name in columns}
