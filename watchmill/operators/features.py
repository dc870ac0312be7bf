"""The 46 features of an event."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from watchmill import fixed_values as V
from watchmill import schema as S
from watchmill.operators.encode import apply_encoders, fit_on_sides
from watchmill.operators.keys import HOT_ROWS, broadcast_if_small
from watchmill.operators.rolling import event_inputs, history_parts


def attach_profile(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profile fields by user, each with its default.

    Catalyst broadcasts profiles below its size threshold; more of them are joined on the user, whose
    partitioning the history already has.
    """
    fields = [c for c in profiles.columns if c != "user_id"]
    events = events.drop(*[c for c in fields if c in events.columns])
    rows = events.join(profiles, "user_id", "left")
    filled = {c: F.coalesce(c, F.lit(v)) for c, v in V.PROFILE_DEFAULTS.items() if c in fields}
    missing = {c: F.lit(v) for c, v in V.PROFILE_DEFAULTS.items() if c not in fields}
    home = F.coalesce("home_region", "user_region") if "home_region" in fields else F.col("user_region")
    return rows.withColumns({**filled, **missing, "home_region": home})


def fit_codes(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """``fit_encoders`` of ``attach_profile``, whose rows are not made for it: a profile's values follow from the users."""
    of_people = [*profiles.columns, *V.PROFILE_DEFAULTS, "home_region"]
    users = events.select("user_id", "user_region").distinct()
    return fit_on_sides(events, attach_profile(users, profiles), of_people)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


# what follows from the event without its profile
OWN_FEATURES = [
    "hour", "day_of_week", "is_weekend", "is_night", "hour_sin", "hour_cos", "outside_business_hours", "deep_night",
    "geo_mismatch_int", "impossible_travel_int", "has_failed_attempts", "high_failed_attempts", "very_high_failed",
    "success_int", "geo_not_travel", "geo_and_travel",
]


def own_features(df: DataFrame) -> DataFrame:
    """``OWN_FEATURES``, once per event: an event becomes as many rows as its user has profiles."""
    made = _event_features()
    return df.withColumns({c: made[c] for c in OWN_FEATURES})


def with_event_features(df: DataFrame, done: Sequence[str] = ()) -> DataFrame:
    """Everything that follows from the event and its profile alone; ``done`` is what the rows have already."""
    return df.withColumns({c: value for c, value in _event_features().items() if c not in done})


def _event_features() -> dict[str, Column]:
    hour = F.hour("timestamp")
    day = F.weekday("timestamp")
    off_hours = (hour < 6) | (hour > 20)
    apart = F.abs(F.col("login_hour") - F.col("base_login_hour"))
    deviation = F.least(apart, 24 - apart)
    zscore = deviation / (F.col("login_hour_std_dev") + 0.1)
    extra = F.col("data_downloaded_mb") - F.col("avg_daily_downloads_mb")
    ratio = F.col("data_downloaded_mb") / (F.col("avg_daily_downloads_mb") + 0.01)
    failed = F.col("failed_attempts_last_15m")
    role = F.col("role")
    turn = 2 * F.pi() * hour / 24
    risk = reduce(lambda c, kv: c.when(role == kv[0], kv[1]), V.ROLE_RISK.items(), F).otherwise(1)
    return {
        "hour": hour,
        "day_of_week": day,
        "is_weekend": _flag(day >= 5),
        "is_night": _flag((hour < 6) | (hour > 22)),
        "login_time_deviation": deviation,
        "login_deviation_zscore": zscore,
        "login_deviation_squared": deviation * deviation,
        "extreme_time_deviation": _flag(zscore > 2.5),
        "hour_sin": F.sin(turn),
        "hour_cos": F.cos(turn),
        "outside_business_hours": _flag(off_hours),
        "non_tech_off_hours": _flag(off_hours & ~role.isin(V.TECH_ROLES)),
        "deep_night": _flag(hour.between(1, 5)),
        "shift_worker_int": F.col("is_shift_worker").cast("int"),
        "off_hours_non_shift": _flag(off_hours & ~F.col("is_shift_worker")),
        "geo_mismatch_int": F.col("geo_mismatch").cast("int"),
        "impossible_travel_int": F.col("impossible_travel").cast("int"),
        "from_home_region": _flag(F.col("ip_region") == F.col("home_region")),
        "download_deviation": extra,
        "download_ratio": ratio,
        "download_deviation_abs": F.abs(extra),
        "is_extreme_download": _flag(ratio > 5),
        "has_failed_attempts": _flag(failed > 0),
        "high_failed_attempts": _flag(failed >= 5),
        "very_high_failed": _flag(failed >= 8),
        "success_int": F.col("success").cast("int"),
        "role_risk_score": risk,
        "remote_worker_int": F.col("remote_worker").cast("int"),
        "admin_non_admin_role": _flag((F.col("action") == "admin") & (role != "Admin")),
        "high_download_non_dev": _flag((ratio > 3) & (role != "Developer")),
        "geo_not_travel": _flag(F.col("geo_mismatch") & ~F.col("impossible_travel")),
        "geo_and_travel": _flag(F.col("geo_mismatch") & F.col("impossible_travel")),
    }


def feature_matrix(df: DataFrame, keep: list[str]) -> DataFrame:
    """The features in their fixed order as doubles: a null or a missing column is 0."""
    def number(name):
        if name not in df.columns:
            return F.lit(0.0).alias(name)
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name)

    return df.select(*keep, *[number(c) for c in S.FEATURE_COLUMNS])


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """The columns of the matrix, and those of the table that stay out of it: ids, times, the label and what features are
    made from."""
    return S.FEATURE_COLUMNS, [c for c in df.columns if c in V.DROPPED_COLUMNS]


def labelled_matrix(df: DataFrame, keep: list[str], label: str = "label") -> DataFrame:
    """The matrix with the label beside it."""
    return feature_matrix(df.withColumn(label, F.col("is_injected_anomaly").cast("int")), [*keep, label])


# column -> (type, least, greatest, whether a row must have it)
INPUT_RULES = {
    "timestamp": ("timestamp", None, None, True),
    "login_hour": ("int", 0, 23, True),
    "data_downloaded_mb": ("double", 0, None, True),
    "failed_attempts_last_15m": ("int", 0, None, False),
    "success": ("boolean", None, None, False),
    "geo_mismatch": ("boolean", None, None, False),
    "impossible_travel": ("boolean", None, None, False),
}
_ERROR = "struct<column:string,reason:string>"


def _no_error() -> Column:
    return F.lit(None).cast(_ERROR)


def _error(name: str, reason: str) -> Column:
    return F.struct(F.lit(name).alias("column"), F.lit(reason).alias("reason"))


def _input_error(name: str, raw: Column, kind: str, least, greatest, needed: bool) -> Column:
    value = raw.try_cast(kind)
    checks = F.when(raw.isNull(), _error(name, "missing") if needed else _no_error())
    if kind == "int":
        # a whole number too large for its type, and not a word
        checks = checks.when(value.isNull() & raw.try_cast("double").isNotNull(), _error(name, "overflow"))
    checks = checks.when(value.isNull(), _error(name, "not a value"))
    if kind == "double":
        checks = checks.when(F.isnan(value), _error(name, "not a value")).when(F.abs(value) == float("inf"), _error(name, "overflow"))
    for bound, outside in ((least, lambda v: v < least), (greatest, lambda v: v > greatest)):
        if bound is not None:
            checks = checks.when(outside(value), _error(name, "out of range"))
    return checks


def checked_inputs(events: DataFrame) -> DataFrame:
    """Raw fields, text or typed, as their types, and ``input_error``: the first that cannot be used and why, else null.

    A field that fails is null, so that nothing later stops at it. Reasons: missing, not a value, overflow, out of range.
    """
    rules = {c: rule for c, rule in INPUT_RULES.items() if c in events.columns}
    errors = [_input_error(c, F.col(c), *rule) for c, rule in rules.items()]
    rows = events.withColumn("input_error", F.coalesce(*errors, _no_error()))
    bad = F.col("input_error.column")
    return rows.withColumns({c: F.when(~bad.eqNullSafe(F.lit(c)), F.col(c).try_cast(kind)) for c, (kind, *_) in rules.items()})


def feature_errors(df: DataFrame) -> Column:
    """The first reason why a row's features cannot be computed: a field that ``checked_inputs`` refused, a field that is
    missing, or a feature that is no finite number."""
    needed = [c for c, (*_, must) in INPUT_RULES.items() if must]
    errors = [F.col("input_error")] if "input_error" in df.columns else []
    errors += [F.when(F.col(c).isNull(), _error(c, "missing")) for c in needed]
    for c in S.FEATURE_COLUMNS:
        if c in df.columns and df.schema[c].dataType.typeName() in ("double", "float"):
            errors.append(F.when(F.isnan(c), _error(c, "not a value")).when(F.abs(c) == float("inf"), _error(c, "overflow")))
    return F.coalesce(*errors, _no_error())


def zero_on_error(df: DataFrame) -> DataFrame:
    """Rows whose features cannot be computed get zeros only, the flag ``feature_error`` and, in ``feature_reason``, the
    column that failed first and why."""
    df = df.withColumn("feature_reason", feature_errors(df))
    bad = F.col("feature_reason").isNotNull()
    numbers = {c: F.when(bad, F.lit(0.0)).otherwise(F.col(c)) for c in S.FEATURE_COLUMNS}
    return df.withColumns({"feature_error": bad, **numbers})


def finish_features(rows: DataFrame, codes: DataFrame, mode: str = "exact", unknown: int = 0) -> DataFrame:
    """Rows with history and profile -> all features. Batch and stream: no exchange in here."""
    if mode == "serving":
        rows = rows.withColumn("is_new_ip", F.col("is_first_ip"))
    return apply_encoders(with_event_features(rows), codes, unknown=unknown)


def engineer_features(
    events: DataFrame,
    profiles: DataFrame,
    codes: DataFrame,
    mode: str = "exact",
    hot_rows: int | None = HOT_ROWS,
    unknown: int = 0,
) -> DataFrame:
    """Events with all features. ``mode`` is ``exact`` (rolling windows) or ``serving`` (capped counters).

    The history comes first, on the event's own columns: that is the one exchange of the plan, and a join with
    profiles, if they are too many to broadcast, finds the rows where it needs them. Users with very many rows
    get their few profiles by a join of their own, so that it does not gather their rows again.
    """
    parts = []
    for rows, hot in history_parts(event_inputs(events), mode, hot_rows):
        people = profiles if hot is None else broadcast_if_small(profiles.join(hot, "user_id", "left_semi"))
        parts.append(attach_profile(rows, people))
    return finish_features(reduce(DataFrame.unionByName, parts), codes, mode, unknown)
