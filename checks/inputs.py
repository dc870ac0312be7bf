"""What several queries start from."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchmill.operators import ledger, rolling
from watchmill.operators.features import engineer_features, fit_codes
from watchmill.plans.scoring import decide, predict_scored
from watchmill.schema import NETWORK_LOG
from watchmill.session import prepare
from watchmill.sources import driver_tables as T


PROCESSES = (
    "Chrome.exe", "FIREFOX", "msedge", "Outlook.exe", "thunderbird", "PowerShell.exe", "cmd.exe", "ssh", "SSHD", "dns", "NSLookup",
    "custom_app", "ssh from chrome", "cmd /c nslookup", "", None,
)
COMMANDS = (
    "powershell -enc base64", "MIMIKATZ.exe", "cmd /c Net User bob /add", "whoami", "notepad.exe", "scan Lateral path", "ping DOMAIN_CONTROLLER",
    "PsExec -s cmd", "wmic process list", "certutil -decode a b", "netuser", "ls -la", "", None, "who am i", "psexe c",
)


def profiles(spark: SparkSession, d: str) -> DataFrame:
    return T.profiles(prepare(spark), d)


def events(spark: SparkSession, d: str, people: DataFrame | None = None, table: DataFrame | None = None) -> DataFrame:
    rows = T.net_events(prepare(spark), d, table, people)
    return rows.withColumn("latency_ms", F.col("k") * F.lit(0.25))


def commands(spark: SparkSession, d: str) -> DataFrame:
    """Events with a process name and a command line chosen by ``k``; all keys of both lists occur."""
    def chosen(words):
        return F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("k") % len(words) + 1).cast("int"))

    return events(spark, d).select("event_id", chosen(PROCESSES).alias("process_name"), chosen(COMMANDS).alias("command_line"))


def events_and_profiles(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    people = profiles(spark, d)
    return events(spark, d, people), people


def log_events(spark: SparkSession, d: str) -> DataFrame:
    """Events with the columns of the log only, ids as text."""
    return events(spark, d).select(*[F.col(f.name).cast(f.dataType) for f in NETWORK_LOG])


def decided(spark: SparkSession, d: str) -> DataFrame:
    """Events with scores, flags and actions."""
    return decide(events(spark, d))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    return predict_scored(events(spark, d))


def inputs(spark: SparkSession, d: str) -> DataFrame:
    return rolling.event_inputs(events(spark, d))


def exact(spark: SparkSession, d: str, hot_rows: int | None = rolling.HOT_ROWS) -> DataFrame:
    return rolling.with_history(inputs(spark, d), "exact", hot_rows)


def serving(spark: SparkSession, d: str, hot_rows: int | None = rolling.HOT_ROWS) -> DataFrame:
    return rolling.with_history(inputs(spark, d), "serving", hot_rows)


def codes(rows: DataFrame, people: DataFrame) -> DataFrame:
    return fit_codes(rows, people)


def features(spark: SparkSession, d: str, mode: str = "exact", hot_rows: int | None = rolling.HOT_ROWS) -> DataFrame:
    rows, people = events_and_profiles(spark, d)
    return engineer_features(rows, people, codes(rows, people), mode, hot_rows)


def alerts(spark: SparkSession, d: str) -> DataFrame:
    return ledger.create_alerts(decided(spark, d))


def decisions_on(alerts_: DataFrame) -> DataFrame:
    """Approve, reject or leave by event id; for every sixth a second, contradictory decision one minute later."""
    event = F.col("event_id")
    decision = F.when(event % 3 == 0, "approve").otherwise("reject")
    other = F.when(event % 3 == 0, "reject").otherwise("approve")

    def one(n, what, minutes, notes):
        return F.struct(
            F.concat(event.cast("string"), F.lit(f"-{n}")).alias("decision_id"), what.alias("decision"),
            (F.col("created_us") + minutes * 60_000_000).alias("at_us"), notes.alias("admin_notes"),
        )

    first = one(1, decision, 10, F.concat(F.lit("note "), event.cast("string")))
    second = one(2, other, 11, F.lit("late"))
    both = F.when(event % 6 == 0, F.array(second, first)).otherwise(F.array(first))
    return alerts_.filter(event % 3 < 2).select("alert_id", F.explode(both).alias("d")).select("alert_id", "d.*")


def current(spark: SparkSession, d: str) -> DataFrame:
    made = alerts(spark, d)
    return ledger.current_alerts(made, decisions_on(made))


def rotations(spark: SparkSession, d: str) -> DataFrame:
    return ledger.rotations(current(spark, d))
