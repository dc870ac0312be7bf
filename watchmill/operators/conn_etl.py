"""Connection logs: from text to typed, named, tagged records, and back to the events behind them."""

from pyspark.sql import Column, DataFrame, functions as F

from watchmill import fixed_values as V
from watchmill import schema as S
from watchmill.functions import conn as C
from watchmill.functions import host as H


def convert_conn(conn: DataFrame) -> DataFrame:
    """Text to types; what cannot be read, ``-`` included, becomes null."""
    def typed(name: str, kind: str) -> Column:
        text = F.nullif(F.trim(name), F.lit("-"))
        return text.alias(name) if kind == "string" else text.try_cast(kind).alias(name)

    return conn.select(*[typed(name, kind) for name, kind in S.CONN_COLUMNS.items()])


def normalise_conn(conn: DataFrame) -> DataFrame:
    """The normalised names: nested ``id``, ``source``, ``destination`` and ``zeek``."""
    nested = ["orig_h", "orig_p", "resp_h", "resp_p", "orig_bytes", "resp_bytes", "conn_state", "orig_pkts", "resp_pkts"]
    rest = [c for c in conn.columns if c not in nested]
    return conn.select(
        *rest,
        F.struct("orig_h", "orig_p", "resp_h", "resp_p").alias("id"),
        F.struct(F.col("orig_bytes").alias("bytes"), F.col("orig_pkts").alias("packets")).alias("source"),
        F.struct(F.col("resp_bytes").alias("bytes"), F.col("resp_pkts").alias("packets")).alias("destination"),
        F.struct("conn_state").alias("zeek"),
    )


def tag_conn(conn: DataFrame, tags: dict[str, str] = V.CONN_TAGS) -> DataFrame:
    return conn.withColumns({name: F.lit(value) for name, value in tags.items()})


def to_conn_records(events: DataFrame, ports: int = V.CLIENT_PORTS) -> DataFrame:
    """The 20 columns of a connection record for every event."""
    service = C.service_of(F.col("action"))
    sent = C.bytes_of(F.col("data_downloaded_mb"))
    back = C.response_bytes(sent)
    uid = F.col("event_id").cast("string")
    no_text = F.lit(None).cast("string")
    columns = {
        "ts": C.epoch_ts(F.col("timestamp")),
        "uid": uid,
        "orig_h": F.col("source_ip"),
        "orig_p": C.client_port(uid, ports).cast("bigint"),
        "resp_h": C.resp_ip(F.col("workspace_id")),
        "resp_p": C.server_port(service).cast("bigint"),
        "proto": F.lit("tcp"),
        "service": service,
        "duration": F.round(C.duration(F.col("data_downloaded_mb")), 6),
        "orig_bytes": sent,
        "resp_bytes": back,
        "conn_state": C.conn_state(F.col("success")),
        "local_orig": no_text,
        "local_resp": no_text,
        "missed_bytes": F.lit(0).cast("bigint"),
        "history": F.lit("S"),
        "orig_pkts": C.packets(sent),
        "orig_ip_bytes": sent,
        "resp_pkts": C.packets(back),
        "resp_ip_bytes": back,
    }
    return events.select(*[columns[name].alias(name) for name in S.CONN_COLUMNS])


def conn_lines(records: DataFrame) -> DataFrame:
    """Records as lines of a log: TAB-separated, ``-`` for null, six decimals."""
    def text(name: str, kind: str) -> Column:
        value = F.format_string("%.6f", F.col(name)) if kind == "double" else F.col(name).cast("string")
        return F.coalesce(F.when(F.col(name).isNotNull(), value), F.lit("-"))

    return records.select(F.concat_ws("\t", *[text(n, k) for n, k in S.CONN_COLUMNS.items()]).alias("value"))


def header_lines() -> list[str]:
    return ["#fields\t" + "\t".join(V.CONN_FIELDS), "#types\t" + "\t".join(V.CONN_TYPES)]


def enrich_conn(conn: DataFrame, events: DataFrame) -> DataFrame:
    """Connection records with the event they belong to: ``uid`` is the event id, unique on both sides."""
    known = events.select(
        F.col("event_id").cast("string").alias("uid"), "user_id", "workspace_id", "ip_region", "user_region", "action"
    )
    return conn.join(known, "uid", "left")


def ids_alerts(raw: DataFrame) -> DataFrame:
    """One alert per record whose command line holds a suspicious word."""
    return raw.filter(H.is_suspicious(F.col("command_line"))).select(
        "event_id", F.lit(V.SUSPICIOUS_MESSAGE).alias("msg")
    )


def to_ecs(raw: DataFrame) -> DataFrame:
    """The normalised agent record; missing columns get their defaults."""
    def present(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in raw.columns else F.lit(default)

    return raw.select(
        "event_id",
        F.lit(V.AGENT_TYPE).alias("agent_type"),
        F.lit(V.AGENT_VERSION).alias("agent_version"),
        F.lit(V.ECS_VERSION).alias("ecs_version"),
        H.classify_event(present("event_type", "")).alias("event_category"),
        F.lit("event").alias("event_kind"),
        present("log_type", "security").alias("event_module"),
        present("hostname", "").alias("host_name"),
        F.lit(V.HOST_OS).alias("host_os"),
        F.lit(True).alias("geo_enriched"),
    )
