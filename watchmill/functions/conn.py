"""Column expressions for connection records."""

from pyspark.sql import Column, functions as F

from watchmill import fixed_values as V
from watchmill.functions.lookup import choose


def safe_int(col: Column, default: int = 0) -> Column:
    return F.coalesce(col.try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_float(col: Column, default: float = 0.0) -> Column:
    return F.coalesce(col.try_cast("double"), F.lit(default))


def service_of(action: Column) -> Column:
    return choose(F.lower(action), V.ACTION_SERVICE, "unknown")


def resp_ip(workspace: Column) -> Column:
    # try_cast raises and catches an error for a text without digits, which costs far more than the cast
    digits = F.nullif(F.right(F.regexp_replace(workspace, r"\D+", ""), F.lit(2)), F.lit(""))
    suffix = F.coalesce(digits.try_cast("int"), F.lit(1))
    return F.concat(F.lit(V.SERVER_NET), (V.SERVER_HOST_BASE + suffix % 100).cast("string"))


def client_port(event_id: Column, ports: int = V.CLIENT_PORTS) -> Column:
    """A port that follows from the id: 32 bits of its digest, which other engines have too."""
    bits = F.conv(F.substring(F.sha2(event_id, 256), 1, 8), 16, 10).cast("bigint")
    return F.lit(V.FIRST_CLIENT_PORT) + F.pmod(bits, F.lit(ports))


def server_port(service: Column) -> Column:
    return F.when(service == "ssh", V.SSH_PORT).otherwise(V.OTHER_PORT)


def epoch_ts(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(1_000_000)


def duration(mb: Column) -> Column:
    return F.greatest(F.lit(V.SHORTEST_CONN), F.least(F.lit(V.LONGEST_CONN), mb * V.SECONDS_PER_MB))


def bytes_of(mb: Column) -> Column:
    return F.floor(F.greatest(F.lit(0.0), mb * V.BYTES_PER_MB)).cast("bigint")


def response_bytes(orig_bytes: Column) -> Column:
    return F.floor(orig_bytes * F.lit(V.RESPONSE_SHARE)).cast("bigint")


def packets(n_bytes: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(n_bytes / F.lit(V.PACKET_BYTES))).cast("bigint")


def conn_state(success: Column) -> Column:
    return F.when(success, "SF").otherwise("REJ")
