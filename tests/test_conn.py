import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from watchmill import fixed_values as V
from watchmill import schema as S
from watchmill.functions import conn as C
from watchmill.functions import host as H
from watchmill.operators import bridge, conn_etl, projection
from watchmill.sources import files, sinks, streams

LINE = "1718445600.123456\te1\t10.0.0.1\t49200\t192.168.0.104\t80\ttcp\thttp\t1.500000\t1000\t200\tSF\t-\t-\t0\tS\t1\t1000\t1\t200"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_conn_log_text_to_types(spark, tmp_path):
    bad = LINE.replace("e1", "e2").replace("49200", "port").replace("1.500000", "-")
    (tmp_path / "conn.log").write_text("\n".join(["#separator \\x09", "#fields\tts", "", "   ", LINE, bad, "#close"]) + "\n")
    rows = conn_etl.convert_conn(files.read_conn_log(spark, str(tmp_path))).orderBy("uid").collect()
    assert [r["uid"] for r in rows] == ["e1", "e2"]
    assert rows[0]["orig_p"] == 49200 and rows[0]["duration"] == 1.5 and rows[0]["local_orig"] is None
    assert rows[1]["orig_p"] is None and rows[1]["duration"] is None and rows[1]["resp_bytes"] == 200
    assert len(rows[0]) == 20


def test_a_line_with_few_fields_keeps_nulls(spark, tmp_path):
    (tmp_path / "conn.log").write_text("1.0\te9\t10.0.0.1\n")
    row = conn_etl.convert_conn(files.read_conn_log(spark, str(tmp_path))).first()
    assert row["uid"] == "e9" and row["service"] is None


def test_numbers_from_text(spark):
    assert one(spark, C.safe_int(F.lit("7")), C.safe_int(F.lit("x")), C.safe_int(F.lit(None).cast("string"), 3),
               C.safe_float(F.lit("1.5")), C.safe_float(F.lit("n/a"))) == (7, 0, 3, 1.5, 0.0)


def test_server_address(spark):
    values = [C.resp_ip(F.lit(w)) for w in ("WS-7", "WS-123", "none", "", "W9X8Y7")]
    assert one(spark, *values) == ("192.168.0.107", "192.168.0.123", "192.168.0.101", "192.168.0.101", "192.168.0.187")


def test_ports_services_states(spark):
    assert one(spark, C.service_of(F.lit("ADMIN")), C.service_of(F.lit("read")), C.service_of(F.lit("login"))) == ("ssh", "http", "unknown")
    assert one(spark, C.server_port(F.lit("ssh")), C.server_port(F.lit("http")), C.conn_state(F.lit(True)), C.conn_state(F.lit(False))) == (22, 80, "SF", "REJ")
    for n in (1000, 16384):
        ids = ["0", "7", "event-1", ""]
        want = [49152 + int(hashlib.sha256(i.encode()).hexdigest()[:8], 16) % n for i in ids]
        assert list(one(spark, *[C.client_port(F.lit(i), n) for i in ids])) == want
        low, high = spark.range(500).select(C.client_port(F.col("id").cast("string"), n).alias("p")).agg(F.min("p"), F.max("p")).first()
        assert 49152 <= low <= high < 49152 + n


def test_sizes(spark):
    assert one(spark, C.duration(F.lit(0.0)), C.duration(F.lit(10.0)), C.duration(F.lit(1e6))) == (0.01, 1.5, 3600.0)
    assert one(spark, C.bytes_of(F.lit(1.0)), C.bytes_of(F.lit(-5.0)), C.response_bytes(F.lit(99))) == (1048576, 0, 19)
    assert one(spark, C.packets(F.lit(0)), C.packets(F.lit(1500)), C.packets(F.lit(1501))) == (1, 1, 2)


def test_processes_and_categories(spark):
    got = one(spark, *[H.guess_service(F.lit(p)) for p in ("chrome.exe", "ssh", "powershell.exe", "custom_app", "NSLOOKUP")])
    assert got == ("http", "ssh", "smb", "unknown", "dns")
    got = one(spark, *[H.classify_event(F.lit(p)) for p in ("network_connection", "process_start", "other")])
    assert got == ("network", "process", "host")


def test_suspicious_commands(spark):
    got = one(spark, *[H.is_suspicious(F.lit(c)) for c in ("PowerShell -enc base64", "net user bob", "ls -l", "")],
              H.is_suspicious(F.lit(None).cast("string")))
    assert got == (True, True, False, False, False)
    raw = spark.createDataFrame([("1", "powershell -enc base64"), ("2", "ls")], "event_id string, command_line string")
    assert [tuple(r) for r in conn_etl.ids_alerts(raw).collect()] == [("1", V.SUSPICIOUS_MESSAGE)]


def test_normalised_names_and_tags(spark, tmp_path):
    (tmp_path / "conn.log").write_text(LINE + "\n")
    conn = conn_etl.normalise_conn(conn_etl.convert_conn(files.read_conn_log(spark, str(tmp_path))))
    row = conn_etl.tag_conn(conn, V.DIRECT_TAGS).first()
    assert row["id"]["orig_p"] == 49200 and row["source"]["bytes"] == 1000 and row["destination"]["packets"] == 1
    assert row["zeek"]["conn_state"] == "SF" and row["pipeline_output"] == "kafka-direct"


def test_unknown_host_record_gets_defaults(spark):
    row = conn_etl.to_ecs(spark.createDataFrame([("1",)], "event_id string")).first()
    assert (row["event_category"], row["event_module"], row["host_name"]) == ("host", "security", "")


def test_event_defaults(spark):
    row = projection.to_network_event(spark.createDataFrame([("x",)], "other string")).first().asDict()
    assert row == V.EVENT_DEFAULTS
    row = projection.to_network_event(spark.createDataFrame([(True, "data_exfiltration")], "is_injected_anomaly boolean, anomaly_type string")).first()
    assert row["is_injected_anomaly"] and row["anomaly_type"] == "data_exfiltration" and row["success"]


def test_blank_users_are_set_apart(spark):
    rows = spark.createDataFrame([("u",), ("",), (None,), ("  ",)], "user_id string")
    assert projection.named_users(rows).count() == 1 and projection.blank_users(rows).count() == 3


def test_malformed_addresses_become_null(spark):
    got = one(spark, *[sinks.valid_ip(F.lit(ip)) for ip in ("10.0.0.1", "fe80::1", "not-an-ip", "")])
    assert got == ("10.0.0.1", "fe80::1", None, None)


def test_log_csv_with_bad_time(spark, tmp_path):
    names = S.NETWORK_LOG.names
    good = ["e1", "2025-06-15 10:00:00.123456", "10", "u1", "w", "1.1.1.1", "US-East", "US-East", "False", "false", "login", "True", "0", "5.5", "False", "None"]
    bad = [*good]
    bad[0], bad[1] = "e2", "yesterday"
    (tmp_path / "log.csv").write_text("\n".join(",".join(r) for r in (names, good, bad)) + "\n")
    rows = files.read_network_logs(spark, str(tmp_path)).orderBy("event_id").collect()
    assert rows[0]["timestamp"].microsecond == 123456 and rows[0]["success"] and rows[1]["timestamp"] is None
    assert rows[1]["data_downloaded_mb"] == 5.5


def test_json_array_and_lines(spark, tmp_path):
    events = [{"event_id": "a", "timestamp": "2025-06-15T10:00:00.5Z", "extra": 1}, {"event_id": "b"}]
    (tmp_path / "array.json").write_text(json.dumps(events, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, events)))
    a = files.read_events_json(spark, str(tmp_path / "array.json")).orderBy("event_id").collect()
    b = files.read_events_json(spark, str(tmp_path / "lines.json"), lines=True).orderBy("event_id").collect()
    assert a == b and len(a) == 2 and a[0]["timestamp"].isoformat() == "2025-06-15T10:00:00.500000"
    people = [{"user_id": 7, "role": "HR"}]
    (tmp_path / "p.json").write_text(json.dumps(people))
    assert files.read_profiles(spark, str(tmp_path / "p.json")).first()["user_id"] == "7"


def test_unreadable_messages(spark):
    values = spark.createDataFrame([('{"event_id": "1"}',), ('{"event_id": "2", "ti',), ("nonsense",)], "value string")
    parsed = streams.parse_events(values)
    assert [r["event_id"] for r in streams.good_messages(parsed).collect()] == ["1"]
    assert streams.poison_messages(parsed).count() == 2


def test_bridge_limit_and_first(spark):
    docs = spark.range(10).select((F.col("id") % 3).alias("key"), "id")
    assert bridge.bridge(docs, "i", "id", limit=4).count() == 4 and bridge.bridge(docs, "i", "id").count() == 10
    first = bridge.first_of_each(docs.withColumn("_es_id", F.col("key").cast("string")), order="id")
    assert sorted(r["id"] for r in first.collect()) == [0, 1, 2]
    assert sorted(r["id"] for r in bridge.not_sent(docs, spark.range(3, 100), "id").collect()) == [0, 1, 2]


def test_batch_limit(spark):
    from watchmill.operators.lists import batch_admission, check_batch

    assert check_batch(spark.range(100)).count() == 100
    with pytest.raises(ValueError):
        check_batch(spark.range(101))
    sizes = batch_admission(spark.range(201).select((F.col("id") > 99).alias("b")), "b").collect()
    assert {r["b"]: r["accepted"] for r in sizes} == {False: True, True: False}


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text("role,unknown,user_id,is_shift_worker,base_login_hour\nAdmin,x,USR-1,true,8.5\nHR,y,USR-2,maybe,\n")
    rows = files.read_profiles(spark, str(tmp_path / "p.csv")).orderBy("user_id").collect()
    assert [(r["user_id"], r["role"], r["is_shift_worker"], r["base_login_hour"], r["home_region"]) for r in rows] == [
        ("USR-1", "Admin", True, 8.5, None), ("USR-2", "HR", None, None, None)]


def test_network_logs_compressed(spark, tmp_path):
    """Logs written compressed read back as the same rows."""
    log = [(str(i), datetime(2024, 1, 1, i), f"USR-{i}", "read", i % 2 == 0, i / 4) for i in range(20)]
    rows = spark.createDataFrame(log, "event_id string, timestamp timestamp, user_id string, action string, success boolean, data_downloaded_mb double")
    plain, small = f"{tmp_path}/plain", f"{tmp_path}/small"
    sinks.write_network_logs(rows, plain)
    sinks.write_network_logs(rows, small, "gzip")
    assert all(f.name.endswith(".csv.gz") for f in tmp_path.joinpath("small").glob("part-*"))
    first, second = (files.read_network_logs(spark, p) for p in (plain, small))
    assert second.count() == 20 and second.exceptAll(first).isEmpty() and first.exceptAll(second).isEmpty()
