import copy
import ipaddress
import json
import random

import pytest
from pyspark.sql import functions as F

from netquarry.functions.network import normalized_ip
from netquarry.operators import contract

FLOW = {
    "flow_id": 1, "ip_version": 4, "protocol": 6, "protocol_name": "TCP", "initiator": {"ip": "10.20.1.5", "port": 50000}, "responder": {"ip": "198.51.100.40", "port": 443}, "initiator_basis": "syn",
    "first_seen": {"unix_seconds": 1_767_225_600, "nanos": 1_999, "rfc3339": "x"}, "last_seen": {"unix_seconds": 1_767_225_605, "nanos": 0, "rfc3339": "x"}, "duration_seconds": 5, "first_packet_index": 0, "last_packet_index": 9,
    "initiator_to_responder": {"packets": 6, "bytes": 600, "payload_bytes": 9000}, "responder_to_initiator": {"packets": 4, "bytes": 400, "payload_bytes": 10}, "packets_total": 10, "bytes_total": 1000,
    "packet_size": {"min": 40, "max": 1500, "mean": 100.5, "stddev": 1, "median": 90, "median_exact": True}, "inter_arrival": None,
    "tcp": {"state": "closed", "flags_initiator": ["SYN"], "flags_responder": [], "syn_packets": 1, "fin_packets": 0, "rst_packets": 0, "duplicate_segments": 0},
    "application": {"protocols": ["tls"], "http_hosts": ["www.example.com:8080"]}, "dominant_endpoint": "responder", "end_reason": "idle_timeout", "warnings": [{"code": "x", "count": 2}], "alert_ids": [1, 2],
}
GONE = object()


def changed(path, value):
    flow = copy.deepcopy(FLOW)
    *parents, last = path.split(".")
    at = flow
    for p in parents:
        at = at[p]
    if value is GONE:
        del at[last]
    else:
        at[last] = value
    return json.dumps(flow)


CASES = [
    ("flow_id", GONE, "missing"), ("protocol", "17", "int_type"), ("protocol", True, "int_type"), ("protocol", 1.0, "int_type"), ("protocol", 256, "less_than_equal"), ("bytes_total", 2**63, "less_than_equal"), ("flow_id", 0, "greater_than_equal"),
    ("initiator.port", 65536, "less_than_equal"), ("duration_seconds", "1", "float_type"), ("duration_seconds", -0.5, "greater_than_equal"), ("duration_seconds", float("nan"), "finite_number"), ("packet_size.mean", float("inf"), "finite_number"),
    ("initiator_basis", "", "string_too_short"), ("initiator_basis", 5, "string_type"), ("ip_version", 5, "literal_error"), ("responder.ip", "010.1.1.1", "invalid_ip_address"), ("responder.ip", "x", "invalid_ip_address"), ("tcp", "x", "model_type"),
    ("application", GONE, "missing"), ("application.protocols", ["a", ""], "string_too_short"), ("tcp.flags_initiator", "SYN", "list_type"), ("alert_ids", [1, -1], "greater_than_equal"), ("warnings", [{"code": "x"}], "missing"),
    ("packet_size.median_exact", 1, "bool_type"), ("first_seen", None, "missing_event_time"), ("last_seen.unix_seconds", 1_767_225_599, "time_reversed"), ("packets_total", 11, "totals_mismatch"), ("bytes_total", 1001, "totals_mismatch"),
    ("ip_version", 6, "ip_version_mismatch"), ("protocol_name", None, None), ("tcp", None, None), ("new_field", {"a": 1}, None), ("application", {}, None), ("warnings", GONE, None), ("end_reason", "something new", None),
]


@pytest.fixture(scope="module")
def told(spark):
    raws = [changed(p, v) for p, v, _ in CASES] + ["[]", "{", None, json.dumps({})]
    rows = [(i, r, "b", "file", "s1", "c1", None, "complete") for i, r in enumerate(raws)]
    df = spark.createDataFrame(rows, "record_index long, raw string, batch_id string, source string, sensor_id string, capture_id string, capture_file string, completion_state string")
    return contract.checked(df.withColumn("ingested_at", F.lit("2026-01-02 00:00:00").cast("timestamp"))).cache()


def test_error_types(told):
    found = {r["record_index"]: (r["error_type"],) for r in told.select("record_index", "error_type").collect()}
    messages = {r["record_index"]: r["error_message"] for r in contract.with_messages(told.where("error_type is not null")).select("record_index", "error_message").collect()}
    assert [found[i][0] for i in range(len(CASES))] == [x for _, _, x in CASES]
    assert [found[len(CASES) + i][0] for i in range(4)] == ["model_type", "model_type", "model_type", "missing"]
    assert messages[0] == "flow_id: the field is missing"
    assert len(messages[len(CASES) + 3]) <= 1000 and messages[len(CASES) + 3].startswith("flow_id: the field is missing; ip_version: ")


def test_bronze_rows(told):
    rows = contract.flattened(told.where("error_type is null")).collect()
    assert len(rows) == sum(x is None for _, _, x in CASES) and len(rows[0]) == 59
    r = rows[0]
    assert (r["initiator_ip"], r["initiator_port"], r["bytes_total"], r["i2r_payload_bytes"], r["http_hosts"], r["dns_queries"]) == ("10.20.1.5", 50000, 1000, 9000, ["www.example.com:8080"], [])
    assert r["first_seen"].microsecond == 1 and r["flow_warnings"][0]["count"] == 2 and r["upstream_alert_ids"] == [1, 2]


def test_quarantine_rows(told):
    bad = contract.quarantined(told.where("error_type is not null").withColumn("raw", F.rpad("raw", 20_000, "x")))
    assert {len(r["raw_record"]) for r in bad.where("raw_record is not null").collect()} == {16_384}


def test_normal_form_of_addresses(spark):
    pick = random.Random(3)
    group = lambda: pick.choice(["0", "0", "0000", "1", "00ab", "FFFF", "ffff", "2001", "g", "12345", ""])
    quad = lambda: ".".join(str(pick.choice([0, 1, 9, 10, 99, 255, 256, "01", "", "a"])) if pick.random() < 0.2 else str(pick.randrange(256)) for _ in range(pick.choice([4, 4, 4, 4, 3, 5])))
    texts = ["2001:DB8:0:0::A00", "10.1.1.1", "10.1.1", "1.2.3.4\n", "::", ":::", "1::2::3", "::ffff:1.2.3.4", "::ffff:0:1", "fe80::1%eth0", "fe80::1%", "fe80::1%a%b", "1.2.3.4%1", "1:2:3:4:5:6:7::", "::1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8", "0:0:0:0:0:0:0:0", "::1.2.3.4", "x", "", ":", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", " 1.2.3.4", "٣.1.1.1"]
    texts += [quad() for _ in range(200)]
    for _ in range(1500):
        parts = [group() if pick.random() < 0.15 else pick.choice(["0", "0", "1", "ab", "0c0"]) for _ in range(pick.choice([8, 8, 8, 7, 6, 3, 9]))]
        if pick.random() < 0.5:
            parts[pick.randrange(len(parts))] = ""
        texts.append(":".join(parts) + (":" + quad() if pick.random() < 0.1 else "") + ("%z" if pick.random() < 0.05 else ""))

    def want(text):
        try:
            return str(ipaddress.ip_address(text))
        except ValueError:
            return None

    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, ip string")
    found = {r["i"]: r["n"] for r in df.select("i", normalized_ip(F.col("ip")).alias("n")).collect()}
    assert [(t, found[i]) for i, t in enumerate(texts)] == [(t, want(t)) for t in texts] and found[len(texts)] is None


def test_bare_numbers_only_outside_texts(spark):
    texts = ['{"a": NaN, "b": "x: NaN, y", "c": [Infinity, -Infinity, -1, "\\\\"], "d": "\\": NaN"}', '{"a": "path: NaN, z"}', '{"a": NAN}', '{"b": "' + "x" * 300_000 + '", "a": NaN}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string").withColumn("v", contract.parsed(F.col("raw")))
    found = {r["i"]: json.loads(r["t"]) if r["t"] else None for r in df.select("i", F.to_json("v").alias("t")).collect()}
    mark = "__not_finite__"
    assert found[0] == {"a": mark, "b": "x: NaN, y", "c": [mark, mark, -1, "\\"], "d": '": NaN'}
    assert found[1] == {"a": "path: NaN, z"} and found[2] is None and found[3]["a"] == mark


def test_envelopes(spark):
    good = {"contract_version": 1, "sensor_id": "s1", "capture_id": "c", "completion_state": "complete", "flow": FLOW}
    values = [json.dumps(good).encode(), b"\xff{", b"{}", json.dumps(good | {"contract_version": 2}).encode(), json.dumps(good | {"flow": []}).encode(), json.dumps(good | {"sensor_id": ""}).encode()]
    found = contract.decode_messages(spark.createDataFrame([(v,) for v in values], "value binary")).collect()
    assert [r["envelope_error"] for r in found] == [None, "invalid_json", "envelope_missing", "envelope_literal_error", "envelope_dict_type", "envelope_string_too_short"]
    assert [r["sensor_id"] for r in found] == ["s1", "unknown", "unknown", "s1", "s1", "unknown"]


def test_unknown_fields_take_the_short_way_and_change_nothing(spark, monkeypatch):
    odd = {"aaa": 1, "zzz": {"x": [1, {"y": None}]}, "a b": "t", "q`u: BIGINT, flow_id": 2.5, "tcp2": [], "flow_idx": True}
    nested = {k: FLOW[k] | {"odd": [1], "zz": {}} for k in ("initiator", "first_seen", "initiator_to_responder", "application")}
    more = [odd, nested, odd | nested, {"deep": {"a": {"b": {"c": {"d": 1}}}}}, {"warnings": [{"code": "c", "count": 1, "more": 2}]}, {"warnings": [{"code": "", "count": 1, "more": 2}]}, {"warnings": [{"code": "c", "count": 1}, {"code": "c", "more": 2}]}]
    wrong = [{}, {"warnings": "x"}, {"alert_ids": {}}, {"protocol": "17"}, {"flow_id": None}, {"packets_total": 0}, {"duration_seconds": -1.5}, {"end_reason": ""}, {"initiator": 5}, {"ip_version": 6}]
    records = [json.dumps(FLOW | m | w) for m in more for w in wrong] + [json.dumps({k: v for k, v in (FLOW | odd).items() if k != gone}) for gone in FLOW]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(records)], "k int, raw string")
    quick = {r["k"]: r["error_type"] for r in contract.checked(df).select("k", "error_type").collect()}
    tolerant = contract.shape(contract.FLOW, tolerant=True)
    schemas = df.selectExpr("k", "schema_of_variant(parse_json(raw)) AS s").where(f"s RLIKE '^{tolerant}$'".replace("\\", "\\\\")).collect()
    assert {r["k"] for r in schemas} >= {0, 10, 20, 40} and not {r["k"] for r in schemas} & {1, 2, 3, 4, 11, 30}
    monkeypatch.setattr(contract, "shape", lambda *a, **k: "never")
    assert {r["k"]: r["error_type"] for r in contract.checked(df).select("k", "error_type").collect()} == quick
    assert quick[0] is None and quick[20] is None and quick[30] is None and quick[1] == "list_type"
