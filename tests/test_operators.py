import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import Row

from netquarry.operators import datatests, detections, facts, hosts, incremental, quality, serving, zones
from netquarry.plans import adapter, registry
from netquarry.sources.reference import SITE_ZONES, reference_table
from netquarry.sources.versions import Versioned

SF = "/root/testdata/sf0.001"
DAY = datetime(2026, 1, 1)


FLOWS = (
    "initiator_ip string, responder_ip string, responder_port int, protocol int, tcp_state string, flow_hour timestamp, event_date date, first_seen timestamp, last_seen timestamp, bytes_total bigint, i2r_bytes bigint, r2i_bytes bigint, "
    "direction string, responder_name string, app_protocol string, service string, dns_queries array<string>"
)


def flow(**columns):
    base = dict(initiator_ip="10.20.1.1", responder_ip="198.51.100.1", responder_port=443, protocol=6, tcp_state="closed", flow_hour=DAY, event_date=DAY.date(), first_seen=DAY, last_seen=DAY, bytes_total=10, i2r_bytes=5, r2i_bytes=5,
                direction="outbound", responder_name="c2.example", app_protocol="none", service="https", dns_queries=[])
    return Row(**(base | columns))


def test_cidr_ranges_and_longest_prefix(spark):
    table = spark.createDataFrame([("a", "10.20.0.0/16", True), ("b", "192.0.2.7/32", False), ("c", "10.0.0.0/8", True), ("all", "0.0.0.0/0", False)], "zone string, cidr string, is_internal boolean")
    assert {r["zone"]: (r["range_start"], r["range_end"]) for r in zones.parse_zones(table).where("zone in ('a', 'b')").collect()} == {"a": (169082880, 169148415), "b": (3221225991, 3221225991)}
    ips = spark.createDataFrame([("10.20.255.255",), ("10.21.0.0",), ("192.0.2.7",), ("192.0.2.8",), ("fd00::1",), ("2001:db8::1",)], "ip string")
    want = {"10.20.255.255": "a", "10.21.0.0": "c", "192.0.2.7": "b", "192.0.2.8": "all", "fd00::1": "private", "2001:db8::1": "external"}
    for lookup in (zones.zone_lookup,):
        assert {r["ip"]: r["zone"] for r in lookup(ips, table).collect()} == want
    assert {r["zone"] for r in zones.zone_lookup(ips, table.limit(0)).collect()} == {"private", "external"}


def test_beacon(spark):
    steady = [flow(first_seen=DAY + timedelta(seconds=300 * i)) for i in range(25)]
    growing = [flow(responder_ip="198.51.100.2", first_seen=DAY + timedelta(seconds=7 * i * i)) for i in range(30)]
    ntp = [flow(responder_ip="198.51.100.3", responder_port=123, protocol=17, first_seen=DAY + timedelta(seconds=1024 * i)) for i in range(30)]
    one = [flow(responder_ip="198.51.100.4")] + [flow(responder_ip="198.51.100.5")] * 30  # no gap; gaps of zero
    found = detections.det_beaconing(spark.createDataFrame(steady + growing + ntp + one, FLOWS), reference_table(spark, "detection_allowlist")).collect()
    assert [(r["dst_ip"], r["connections"], r["mean_interval_seconds"], r["dst_name"]) for r in found] == [("198.51.100.1", 25, 300.0, "c2.example")]


def test_port_scan(spark):
    rows = [flow(responder_port=1000 + i, tcp_state="reset", responder_ip="10.1.1.1") for i in range(60)] + [flow(responder_port=1000 + i, responder_ip="10.1.1.2") for i in range(60)] + [flow(responder_port=i, tcp_state=None, responder_ip="10.1.1.3") for i in range(60)]
    found = detections.det_port_scan(spark.createDataFrame(rows, FLOWS)).collect()
    assert [(r["dst_ip"], r["distinct_ports"], r["sample_ports"][:2], len(r["sample_ports"])) for r in found] == [("10.1.1.1", 60, [1000, 1001], 10)]


def test_allowlist_wildcards(spark):
    rows = spark.createDataFrame([("r", "a", "b", 1), ("r", "a", None, 1), ("r", "c", "b", None), ("q", "a", "b", 1)], "rule_id string, src_ip string, dst_ip string, dst_port int")
    entries = lambda *e: reference_table(spark, "detection_allowlist", tuple((*x, "why") for x in e))
    left = lambda *e: sorted(tuple(r) for r in detections.allowed(rows, entries(*e)).select("rule_id", "src_ip").collect())
    assert left(("r", "*", "b", "*")) == [("q", "a"), ("r", "a")]
    assert left(("r", "a", "*", "*")) == [("q", "a"), ("r", "c")]
    assert left(("r", "*", "*", "1")) == [("q", "a"), ("r", "c")]
    assert len(left(("z", "*", "*", "*"))) == 4


def test_thresholds():
    assert detections.Thresholds.of(beaconing_max_cv=0.5).beaconing_max_cv == 0.5
    for bad in ({"nope": 1}, {"beaconing_max_cv": "1"}, {"port_scan_min_distinct_ports": 1.5}, {"exfiltration_min_bytes_out": -1}, {"beaconing_max_cv": True}, {"beaconing_max_cv": float("nan")}):
        with pytest.raises(ValueError):
            detections.Thresholds.of(**bad)


def test_scd2_rename_and_gap(spark):
    rows = [flow(responder_name=n, flow_hour=DAY + timedelta(hours=h)) for h, n in ((0, "a"), (0, "a"), (0, "b"), (9, "a"), (10, "c"), (11, None), (12, "a"))]
    found = hosts.host_names_scd2(spark.createDataFrame(rows, FLOWS)).orderBy("version")
    assert [(r["hostname"], r["flows"], r["is_current"]) for r in found.collect()] == [("a", 3, False), ("c", 1, False), ("a", 1, True)]
    assert quality.check_scd2(found).isEmpty() and not quality.check_scd2(found.where("version <> 2")).isEmpty()


def test_responder_name_without_port(spark):
    from pyspark.sql import functions as F

    from netquarry.functions.network import parent_domain, responder_name

    df = spark.createDataFrame([([], ["www.example.com:8080"], ["d"]), ([], ["[2001:db8::1]:80"], []), (["t"], ["h"], []), ([], [], ["d"]), ([], [], [])], "t array<string>, h array<string>, d array<string>")
    assert [r[0] for r in df.select(responder_name(F.col("t"), F.col("h"), F.col("d"))).collect()] == ["www.example.com", "[2001:db8::1]", "t", "d", None]
    names = spark.createDataFrame([("a.b.tunnel.example",), ("one",), ("a.b.",)], "n string")
    assert [r[0] for r in names.select(parent_domain(F.col("n"))).collect()] == ["tunnel.example", "one", "b."]


def test_validation_of_reference_tables(spark):
    table = spark.createDataFrame([("z", "10.0.0.0/8", True), ("", "10.0.0.1/8", None), ("x", "fd00::/8", True), ("y", "300.0.0.0/8", True), ("w", "10.0.0.0/33", True), ("v", None, True)], "zone string, cidr string, is_internal boolean")
    assert sorted((r["zone"], r["problem"][:6]) for r in quality.validate_zones(table).collect()) == [("", "cidr h"), ("", "is_int"), ("", "zone i"), ("v", "cidr i"), ("w", "cidr i"), ("x", "cidr i"), ("y", "cidr i")]
    entries = reference_table(spark, "detection_allowlist", (("beaconing", "*", "10.1.1.1", "80", ""), ("nope", "x", "fd00::1", "70000", "")))
    assert sorted(r["problem"] for r in quality.validate_allowlist(entries, reference_table(spark, "detection_rules")).collect()) == ["dst_port is no port", "rule_id is unknown", "src_ip is no address"]


def test_scores_without_incidents_or_alerts(spark):
    alerts = spark.createDataFrame([], "alert_id string, rule_id string, src_ip string, window_start timestamp, window_end timestamp")
    incidents = spark.createDataFrame([("i1", "beaconing", "a", DAY, DAY)], "incident_id string, rule_id string, src_ip string, start timestamp, end timestamp")
    found = {r["rule_id"]: (r["precision"], r["recall"]) for r in serving.rule_scores(alerts, incidents).collect()}
    assert found == {"beaconing": (1.0, 0.0), "all": (1.0, 0.0)}


def test_incremental_is_a_full_refresh(spark, tmp_path):
    bronze = adapter.bronze(spark, SF).cache()
    ref = reference_table(spark, "network_zones", SITE_ZONES), reference_table(spark, "service_ports")
    cuts = [datetime(2024, 1, 10), datetime(2024, 1, 20), datetime(2030, 1, 1)]
    runs = [datetime(2024, 3, 1 + i) for i in range(4)]
    for cut, run in zip(cuts, runs, strict=False):
        incremental.build(spark, bronze.where(f"ingested_at < '{cut}'"), f"{tmp_path}/inc", *ref, run)
    incremental.build(spark, bronze, f"{tmp_path}/full", *ref, runs[3], full_refresh=True)
    read = lambda top, name, *drop: Versioned(spark, f"{tmp_path}/{top}/{name}").read().drop(*drop)
    a, b = read("inc", "fct_flows", "loaded_at", "flow_warnings"), read("full", "fct_flows", "loaded_at", "flow_warnings")
    assert serving.snapshot_difference(a, b).isEmpty() and a.count() == 1000
    assert serving.snapshot_difference(read("inc", "agg_traffic_hourly", "max_loaded_at"), read("full", "agg_traffic_hourly", "max_loaded_at")).isEmpty()
    assert read("inc", "fct_flows").select("loaded_at").distinct().count() == 3  # rows out of the lookback keep theirs
    incremental.build(spark, bronze.unionByName(bronze), f"{tmp_path}/inc", *ref, runs[3])  # a replay
    assert serving.snapshot_difference(read("inc", "fct_flows", "loaded_at", "flow_warnings"), b).isEmpty()


def test_empty_lake_then_data(spark, tmp_path):
    bronze = adapter.bronze(spark, SF)
    ref = reference_table(spark, "network_zones"), reference_table(spark, "service_ports")
    incremental.build(spark, bronze.limit(0), f"{tmp_path}/g", *ref, DAY)
    incremental.build(spark, bronze, f"{tmp_path}/g", *ref, DAY)
    assert Versioned(spark, f"{tmp_path}/g/fct_flows").read().count() == 1000
    assert Versioned(spark, f"{tmp_path}/g/agg_traffic_hourly").read().count() > 0


def test_plan_of_the_zone_lookup_has_no_nested_loop(spark):
    found = zones.zone_lookup(facts.addresses(adapter.bronze(spark, SF)), reference_table(spark, "network_zones", SITE_ZONES))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ["agg_traffic_hourly", "det_exfiltration", "fct_alerts", "scd2", "dq_batches", "kpis", "check_scd2"])
def test_queries_equal_their_oracles(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda row: tuple(str(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in row)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    assert sorted(map(key, got.collect())) == sorted(map(key, con.sql(f"SELECT {columns} FROM want").fetchall()))


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_queries_follow_a_replaced_table(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    flows = lambda: registry.queries()["kpis"](spark, str(tmp_path)).first()["flows"]
    events.limit(40).write.parquet(f"{tmp_path}/events.parquet")
    assert flows() == 40
    events.limit(90).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert flows() == 90


def test_windows_that_overlap_meet_once(spark):
    hour = lambda k: datetime(2024, 1, 1) + timedelta(hours=k)
    rng = random.Random(1)
    spans = lambda n: [(str(k), rng.choice("rs"), rng.choice("ab"), hour(a := rng.randrange(200)), hour(a + rng.choice([0, 1, 24, 60]))) for k in range(n)]
    a, i = spans(60), spans(60)
    alerts = spark.createDataFrame(a, "alert_id string, rule_id string, src_ip string, window_start timestamp, window_end timestamp")
    incidents = spark.createDataFrame([*i, ("back", "r", "a", hour(50), hour(49))], "incident_id string, rule_id string, src_ip string, start timestamp, end timestamp")
    want = sorted((x[0], y[0]) for x in a for y in [*i, ("back", "r", "a", hour(50), hour(49))] if x[1:3] == y[1:3] and x[3] <= y[4] and y[3] < x[4])
    found = serving.incident_overlap(alerts, incidents)
    assert sorted((r["alert_id"], r["incident_id"]) for r in found.collect()) == want and len(want) > 100
    assert "bin#" in found._jdf.queryExecution().optimizedPlan().toString().split("Join Inner", 1)[1].split("\n", 1)[0]


def test_thresholds_are_of_their_kind():
    for name, value, what in (("beaconing_min_connections", 50.0, "whole"), ("beaconing_min_connections", float("inf"), "whole"), ("dns_tunneling_min_avg_label_length", 6.5, "whole"), ("beaconing_max_cv", float("nan"), "negative"), ("beaconing_max_cv", True, "number")):
        with pytest.raises(ValueError, match=what):
            detections.Thresholds.of(**{name: value})
    assert detections.Thresholds.of(beaconing_max_cv=1).beaconing_max_cv == 1


def test_data_tests_are_one_pass_over_each_table(spark):
    frames = {
        "child": spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, None, 7), (None, "z", None), (None, "a", 1)], "k int, p string, v int"),
        "parent": spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "p string"),
    }
    suites = {
        "child": datatests.Suite((datatests.not_null("k"), datatests.accepted("p", "a b", "warn"), datatests.holds("v < 7")), datatests.unique("k"), (datatests.parent("p", "parent", "p"),), (("sums", "error", "v", "v"), ("sums", "error", "n", "1L"))),
        "parent": datatests.Suite((datatests.not_null("p"),), totals=(("sums", "error", "v", "-19"), ("sums", "error", "n", "-1L"))),
    }
    found = datatests.run(frames.__getitem__, suites)
    assert {(r["table"], r["test"]): (r["violations"], r["status"]) for r in found.collect()} == {
        ("child", "not_null(k)"): (2, "fail"), ("child", "accepted_values(p)"): (1, "warn"), ("child", "expression(v < 7)"): (1, "fail"), ("child", "unique(k)"): (1, "fail"), ("child", "relationships(p)"): (1, "fail"),
        ("parent", "not_null(p)"): (1, "fail"), ("child", "sums"): (2, "fail"),
    }
    assert sum(len(s.rows) + bool(s.key) + len(s.parents) + bool(s.scd2) for s in datatests.DECLARED.values()) + 1 == 49
    plan = datatests.measured(frames["child"], suites["child"], frames.__getitem__)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2  # the table and the parent's keys
