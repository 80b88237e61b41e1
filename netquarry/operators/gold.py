"""All gold models as stored tables, each built once and from the stored ones before it, and the checks over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.operators import datatests as tests
from netquarry.operators import detections, facts, hosts, incremental, ocsf, quality, zones
from netquarry.sources.versions import Versioned

Tables = Callable[[str], DataFrame]
#: Models that follow the fact by day, or by hour where a column tells it; the fact and the hourly table come before them.
DAILY: dict[str, tuple[Callable[[DataFrame, Tables, detections.Thresholds], DataFrame], str | None]] = {
    "det_port_scan": (lambda f, x, t: _dated(detections.det_port_scan(f, t), "window_start"), "window_start"),
    "det_beaconing": (lambda f, x, t: detections.det_beaconing(f, x("detection_allowlist"), t), None),
    "det_exfiltration": (lambda f, x, t: detections.det_exfiltration(f, t), None),
    "det_dns_tunneling": (lambda f, x, t: _dated(detections.det_dns_tunneling(f, t), "window_start"), "window_start"),
    "ocsf_network_activity": (lambda f, x, t: ocsf.network_activity(f).withColumn(incremental.DAY, F.to_date(F.timestamp_millis("start_time"))), None),
}
#: Models that are made whole from those before them.
WHOLE: dict[str, Callable[[Tables], DataFrame]] = {
    "stg_quarantine": lambda x: facts.stage_quarantine(x("quarantine")),
    "stg_network_zones": lambda x: zones.parse_zones(x("network_zones")),
    "dim_hosts": lambda x: hosts.dim_hosts(x("fct_flows")),
    "dim_host_names": lambda x: hosts.host_names_scd2(x("fct_flows")),
    "fct_alerts": lambda x: detections.fct_alerts(x("det_port_scan"), x("det_beaconing"), x("det_exfiltration"), x("det_dns_tunneling"), x("detection_rules"), x("mitre_techniques"), x("detection_allowlist")),
    "dq_batches": lambda x: quality.dq_batches(facts.stage_flows(x("flows")), x("quarantine")),
}
#: Models whose day is there for their partitions alone.
_UNDATED = ("agg_traffic_hourly", "det_port_scan", "det_dns_tunneling", "ocsf_network_activity")


def _dated(rows: DataFrame, time: str) -> DataFrame:
    return rows.withColumn(incremental.DAY, F.to_date(time))


def tables(spark: SparkSession, gold: str, inputs: Mapping[str, DataFrame]) -> Tables:
    """Any table by name: an input (bronze `flows`, `quarantine`, the reference tables), or the current version of a model below `gold`."""

    def found(name: str) -> DataFrame:
        if name in inputs:
            return inputs[name]
        rows = Versioned(spark, f"{gold}/{name}").read()
        return rows.drop(incremental.DAY) if name in _UNDATED else rows

    return found


def build(spark: SparkSession, inputs: Mapping[str, DataFrame], gold: str, run_started_at: datetime, thresholds: detections.Thresholds = detections.Thresholds(), full_refresh: bool = False) -> Tables:
    """Bring every model up to date; each is a version of its own, so a run that stops on the way is simply run again."""
    incremental.build(spark, inputs["flows"], gold, inputs["network_zones"], inputs["service_ports"], run_started_at, thresholds, full_refresh)
    found = tables(spark, gold, inputs)
    fact = Versioned(spark, f"{gold}/fct_flows")
    # the entries are few; a table of another content makes another sum
    allowed = inputs["detection_allowlist"].agg(F.count("*"), F.sum(F.xxhash64(*inputs["detection_allowlist"].columns).cast("decimal(38,0)"))).first()
    for name, (make, hour) in DAILY.items():
        incremental.update(fact, Versioned(spark, f"{gold}/{name}"), lambda f, make=make: make(f, found, thresholds), hour, f"{thresholds} {allowed[0]} {allowed[1]}")
    for name, whole in WHOLE.items():
        model = Versioned(spark, f"{gold}/{name}")
        model.write(whole(found), base=model.manifest())
    return found


_DIRECTIONS = "internal outbound inbound external"
_nn = lambda *names: [tests.not_null(c) for c in names]
#: The library's own checks of each table, beside the declared ones of datatests.
CHECKS: dict[str, tests.Suite] = {
    "fct_flows": tests.Suite(
        (
            *_nn("record_id", "first_seen", "initiator_ip", "responder_ip", "initiator_zone", "responder_zone", "service"), tests.accepted("direction", _DIRECTIONS), tests.holds("last_seen >= first_seen"),
            tests.holds("bytes_total >= 0 and packets_total > 0"), tests.holds("payload_bytes <= bytes_total", "warn"),
        ), tests.unique("record_id"), (tests.parent("initiator_ip", "dim_hosts", "ip"), tests.parent("responder_ip", "dim_hosts", "ip")), tuple(("reconciliation", "error", part, sql) for part, sql in (("flows", "1L"), ("packets", "packets_total"), ("bytes", "bytes_total"))),
    ),
    "agg_traffic_hourly": tests.Suite(
        (*_nn("hour_start", "direction", "flows"), tests.accepted("direction", _DIRECTIONS), tests.holds("flows > 0")), ("unique(hour_key)", "error", "concat_ws('|', hour_start, direction, protocol_name, service)"),
        totals=tuple(("reconciliation", "error", part, f"-{part}") for part in ("flows", "packets", "bytes")),
    ),
    "dim_hosts": tests.Suite((*_nn("ip", "zone", "is_internal"), tests.holds("first_seen <= last_seen"), tests.holds("flows = flows_initiated + flows_received")), tests.unique("ip")),
    "dim_host_names": tests.Suite((*_nn("ip", "hostname", "valid_from"), tests.holds("valid_to is null or valid_to > valid_from")), tests.unique("host_name_key"), (tests.parent("ip", "dim_hosts", "ip"),), scd2=("scd2", "error")),
    "det_port_scan": tests.Suite((*_nn("src_ip", "dst_ip", "window_start"), tests.holds("failed_ratio between 0 and 1"))),
    "det_beaconing": tests.Suite((*_nn("src_ip", "dst_ip", "event_date"), tests.holds("interval_cv >= 0"))),
    "det_exfiltration": tests.Suite((*_nn("src_ip", "dst_ip", "event_date"), tests.holds("upload_ratio between 0 and 1"))),
    "det_dns_tunneling": tests.Suite((*_nn("src_ip", "parent_domain", "window_start"), tests.holds("distinct_names <= queries"))),
    "fct_alerts": tests.Suite(
        (*_nn("alert_id", "rule_id", "severity", "src_ip", "window_start"), tests.accepted("severity", "critical high medium low"), tests.holds("window_end > window_start")), parents=(tests.parent("rule_id", "detection_rules", "rule_id"),),
    ),
    "dq_batches": tests.Suite((*_nn("batch_id", "records_accepted"), tests.holds("quarantine_rate between 0 and 1"), tests.holds("quarantine_rate <= 0.05", "warn")), tests.unique("batch_id")),
    "ocsf_network_activity": tests.Suite((("accepted_values(class_uid)", "error", "class_uid <> 4001"),), ("unique(uid)", "error", "metadata.uid")),
}


def run_checks(x: Tables) -> DataFrame:
    """(table, check, severity, violations) of the checks that fail, in one job with one pass over each table; a gold build is good if none is an error."""
    return tests.run(x, CHECKS).where("violations > 0").select("table", F.col("test").alias("check"), "severity", "violations")
