"""All queries of the flow library and their oracles, by name.

Every query reads the `events` table through the adapter; gold models are built from it once a session and then read. Results are flat: times and lists as text, doubles rounded to
six digits, so that both engines' rows compare.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netquarry.functions import network as N
from netquarry.operators import contract, datatests, detections, facts, hosts, ocsf, quality, serving, zones
from netquarry.plans import adapter, contract_cases, landing_cases, oracles, stored
from netquarry.sources.lake import exists, work_dir
from netquarry.sources.reference import SITE_ZONES, reference_table
from netquarry.streaming import detections as streamed

LOADED_AT = datetime(2024, 3, 1)
T = detections.Thresholds.of(
    port_scan_min_distinct_ports=3, port_scan_min_failed_ratio=0.6, beaconing_min_connections=8, beaconing_max_cv=0.8, beaconing_max_interval_seconds=86_400,
    exfiltration_min_bytes_out=300_000, exfiltration_min_upload_ratio=0.7, dns_tunneling_min_distinct_names=2, dns_tunneling_min_avg_label_length=6,
)


#: Where the models of a session's runs are stored, by session, input files and model.
_BUILT: dict[tuple[str, str, str], str] = {}


def _files(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of change of the files at `path`: another content is another text."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True), []
    while found.hasNext():
        f = found.next()
        files.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(files))


class Lake:
    """The tables of one run, each built from the ones before it; the gold models are stored, so each is built once a session."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.inputs = _files(spark, f"{sf_dir}/events.parquet")

    def built(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.inputs, name)
        if key not in _BUILT or not exists(self.spark, f"{_BUILT[key]}/_SUCCESS"):
            path = work_dir(self.spark, name)
            make().write.option("compression", "zstd").parquet(path)
            _BUILT[key] = path
        return self.spark.read.parquet(_BUILT[key])

    def ref(self, name: str) -> DataFrame:
        return reference_table(self.spark, name, SITE_ZONES if name == "network_zones" else None)

    @property
    def bronze(self) -> DataFrame:
        return adapter.bronze(self.spark, self.sf_dir)

    @property
    def quarantine(self) -> DataFrame:
        return adapter.quarantine(self.spark, self.sf_dir)

    @property
    def staged(self) -> DataFrame:
        return facts.stage_flows(self.bronze)

    @property
    def facts(self) -> DataFrame:
        return self.built("fct_flows", lambda: facts.fct_flows(self.staged, self.ref("network_zones"), self.ref("service_ports"), LOADED_AT))

    @property
    def hourly(self) -> DataFrame:
        return self.built("agg_traffic_hourly", lambda: facts.agg_traffic_hourly(self.facts))

    @property
    def hosts(self) -> DataFrame:
        return self.built("dim_hosts", lambda: hosts.dim_hosts(self.facts))

    @property
    def versions(self) -> DataFrame:
        return self.built("dim_host_names", lambda: hosts.host_names_scd2(self.facts))

    @property
    def batches(self) -> DataFrame:
        return quality.dq_batches(self.staged, self.quarantine)

    @property
    def scans(self) -> DataFrame:
        return self.built("det_port_scan", lambda: detections.det_port_scan(self.facts, T))

    @property
    def beacons(self) -> DataFrame:
        return self.built("det_beaconing", lambda: detections.det_beaconing(self.facts, self.ref("detection_allowlist"), T))

    @property
    def uploads(self) -> DataFrame:
        return self.built("det_exfiltration", lambda: detections.det_exfiltration(self.facts, T))

    @property
    def tunnels(self) -> DataFrame:
        return self.built("det_dns_tunneling", lambda: detections.det_dns_tunneling(self.facts, T))

    @property
    def alerts(self) -> DataFrame:
        rules = self.ref("detection_rules"), self.ref("mitre_techniques"), self.ref("detection_allowlist")
        return self.built("fct_alerts", lambda: detections.fct_alerts(self.scans, self.beacons, self.uploads, self.tunnels, *rules))

    def table(self, name: str) -> DataFrame:
        """Any table of the data tests by its name."""
        own = {
            "flows": lambda: self.bronze, "stg_flows": lambda: self.staged, "quarantine": lambda: self.quarantine, "stg_quarantine": lambda: facts.stage_quarantine(self.quarantine), "stg_network_zones": lambda: zones.parse_zones(self.ref("network_zones")),
            "fct_flows": lambda: self.facts, "agg_traffic_hourly": lambda: self.hourly, "dim_hosts": lambda: self.hosts, "dim_host_names": lambda: self.versions, "fct_alerts": lambda: self.alerts, "dq_batches": lambda: self.batches,
            "ocsf_network_activity": lambda: ocsf.network_activity(self.facts),
        }
        return own[name]() if name in own else self.ref(name)

    @property
    def incidents(self) -> DataFrame:
        """Labelled incidents: the events of a value above 100, each with a window of an hour."""
        events = self.spark.read.parquet(f"{self.sf_dir}/events.parquet")
        return events.where("value > 100").select(*[F.expr(e).alias(c) for c, e in oracles.INCIDENTS])


def flat(df: DataFrame) -> DataFrame:
    """Times, dates, lists and maps as text, doubles rounded, whole numbers as BIGINT."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("timestamp", "date", "timestamp_ntz"):
            c = c.cast("string")
        elif kind.startswith("array<struct") or kind.startswith("map"):
            c = F.to_json(c)
        elif kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), ",")
        elif kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), 6)
        elif kind in ("tinyint", "smallint", "int"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


def _cols(df: DataFrame, names: str) -> DataFrame:
    return df.select(*names.split())


Q: dict[str, Callable[[Lake], DataFrame]] = {
    # projections
    "stg_flows": lambda x: _cols(x.staged, oracles.STAGED),
    "protocol_name": lambda x: x.staged.groupBy("protocol", "protocol_name").agg(F.count("*").alias("flows")),
    "flow_hour": lambda x: x.staged.groupBy("flow_hour").agg(F.count("*").alias("flows")),
    "event_date": lambda x: x.staged.groupBy("event_date").agg(F.count("*").alias("flows")),
    "app_protocol": lambda x: x.staged.groupBy("app_protocol").agg(F.count("*").alias("flows")),
    "responder_name": lambda x: x.staged.groupBy("responder_name").agg(F.count("*").alias("flows")),
    "has_warnings": lambda x: x.staged.groupBy("has_warnings").agg(F.count("*").alias("flows")),
    "stg_quarantine": lambda x: facts.stage_quarantine(x.quarantine).drop("raw_record"),
    "stg_network_zones": lambda x: _zones_in_use(x),
    "ipv4_to_int": lambda x: facts.addresses(x.bronze).select("ip", N.ipv4_to_int(F.col("ip")).alias("n")),
    "is_private_ipv6": lambda x: facts.addresses(x.bronze).select("ip", N.is_private_ipv6(F.col("ip")).alias("private")),
    "parent_domain": lambda x: x.bronze.select(F.explode("dns_queries").alias("name")).select(N.parent_domain(F.lower("name")).alias("domain")).groupBy("domain").agg(F.count("*").alias("n")),
    "direction": lambda x: x.facts.groupBy("direction", "initiator_is_internal", "responder_is_internal").agg(F.count("*").alias("flows")),
    "service": lambda x: x.facts.groupBy("service", "protocol").agg(F.count("*").alias("flows")),
    "payload_bytes": lambda x: x.facts.select("record_id", "payload_bytes"),
    "ocsf_network_activity": lambda x: ocsf.flattened(ocsf.network_activity(x.facts)),
    "alert_evidence": lambda x: x.alerts.withColumn("e", F.from_json("evidence", detections.EVIDENCE)).select("alert_id", "dst_port", "e.*"),
    # detections over a stream
    "stream_port_scan": lambda x: _streamed(x, lambda f: streamed.port_scans(f, T)),
    "stream_beaconing": lambda x: _streamed(x, lambda f: streamed.beacons(f, x.ref("detection_allowlist"), T)),
    "stream_exfiltration": lambda x: _streamed(x, lambda f: streamed.uploads(f, T)),
    "stream_dns_tunneling": lambda x: _streamed(x, lambda f: streamed.tunnels(f, T)),
    # joins
    "zone_lookup": lambda x: zones.zone_lookup(facts.addresses(x.bronze), x.ref("network_zones")),
    "zone_attach": lambda x: facts.attach_zones(facts.dedupe_latest(x.staged).select("record_id", "initiator_ip", "responder_ip"), zones.zone_lookup(facts.addresses(x.bronze), x.ref("network_zones"))).select("record_id", "initiator_zone", "responder_zone"),
    "service_attach": lambda x: facts.attach_services(facts.dedupe_latest(x.staged), x.ref("service_ports")).select("record_id", "service"),
    "alert_rules": lambda x: x.alerts.groupBy("rule_id", "rule_name", "severity", "mitre_technique_id", "mitre_technique_name", "mitre_tactic").agg(F.count("*").alias("alerts")),
    "allowlist_anti": lambda x: detections.allowed(x.uploads.select(F.lit("exfiltration").alias("rule_id"), "src_ip", "dst_ip", F.lit(None).cast("int").alias("dst_port"), "event_date"), oracles.allowlist(x.spark)).select("src_ip", "dst_ip", "event_date"),
    "dq_full_outer": lambda x: _cols(x.batches, "batch_id records_accepted records_quarantined"),
    "changed_hours_semi": lambda x: x.facts.join(_changed(x), "flow_hour", "left_semi").groupBy("flow_hour").agg(F.count("*").alias("flows")),
    "incident_overlap": lambda x: serving.incident_overlap(x.alerts, x.incidents).select("alert_id", "incident_id", "rule_id"),
    "renamed_hosts_semi": lambda x: x.versions.join(x.versions.groupBy("ip").count().where("count > 1").select("ip"), "ip", "left_semi").select("ip", "hostname", "version"),
    "relationships": lambda x: quality.check_relationships(x.facts.select("record_id", "service"), "service", x.ref("service_ports"), "service").select("record_id", "service"),
    "reconcile_cross": lambda x: x.facts.agg(F.count("*").alias("fact_flows")).join(x.hourly.agg(F.sum("flows").alias("hourly_flows")), F.lit(True)),
    "dns_unnest": lambda x: detections.dns_queries(x.facts).groupBy("src_ip", "query").agg(F.count("*").alias("n")),
    # aggregations
    "agg_traffic_hourly": lambda x: x.hourly,
    "dim_hosts": lambda x: x.hosts,
    "det_port_scan": lambda x: x.scans,
    "det_beaconing": lambda x: x.beacons,
    "det_exfiltration": lambda x: x.uploads,
    "det_dns_tunneling": lambda x: x.tunnels,
    "dq_accepted": lambda x: quality.dq_accepted(x.staged),
    "dq_rejected": lambda x: quality.dq_rejected(x.quarantine).drop("quarantine_reasons"),
    "dq_batches": lambda x: x.batches.drop("quarantine_reasons"),
    "quarantine_reasons": lambda x: quality.dq_rejected(x.quarantine).select("batch_id", F.explode("quarantine_reasons").alias("reason", "n")),
    "scd2_named": lambda x: hosts.named_hours(x.facts),
    "scd2_versions": lambda x: hosts.name_versions(hosts.islands(hosts.name_changes(hosts.dominant_names(hosts.named_hours(x.facts))))),
    "rule_scores": lambda x: serving.rule_scores(x.alerts, x.incidents),
    "missed_incidents": lambda x: serving.missed_incidents(x.alerts, x.incidents).select("incident_id"),
    "false_alerts": lambda x: serving.false_alerts(x.alerts, x.incidents).select("alert_id"),
    "quarantine_by_type": lambda x: serving.quarantine_by_type(x.quarantine),
    "kpis": lambda x: serving.kpis(x.facts),
    "host_counts": lambda x: serving.host_counts(x.hosts),
    "hourly_by_direction": lambda x: serving.hourly_by_direction(x.hourly),
    "batch_totals": lambda x: serving.batch_totals(x.batches),
    "alerts_by_severity": lambda x: serving.alerts_by_severity(x.alerts),
    "lake_quarantine_rate": lambda x: serving.lake_quarantine_rate(x.bronze, x.quarantine),
    "upload_peak_median": lambda x: serving.upload_peak_median(x.hourly),
    "source_freshness": lambda x: serving.source_freshness(x.bronze, LOADED_AT),
    # windows
    "dedupe_latest": lambda x: facts.dedupe_latest(x.staged).select("record_id", "ingested_at", "batch_id"),
    "longest_prefix": lambda x: zones.zone_lookup(facts.addresses(x.bronze), x.ref("network_zones")).groupBy("zone", "is_internal").agg(F.count("*").alias("addresses")),
    "dominant_name": lambda x: hosts.dominant_names(hosts.named_hours(x.facts)),
    "name_change_flag": lambda x: hosts.name_changes(hosts.dominant_names(hosts.named_hours(x.facts))),
    "islands": lambda x: hosts.islands(hosts.name_changes(hosts.dominant_names(hosts.named_hours(x.facts)))),
    "scd2": lambda x: x.versions,
    "scd2_validity": lambda x: x.versions.select("ip", "version", "valid_from", "valid_to", "is_current"),
    "connection_gaps": lambda x: detections.connection_gaps(x.facts),
    "contiguity_check": lambda x: quality.check_scd2(x.versions.withColumn("valid_to", F.when(F.col("version") != 1, F.col("valid_to")))).select("ip", "problem"),
    # sort, limit, top-k
    "top_talkers": lambda x: _placed(serving.top_talkers(x.hosts)),
    "alerts_ranked": lambda x: _placed(serving.alerts_ranked(x.alerts)).select("place", "severity", "window_start"),
    "renames": lambda x: _placed(serving.renamed_hosts(x.versions)),
    "quarantine_ranked": lambda x: _placed(serving.quarantine_by_type(x.quarantine)),
    "sample_ports": lambda x: x.scans.select("src_ip", "dst_ip", "window_start", "sample_ports"),
    "alerts_by_time": lambda x: _placed(serving.alerts_by_time(x.alerts)).select("place", "window_start", "rule_id"),
    # set operations
    "addresses": lambda x: facts.addresses(x.bronze),
    "endpoints": lambda x: hosts.endpoints(x.facts).groupBy("ip", "initiated").agg(F.count("*").alias("n"), F.sum("bytes_sent").alias("bytes_sent")),
    "fct_flows": lambda x: _cols(x.facts, oracles.FACT),
    "fct_alerts": lambda x: x.alerts.drop("evidence"),
    "scd2_problems": lambda x: quality.check_scd2(x.versions.withColumn("is_current", F.lit(True))).select("ip", "problem"),
    "distinct_hours": lambda x: x.facts.select("flow_hour").distinct(),
    "snapshot_difference": lambda x: serving.snapshot_difference(x.facts.select("record_id", "direction"), x.facts.where("direction <> 'inbound'").select("record_id", "direction")),
    "snapshot_equal": lambda x: stored.snapshots(x.spark, x.sf_dir),
    "quarantine_difference": lambda x: serving.quarantine_difference(x.quarantine, x.quarantine.where("record_index % 2 = 0").groupBy("error_type").agg(F.count("*").alias("records"))),
    "dense_hour_axis": lambda x: serving.dense_hour_axis(x.hourly),
    "hourly_windows": lambda x: x.facts.groupBy(F.window("first_seen", "1 hour").alias("w")).agg(F.count("*").alias("flows")).select("w.start", "w.end", "flows"),
    "daily_windows": lambda x: x.facts.groupBy(F.window("first_seen", "1 day").alias("w")).agg(F.count("*").alias("flows")).select("w.start", "w.end", "flows"),
    # checks
    "check_not_null": lambda x: quality.check_not_null(x.facts.select("record_id", "responder_name"), "responder_name", "warn"),
    "check_unique": lambda x: quality.check_unique(x.bronze, "record_id"),
    "check_accepted_values": lambda x: quality.check_accepted_values(x.facts.select("record_id", "direction"), "direction", ["internal", "outbound", "inbound"]),
    "check_relationships": lambda x: quality.check_relationships(x.facts.select("record_id", "service"), "service", x.ref("service_ports"), "service"),
    "check_expression": lambda x: quality.check_expression(x.facts.select("record_id", "bytes_total", "packets_total"), "bytes_total > 1000 * packets_total", "warn"),
    "check_reconciliation": lambda x: quality.check_reconciliation(x.facts, x.hourly.where("direction <> 'inbound'")),
    "check_scd2": lambda x: quality.check_scd2(x.versions.where("version <> 2")),
    "data_tests": lambda x: datatests.run(x.table),
    "validate_zones": lambda x: quality.validate_zones(_event_zones(x)).select("zone", "cidr", "problem"),
    "validate_allowlist": lambda x: quality.validate_allowlist(_event_allowlist(x), x.ref("detection_rules")).select("rule_id", "src_ip", "dst_ip", "dst_port", "problem"),
    # contract
    "contract": lambda x: contract_cases.told(x.spark, x.sf_dir),
    "contract_first_error": lambda x: contract_cases.told(x.spark, x.sf_dir).groupBy("error_type").agg(F.count("*").alias("records")),
    "contract_messages": lambda x: contract.with_messages(contract.checked(contract_cases.raw(x.spark, x.sf_dir)).where("error_type is not null")).select("record_index", "error_message"),
    "contract_bronze": lambda x: contract_cases.valid(x.spark, x.sf_dir).drop("ingest_date"),
    "envelope_check": lambda x: contract_cases.envelopes(x.spark, x.sf_dir),
}


def _streamed(x: Lake, detect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a detection gives over all flows of the fact as a stream. A last flow, years later and of no address, ends all windows."""
    top = work_dir(x.spark, "stream")
    facts = x.facts.select("initiator_ip", "responder_ip", "responder_port", "responder_name", "first_seen", "last_seen", "flow_hour", "direction", "protocol", "service", "app_protocol", "dns_queries", "tcp_state", "i2r_bytes", "r2i_bytes", "bytes_total")
    facts.write.parquet(f"{top}/flows")
    latest = facts.agg(F.max("first_seen").alias("first_seen")).select((F.col("first_seen") + F.expr("interval 3650 days")).alias("first_seen"))
    # as the filters of each detection come before its watermark, it has to pass them all
    given = {"first_seen": F.col("first_seen"), "direction": F.lit("outbound"), "service": F.lit("dns"), "dns_queries": F.array(F.lit("end"))}
    for protocol in (6, 17):
        end = latest.select(*[(F.lit(protocol) if c == "protocol" else given.get(c, F.lit(None))).cast(k).alias(c) for c, k in facts.dtypes])
        end.write.mode("append").parquet(f"{top}/flows")
    source = x.spark.readStream.schema(facts.schema).parquet(f"{top}/flows")
    writer = detect(source).writeStream.option("checkpointLocation", f"{top}/checkpoint").format("parquet").option("path", f"{top}/found")
    writer.trigger(availableNow=True).start().awaitTermination()
    return x.spark.read.parquet(f"{top}/found")


def _placed(ranked: DataFrame) -> DataFrame:
    """place: the row's number in the order of a ranked result.

    The sorted rows are a table first, each with its partition and its number there; the partitions' sizes tell the rest, so
    that no task sees all rows.
    """
    spark = ranked.sparkSession
    path = work_dir(spark, "ranked")
    ranked.withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumns({"__part": F.shiftright("__at", 33), "__in": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))})
    # a row for each partition
    sizes = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return rows.join(before, "__part").select((F.col("__before") + F.col("__in") + 1).alias("place"), *ranked.columns)


def _event_allowlist(x: Lake) -> DataFrame:
    """An allowlist of one row for each user of the events, some of them wrong."""
    users = x.spark.read.parquet(f"{x.sf_dir}/events.parquet").select("user_id").distinct()
    return users.select(*[F.expr(e).alias(c) for c, e in oracles.EVENT_ALLOWLIST])


def _zones_in_use(x: Lake) -> DataFrame:
    """Parsed zones with the number of distinct addresses in each range."""
    found = zones.parse_zones(x.ref("network_zones"))
    n = facts.addresses(x.bronze).select(N.ipv4_to_int(F.col("ip")).alias("n"))
    return found.join(n, F.col("n").between(F.col("range_start"), F.col("range_end"))).groupBy("zone", "cidr", "is_internal", "prefix_length", "range_start", "range_end").agg(F.count("*").alias("addresses"))


def _changed(x: Lake) -> DataFrame:
    return x.bronze.where("batch_id like 'r-%'").select(F.date_trunc("hour", "first_seen").alias("flow_hour")).distinct()


def _event_zones(x: Lake) -> DataFrame:
    """A zone table of one row for each user of the events, some of them wrong."""
    users = x.spark.read.parquet(f"{x.sf_dir}/events.parquet").select("user_id").distinct()
    return users.select(*[F.expr(e).alias(c) for c, e in oracles.EVENT_ZONES])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    derived = {name: (lambda spark, sf_dir, f=f: flat(f(Lake(spark, sf_dir)))) for name, f in Q.items()}
    return derived | {name: (lambda spark, sf_dir, f=f: flat(f(spark, sf_dir))) for name, f in (stored.QUERIES | landing_cases.QUERIES).items()}


def oracle_sql() -> dict[str, str]:
    found = oracles.sql() | landing_cases.oracle_sql()
    same = {f"stream_{x}": found[f"det_{x}"] for x in ("port_scan", "beaconing", "exfiltration", "dns_tunneling")}
    return found | same
