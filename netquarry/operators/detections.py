"""Threat detections over the flow fact and their union as alerts."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netquarry.functions.network import parent_domain, utc_text
from netquarry.operators.hosts import with_mode


@dataclass(frozen=True)
class Thresholds:
    """Detection thresholds and the incremental lookback; of() checks overrides."""

    port_scan_min_distinct_ports: int = 50
    port_scan_min_failed_ratio: float = 0.8
    beaconing_min_connections: int = 20
    beaconing_max_cv: float = 0.2
    beaconing_min_interval_seconds: int = 10
    beaconing_max_interval_seconds: int = 3600
    exfiltration_min_bytes_out: int = 500_000_000
    exfiltration_min_upload_ratio: float = 0.8
    dns_tunneling_min_distinct_names: int = 50
    dns_tunneling_min_avg_label_length: int = 20
    incremental_lookback_minutes: int = 30

    @classmethod
    def of(cls, **overrides: object) -> Thresholds:
        known = {f.name: f for f in fields(cls)}
        for name, value in overrides.items():
            if name not in known:
                raise ValueError(f"unknown threshold {name!r}; known: {', '.join(known)}")
            if isinstance(value, bool) or not isinstance(value, (int, float)):
                raise ValueError(f"{name} must be a number, not {value!r}")
            if isinstance(known[name].default, int) and not isinstance(value, int):
                raise ValueError(f"{name} must be a whole number, not {value!r}")
            if not value >= 0:
                raise ValueError(f"{name} must not be negative: {value!r}")
        return cls(**overrides)


def det_port_scan(facts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Many ports tried on one host within an hour, most in vain. A null tcp_state is no failure."""
    failed = F.avg(F.when(F.col("tcp_state").isin("reset", "syn_sent"), 1.0).otherwise(0.0))
    ports = F.array_sort(F.collect_set("responder_port"))
    grouped = facts.where("protocol = 6").groupBy(F.col("initiator_ip").alias("src_ip"), F.col("responder_ip").alias("dst_ip"), F.col("flow_hour").alias("window_start")).agg(
        F.count("*").alias("flows"), ports.alias("ports"), failed.alias("failed_ratio"), F.sum("bytes_total").alias("bytes"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )
    # at most 65,536 ports in a set
    kept = grouped.where((F.size("ports") >= t.port_scan_min_distinct_ports) & (F.col("failed_ratio") >= t.port_scan_min_failed_ratio))
    return kept.select(
        "src_ip", "dst_ip", "window_start", (F.col("window_start") + F.expr("interval 1 hour")).alias("window_end"), "flows", F.size("ports").cast("bigint").alias("distinct_ports"),
        "failed_ratio", "bytes", "first_seen", "last_seen", F.slice("ports", 1, 10).alias("sample_ports"),
    )


def connection_gaps(facts: DataFrame) -> DataFrame:
    """Outbound TCP and UDP flows with gap_seconds to the one before in the same (source, destination, port, day); the first has none.

    A busy connection's day is cut into hours: within an hour by a window, over to the next by each hour's last flow.
    """
    outbound = facts.where("direction = 'outbound' and protocol in (6, 17)").select("initiator_ip", "responder_ip", "responder_port", "event_date", F.date_trunc("hour", "first_seen").alias("__hour"), "first_seen", "responder_name")
    keys = ["initiator_ip", "responder_ip", "responder_port", "event_date"]
    seconds = F.col("first_seen").cast("double")
    hours = outbound.groupBy(*keys, "__hour").agg(F.max(seconds).alias("__last"))
    carried = hours.select(*[F.col(c).alias(f"__{c}") for c in keys], F.col("__hour").alias("__h"), F.lag("__last").over(Window.partitionBy(*keys).orderBy("__hour")).alias("__before")).where("__before is not null")
    within = outbound.withColumn("__previous", F.lag(seconds).over(Window.partitionBy(*keys, "__hour").orderBy("first_seen")))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys] + [F.col("__hour") == F.col("__h")]
    gap = seconds - F.coalesce("__previous", "__before")
    return within.join(carried, same, "left").select(*keys, "first_seen", "responder_name", gap.alias("gap_seconds"))


def allowed(rows: DataFrame, allowlist: DataFrame) -> DataFrame:
    """rows (rule_id, src_ip, dst_ip, dst_port) without those on the allowlist; `*` matches anything, null only `*`.

    Entries that name a source join on it; the rest, which name none, are matched by rule. Both joins have keys.
    """
    same = lambda name, value: (F.col(f"w_{name}") == "*") | (F.col(f"w_{name}") == value)
    entries = allowlist.select(F.col("rule_id").alias("w_rule"), F.col("src_ip").alias("w_src_ip"), F.col("dst_ip").alias("w_dst_ip"), F.col("dst_port").alias("w_dst_port")).distinct()
    rest = (F.col("w_rule") == F.col("rule_id")) & same("dst_ip", F.col("dst_ip")) & same("dst_port", F.col("dst_port").cast("string"))
    kept = rows.join(entries.where("w_src_ip <> '*'"), rest & (F.col("w_src_ip") == F.col("src_ip")), "left_anti")
    return kept.join(entries.where("w_src_ip = '*'"), rest, "left_anti")


def det_beaconing(facts: DataFrame, allowlist: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Connections to one outside endpoint at regular intervals through a day."""
    keys = [F.col("initiator_ip").alias("src_ip"), F.col("responder_ip").alias("dst_ip"), F.col("responder_port").alias("dst_port"), F.col("event_date")]
    gaps = connection_gaps(facts)
    pairs = gaps.groupBy(*keys).agg(
        F.count("*").alias("connections"), F.avg("gap_seconds").alias("mean_interval_seconds"), F.stddev_samp("gap_seconds").alias("stddev_interval_seconds"),
        F.min("first_seen").alias("first_seen"), F.max("first_seen").alias("last_seen"),
    )
    cv = F.try_divide("stddev_interval_seconds", "mean_interval_seconds")
    mean = F.col("mean_interval_seconds").between(t.beaconing_min_interval_seconds, t.beaconing_max_interval_seconds)
    regular = pairs.withColumn("interval_cv", cv).where((F.col("connections") >= t.beaconing_min_connections) & mean & (F.col("interval_cv") <= t.beaconing_max_cv))
    found = allowed(regular.withColumn("rule_id", F.lit("beaconing")), allowlist).drop("rule_id")
    names = facts.where("direction = 'outbound' and protocol in (6, 17)").select(*keys, "responder_name")
    return with_mode(found, names, "responder_name", "dst_name").select(
        "src_ip", "dst_ip", "dst_port", "event_date", "connections", "mean_interval_seconds", "stddev_interval_seconds", "first_seen", "last_seen", "dst_name", "interval_cv"
    )


def det_exfiltration(facts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """A large and mostly one-way upload from an inside host to one outside host in a day."""
    sums = facts.where("direction = 'outbound'").groupBy(F.col("initiator_ip").alias("src_ip"), F.col("responder_ip").alias("dst_ip"), "event_date").agg(
        F.count("*").alias("flows"), F.sum("i2r_bytes").alias("bytes_out"), F.sum("r2i_bytes").alias("bytes_in"), F.sum("bytes_total").alias("__all"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )
    rated = sums.withColumn("upload_ratio", F.try_divide("bytes_out", "__all"))
    found = rated.where((F.col("bytes_out") >= t.exfiltration_min_bytes_out) & (F.col("upload_ratio") >= t.exfiltration_min_upload_ratio))
    names = facts.where("direction = 'outbound'").select(F.col("initiator_ip").alias("src_ip"), F.col("responder_ip").alias("dst_ip"), "event_date", "responder_name")
    return with_mode(found, names, "responder_name", "dst_name").select(
        "src_ip", "dst_ip", "event_date", "flows", "bytes_out", "bytes_in", "upload_ratio", "first_seen", "last_seen", "dst_name"
    )


def dns_queries(facts: DataFrame) -> DataFrame:
    """One row for each DNS question: src_ip, flow_hour, first_seen, query, parent_domain, first_label."""
    asked = facts.where("app_protocol = 'dns' or service = 'dns'").select(F.col("initiator_ip").alias("src_ip"), "flow_hour", "first_seen", F.explode("dns_queries").alias("q"))
    query = F.lower("q")
    return asked.select("src_ip", "flow_hour", "first_seen", query.alias("query"), parent_domain(query).alias("parent_domain"), F.substring_index(query, ".", 1).alias("first_label"))


def det_dns_tunneling(facts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Many distinct long names under one domain within an hour. Summed by name first, so the distinct count is a plain count."""
    by_name = dns_queries(facts).groupBy("src_ip", "parent_domain", "flow_hour", "query").agg(
        F.count("*").alias("n"), F.first(F.length("first_label")).alias("label"), F.min("first_seen").alias("first_seen"), F.max("first_seen").alias("last_seen")
    )
    sums = by_name.groupBy("src_ip", "parent_domain", F.col("flow_hour").alias("window_start")).agg(
        F.sum("n").alias("queries"), F.count("*").alias("distinct_names"), (F.sum(F.col("n") * F.col("label")) / F.sum("n")).alias("avg_label_length"),
        F.max(F.length("query")).alias("max_name_length"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.min("query").alias("sample_query"),
    )
    kept = sums.where((F.col("distinct_names") >= t.dns_tunneling_min_distinct_names) & (F.col("avg_label_length") >= t.dns_tunneling_min_avg_label_length))
    return kept.select(
        "src_ip", "parent_domain", "window_start", (F.col("window_start") + F.expr("interval 1 hour")).alias("window_end"), "queries", "distinct_names", "avg_label_length",
        F.col("max_name_length").cast("bigint").alias("max_name_length"), "first_seen", "last_seen", "sample_query",
    )


#: The fields of all rules' evidence.
EVIDENCE = (
    "distinct_ports bigint, failed_ratio double, sample_ports array<int>, connections bigint, mean_interval_seconds double, interval_cv double, first_seen string, last_seen string, "
    "bytes_out bigint, bytes_in bigint, upload_ratio double, distinct_names bigint, avg_label_length double, sample_query string"
)


def evidence(**columns: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]), {"ignoreNullFields": "false"})


def fct_alerts(scans: DataFrame, beacons: DataFrame, uploads: DataFrame, tunnels: DataFrame, rules: DataFrame, techniques: DataFrame, allowlist: DataFrame) -> DataFrame:
    """All detections in one shape with rule and technique names, without allowlisted ones.

    alert_id is stable across rebuilds: rule, addresses, name and window; beacons to two ports of one host share it.
    """
    c, null = F.col, lambda kind: F.lit(None).cast(kind)
    day = c("event_date").cast("timestamp")
    seen = {"first_seen": utc_text(c("first_seen")), "last_seen": utc_text(c("last_seen"))}
    shape = lambda df, rule, dst_ip, port, name, start, end, flows, size, proof: df.select(
        F.lit(rule).alias("rule_id"), "src_ip", dst_ip.alias("dst_ip"), port.cast("int").alias("dst_port"), name.alias("dst_name"), start.alias("window_start"), end.alias("window_end"),
        flows.alias("flows"), size.alias("bytes"), proof.alias("evidence"),
    )
    hour_end, day_end = c("window_end"), day + F.expr("interval 1 day")
    alerts = (
        shape(scans, "port_scan", c("dst_ip"), null("int"), null("string"), c("window_start"), hour_end, c("flows"), c("bytes"), evidence(distinct_ports=c("distinct_ports"), failed_ratio=F.round("failed_ratio", 3), sample_ports=c("sample_ports")))
        .unionByName(shape(beacons, "beaconing", c("dst_ip"), c("dst_port"), c("dst_name"), day, day_end, c("connections"), null("bigint"), evidence(connections=c("connections"), mean_interval_seconds=F.round("mean_interval_seconds", 1), interval_cv=F.round("interval_cv", 4), **seen)))
        .unionByName(shape(uploads, "exfiltration", c("dst_ip"), null("int"), c("dst_name"), day, day_end, c("flows"), c("bytes_out"), evidence(bytes_out=c("bytes_out"), bytes_in=c("bytes_in"), upload_ratio=F.round("upload_ratio", 4), **seen)))
        .unionByName(shape(tunnels, "dns_tunneling", null("string"), F.lit(53), c("parent_domain"), c("window_start"), hour_end, c("queries"), null("bigint"), evidence(distinct_names=c("distinct_names"), avg_label_length=F.round("avg_label_length", 1), sample_query=c("sample_query"))))
    )
    alert_id = F.md5(F.concat_ws("|", "rule_id", "src_ip", "dst_ip", "dst_name", utc_text(c("window_start"))))
    named = allowed(alerts, allowlist).join(rules.drop("description"), "rule_id").join(techniques, c("mitre_technique_id") == c("technique_id"))
    return named.select(
        alert_id.alias("alert_id"), "rule_id", "rule_name", "severity", "mitre_technique_id", c("technique_name").alias("mitre_technique_name"), c("tactic").alias("mitre_tactic"),
        "src_ip", "dst_ip", "dst_port", "dst_name", "window_start", "window_end", "flows", "bytes", "evidence",
    )
