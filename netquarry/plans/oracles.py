"""DuckDB SQL for the registered queries, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netquarry.operators.facts import FACT as _FACT
from netquarry.operators.facts import STAGED as _STAGED
from netquarry.plans import adapter, contract_cases
from netquarry.sources.reference import RULES, SERVICES, SITE_ZONES, TECHNIQUES, reference_table

STAGED = " ".join(c for c in _STAGED if c not in ("flow_warnings",))
FACT = " ".join(c for c in _FACT if c not in ("flow_warnings",))
#: Entries for the wildcard anti join: an exact destination, an exact source, and one that fits nothing.
ALLOWED = (("exfiltration", "*", "198.51.100.10", "*", "x"), ("exfiltration", "10.20.1.1", "*", "*", "x"), ("exfiltration", "*", "*", "443", "x"))
INCIDENTS = (
    ("incident_id", "concat('i-', CAST(event_id AS STRING))"), ("rule_id", "CASE event_id % 3 WHEN 0 THEN 'port_scan' WHEN 1 THEN 'beaconing' ELSE 'exfiltration' END"),
    ("src_ip", "concat('10.20.1.', CAST(user_id % 4 AS STRING))"), ("start", "CAST(ts AS TIMESTAMP)"), ("end", "CAST(ts AS TIMESTAMP) + INTERVAL 1 HOUR"),
)
#: By user_id: networks and what is wrong with them.
CIDRS = {
    0: ("10.1.0.0/16", ""), 1: ("10.0.1.0/16", "cidr has host bits set"), 2: ("fd00::/8", "cidr is not an IPv4 network"), 3: ("10.0.0.0/33", "cidr is not an IPv4 network"), 4: ("010.0.0.0/8", "cidr is not an IPv4 network"),
    5: ("10.0.0.7", ""), 6: ("10.0.0.0/255.0.0.0", ""), 7: ("10.0.0.0/0.255.255.255", ""), 8: ("10.0.0.0/255.0.255.0", "cidr is not an IPv4 network"), 9: ("10.1.0.0/255.0.0.0", "cidr has host bits set"), 10: ("0.0.0.0/0", ""), 11: ("10.0.0/8", "cidr is not an IPv4 network"), 12: ("10.0.0.0/", "cidr is not an IPv4 network"),
}
EVENT_ZONES = (
    ("zone", "CASE WHEN user_id % 5 = 0 THEN '' ELSE concat('z', CAST(user_id AS STRING)) END"),
    ("cidr", f"CASE user_id % {len(CIDRS)} " + " ".join(f"WHEN {k} THEN '{c}'" for k, (c, _) in CIDRS.items()) + " END"),
    ("is_internal", "user_id % 3 = 0"),
)
#: By user_id: addresses, and whether they are any.
ADDRESSES = {0: ("*", 1), 1: ("10.20.1.7", 1), 2: ("fe80::1%eth0", 1), 3: ("1:2", 0), 4: (":::::", 0), 5: ("10.01.0.1", 0), 6: ("10.1.1", 0), 7: ("::ffff:10.0.0.1", 1), 8: ("2001:DB8::1", 1), 9: ("::1%", 0), 10: ("", 0), 11: ("1:2:3:4:5:6:7:8:9", 0)}
PORTS = {0: ("*", 1), 1: ("443", 1), 2: ("65536", 0), 3: ("00080", 1), 4: ("-1", 0), 5: ("8o", 0), 6: ("65535", 1), 7: ("99999999999999999999", 0)}

_pick = lambda cases, what, key: f"CASE {key} % {len(cases)} " + " ".join(f"WHEN {k} THEN '{v[what]}'" for k, v in cases.items()) + " END"
EVENT_ALLOWLIST = (
    ("rule_id", "CASE WHEN user_id % 5 = 0 THEN 'no_rule' ELSE 'beaconing' END"), ("src_ip", _pick(ADDRESSES, 0, "user_id")), ("dst_ip", _pick(ADDRESSES, 0, "(user_id + 1)")), ("dst_port", _pick(PORTS, 0, "user_id")),
)
_bad = lambda cases, column: f"{column} IN ({', '.join(repr(v) for v, ok in cases.values() if not ok)})"
ALLOWLIST_PROBLEMS = (("rule_id = 'no_rule'", "rule_id is unknown"), (_bad(ADDRESSES, "src_ip"), "src_ip is no address"), (_bad(ADDRESSES, "dst_ip"), "dst_ip is no address"), (_bad(PORTS, "dst_port"), "dst_port is no port"))
#: What is told of the contract cases, by event_id % 40.
CASE_MESSAGES = {
    0: "flow_id: the field is missing", 1: "protocol: not a whole number", 2: "protocol: above the largest allowed value", 3: "packets_total: below the least allowed value", 4: "duration_seconds: not finite",
    5: "initiator_basis: an empty text", 6: "ip_version: not one of the allowed values", 7: "initiator.ip: no address of IPv4 or IPv6", 8: "<record>: both first_seen and last_seen must be there",
    9: "<record>: last_seen comes before first_seen", 10: "<record>: the directions don''t add up to the total", 11: "<record>: an address isn''t of the version that ip_version tells",
}


def allowlist(spark: SparkSession) -> DataFrame:
    return reference_table(spark, "detection_allowlist", ALLOWED)


def _values(rows: tuple, names: str) -> str:
    lit = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS v({names}))"


def _int(ip: str) -> str:
    part = lambda k: f"CAST(split_part({ip}, '.', {k}) AS BIGINT)"
    return f"CASE WHEN {ip} NOT LIKE '%:%' THEN {part(1)} * 16777216 + {part(2)} * 65536 + {part(3)} * 256 + {part(4)} END"


_PRIVATE6 = "(ip LIKE '%:%' AND regexp_matches(lower(ip), '^(f[cd]|fe[89ab])'))"
_DERIVED = {
    "protocol_name": "coalesce(protocol_name, 'IP-' || protocol)", "flow_hour": "date_trunc('hour', first_seen)", "event_date": "CAST(first_seen AS DATE)", "app_protocol": "coalesce(app_protocols[1], 'none')",
    "responder_name": r"coalesce(tls_server_names[1], regexp_replace(http_hosts[1], '^(\[[^\]]*\]|[^:]*):[0-9]+$', '\1'), responder_dns_names[1])", "has_warnings": "n_warnings > 0",
}
_STAGE = "staged AS (SELECT " + ", ".join(f"{_DERIVED[c]} AS {c}" if c in _DERIVED else c for c in STAGED.split()) + " FROM bronze)"
_ZONES = (
    f"zones AS (SELECT zone, cidr, is_internal, CAST(split_part(cidr, '/', 2) AS BIGINT) AS prefix_length, {_int('split_part(cidr, chr(47), 1)')} AS range_start FROM {_values(tuple((z, c, int(i)) for z, c, i, _ in SITE_ZONES), 'zone, cidr, flag')} AS s, LATERAL (SELECT flag = 1 AS is_internal)), "
    "ranges AS (SELECT *, range_start + CAST(pow(2, 32 - prefix_length) AS BIGINT) - 1 AS range_end FROM zones), "
    f"ips AS (SELECT ip, {_int('ip')} AS n FROM (SELECT initiator_ip AS ip FROM bronze UNION SELECT responder_ip FROM bronze)), "
    f"ip_zones AS (SELECT ip, coalesce(zone, CASE WHEN {_PRIVATE6} THEN 'private' ELSE 'external' END) AS zone, coalesce(is_internal, {_PRIVATE6}) AS is_internal "
    "FROM ips LEFT JOIN ranges ON n BETWEEN range_start AND range_end QUALIFY row_number() OVER (PARTITION BY ip ORDER BY prefix_length DESC NULLS LAST) = 1)"
)
_NEWEST = "newest AS (SELECT * FROM staged QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY ingested_at DESC, batch_id DESC) = 1)"
_FACTS = (
    f"services AS {_values(SERVICES, 'protocol, port, service')}, "
    "fct AS (SELECT f.*, a.zone AS initiator_zone, a.is_internal AS initiator_is_internal, b.zone AS responder_zone, b.is_internal AS responder_is_internal, "
    "CASE WHEN a.is_internal AND b.is_internal THEN 'internal' WHEN a.is_internal THEN 'outbound' WHEN b.is_internal THEN 'inbound' ELSE 'external' END AS direction, "
    "coalesce(s.service, t.service, 'other') AS service, i2r_payload_bytes + r2i_payload_bytes AS payload_bytes, TIMESTAMP '2024-03-01 00:00:00' AS loaded_at "
    "FROM newest f JOIN ip_zones a ON a.ip = f.initiator_ip JOIN ip_zones b ON b.ip = f.responder_ip LEFT JOIN services s ON s.protocol = f.protocol AND s.port = f.responder_port "
    "LEFT JOIN services t ON t.protocol = f.protocol AND t.port = f.initiator_port)"
)
_SUMS = "count(*) AS flows, sum(packets_total) AS packets, sum(bytes_total) AS bytes, sum(i2r_bytes) AS bytes_from_initiators, sum(r2i_bytes) AS bytes_from_responders"
_HOURLY = f"hourly AS (SELECT flow_hour AS hour_start, direction, protocol_name, service, {_SUMS}, count(DISTINCT initiator_ip) AS distinct_initiators, count(DISTINCT responder_ip) AS distinct_responders, max(loaded_at) AS max_loaded_at FROM fct GROUP BY ALL)"
_ENDS = (
    "ends AS (SELECT first_seen, last_seen, initiator_ip AS ip, initiator_zone AS zone, initiator_is_internal AS is_internal, i2r_bytes AS bytes_sent, r2i_bytes AS bytes_received, 1 AS initiated, responder_ip AS peer_ip, CAST(NULL AS VARCHAR) AS observed_name FROM fct "
    "UNION ALL SELECT first_seen, last_seen, responder_ip, responder_zone, responder_is_internal, r2i_bytes, i2r_bytes, 0, initiator_ip, responder_name FROM fct)"
)
_HOSTS = (
    _ENDS + ", top_names AS (SELECT ip, observed_name FROM (SELECT ip, observed_name, count(*) AS n FROM ends WHERE observed_name IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY ip ORDER BY n DESC, observed_name) = 1), "
    "hosts AS (SELECT e.ip, arg_max(zone, last_seen) AS zone, arg_max(is_internal, last_seen) AS is_internal, min(first_seen) AS first_seen, max(last_seen) AS last_seen, count(*) AS flows, sum(initiated) AS flows_initiated, count(*) - sum(initiated) AS flows_received, "
    "sum(bytes_sent) AS bytes_sent, sum(bytes_received) AS bytes_received, count(DISTINCT peer_ip) AS distinct_peers, any_value(t.observed_name) AS most_common_name FROM ends e LEFT JOIN top_names t ON t.ip = e.ip GROUP BY e.ip)"
)
_NAMES = (
    "named AS (SELECT responder_ip AS ip, flow_hour, responder_name AS hostname, count(*) AS flows FROM fct WHERE responder_name IS NOT NULL GROUP BY ALL), "
    "dominant AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY ip, flow_hour ORDER BY flows DESC, hostname) = 1), "
    "changes AS (SELECT *, CASE WHEN hostname IS DISTINCT FROM lag(hostname) OVER (PARTITION BY ip ORDER BY flow_hour) THEN 1 ELSE 0 END AS is_change FROM dominant), "
    "numbered AS (SELECT *, sum(is_change) OVER (PARTITION BY ip ORDER BY flow_hour ROWS UNBOUNDED PRECEDING) AS island FROM changes), "
    "spans AS (SELECT ip, hostname, min(flow_hour) AS valid_from, max(flow_hour) + INTERVAL 1 HOUR AS observed_until, sum(flows) AS flows FROM numbered GROUP BY ip, island, hostname), "
    "versions AS (SELECT md5(ip || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S') || '+00') AS host_name_key, ip, hostname, row_number() OVER w AS version, valid_from, lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current, observed_until, flows "
    "FROM spans WINDOW w AS (PARTITION BY ip ORDER BY valid_from))"
)
_mode = lambda keys, name: f"(SELECT {keys}, {name} AS dst_name FROM (SELECT {keys}, {name}, count(*) AS n FROM fct WHERE direction = 'outbound' AND {name} IS NOT NULL"
_DETECT = (
    "scans AS (SELECT initiator_ip AS src_ip, responder_ip AS dst_ip, flow_hour AS window_start, flow_hour + INTERVAL 1 HOUR AS window_end, count(*) AS flows, count(DISTINCT responder_port) AS distinct_ports, "
    "avg(CASE WHEN tcp_state IN ('reset', 'syn_sent') THEN 1.0 ELSE 0.0 END) AS failed_ratio, sum(bytes_total) AS bytes, min(first_seen) AS first_seen, max(last_seen) AS last_seen, list_slice(list_sort(list_distinct(list(responder_port))), 1, 10) AS sample_ports "
    "FROM fct WHERE protocol = 6 GROUP BY ALL HAVING count(DISTINCT responder_port) >= 3 AND avg(CASE WHEN tcp_state IN ('reset', 'syn_sent') THEN 1.0 ELSE 0.0 END) >= 0.6), "
    "gaps AS (SELECT initiator_ip, responder_ip, responder_port, event_date, first_seen, responder_name, epoch(first_seen) - lag(epoch(first_seen)) OVER (PARTITION BY initiator_ip, responder_ip, responder_port, event_date ORDER BY first_seen) AS gap_seconds FROM fct WHERE direction = 'outbound' AND protocol IN (6, 17)), "
    "beacon_names AS (SELECT initiator_ip, responder_ip, responder_port, event_date, responder_name FROM (SELECT initiator_ip, responder_ip, responder_port, event_date, responder_name, count(*) AS n FROM gaps WHERE responder_name IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY initiator_ip, responder_ip, responder_port, event_date ORDER BY n DESC, responder_name) = 1), "
    "beacons AS (SELECT p.*, b.responder_name AS dst_name FROM (SELECT initiator_ip AS src_ip, responder_ip AS dst_ip, responder_port AS dst_port, event_date, count(*) AS connections, avg(gap_seconds) AS mean_interval_seconds, stddev_samp(gap_seconds) AS stddev_interval_seconds, min(first_seen) AS first_seen, max(first_seen) AS last_seen, stddev_samp(gap_seconds) / avg(gap_seconds) AS interval_cv FROM gaps GROUP BY ALL) p "
    "LEFT JOIN beacon_names b ON b.initiator_ip = src_ip AND b.responder_ip = dst_ip AND b.responder_port = dst_port AND b.event_date = p.event_date WHERE connections >= 8 AND mean_interval_seconds BETWEEN 10 AND 86400 AND interval_cv <= 0.8 AND dst_port <> 123), "
    "upload_names AS (SELECT initiator_ip, responder_ip, event_date, responder_name FROM (SELECT initiator_ip, responder_ip, event_date, responder_name, count(*) AS n FROM fct WHERE direction = 'outbound' AND responder_name IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY initiator_ip, responder_ip, event_date ORDER BY n DESC, responder_name) = 1), "
    "uploads AS (SELECT u.*, n.responder_name AS dst_name FROM (SELECT initiator_ip AS src_ip, responder_ip AS dst_ip, event_date, count(*) AS flows, sum(i2r_bytes) AS bytes_out, sum(r2i_bytes) AS bytes_in, sum(i2r_bytes) / sum(bytes_total) AS upload_ratio, min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM fct WHERE direction = 'outbound' GROUP BY ALL) u "
    "LEFT JOIN upload_names n ON n.initiator_ip = src_ip AND n.responder_ip = dst_ip AND n.event_date = u.event_date WHERE bytes_out >= 300000 AND upload_ratio >= 0.7), "
    "asked AS (SELECT initiator_ip AS src_ip, flow_hour, first_seen, lower(unnest(dns_queries)) AS query FROM fct WHERE app_protocol = 'dns' OR service = 'dns'), "
    "labels AS (SELECT *, array_to_string(list_slice(string_split(query, '.'), -2, -1), '.') AS parent_domain, split_part(query, '.', 1) AS first_label FROM asked), "
    "tunnels AS (SELECT src_ip, parent_domain, flow_hour AS window_start, flow_hour + INTERVAL 1 HOUR AS window_end, count(*) AS queries, count(DISTINCT query) AS distinct_names, avg(length(first_label)) AS avg_label_length, max(length(query)) AS max_name_length, min(first_seen) AS first_seen, max(first_seen) AS last_seen, min(query) AS sample_query "
    "FROM labels GROUP BY ALL HAVING count(DISTINCT query) >= 2 AND avg(length(first_label)) >= 6)"
)
_DAY = "CAST(event_date AS TIMESTAMP) AS window_start, CAST(event_date AS TIMESTAMP) + INTERVAL 1 DAY AS window_end"
_SEEN = "strftime(first_seen, '%Y-%m-%d %H:%M:%S') || '+00' AS first_seen, strftime(last_seen, '%Y-%m-%d %H:%M:%S') || '+00' AS last_seen"
_PROOF = "distinct_ports failed_ratio sample_ports connections mean_interval_seconds interval_cv first_seen last_seen bytes_out bytes_in upload_ratio distinct_names avg_label_length sample_query"
_ALERTS = (
    f"rules AS {_values(tuple(r[:4] for r in RULES), 'rule_id, rule_name, severity, mitre_technique_id')}, techniques AS {_values(TECHNIQUES, 'technique_id, technique_name, tactic')}, "
    "every AS (SELECT 'port_scan' AS rule_id, src_ip, dst_ip, CAST(NULL AS BIGINT) AS dst_port, CAST(NULL AS VARCHAR) AS dst_name, window_start, window_end, flows, bytes, distinct_ports, round(failed_ratio, 3) AS failed_ratio, sample_ports FROM scans "
    f"UNION ALL BY NAME SELECT 'beaconing' AS rule_id, src_ip, dst_ip, dst_port, dst_name, {_DAY}, connections AS flows, connections, round(mean_interval_seconds, 1) AS mean_interval_seconds, round(interval_cv, 4) AS interval_cv, {_SEEN} FROM beacons "
    f"UNION ALL BY NAME SELECT 'exfiltration' AS rule_id, src_ip, dst_ip, dst_name, {_DAY}, flows, bytes_out AS bytes, bytes_out, bytes_in, round(upload_ratio, 4) AS upload_ratio, {_SEEN} FROM uploads "
    "UNION ALL BY NAME SELECT 'dns_tunneling' AS rule_id, src_ip, 53 AS dst_port, parent_domain AS dst_name, window_start, window_end, queries AS flows, distinct_names, round(avg_label_length, 1) AS avg_label_length, sample_query FROM tunnels), "
    "alerts AS (SELECT md5(concat_ws('|', e.rule_id, src_ip, dst_ip, dst_name, strftime(window_start, '%Y-%m-%d %H:%M:%S') || '+00', NULL)) AS alert_id, e.rule_id, rule_name, severity, mitre_technique_id, technique_name AS mitre_technique_name, tactic AS mitre_tactic, "
    f"src_ip, dst_ip, dst_port, dst_name, window_start, window_end, flows, bytes, {', '.join(_PROOF.split())} FROM every e JOIN rules r ON r.rule_id = e.rule_id JOIN techniques t ON t.technique_id = mitre_technique_id)"
)
_INCIDENTS = "incidents AS (SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in INCIDENTS) + " FROM events WHERE value > 100), hits AS (SELECT alert_id, incident_id, a.rule_id FROM alerts a JOIN incidents i ON a.rule_id = i.rule_id AND a.src_ip = i.src_ip AND a.window_start <= i.\"end\" AND i.start < a.window_end)"
_BATCHES = (
    "accepted AS (SELECT batch_id, min(sensor_id) AS sensor_id, min(source) AS source, min(capture_file) AS capture_file, min(capture_completion_state) AS capture_completion_state, max(ingested_at) AS ingested_at, count(*) AS records_accepted, count(DISTINCT record_id) AS distinct_records FROM staged GROUP BY batch_id), "
    "rejected AS (SELECT batch_id, min(sensor_id) AS sensor_id, min(source) AS source, max(ingested_at) AS ingested_at, count(*) AS records_quarantined FROM quarantine GROUP BY batch_id), "
    "batches AS (SELECT coalesce(a.batch_id, r.batch_id) AS batch_id, coalesce(a.sensor_id, r.sensor_id) AS sensor_id, coalesce(a.source, r.source) AS source, capture_file, capture_completion_state, coalesce(capture_completion_state, 'complete') <> 'complete' AS capture_was_cut_short, "
    "coalesce(a.ingested_at, r.ingested_at) AS ingested_at, coalesce(records_accepted, 0) AS records_accepted, coalesce(records_quarantined, 0) AS records_quarantined, coalesce(records_quarantined, 0) / (coalesce(records_accepted, 0) + coalesce(records_quarantined, 0)) AS quarantine_rate FROM accepted a FULL JOIN rejected r ON r.batch_id = a.batch_id)"
)
_DENSE = (
    "axis AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_start FROM (SELECT min(hour_start) AS lo, max(hour_start) AS hi FROM hourly)), "
    "dense AS (SELECT axis.hour_start, d.direction, coalesce(sum(flows), 0) AS flows, coalesce(sum(bytes), 0) AS bytes FROM axis, (VALUES ('internal'), ('outbound'), ('inbound'), ('external')) AS d(direction) LEFT JOIN hourly h ON h.hour_start = axis.hour_start AND h.direction = d.direction GROUP BY ALL)"
)
_SEVERITY = "CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 4 END"

#: The CTEs in order; a query gets all up to the last one it needs.
_LEVELS = {
    "bronze": adapter.duckdb_bronze(), "staged": _STAGE, "zones": _ZONES, "newest": _NEWEST, "fct": _FACTS, "hourly": _HOURLY, "hosts": _HOSTS, "names": _NAMES, "detect": _DETECT, "alerts": _ALERTS, "incidents": _INCIDENTS,
    "batches": _BATCHES, "dense": _DENSE,
}
_NEEDS = {
    "bronze": "bronze", "staged": "bronze staged", "zones": "bronze staged zones", "newest": "bronze staged newest", "fct": "bronze staged zones newest fct", "hourly": "bronze staged zones newest fct hourly", "hosts": "bronze staged zones newest fct hosts",
    "names": "bronze staged zones newest fct names", "detect": "bronze staged zones newest fct detect", "alerts": "bronze staged zones newest fct detect alerts", "incidents": "bronze staged zones newest fct detect alerts incidents",
    "gold": "bronze staged zones newest fct hourly hosts names batches", "gold_tests": "bronze staged zones newest fct hourly hosts names detect alerts batches", "batches": "bronze staged batches", "dense": "bronze staged zones newest fct hourly dense",
}
_TIMES = set("first_seen last_seen flow_hour event_date ingest_date ingested_at hour_start max_loaded_at loaded_at window_start window_end valid_from valid_to observed_until peak_hour newest start end".split())
_LISTS = set("tcp_flags_initiator tcp_flags_responder app_protocols dns_queries responder_dns_names http_hosts http_paths tls_server_names sample_ports".split())
_ROUNDED = set("duration_seconds pkt_size_mean pkt_size_stddev iat_mean_seconds iat_stddev_seconds failed_ratio mean_interval_seconds stddev_interval_seconds interval_cv upload_ratio avg_label_length quarantine_rate precision recall rate gap_seconds age_hours".split())
_WHOLE = set(
    "contract_version flow_id ip_version protocol initiator_port responder_port i2r_packets i2r_bytes i2r_payload_bytes r2i_packets r2i_bytes r2i_payload_bytes packets_total bytes_total payload_bytes tcp_rst_packets flows packets bytes "
    "bytes_from_initiators bytes_from_responders distinct_initiators distinct_responders flows_initiated flows_received bytes_sent bytes_received distinct_peers version is_change island distinct_ports connections bytes_out bytes_in queries "
    "expected found distinct_names max_name_length dst_port records_accepted records_quarantined distinct_records n incidents detected alerts true_alerts records violations place sensors internal external batches accepted quarantined cut_short rank rejected peak_bytes "
    "median_bytes initiated addresses prefix_length range_start range_end time start_time duration direction_id packets_in class_uid activity_id type_uid fact_flows hourly_flows fact_packets hourly_packets fact_bytes hourly_bytes count record_index".split()
)


def _select(level: str | None, columns: str, source: str) -> str:
    """columns: names, or `name=expression` without blanks inside the expression; typed by name."""
    out = []
    for item in columns.split():
        name, _, e = item.partition("=")
        e = (e or f'"{name}"').replace("~", " ")
        e = f"CAST({e} AS VARCHAR)" if name in _TIMES else f"array_to_string({e}, ',')" if name in _LISTS else f"round(CAST({e} AS DOUBLE), 6)" if name in _ROUNDED else f"CAST({e} AS BIGINT)" if name in _WHOLE else e
        out.append(f'{e} AS "{name}"')
    ctes = ", ".join(_LEVELS[x] for x in _NEEDS[level].split()) if level else ""
    return (f"WITH {ctes} " if ctes else "") + f"SELECT {', '.join(out)} FROM {source}"


def _ordered(source: str, order: str, limit: int | None = None) -> str:
    """The rows with their place in an order; rows that the order leaves equal differ in nothing that is compared."""
    return f"(SELECT row_number() OVER (ORDER BY {order}) AS place, * FROM {source}{f' ORDER BY place LIMIT {limit}' if limit else ''})"


def _data_tests() -> str:
    """Each test of the build written out; most hold by how the models are made."""
    t = []
    count = lambda source, where: f"(SELECT count(*) FROM {source} WHERE {where})"
    twice = lambda source, key: f"(SELECT count(*) FROM (SELECT {key} AS k FROM {source} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
    add = lambda table, test, severity, n: t.append(f"SELECT '{table}' AS \"table\", '{test}' AS test, '{severity}' AS severity, CAST({n} AS BIGINT) AS violations")
    site = _values(tuple((z, c) for z, c, *_ in SITE_ZONES), "zone, cidr")
    for table, source, columns in (
        ("flows", "bronze", "record_id"), ("stg_flows", "staged", "record_id first_seen"), ("stg_quarantine", "quarantine", "error_type"), ("network_zones", site, "cidr"), ("mitre_techniques", "techniques", "technique_id"), ("detection_rules", "rules", "rule_id"),
        ("fct_flows", "fct", "record_id first_seen initiator_zone responder_zone direction"), ("agg_traffic_hourly", "hourly", "hour_start"), ("dim_hosts", "hosts", "ip zone"), ("dim_host_names", "versions", "host_name_key hostname"), ("fct_alerts", "alerts", "alert_id rule_id src_ip"), ("dq_batches", "batches", "batch_id"),
    ):
        for c in columns.split():
            add(table, f"not_null({c})", "error", count(source, f"{c} IS NULL"))
    add("fct_alerts", "not_null(evidence)", "error", 0)
    for table, source, key, severity in (
        ("network_zones", site, "cidr", "error"), ("service_ports", "services", "concat(protocol, '/', port)", "error"), ("mitre_techniques", "techniques", "technique_id", "error"), ("detection_rules", "rules", "rule_id", "error"), ("fct_flows", "fct", "record_id", "error"), ("dim_hosts", "hosts", "ip", "error"),
        ("dim_host_names", "versions", "host_name_key", "error"), ("fct_alerts", "alerts", "alert_id", "warn"), ("dq_batches", "batches", "batch_id", "error"),
    ):
        add(table, f"unique({key})".replace("'", "''"), severity, twice(source, key))
    for table, source, rule, severity in (
        ("stg_network_zones", "ranges", "range_end >= range_start", "error"), ("stg_network_zones", "ranges", "prefix_length between 0 and 32", "error"), ("fct_flows", "fct", "bytes_total = i2r_bytes + r2i_bytes", "error"), ("fct_flows", "fct", "packets_total = i2r_packets + r2i_packets", "error"),
        ("fct_flows", "fct", "last_seen >= first_seen", "error"), ("agg_traffic_hourly", "hourly", "flows > 0", "error"), ("dq_batches", "batches", "quarantine_rate between 0 and 1", "error"), ("dq_batches", "batches", "quarantine_rate <= 0.05", "warn"),
    ):
        add(table, f"expression({rule})", severity, count(source, f"NOT ({rule})"))
    for table, source, column, values, severity in (
        ("detection_rules", "rules", "severity", "low medium high critical", "error"), ("fct_flows", "fct", "direction", "internal outbound inbound external", "error"), ("fct_flows", "fct", "tcp_state", "syn_sent syn_received established midstream closing closed reset", "warn"),
        ("fct_flows", "fct", "end_reason", "idle_timeout tcp_finished evicted capture_end clock_reset", "warn"), ("dq_batches", "batches", "capture_was_cut_short", "false", "warn"),
    ):
        add(table, f"accepted_values({column})", severity, count(source, f"CAST({column} AS VARCHAR) NOT IN ({', '.join(repr(v) for v in values.split())})"))
    add("ocsf_network_activity", "accepted_values(type_uid)", "error", 0)
    add("detection_rules", "relationships(mitre_technique_id)", "error", count("rules", "mitre_technique_id NOT IN (SELECT technique_id FROM techniques)"))
    add("fct_alerts", "relationships(rule_id)", "error", count("alerts", "rule_id NOT IN (SELECT rule_id FROM rules)"))
    add("agg_traffic_hourly", "hourly_traffic_reconciles", "error", "(SELECT CAST(a.n <> b.n AS BIGINT) + CAST(a.p <> b.p AS BIGINT) + CAST(a.y <> b.y AS BIGINT) FROM (SELECT count(*) AS n, sum(packets_total) AS p, sum(bytes_total) AS y FROM fct) a, (SELECT sum(flows) AS n, sum(packets) AS p, sum(bytes) AS y FROM hourly) b)")
    add("dim_host_names", "scd2_versions_are_contiguous", "error", "(SELECT count(*) FROM (SELECT ip FROM versions GROUP BY ip HAVING count(*) FILTER (WHERE is_current) <> 1))")
    return _select("gold_tests", "table test severity violations status=CASE~WHEN~violations=0~THEN~'pass'~WHEN~severity='warn'~THEN~'warn'~ELSE~'fail'~END", "(" + " UNION ALL ".join(t) + ")")


def _bronze() -> str:
    """All columns of the bronze rows that the valid contract cases give."""
    closed = lambda e: f"CASE WHEN event_id % 40 <> 13 THEN {e} END"
    null = lambda names, kind: {n: f"CAST(NULL AS {kind})" for n in names.split()}
    at = "CAST({} AS VARCHAR)".format
    columns = {
        "record_id": "substr(sha256(concat('s1', chr(31), 'capture-', event_id % 20, chr(31), event_id + 1)), 1, 32)", "batch_id": "concat('b-', event_id % 20)", "source": "'file'", "sensor_id": "'s1'", "capture_id": "concat('capture-', event_id % 20)",
        "capture_file": "CAST(NULL AS VARCHAR)", "capture_completion_state": "'complete'", "contract_version": "1", "ingested_at": at("CAST(ts AS TIMESTAMP)"), "flow_id": "event_id + 1", "ip_version": "4", "protocol": "6", "protocol_name": "'TCP'",
        "initiator_ip": "concat('10.20.1.', user_id % 4)", "initiator_port": "40000", "responder_ip": "'198.51.100.40'", "responder_port": "443", "initiator_basis": "'syn'", "first_seen": at("date_trunc('second', ts) + INTERVAL 1 MICROSECOND"),
        "last_seen": at("date_trunc('second', ts) + INTERVAL 5 SECOND"), "duration_seconds": "CAST(5 AS DOUBLE)", "first_packet_index": "0", "last_packet_index": "9", "i2r_packets": "6", "i2r_bytes": "100 + event_id", "i2r_payload_bytes": "10",
        "r2i_packets": "4", "r2i_bytes": "50", "r2i_payload_bytes": "10", "packets_total": "10", "bytes_total": "150 + event_id", **null("pkt_size_min pkt_size_max pkt_size_mean pkt_size_stddev pkt_size_median", "DOUBLE"), **null("pkt_size_median_exact", "BOOLEAN"),
        **null("iat_min_seconds iat_max_seconds iat_mean_seconds iat_stddev_seconds", "DOUBLE"), "tcp_state": closed("'closed'"), "tcp_flags_initiator": closed("'SYN'"), "tcp_flags_responder": closed("''"), "tcp_syn_packets": closed("1"),
        **{f"tcp_{x}": closed("0") for x in ("fin_packets", "rst_packets", "duplicate_segments")}, "dns_queries": "'a.example'", **{x: "''" for x in "app_protocols responder_dns_names http_hosts http_paths tls_server_names tls_alpn upstream_alert_ids".split()},
        "dominant_endpoint": "'initiator'", "end_reason": "'idle_timeout'", "flow_warnings": "'[]'",
    }
    whole = set("contract_version ip_version protocol initiator_port responder_port first_packet_index last_packet_index i2r_packets i2r_payload_bytes r2i_packets r2i_bytes r2i_payload_bytes packets_total tcp_syn_packets tcp_fin_packets tcp_rst_packets tcp_duplicate_segments".split())
    return "SELECT " + ", ".join(f"CAST({e} AS BIGINT) AS {c}" if c in whole else f"{e} AS {c}" for c, e in columns.items()) + " FROM events WHERE event_id % 40 > 11"


def sql() -> dict[str, str]:
    host = "ip zone is_internal first_seen last_seen flows flows_initiated flows_received bytes_sent bytes_received distinct_peers most_common_name"
    alert = "alert_id rule_id rule_name severity mitre_technique_id mitre_technique_name mitre_tactic src_ip dst_ip dst_port dst_name window_start window_end flows bytes"
    by = lambda name: f"(SELECT {name}, count(*) AS flows FROM staged GROUP BY ALL)"
    scan = "src_ip dst_ip window_start window_end flows distinct_ports failed_ratio bytes first_seen last_seen sample_ports"
    check = lambda name, severity: f"check='{name}' severity='{severity}'"
    kind = "CASE event_id % 40 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in contract_cases.CASES.items()) + " END"
    envelope = "CASE event_id % 10 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in contract_cases.ENVELOPES.items()) + " END"
    zone, allow = (", ".join(f"{e} AS {c}" for c, e in x) for x in (EVENT_ZONES, EVENT_ALLOWLIST))
    message = "CASE event_id % 40 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in CASE_MESSAGES.items()) + " END"
    problem = lambda when, what: f"SELECT zone, cidr, '{what}' AS problem FROM z WHERE {when}"
    return {
        "stg_flows": _select("staged", STAGED, "staged"),
        "protocol_name": _select("staged", "protocol protocol_name flows", by("protocol, protocol_name")),
        "flow_hour": _select("staged", "flow_hour flows", by("flow_hour")),
        "event_date": _select("staged", "event_date flows", by("event_date")),
        "app_protocol": _select("staged", "app_protocol flows", by("app_protocol")),
        "responder_name": _select("staged", "responder_name flows", by("responder_name")),
        "has_warnings": _select("staged", "has_warnings flows", by("has_warnings")),
        "stg_quarantine": _select("bronze", "batch_id record_index source sensor_id capture_id ingest_date ingested_at error_type error_message", "quarantine"),
        "stg_network_zones": _select("zones", "zone cidr is_internal prefix_length range_start range_end addresses", "(SELECT r.*, count(*) AS addresses FROM ranges r JOIN ips ON ips.n BETWEEN range_start AND range_end GROUP BY ALL)"),
        "ipv4_to_int": _select("zones", "ip n", "ips"),
        "is_private_ipv6": _select("zones", f"ip private={_PRIVATE6.replace(' ', '~')}", "ips"),
        "parent_domain": _select("bronze", "domain n", "(SELECT array_to_string(list_slice(string_split(q, '.'), -2, -1), '.') AS domain, count(*) AS n FROM (SELECT lower(unnest(dns_queries)) AS q FROM bronze) GROUP BY ALL)"),
        "direction": _select("fct", "direction initiator_is_internal responder_is_internal flows", "(SELECT direction, initiator_is_internal, responder_is_internal, count(*) AS flows FROM fct GROUP BY ALL)"),
        "service": _select("fct", "service protocol flows", "(SELECT service, protocol, count(*) AS flows FROM fct GROUP BY ALL)"),
        "payload_bytes": _select("fct", "record_id payload_bytes", "fct"),
        "ocsf_network_activity": _select("fct", "uid=record_id class_uid=4001 activity_id=6 type_uid=400106 time=epoch_us(last_seen)//1000 start_time=epoch_us(first_seen)//1000 duration=round(duration_seconds*1000) src_ip=initiator_ip dst_ip=responder_ip dst_port=responder_port hostname=responder_name protocol_name=lower(protocol_name) "
            "direction_id=CASE~direction~WHEN~'inbound'~THEN~1~WHEN~'outbound'~THEN~2~WHEN~'internal'~THEN~3~ELSE~0~END direction=CASE~direction~WHEN~'inbound'~THEN~'Inbound'~WHEN~'outbound'~THEN~'Outbound'~WHEN~'internal'~THEN~'Lateral'~ELSE~'Unknown'~END bytes=bytes_total bytes_out=i2r_bytes packets_in=r2i_packets", "fct"),
        "alert_evidence": _select("alerts", f"alert_id dst_port {_PROOF}", "alerts"),
        "zone_lookup": _select("zones", "ip zone is_internal", "ip_zones"),
        "longest_prefix": _select("zones", "zone is_internal addresses", "(SELECT zone, is_internal, count(*) AS addresses FROM ip_zones GROUP BY ALL)"),
        "zone_attach": _select("fct", "record_id initiator_zone responder_zone", "fct"),
        "service_attach": _select("fct", "record_id service", "fct"),
        "alert_rules": _select("alerts", "rule_id rule_name severity mitre_technique_id mitre_technique_name mitre_tactic alerts", "(SELECT rule_id, rule_name, severity, mitre_technique_id, mitre_technique_name, mitre_tactic, count(*) AS alerts FROM alerts GROUP BY ALL)"),
        "allowlist_anti": _select("detect", "src_ip dst_ip event_date", "uploads WHERE dst_ip <> '198.51.100.10' AND src_ip <> '10.20.1.1'"),
        "dq_full_outer": _select("batches", "batch_id records_accepted records_quarantined", "batches"),
        "changed_hours_semi": _select("fct", "flow_hour flows", "(SELECT flow_hour, count(*) AS flows FROM fct WHERE flow_hour IN (SELECT date_trunc('hour', first_seen) FROM bronze WHERE batch_id LIKE 'r-%') GROUP BY ALL)"),
        "incident_overlap": _select("incidents", "alert_id incident_id rule_id", "hits"),
        "renamed_hosts_semi": _select("names", "ip hostname version", "versions WHERE ip IN (SELECT ip FROM versions GROUP BY ip HAVING count(*) > 1)"),
        "relationships": _select("fct", "record_id service", "fct WHERE service NOT IN (SELECT service FROM services)"),
        "reconcile_cross": _select("fct", "fact_flows hourly_flows", "(SELECT count(*) AS fact_flows, count(*) AS hourly_flows FROM fct)"),
        "dns_unnest": _select("detect", "src_ip query n", "(SELECT src_ip, query, count(*) AS n FROM labels GROUP BY ALL)"),
        "agg_traffic_hourly": _select("hourly", "hour_start direction protocol_name service flows packets bytes bytes_from_initiators bytes_from_responders distinct_initiators distinct_responders max_loaded_at", "hourly"),
        "dim_hosts": _select("hosts", host, "hosts"),
        "det_port_scan": _select("detect", scan, "scans"),
        "det_beaconing": _select("detect", "src_ip dst_ip dst_port event_date connections mean_interval_seconds stddev_interval_seconds first_seen last_seen dst_name interval_cv", "beacons"),
        "det_exfiltration": _select("detect", "src_ip dst_ip event_date flows bytes_out bytes_in upload_ratio first_seen last_seen dst_name", "uploads"),
        "det_dns_tunneling": _select("detect", "src_ip parent_domain window_start window_end queries distinct_names avg_label_length max_name_length first_seen last_seen sample_query", "tunnels"),
        "dq_accepted": _select("batches", "batch_id sensor_id source capture_file capture_completion_state ingested_at records_accepted distinct_records", "accepted"),
        "dq_rejected": _select("batches", "batch_id sensor_id source ingested_at records_quarantined", "rejected"),
        "dq_batches": _select("batches", "batch_id sensor_id source capture_file capture_completion_state capture_was_cut_short ingested_at records_accepted records_quarantined quarantine_rate", "batches"),
        "quarantine_reasons": _select("bronze", "batch_id reason n", "(SELECT batch_id, error_type AS reason, count(*) AS n FROM quarantine GROUP BY ALL)"),
        "scd2_named": _select("names", "ip flow_hour hostname flows", "named"),
        "scd2_versions": _select("names", "ip hostname valid_from observed_until flows", "spans"),
        "rule_scores": _select("incidents", "rule_id incidents detected alerts true_alerts precision=CASE~WHEN~alerts=0~THEN~1.0~ELSE~true_alerts/alerts~END recall=CASE~WHEN~incidents=0~THEN~1.0~ELSE~detected/incidents~END",
            "(SELECT coalesce(rule_id, 'all') AS rule_id, sum(incidents) AS incidents, sum(detected) AS detected, sum(alerts) AS alerts, sum(true_alerts) AS true_alerts FROM (SELECT coalesce(a.rule_id, i.rule_id) AS rule_id, coalesce(na, 0) AS alerts, coalesce(ni, 0) AS incidents, coalesce(d, 0) AS detected, coalesce(ta, 0) AS true_alerts "
            "FROM (SELECT rule_id, count(*) AS na FROM alerts GROUP BY 1) a FULL JOIN (SELECT rule_id, count(*) AS ni FROM incidents GROUP BY 1) i ON a.rule_id = i.rule_id LEFT JOIN (SELECT rule_id, count(DISTINCT incident_id) AS d, count(DISTINCT alert_id) AS ta FROM hits GROUP BY 1) h ON h.rule_id = coalesce(a.rule_id, i.rule_id)) GROUP BY GROUPING SETS ((rule_id), ()))"),
        "missed_incidents": _select("incidents", "incident_id", "incidents WHERE incident_id NOT IN (SELECT incident_id FROM hits)"),
        "false_alerts": _select("incidents", "alert_id", "alerts WHERE alert_id NOT IN (SELECT alert_id FROM hits)"),
        "quarantine_by_type": _select("bronze", "error_type records", "(SELECT error_type, count(*) AS records FROM quarantine GROUP BY ALL)"),
        "quarantine_ranked": _select("bronze", "place error_type records", _ordered("(SELECT error_type, count(*) AS records FROM quarantine GROUP BY ALL)", "records DESC, error_type")),
        "kpis": _select("fct", "flows bytes first_seen last_seen sensors", "(SELECT count(*) AS flows, sum(bytes_total) AS bytes, min(first_seen) AS first_seen, max(last_seen) AS last_seen, count(DISTINCT sensor_id) AS sensors FROM fct)"),
        "host_counts": _select("zones", "internal external", "(SELECT count(*) FILTER (WHERE is_internal) AS internal, count(*) FILTER (WHERE NOT is_internal) AS external FROM ip_zones)"),
        "hourly_by_direction": _select("hourly", "hour_start direction flows bytes", "(SELECT hour_start, direction, sum(flows) AS flows, sum(bytes) AS bytes FROM hourly GROUP BY ALL)"),
        "batch_totals": _select("batches", "batches accepted quarantined cut_short", "(SELECT count(*) AS batches, sum(records_accepted) AS accepted, sum(records_quarantined) AS quarantined, count(*) FILTER (WHERE capture_was_cut_short) AS cut_short FROM batches)"),
        "alerts_by_severity": _select("alerts", "severity alerts rank", f"(SELECT severity, count(*) AS alerts, {_SEVERITY} AS rank FROM alerts GROUP BY ALL)"),
        "lake_quarantine_rate": _select("bronze", "accepted rejected rate passed=(rate<=0.05)", "(SELECT *, rejected / (accepted + rejected) AS rate FROM (SELECT (SELECT count(*) FROM bronze) AS accepted, (SELECT count(*) FROM quarantine) AS rejected))"),
        "upload_peak_median": _select("dense", "peak_hour peak_bytes median_bytes", "(SELECT (SELECT hour_start FROM dense WHERE direction = 'outbound' ORDER BY bytes DESC, hour_start LIMIT 1) AS peak_hour, (SELECT max(bytes) FROM dense WHERE direction = 'outbound') AS peak_bytes, list_sort(list(bytes))[CAST(count(*) AS BIGINT) // 2 + 1] AS median_bytes FROM dense WHERE direction = 'outbound')"),
        "source_freshness": _select("bronze", "newest age_hours status", "(SELECT newest, age_hours, CASE WHEN age_hours > 24 THEN 'error' WHEN age_hours > 6 THEN 'warn' ELSE 'pass' END AS status FROM (SELECT max(ingested_at) AS newest, (epoch(TIMESTAMP '2024-03-01 00:00:00') - epoch(max(ingested_at))) / 3600 AS age_hours FROM bronze))"),
        "dedupe_latest": _select("newest", "record_id ingested_at batch_id", "newest"),
        "dominant_name": _select("names", "ip flow_hour hostname flows", "dominant"),
        "name_change_flag": _select("names", "ip flow_hour hostname flows is_change", "changes"),
        "islands": _select("names", "ip flow_hour hostname flows is_change island", "numbered"),
        "scd2": _select("names", "host_name_key ip hostname version valid_from valid_to is_current observed_until flows", "versions"),
        "scd2_validity": _select("names", "ip version valid_from valid_to is_current", "versions"),
        "connection_gaps": _select("detect", "initiator_ip responder_ip responder_port event_date first_seen responder_name gap_seconds", "gaps"),
        "contiguity_check": _select("names", "ip problem='not~contiguous'", "versions WHERE version = 1 AND valid_to IS NOT NULL"),
        "top_talkers": _select("hosts", "place ip zone flows bytes_sent bytes_received distinct_peers", _ordered("hosts WHERE is_internal", "bytes_sent DESC, ip", 10)),
        "alerts_ranked": _select("alerts", "place severity window_start", _ordered("alerts", f"{_SEVERITY}, window_start")),
        "renames": _select("names", "place ip hostname version valid_from valid_to is_current", _ordered("versions WHERE ip IN (SELECT ip FROM versions GROUP BY ip HAVING count(*) > 1)", "ip, version", 20)),
        "sample_ports": _select("detect", "src_ip dst_ip window_start sample_ports", "scans"),
        "alerts_by_time": _select("alerts", "place window_start rule_id", _ordered("alerts", "window_start, rule_id")),
        "addresses": _select("zones", "ip", "ips"),
        "endpoints": _select("hosts", "ip initiated n bytes_sent", "(SELECT ip, initiated, count(*) AS n, sum(bytes_sent) AS bytes_sent FROM ends GROUP BY ALL)"),
        "fct_flows": _select("fct", FACT, "fct"),
        "fct_alerts": _select("alerts", alert, "alerts"),
        "scd2_problems": _select("names", "ip problem='not~exactly~one~current~version'", "(SELECT ip FROM versions GROUP BY ip HAVING count(*) > 1)"),
        "quarantine_difference": _select("bronze", "error_type expected found", "(SELECT error_type, count(*) FILTER (WHERE record_index % 2 = 0) AS expected, count(*) AS found FROM quarantine GROUP BY ALL HAVING count(*) FILTER (WHERE record_index % 2 = 0) <> count(*))"),
        "distinct_hours": _select("fct", "flow_hour", "(SELECT DISTINCT flow_hour FROM fct)"),
        "snapshot_difference": _select("fct", "record_id direction only_in='one'", "fct WHERE direction = 'inbound'"),
        "snapshot_equal": _select("hourly", "model found expected=found more=0::BIGINT missing=0::BIGINT", "(SELECT 'fct_flows' AS model, count(*) AS found FROM fct UNION ALL SELECT 'agg_traffic_hourly', count(*) FROM hourly)"),
        "data_tests": _data_tests(),
        "dense_hour_axis": _select("dense", "hour_start direction flows bytes", "dense"),
        "hourly_windows": _select("fct", 'start end flows', "(SELECT date_trunc('hour', first_seen) AS start, date_trunc('hour', first_seen) + INTERVAL 1 HOUR AS \"end\", count(*) AS flows FROM fct GROUP BY ALL)"),
        "daily_windows": _select("fct", 'start end flows', "(SELECT date_trunc('day', first_seen) AS start, date_trunc('day', first_seen) + INTERVAL 1 DAY AS \"end\", count(*) AS flows FROM fct GROUP BY ALL)"),
        "check_not_null": _select("fct", check("not_null(responder_name)", "warn") + " record_id responder_name", "fct WHERE responder_name IS NULL"),
        "check_unique": _select("bronze", check("unique(key)", "error") + " key count", "(SELECT record_id AS key, count(*) AS count FROM bronze GROUP BY 1 HAVING count(*) > 1)"),
        "check_accepted_values": _select("fct", check("accepted_values(direction)", "error") + " record_id direction", "fct WHERE direction NOT IN ('internal', 'outbound', 'inbound')"),
        "check_relationships": _select("fct", check("relationships(service)", "error") + " record_id service", "fct WHERE service NOT IN (SELECT service FROM services)"),
        "check_expression": _select("fct", check("expression(bytes_total~>~1000~*~packets_total)", "warn") + " record_id bytes_total packets_total", "fct WHERE NOT bytes_total > 1000 * packets_total"),
        "check_reconciliation": _select("hourly", check("reconciliation", "error") + " fact_flows fact_packets fact_bytes hourly_flows hourly_packets hourly_bytes",
            "(SELECT * FROM (SELECT count(*) AS fact_flows, sum(packets_total) AS fact_packets, sum(bytes_total) AS fact_bytes FROM fct), (SELECT sum(flows) AS hourly_flows, sum(packets) AS hourly_packets, sum(bytes) AS hourly_bytes FROM hourly WHERE direction <> 'inbound') WHERE fact_flows <> hourly_flows)"),
        "check_scd2": _select("names", check("scd2", "error") + " ip problem",
            "(SELECT ip, 'not contiguous' AS problem FROM (SELECT *, lead(valid_from) OVER (PARTITION BY ip ORDER BY version) AS after FROM versions WHERE version <> 2) WHERE after IS NOT NULL AND valid_to IS DISTINCT FROM after UNION ALL SELECT ip, 'not exactly one current version' FROM versions WHERE version <> 2 GROUP BY ip HAVING count(*) FILTER (WHERE is_current) <> 1)"),
        "validate_zones": f"WITH z AS (SELECT {zone} FROM (SELECT DISTINCT user_id FROM events)) "
            + problem("zone = ''", "zone is empty") + " UNION ALL " + " UNION ALL ".join(problem(f"cidr = '{c}'", what) for c, what in CIDRS.values() if what),
        "validate_allowlist": f"WITH a AS (SELECT {allow} FROM (SELECT DISTINCT user_id FROM events)) "
            + " UNION ALL ".join(f"SELECT rule_id, src_ip, dst_ip, dst_port, '{what}' AS problem FROM a WHERE {when}" for when, what in ALLOWLIST_PROBLEMS),
        "contract_messages": f"SELECT event_id AS record_index, {message} AS error_message FROM events WHERE event_id % 40 < 12",
        "capture_documents": "SELECT 's1' AS sensor_id, 'valid' AS status, 'complete' AS completion_state, count(DISTINCT event_id % 20) AS documents, count(*) AS flows FROM events",
        "explode_flows": "SELECT record_index, count(*) AS n FROM (SELECT row_number() OVER (PARTITION BY event_id % 20 ORDER BY event_id) - 1 AS record_index FROM events) GROUP BY 1",
        "fct_flows_incremental": _select("fct", "record_id direction service bytes_total batch_id", "fct"),
        "agg_hourly_incremental": _select("hourly", "hour_start direction protocol_name service flows packets bytes distinct_initiators distinct_responders", "hourly"),
        "stream_to_bronze": f"SELECT coalesce({kind}, 'valid') AS outcome, count(*) AS records FROM events GROUP BY 1",
        "lake_commit": f"WITH o AS (SELECT coalesce({kind}, 'valid') AS outcome, count(*) AS records FROM events GROUP BY 1) SELECT * FROM o UNION ALL SELECT CASE outcome WHEN 'valid' THEN 'ledger ingested' ELSE 'ledger ' || outcome END, CAST(2 * records AS BIGINT) FROM o",
        "gold_build": _select("gold", "model n", "(SELECT 'fct_flows' AS model, count(*) AS n FROM fct UNION ALL SELECT 'ocsf_network_activity', count(*) FROM fct UNION ALL SELECT 'agg_traffic_hourly', count(*) FROM hourly UNION ALL SELECT 'stg_quarantine', count(*) FROM quarantine "
            "UNION ALL SELECT 'stg_network_zones', count(*) FROM ranges UNION ALL SELECT 'dim_hosts', count(*) FROM hosts UNION ALL SELECT 'dim_host_names', count(*) FROM versions UNION ALL SELECT 'dq_batches', count(*) FROM batches)"),
        "gold_checks": _select("gold", "table check severity violations", "(SELECT 'fct_flows' AS \"table\", 'expression(payload_bytes <= bytes_total)' AS \"check\", 'warn' AS severity, CAST(0 AS BIGINT) AS violations WHERE false UNION ALL SELECT 'dq_batches', 'expression(quarantine_rate <= 0.05)', 'warn', count(*) FROM batches WHERE quarantine_rate > 0.05 HAVING count(*) > 0)"),
        "ocsf_export": _select("fct", "day n bytes", "(SELECT CAST(CAST(last_seen AS DATE) AS VARCHAR) AS day, count(*) AS n, CAST(sum(bytes_total) AS BIGINT) AS bytes FROM fct GROUP BY 1)"),
        "contract": f"SELECT event_id AS record_index, {kind} AS error_type FROM events",
        "contract_first_error": f"SELECT {kind} AS error_type, count(*) AS records FROM events GROUP BY 1",
        "contract_bronze": _bronze(),
        "landing_files": f"SELECT 's1' AS sensor_id, 'json' AS suffix, count(DISTINCT (event_id % 20, event_id // {20 * 4000})) AS n FROM events WHERE event_id % 40 <> 4",
        "ingest_all": f"WITH e AS (SELECT *, {kind} AS kind FROM events WHERE event_id % 40 <> 4), d AS (SELECT count(DISTINCT (event_id % 20, event_id // {20 * 4000})) AS n FROM e) "
            "SELECT 'first ingested' AS outcome, n AS records FROM d UNION ALL SELECT 'again skipped', n FROM d UNION ALL SELECT coalesce(kind, 'valid'), count(*) FROM e GROUP BY 1",
        "changed_folders": f"WITH d AS (SELECT DISTINCT event_id % 20 AS k, event_id // {20 * 4000} AS part FROM events WHERE event_id % 40 <> 4), "
            "h AS (SELECT k % 2 AS half, count(*) AS n, count(*) + count(DISTINCT k) AS folders FROM d GROUP BY 1), o AS (SELECT sum(n) FILTER (WHERE half = 0) AS n0, sum(n) FILTER (WHERE half = 1) AS n1, sum(folders) FILTER (WHERE half = 0) AS f0, sum(folders) FILTER (WHERE half = 1) AS f1 FROM h) "
            "SELECT CAST(run AS BIGINT) AS run, CAST(CASE run WHEN 1 THEN n0 WHEN 2 THEN n1 ELSE 0 END AS BIGINT) AS ingested, CAST(0 AS BIGINT) AS others, "
            "CAST(CASE run WHEN 1 THEN f0 + 2 WHEN 2 THEN f1 + 2 ELSE 0 END AS BIGINT) AS listed, CAST(CASE run WHEN 1 THEN 0 WHEN 2 THEN f0 ELSE f0 + f1 + 2 END AS BIGINT) AS unchanged FROM (VALUES (1), (2), (3)) AS v(run), o",
        "ledger_compaction": "SELECT CASE WHEN event_id % 3 = 0 THEN 'rejected' ELSE 'ingested' END AS status, count(*) AS batches, CAST(sum(event_id % 7) AS BIGINT) AS records_written, CAST(sum(event_id % 5) AS BIGINT) AS records FROM events GROUP BY 1",
        "ingest_in_pieces": f"WITH e AS (SELECT *, {kind} AS kind FROM events WHERE event_id % 40 <> 4), d AS (SELECT count(DISTINCT (event_id % 20, event_id // {20 * 4000})) AS n FROM e) "
            "SELECT 'ingested' AS outcome, n AS records FROM d UNION ALL SELECT 'hashed alike', n FROM d UNION ALL SELECT coalesce(kind, 'valid'), count(*) FROM e GROUP BY 1",
        "retention": "WITH e AS (SELECT event_id % 20 AS k FROM events WHERE event_id % 40 > 11), d AS (SELECT CASE WHEN k = 2 THEN '2024-03-02' ELSE '2024-03-01' END AS ingest_date, count(*) AS n FROM e WHERE k IN (1, 2) OR k >= 10 GROUP BY 1) "
            "SELECT 'before' AS at, * FROM d UNION ALL SELECT 'after', * FROM d WHERE ingest_date = '2024-03-02'",
        "empty_lake": "SELECT t AS \"table\", CAST(0 AS BIGINT) AS n, events FROM (VALUES ('flows'), ('quarantine'), ('ledger')) AS v(t), (SELECT count(*) AS events FROM events)",
        "reference_tables": "SELECT CAST(user_id % 2 * 11 + 6 AS BIGINT) AS protocol, CAST(user_id AS BIGINT) AS port, 's, \"' || (user_id % 7) || '\"' AS service FROM (SELECT DISTINCT user_id FROM events)",
        "full_refresh": _select("fct", "loaded_at direction flows bytes", "(SELECT TIMESTAMP '2024-03-03 00:00:00' AS loaded_at, direction, count(*) AS flows, sum(bytes_total) AS bytes FROM fct GROUP BY ALL)"),
        "replay_dedupe": f"SELECT coalesce({kind}, 'valid') AS outcome, count(*) AS records FROM events GROUP BY 1",
        "drain_and_stop": "SELECT CAST(k AS BIGINT) AS run, CASE WHEN k < 2 THEN n ELSE n + m END AS records FROM (VALUES (0), (1), (2)) AS v(k), (SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 3 = 0) AS m FROM events)",
        "envelope_check": f"SELECT event_id, CASE WHEN event_id % 10 < 2 THEN 'unknown' ELSE 's1' END AS sensor_id, {envelope} AS envelope_error FROM events",
    }
