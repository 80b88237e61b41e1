"""Reference tables: zones, services, detection rules, techniques, allowlist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The default contents of the reference tables; descriptions are free text that no query reads.
ZONES = (
    ("private", "10.0.0.0/8", True, "site addresses"),
    ("private", "172.16.0.0/12", True, "site addresses"),
    ("private", "192.168.0.0/16", True, "site addresses"),
    ("link_local", "169.254.0.0/16", True, "self-assigned"),
    ("loopback", "127.0.0.0/8", True, "the host itself"),
)
SITE_ZONES = (
    ("hq_workstations", "10.20.0.0/16", True, "desks at the main site"),
    ("branch_workstations", "10.30.0.0/16", True, "desks at the branches"),
    ("servers", "10.10.0.0/24", True, "machine room of the main site"),
    ("private", "10.0.0.0/8", True, "the rest of the site"),
    ("private", "172.16.0.0/12", True, "site addresses"),
    ("private", "192.168.0.0/16", True, "site addresses"),
)
SERVICES = (
    (6, 22, "ssh"), (6, 25, "smtp"), (17, 53, "dns"), (6, 53, "dns"), (17, 67, "dhcp"), (17, 68, "dhcp"), (6, 80, "http"),
    (6, 88, "kerberos"), (17, 88, "kerberos"), (17, 123, "ntp"), (6, 135, "msrpc"), (6, 139, "netbios"), (6, 389, "ldap"),
    (6, 443, "https"), (17, 443, "quic"), (6, 445, "smb"), (6, 636, "ldaps"), (6, 3389, "rdp"), (6, 8080, "http-alt"), (6, 8443, "https-alt"),
)
RULES = (
    ("port_scan", "Port scan", "medium", "T1046", "many ports of one target tried in vain within the hour"),
    ("beaconing", "Periodic beaconing", "high", "T1071.001", "connections to one outside endpoint as if by the clock"),
    ("dns_tunneling", "DNS tunneling", "high", "T1071.004", "long names under one domain, each asked for once or so"),
    ("exfiltration", "Large outbound transfer", "critical", "T1048", "a day's upload to one outside target that is large and one-way"),
)
TECHNIQUES = (
    ("T1046", "Network Service Discovery", "Discovery"),
    ("T1071.001", "Application Layer Protocol: Web Protocols", "Command and Control"),
    ("T1071.004", "Application Layer Protocol: DNS", "Command and Control"),
    ("T1048", "Exfiltration Over Alternative Protocol", "Exfiltration"),
)
ALLOWLIST = (("beaconing", "*", "*", "123", "clocks are set at regular intervals"),)

SCHEMAS = {
    "network_zones": "zone string, cidr string, is_internal boolean, description string",
    "service_ports": "protocol smallint, port int, service string",
    "detection_rules": "rule_id string, rule_name string, severity string, mitre_technique_id string, description string",
    "mitre_techniques": "technique_id string, technique_name string, tactic string",
    "detection_allowlist": "rule_id string, src_ip string, dst_ip string, dst_port string, reason string",
}
DEFAULTS = {"network_zones": ZONES, "service_ports": SERVICES, "detection_rules": RULES, "mitre_techniques": TECHNIQUES, "detection_allowlist": ALLOWLIST}


def reference_table(spark: SparkSession, name: str, rows: tuple | None = None, path: str | None = None) -> DataFrame:
    """One reference table: of the CSV file at `path` (with a header), of `rows`, or the defaults."""
    if path:
        return spark.read.csv(path, header=True, schema=SCHEMAS[name], mode="FAILFAST", escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return spark.createDataFrame(list(DEFAULTS[name] if rows is None else rows), SCHEMAS[name])
