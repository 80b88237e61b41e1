"""Batch quality mart and data checks. A check returns the rows that violate a rule, with its name and severity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netquarry.functions.network import ipv4_to_int, normalized_ip


def dq_accepted(staged: DataFrame) -> DataFrame:
    return staged.groupBy("batch_id").agg(
        F.min("sensor_id").alias("sensor_id"), F.min("source").alias("source"), F.min("capture_file").alias("capture_file"), F.min("capture_completion_state").alias("capture_completion_state"),
        F.max("ingested_at").alias("ingested_at"), F.count("*").alias("records_accepted"), F.count_distinct("record_id").alias("distinct_records"),
    )


def dq_rejected(quarantine: DataFrame) -> DataFrame:
    """Counts and a map of error types for each batch."""
    by_type = quarantine.groupBy("batch_id", "error_type").agg(F.min("sensor_id").alias("sensor_id"), F.min("source").alias("source"), F.max("ingested_at").alias("ingested_at"), F.count("*").alias("n"))
    # as many pairs as there are error types
    reasons = F.map_from_entries(F.array_sort(F.collect_list(F.struct("error_type", "n"))))
    return by_type.groupBy("batch_id").agg(F.min("sensor_id").alias("sensor_id"), F.min("source").alias("source"), F.max("ingested_at").alias("ingested_at"), F.sum("n").alias("records_quarantined"), reasons.alias("quarantine_reasons"))


def dq_batches(staged: DataFrame, quarantine: DataFrame) -> DataFrame:
    a, r = dq_accepted(staged).alias("a"), dq_rejected(quarantine).alias("r")
    both = a.join(r, F.col("a.batch_id") == F.col("r.batch_id"), "full")
    either = lambda name: F.coalesce(f"a.{name}", f"r.{name}").alias(name)
    accepted, rejected = F.coalesce("a.records_accepted", F.lit(0)), F.coalesce("r.records_quarantined", F.lit(0))
    return both.select(
        either("batch_id"), either("sensor_id"), either("source"), "a.capture_file", "a.capture_completion_state",
        (F.coalesce("a.capture_completion_state", F.lit("complete")) != "complete").alias("capture_was_cut_short"), either("ingested_at"), accepted.alias("records_accepted"),
        rejected.alias("records_quarantined"), F.try_divide(rejected, accepted + rejected).alias("quarantine_rate"), "r.quarantine_reasons",
    )


def _violations(rows: DataFrame, check: str, severity: str) -> DataFrame:
    if severity not in ("error", "warn"):
        raise ValueError(f"severity {severity!r} is neither error nor warn")
    return rows.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), *rows.columns)


def check_not_null(df: DataFrame, column: str, severity: str = "error") -> DataFrame:
    return _violations(df.where(F.col(column).isNull()), f"not_null({column})", severity)


def check_unique(df: DataFrame, key: str | Column, severity: str = "error", name: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their count; null keys don't count."""
    key = F.expr(key) if isinstance(key, str) else key
    return _violations(df.select(key.cast("string").alias("key")).where("key is not null").groupBy("key").count().where("count > 1"), f"unique({name or 'key'})", severity)


def check_accepted_values(df: DataFrame, column: str, values: Sequence[object], severity: str = "error") -> DataFrame:
    """Null passes."""
    return _violations(df.where(~F.col(column).isin(*values)), f"accepted_values({column})", severity)


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> DataFrame:
    """Children whose key has no parent; null passes."""
    keys = parent.select(F.col(parent_column).alias("__parent")).distinct()
    return _violations(child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__parent"), "left_anti"), f"relationships({column})", severity)


def check_expression(df: DataFrame, expression: str, severity: str = "error") -> DataFrame:
    """Rows for which the expression is false; null passes."""
    return _violations(df.where(~F.expr(expression)), f"expression({expression})", severity)


def check_reconciliation(facts: DataFrame, hourly: DataFrame) -> DataFrame:
    """One row if flows, packets or bytes of the fact and the hourly table differ."""
    total = facts.agg(F.count("*").alias("fact_flows"), F.coalesce(F.sum("packets_total"), F.lit(0)).alias("fact_packets"), F.coalesce(F.sum("bytes_total"), F.lit(0)).alias("fact_bytes"))
    hours = hourly.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"hourly_{c}") for c in ("flows", "packets", "bytes")])
    # two single rows
    differ = total.join(hours, F.lit(True)).where("fact_flows <> hourly_flows or fact_packets <> hourly_packets or fact_bytes <> hourly_bytes")
    return _violations(differ, "reconciliation", "error")


def check_scd2(versions: DataFrame) -> DataFrame:
    """Versions that don't end where the next begins, and addresses without exactly one current version."""
    after = F.lead("valid_from").over(Window.partitionBy("ip").orderBy("version"))
    gaps = versions.withColumn("after", after).where("after is not null and not valid_to <=> after").select("ip", F.lit("not contiguous").alias("problem"))
    current = versions.groupBy("ip").agg(F.count_if("is_current").alias("n")).where("n <> 1").select("ip", F.lit("not exactly one current version").alias("problem"))
    return _violations(gaps.unionByName(current), "scd2", "error")


def _masks() -> dict[str, int]:
    """Prefix length by dotted mask: of hosts, and before these of networks."""
    dotted = lambda n: ".".join(str(n >> k & 255) for k in (24, 16, 8, 0))
    return {dotted((1 << 32 - p) - 1): p for p in range(33)} | {dotted((1 << 32) - (1 << 32 - p)): p for p in range(33)}


def validate_zones(zones: DataFrame) -> DataFrame:
    """zone, cidr, problem: empty names, malformed or IPv6 CIDRs, host bits, is_internal not set.

    A network is a dotted quad without leading zeros, alone or with a prefix length or a dotted mask.
    """
    quad, suffix = F.substring_index("cidr", "/", 1), F.regexp_extract("cidr", r"\A[^/]*/(.*)\z", 1)
    masks = F.create_map(*[F.lit(x) for pair in _masks().items() for x in pair])
    prefix = F.when(~F.contains("cidr", F.lit("/")), F.lit(32)).when(suffix.rlike(r"\A[0-9]{1,9}\z"), suffix.try_cast("int")).otherwise(F.try_element_at(masks, suffix))
    fits = ~F.contains("cidr", F.lit(":")) & normalized_ip(quad).isNotNull() & (prefix <= 32)
    n = ipv4_to_int(quad)
    host_bits = F.when(fits, n % F.pow(F.lit(2.0), 32 - prefix).cast("bigint") != 0)
    problems = F.filter(F.array(
        F.when(F.coalesce(F.length("zone"), F.lit(0)) == 0, "zone is empty"),
        F.when(~F.coalesce(fits, F.lit(False)), "cidr is not an IPv4 network"),
        F.when(host_bits, "cidr has host bits set"),
        F.when(F.col("is_internal").isNull(), "is_internal is neither true nor false"),
    ), lambda x: x.isNotNull())
    return zones.select("zone", "cidr", F.explode(problems).alias("problem"))


def validate_allowlist(allowlist: DataFrame, rules: DataFrame) -> DataFrame:
    """rule_id, src_ip, dst_ip, dst_port, problem."""
    address = lambda c: F.coalesce((F.col(c) == "*") | normalized_ip(F.col(c)).isNotNull(), F.lit(False))
    number = F.regexp_replace("dst_port", r"\A0+(?=.)", "")
    port = F.coalesce((F.col("dst_port") == "*") | number.rlike(r"\A[0-9]{1,5}\z") & (number.try_cast("int") <= 65535), F.lit(False))
    known = rules.select(F.col("rule_id").alias("__rule")).distinct()
    told = allowlist.join(known, F.col("rule_id") == F.col("__rule"), "left")
    problems = F.filter(F.array(
        F.when(F.col("__rule").isNull(), "rule_id is unknown"), F.when(~address("src_ip"), "src_ip is no address"),
        F.when(~address("dst_ip"), "dst_ip is no address"), F.when(~port, "dst_port is no port"),
    ), lambda x: x.isNotNull())
    return told.select("rule_id", "src_ip", "dst_ip", "dst_port", F.explode(problems).alias("problem"))
