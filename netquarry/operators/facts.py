"""Staging and the flow fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netquarry.functions import network as N
from netquarry.operators.zones import zone_lookup
from netquarry.sources.lake import stored

STAGED = (
    "record_id batch_id source sensor_id capture_id capture_file capture_completion_state contract_version ingest_date ingested_at flow_id ip_version protocol protocol_name "
    "initiator_ip initiator_port responder_ip responder_port initiator_basis first_seen last_seen flow_hour event_date duration_seconds i2r_packets i2r_bytes i2r_payload_bytes "
    "r2i_packets r2i_bytes r2i_payload_bytes packets_total bytes_total pkt_size_mean pkt_size_stddev iat_mean_seconds iat_stddev_seconds tcp_state tcp_flags_initiator "
    "tcp_flags_responder tcp_rst_packets app_protocols app_protocol dns_queries responder_dns_names http_hosts http_paths tls_server_names responder_name dominant_endpoint "
    "end_reason flow_warnings has_warnings"
).split()
FACT = (
    "record_id sensor_id capture_id capture_file capture_completion_state flow_id event_date flow_hour first_seen last_seen duration_seconds ip_version protocol protocol_name "
    "initiator_ip initiator_port initiator_zone initiator_is_internal responder_ip responder_port responder_zone responder_is_internal direction service app_protocol "
    "responder_name i2r_packets i2r_bytes r2i_packets r2i_bytes packets_total bytes_total payload_bytes pkt_size_mean iat_mean_seconds iat_stddev_seconds tcp_state "
    "tcp_flags_initiator tcp_flags_responder dominant_endpoint end_reason dns_queries http_hosts http_paths tls_server_names app_protocols has_warnings flow_warnings batch_id "
    "source ingested_at loaded_at"
).split()


def stage_flows(bronze: DataFrame) -> DataFrame:
    """Bronze flows with their derived columns; a projection only, so filters reach the scan."""
    derived = {
        "protocol_name": N.protocol_name(F.col("protocol_name"), F.col("protocol")),
        "flow_hour": F.date_trunc("hour", "first_seen"),
        "event_date": F.to_date("first_seen"),
        "app_protocol": N.app_protocol(F.col("app_protocols")),
        "responder_name": N.responder_name(F.col("tls_server_names"), F.col("http_hosts"), F.col("responder_dns_names")),
        "has_warnings": F.size("flow_warnings") > 0,
    }
    return bronze.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in STAGED])


def stage_quarantine(quarantine: DataFrame) -> DataFrame:
    return quarantine.select("batch_id", "record_index", "source", "sensor_id", "capture_id", "ingest_date", "ingested_at", "error_type", "error_message", "raw_record")


def dedupe_latest(flows: DataFrame) -> DataFrame:
    """One row for each record_id: the one ingested last, of equals the largest batch_id.

    Only hashes of ids are counted over all rows. Ids whose hash occurs once, nearly all, need no order; the whole rows of the
    others alone are brought together and sorted, by their ids. These hashes are a table first: Spark knows its size then, and
    while it is small the rows stay where they are.
    """
    hashed = F.when(F.col("record_id").isNotNull(), F.xxhash64("record_id"))
    again = stored(flows.groupBy(hashed.alias("__id")).agg(F.count("*").alias("__n")).where("__n > 1 and __id is not null").select("__id"), "again")
    newest = Window.partitionBy("record_id").orderBy(F.desc("ingested_at"), F.desc("batch_id"))
    latest = flows.join(again, hashed == F.col("__id"), "left_semi").withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")
    return flows.join(again, hashed == F.col("__id"), "left_anti").unionByName(latest)


def addresses(flows: DataFrame) -> DataFrame:
    """ip: the distinct addresses of both roles, in one pass over the flows."""
    return flows.select(F.explode(F.array("initiator_ip", "responder_ip")).alias("ip")).where("ip is not null").distinct()


def attach_zones(flows: DataFrame, address_zones: DataFrame) -> DataFrame:
    for role in ("initiator", "responder"):
        named = address_zones.select(F.col("ip").alias(f"{role}_ip"), F.col("zone").alias(f"{role}_zone"), F.col("is_internal").alias(f"{role}_is_internal"))
        flows = flows.join(named, f"{role}_ip")
    return flows


def attach_services(flows: DataFrame, services: DataFrame) -> DataFrame:
    """service: by the responder's port, else by the initiator's, else `other`."""
    # at most one row for each port and protocol; joined by shuffles, all flows to one busy port would be one task's
    for role in ("responder", "initiator"):
        named = F.broadcast(services).select(F.col("protocol").alias("__p"), F.col("port").alias("__n"), F.col("service").alias(f"__{role}_service"))
        flows = flows.join(named, (F.col("__p") == F.col("protocol")) & (F.col("__n") == F.col(f"{role}_port")), "left").drop("__p", "__n")
    return flows.withColumn("service", F.coalesce("__responder_service", "__initiator_service", F.lit("other"))).drop("__responder_service", "__initiator_service")


def fct_flows(staged: DataFrame, zones: DataFrame, services: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """The flow fact of staged rows: deduplicated, classified by zone, direction and service."""
    rows = dedupe_latest(staged)
    classified = attach_services(attach_zones(rows, zone_lookup(addresses(staged), zones)), services)
    stamped = classified.withColumns({
        "direction": N.direction(F.col("initiator_is_internal"), F.col("responder_is_internal")),
        "payload_bytes": F.col("i2r_payload_bytes") + F.col("r2i_payload_bytes"),
        "loaded_at": F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp(),
    })
    return stamped.select(*FACT)


def agg_traffic_hourly(facts: DataFrame) -> DataFrame:
    """Traffic by hour, direction, protocol and service.

    The two distinct counts run as one aggregation over rows that are distinct by both addresses first; no row expansion.
    """
    keys = ["flow_hour", "direction", "protocol_name", "service"]
    sums = {"flows": F.count("*"), "packets": F.sum("packets_total"), "bytes": F.sum("bytes_total"), "bytes_from_initiators": F.sum("i2r_bytes"), "bytes_from_responders": F.sum("r2i_bytes"), "max_loaded_at": F.max("loaded_at")}
    pairs = facts.groupBy(*keys, "initiator_ip", "responder_ip").agg(*[c.alias(n) for n, c in sums.items()])
    whole = [(F.max(n) if n == "max_loaded_at" else F.sum(n)).alias(n) for n in sums]
    out = pairs.groupBy(*keys).agg(*whole, F.count_distinct("initiator_ip").alias("distinct_initiators"), F.count_distinct("responder_ip").alias("distinct_responders"))
    return out.select(F.col("flow_hour").alias("hour_start"), "direction", "protocol_name", "service", "flows", "packets", "bytes", "bytes_from_initiators", "bytes_from_responders", "distinct_initiators", "distinct_responders", "max_loaded_at")
