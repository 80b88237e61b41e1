"""Raw flow records as JSON text from the `events` table, some of them broken by event_id arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.operators import contract

#: event_id % 40 of the broken records and their error types; the others are valid.
CASES = {
    0: "missing", 1: "int_type", 2: "less_than_equal", 3: "greater_than_equal", 4: "finite_number", 5: "string_too_short", 6: "literal_error", 7: "invalid_ip_address",
    8: "missing_event_time", 9: "time_reversed", 10: "totals_mismatch", 11: "ip_version_mismatch",
}
ENVELOPES = {0: "invalid_json", 1: "envelope_missing", 2: "envelope_literal_error", 3: "envelope_string_too_short"}

_K = "(event_id % 40)"
_SECONDS = "unix_seconds(CAST(ts AS TIMESTAMP))"
_TEXT = lambda x: f"CAST({x} AS STRING)"
RAW = "concat(" + ", ".join([
    "'{'", f"CASE WHEN {_K} = 0 THEN '' ELSE concat('\"flow_id\":', {_TEXT('event_id + 1')}, ',') END", "'\"ip_version\":'", f"CASE {_K} WHEN 6 THEN '5' WHEN 11 THEN '6' ELSE '4' END",
    "',\"protocol\":'", f"CASE {_K} WHEN 1 THEN '\"17\"' WHEN 2 THEN '300' ELSE '6' END", "',\"protocol_name\":\"TCP\",\"initiator\":{\"ip\":\"'",
    f"CASE {_K} WHEN 7 THEN '999.1.1.1' ELSE concat('10.20.1.', {_TEXT('user_id % 4')}) END", "'\",\"port\":40000},\"responder\":{\"ip\":\"198.51.100.40\",\"port\":443},\"initiator_basis\":\"'",
    f"CASE {_K} WHEN 5 THEN '' ELSE 'syn' END", "'\",\"first_seen\":'",
    f"CASE {_K} WHEN 8 THEN 'null' ELSE concat('{{\"unix_seconds\":', {_TEXT(_SECONDS)}, ',\"nanos\":1500,\"rfc3339\":\"x\"}}') END",
    "',\"last_seen\":{\"unix_seconds\":'", f"CASE {_K} WHEN 9 THEN {_TEXT(_SECONDS + ' - 5')} ELSE {_TEXT(_SECONDS + ' + 5')} END", "',\"nanos\":0,\"rfc3339\":\"x\"},\"duration_seconds\":'",
    f"CASE {_K} WHEN 4 THEN 'NaN' ELSE '5.0' END", "',\"first_packet_index\":0,\"last_packet_index\":9,\"initiator_to_responder\":{\"packets\":6,\"bytes\":'", _TEXT("100 + event_id"),
    "',\"payload_bytes\":10},\"responder_to_initiator\":{\"packets\":4,\"bytes\":50,\"payload_bytes\":10},\"packets_total\":'", f"CASE {_K} WHEN 3 THEN '0' ELSE '10' END", "',\"bytes_total\":'",
    f"CASE {_K} WHEN 10 THEN {_TEXT('151 + event_id')} ELSE {_TEXT('150 + event_id')} END", "',\"packet_size\":null,\"inter_arrival\":null,\"tcp\":'",
    f"CASE {_K} WHEN 13 THEN 'null' ELSE '{{\"state\":\"closed\",\"flags_initiator\":[\"SYN\"],\"flags_responder\":[],\"syn_packets\":1,\"fin_packets\":0,\"rst_packets\":0,\"duplicate_segments\":0}}' END",
    "',\"application\":{\"dns_queries\":[\"a.example\"]},\"dominant_endpoint\":\"initiator\",\"end_reason\":\"idle_timeout\"'", f"CASE {_K} WHEN 12 THEN ',\"new_field\":{{}}' ELSE '' END", "'}'",
]) + ")"
ENVELOPE = (
    "CASE event_id % 10 WHEN 0 THEN 'x{' ELSE concat('{\"contract_version\":', CASE event_id % 10 WHEN 2 THEN '2' ELSE '1' END, CASE event_id % 10 WHEN 1 THEN '' ELSE ',\"sensor_id\":\"s1\"' END, "
    "',\"capture_id\":\"', CASE event_id % 10 WHEN 3 THEN '' ELSE 'c1' END, '\",\"completion_state\":\"complete\",\"flow\":{\"flow_id\":', CAST(event_id AS STRING), '}}') END"
)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the file may be one row group, which is one task; ids go through the shuffle, not yet the texts
    events = contract.spread(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id"), "event_id")
    return events.select(
        F.expr(RAW).alias("raw"), F.col("event_id").alias("record_index"), F.expr("concat('b-', CAST(event_id % 20 AS STRING))").alias("batch_id"), F.lit("file").alias("source"), F.lit("s1").alias("sensor_id"),
        F.expr("concat('capture-', CAST(event_id % 20 AS STRING))").alias("capture_id"), F.lit(None).cast("string").alias("capture_file"), F.lit("complete").alias("completion_state"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )


def told(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.checked(raw(spark, sf_dir)).select("record_index", "error_type")


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.validate(raw(spark, sf_dir))[0]


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = contract.spread(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id"), "event_id").select("event_id", F.expr(ENVELOPE).alias("value"))
    return contract.decode_messages(messages).select("event_id", "sensor_id", "envelope_error")
