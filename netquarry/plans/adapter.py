"""Flow-shaped data from the `events` table, for the registered queries; and the same as DuckDB text for their oracles.

Both engines read the same expressions; arrays are written as ARR(...) and rendered for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.operators import contract

_ID = "CAST(event_id AS STRING)"
#: (column, expression); derived from event_id, ts, user_id, event_type and value.
COLUMNS = (
    ("record_id", f"md5(concat('evt|', {_ID}))"),
    ("batch_id", "concat('b-', CAST(event_id % 20 AS STRING))"),
    ("source", "'file'"),
    ("sensor_id", "concat('sensor-', CAST(event_id % 3 AS STRING))"),
    ("capture_id", "concat('capture-', CAST(event_id % 20 AS STRING))"),
    ("capture_file", "CASE WHEN event_id % 20 < 15 THEN concat('c', CAST(event_id % 20 AS STRING), '.json') END"),
    ("capture_completion_state", "CASE WHEN event_id % 20 = 7 THEN 'packet_limit_reached' ELSE 'complete' END"),
    ("contract_version", "CAST(1 AS SMALLINT)"),
    ("ingest_date", "CAST(CAST(ts AS TIMESTAMP) + INTERVAL 1 DAY * CAST(event_id % 3 AS INT) AS DATE)"),
    ("ingested_at", "CAST(ts AS TIMESTAMP) + INTERVAL 1 DAY * CAST(event_id % 3 AS INT)"),
    ("flow_id", "event_id + 1"),
    ("ip_version", "CAST(4 AS TINYINT)"),
    ("protocol", "CAST(CASE WHEN event_id % 4 = 3 THEN 17 ELSE 6 END AS SMALLINT)"),
    ("protocol_name", "CASE WHEN event_id % 4 = 3 THEN 'UDP' WHEN event_id % 8 = 0 THEN NULL ELSE 'TCP' END"),
    ("initiator_ip", "CASE WHEN event_id % 10 = 9 THEN concat('203.0.113.', CAST(user_id % 7 AS STRING)) WHEN event_id % 25 = 4 THEN concat('fd00::', CAST(user_id % 9 AS STRING)) ELSE concat('10.20.1.', CAST(user_id % 4 AS STRING)) END"),
    ("initiator_port", "CAST(40000 + event_id % 20000 AS INT)"),
    ("responder_ip", "CASE event_type WHEN 'click' THEN concat('198.51.100.', CAST(10 + user_id % 2 AS STRING)) WHEN 'view' THEN '198.51.100.40' WHEN 'signup' THEN '10.10.0.20' WHEN 'purchase' THEN '203.0.113.66' ELSE concat('2001:db8::', CAST(user_id % 3 AS STRING)) END"),
    ("responder_port", "CAST(CASE WHEN event_id % 4 = 3 THEN 53 WHEN event_type IN ('click', 'view') THEN 443 WHEN event_type = 'purchase' THEN 8443 ELSE 1000 + event_id % 50 END AS INT)"),
    ("initiator_basis", "'first_packet'"),
    ("first_seen", "CAST(ts AS TIMESTAMP)"),
    ("last_seen", "CAST(ts AS TIMESTAMP) + INTERVAL 1 SECOND * CAST(event_id % 60 AS INT)"),
    ("duration_seconds", "CAST(event_id % 60 AS DOUBLE)"),
    ("i2r_packets", "1 + event_id % 11"),
    ("i2r_bytes", "CAST(floor(value * 1000) AS BIGINT)"),
    ("i2r_payload_bytes", "CAST(floor(value * 500) AS BIGINT)"),
    ("r2i_packets", "event_id % 9"),
    ("r2i_bytes", "CAST(floor(value * 100) AS BIGINT) * (event_id % 9)"),
    ("r2i_payload_bytes", "CAST(floor(value * 50) AS BIGINT) * (event_id % 9)"),
    ("packets_total", "1 + event_id % 11 + event_id % 9"),
    ("bytes_total", "CAST(floor(value * 1000) AS BIGINT) + CAST(floor(value * 100) AS BIGINT) * (event_id % 9)"),
    ("pkt_size_mean", "CAST(event_id % 1400 AS DOUBLE)"),
    ("pkt_size_stddev", "CAST(event_id % 300 AS DOUBLE)"),
    ("iat_mean_seconds", "CAST(event_id % 7 AS DOUBLE)"),
    ("iat_stddev_seconds", "CAST(event_id % 3 AS DOUBLE)"),
    ("tcp_state", "CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_type IN ('error', 'signup') AND event_id % 5 < 4 THEN 'reset' ELSE 'closed' END"),
    ("tcp_flags_initiator", "CASE WHEN event_id % 4 < 3 THEN ARR('SYN', 'ACK') END"),
    ("tcp_flags_responder", "CASE WHEN event_id % 4 < 3 THEN ARR('ACK') END"),
    ("tcp_rst_packets", "CASE WHEN event_id % 4 < 3 THEN event_id % 2 END"),
    ("app_protocols", "CASE WHEN event_id % 4 = 3 THEN ARR('dns') WHEN event_type IN ('click', 'view') THEN ARR('tls', 'http') ELSE CAST(ARR() AS STRINGS) END"),
    ("dns_queries", "CASE WHEN event_id % 4 = 3 THEN ARR(concat('q', CAST(event_id AS STRING), '-', event_type, '.t.Tunnel.example'), concat('www', CAST(user_id % 3 AS STRING), '.example.com')) ELSE CAST(ARR() AS STRINGS) END"),
    ("responder_dns_names", "CASE WHEN event_type = 'purchase' AND event_id % 6 = 1 THEN ARR('pay.example.net') ELSE CAST(ARR() AS STRINGS) END"),
    ("http_hosts", "CASE WHEN event_type = 'click' THEN ARR(concat('www', CAST(user_id % 2 AS STRING), '.example.com:8080')) ELSE CAST(ARR() AS STRINGS) END"),
    ("http_paths", "CASE WHEN event_type = 'click' THEN ARR('/') ELSE CAST(ARR() AS STRINGS) END"),
    ("tls_server_names", "CASE WHEN event_type = 'view' THEN ARR(CASE WHEN CAST(ts AS TIMESTAMP) < TIMESTAMP '2024-01-16 00:00:00' THEN 'crm.example.com' ELSE 'status.example.org' END) ELSE CAST(ARR() AS STRINGS) END"),
    ("dominant_endpoint", "CASE WHEN event_id % 9 > 5 THEN 'responder' ELSE 'initiator' END"),
    ("end_reason", "'idle_timeout'"),
)
#: Rows with event_id % 50 = 0 come a second time, a day later: a replay.
REPLAYED = 50


def bronze(spark: SparkSession, sf_dir: str, replay: bool = True) -> DataFrame:
    """Bronze-shaped flows of every event, with replayed rows."""
    # the file may be one row group, and what follows has no shuffle of rows: all of it would be one task
    events = contract.spread(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id")
    render = lambda e: e.replace("ARR(", "array(").replace("STRINGS", "array<string>")
    flows = events.select(*[F.expr(render(e)).alias(c) for c, e in COLUMNS]).withColumn(
        "flow_warnings", F.when(F.col("flow_id") % 13 == 0, F.array(F.struct(F.lit("truncated").alias("code"), F.lit(1).cast("bigint").alias("count")))).otherwise(F.array().cast("array<struct<code:string,count:bigint>>"))
    )
    if not replay:
        return flows
    again = flows.where((F.col("flow_id") - 1) % REPLAYED == 0)
    later = {"ingested_at": F.col("ingested_at") + F.expr("interval 1 day"), "ingest_date": F.date_add("ingest_date", 1), "batch_id": F.concat(F.lit("r-"), "batch_id")}
    return flows.unionByName(again.withColumns(later))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine-shaped rows: events of a value above 120."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("value > 120")
    return events.select(*[F.expr(e).alias(c) for c, e in QUARANTINE])


QUARANTINE = (
    ("batch_id", "concat('b-', CAST(event_id % 23 AS STRING))"),
    ("record_index", "event_id"),
    ("source", "'file'"),
    ("sensor_id", "concat('sensor-', CAST(event_id % 3 AS STRING))"),
    ("capture_id", "concat('capture-', CAST(event_id % 23 AS STRING))"),
    ("ingest_date", "CAST(CAST(ts AS TIMESTAMP) AS DATE)"),
    ("ingested_at", "CAST(ts AS TIMESTAMP)"),
    ("error_type", "CASE event_id % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'totals_mismatch' WHEN 2 THEN 'time_reversed' ELSE 'int_type' END"),
    ("error_message", "concat('event ', CAST(event_id AS STRING))"),
    ("raw_record", "props"),
)


def duckdb_bronze() -> str:
    """CTEs `bronze` and `quarantine`."""
    render = lambda e: e.replace("ARR(", "list_value(").replace("STRINGS", "VARCHAR[]")
    once = ", ".join(f"{render(e)} AS {c}" for c, e in COLUMNS)
    return (
        f"once AS (SELECT {once}, CASE WHEN (event_id + 1) % 13 = 0 THEN 1 ELSE 0 END AS n_warnings FROM events), "
        f"bronze AS (SELECT * FROM once UNION ALL SELECT * REPLACE (ingested_at + INTERVAL 1 DAY AS ingested_at, CAST(ingest_date + INTERVAL 1 DAY AS DATE) AS ingest_date, concat('r-', batch_id) AS batch_id) FROM once WHERE (flow_id - 1) % {REPLAYED} = 0), "
        f"quarantine AS (SELECT {', '.join(f'{e} AS {c}' for c, e in QUARANTINE)} FROM events WHERE value > 120)"
    )
