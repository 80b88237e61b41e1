"""Schemas of the stored tables."""

from __future__ import annotations

BRONZE = """
record_id string not null, batch_id string not null, source string not null, sensor_id string not null, capture_id string not null, capture_file string,
capture_completion_state string not null, contract_version smallint, ingested_at timestamp, flow_id bigint, ip_version tinyint, protocol smallint, protocol_name string,
initiator_ip string, initiator_port int, responder_ip string, responder_port int, initiator_basis string, first_seen timestamp, last_seen timestamp, duration_seconds double,
first_packet_index bigint, last_packet_index bigint, i2r_packets bigint, i2r_bytes bigint, i2r_payload_bytes bigint, r2i_packets bigint, r2i_bytes bigint, r2i_payload_bytes bigint,
packets_total bigint, bytes_total bigint, pkt_size_min double, pkt_size_max double, pkt_size_mean double, pkt_size_stddev double, pkt_size_median double, pkt_size_median_exact boolean,
iat_min_seconds double, iat_max_seconds double, iat_mean_seconds double, iat_stddev_seconds double, tcp_state string, tcp_flags_initiator array<string>, tcp_flags_responder array<string>,
tcp_syn_packets bigint, tcp_fin_packets bigint, tcp_rst_packets bigint, tcp_duplicate_segments bigint, app_protocols array<string>, dns_queries array<string>,
responder_dns_names array<string>, http_hosts array<string>, http_paths array<string>, tls_server_names array<string>, tls_alpn array<string>, dominant_endpoint string, end_reason string,
flow_warnings array<struct<code: string, count: bigint>>, upstream_alert_ids array<bigint>
"""
QUARANTINE = "batch_id string, record_index bigint, source string, sensor_id string, capture_id string, ingested_at timestamp, error_type string, error_message string, raw_record string"
LEDGER = "batch_id string, status string, source string, input_ref string, sensor_id string, records_written bigint, records_quarantined bigint, reasons map<string, bigint>, reason string, files array<string>, modified timestamp, finished_at timestamp, commit string"
EVIDENCE_LIMIT = 16_384
MESSAGE_LIMIT = 1_000
