"""Flows as OCSF Network Activity events (class 4001, activity 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the OCSF 1.3 schema.
CONSTANTS = {
    "class_uid": 4001, "class_name": "Network Activity", "category_uid": 4, "category_name": "Network Activity", "activity_id": 6, "activity_name": "Traffic", "type_uid": 400106,
    "type_name": "Network Activity: Traffic", "severity_id": 1, "severity": "Informational",
}
DIRECTIONS = {"inbound": (1, "Inbound"), "outbound": (2, "Outbound"), "internal": (3, "Lateral")}


def network_activity(facts: DataFrame, product: str = "netquarry", vendor: str = "netquarry") -> DataFrame:
    c = F.col
    number, name = F.lit(0), F.lit("Unknown")
    for key, (n, text) in DIRECTIONS.items():
        number, name = F.when(c("direction") == key, n).otherwise(number), F.when(c("direction") == key, text).otherwise(name)
    return facts.select(
        *[F.lit(v).alias(k) for k, v in CONSTANTS.items()],
        F.unix_millis("last_seen").alias("time"), F.unix_millis("first_seen").alias("start_time"), F.unix_millis("last_seen").alias("end_time"), F.round(c("duration_seconds") * 1000).cast("bigint").alias("duration"),
        F.struct(c("initiator_ip").alias("ip"), c("initiator_port").alias("port")).alias("src_endpoint"),
        F.struct(c("responder_ip").alias("ip"), c("responder_port").alias("port"), c("responder_name").alias("hostname")).alias("dst_endpoint"),
        F.struct(c("protocol").alias("protocol_num"), F.lower("protocol_name").alias("protocol_name"), c("ip_version").alias("protocol_ver_id"), number.alias("direction_id"), name.alias("direction")).alias("connection_info"),
        F.struct(c("bytes_total").alias("bytes"), c("packets_total").alias("packets"), c("i2r_bytes").alias("bytes_out"), c("i2r_packets").alias("packets_out"), c("r2i_bytes").alias("bytes_in"), c("r2i_packets").alias("packets_in")).alias("traffic"),
        F.struct(F.lit("1.3.0").alias("version"), c("record_id").alias("uid"), F.struct(F.lit(product).alias("name"), F.lit(vendor).alias("vendor_name")).alias("product")).alias("metadata"),
    )


def flattened(events: DataFrame) -> DataFrame:
    """The events with one column for each leaf that varies."""
    return events.select(
        F.col("metadata.uid").alias("uid"), "class_uid", "activity_id", "type_uid", "time", "start_time", "duration", F.col("src_endpoint.ip").alias("src_ip"), F.col("dst_endpoint.ip").alias("dst_ip"),
        F.col("dst_endpoint.port").alias("dst_port"), F.col("dst_endpoint.hostname").alias("hostname"), "connection_info.protocol_name", "connection_info.direction_id", F.col("connection_info.direction").alias("direction"),
        F.col("traffic.bytes").alias("bytes"), "traffic.bytes_out", "traffic.packets_in",
    )


def export(facts: DataFrame, path: str, form: str = "parquet") -> None:
    """Write the events of the flow fact to `path`, below the day that each happened on, as Parquet or JSON lines."""
    if form not in ("parquet", "json"):
        raise ValueError(f"{form!r} is neither parquet nor json")
    events = network_activity(facts).withColumn("day", F.to_date(F.timestamp_millis("time")))
    events.write.mode("overwrite").option("compression", "zstd" if form == "parquet" else "gzip").partitionBy("day").format(form).save(path)
