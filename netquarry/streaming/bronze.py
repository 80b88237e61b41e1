"""Flow messages from a stream into the lake.

Any streaming DataFrame with `value` will do (Kafka, files); with topic, partition and offset a batch is known by its
offset ranges, so a replayed batch is skipped. Offsets are committed by the checkpoint after files and ledger: at least
once, and the fact's dedupe on record_id makes it once in effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netquarry.operators import contract
from netquarry.sources import lake as L


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int = 50_000) -> DataFrame:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "kafka.isolation.level": "read_committed", "maxOffsetsPerTrigger": str(per_trigger)}
    return spark.readStream.format("kafka").options(**options).load()


def encode_messages(documents: DataFrame) -> DataFrame:
    """(key, value) of each flow of capture documents: `sensor|capture` and a JSON envelope."""
    flows = documents.where("status = 'valid'").select("sensor_id", "capture_id", "capture_file", "completion_state", F.explode("flows").alias("flow"))
    # the flow is JSON text already and goes in as it is
    head = F.to_json(F.struct(F.lit(1).alias("contract_version"), "sensor_id", "capture_id", "capture_file", "completion_state"))
    value = F.concat(F.expr("left(h, length(h) - 1)"), F.lit(',"flow":'), "flow", F.lit("}"))
    return flows.withColumn("h", head).select(F.concat_ws("|", "sensor_id", "capture_id").alias("key"), value.alias("value"))


def stream_batch_id(batch: DataFrame, batch_number: int, name: str) -> str:
    """By topic and offset ranges, else by query and number."""
    if {"topic", "partition", "offset"} <= set(batch.columns):
        ranges = batch.groupBy("topic", "partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
        text = F.concat("topic", F.lit("|"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("partition", "lo", "hi"))), lambda r: F.concat_ws("", r["partition"], F.lit(":"), r["lo"], F.lit("-"), r["hi"])), ";"))
        row = ranges.groupBy("topic").agg(text.alias("t")).orderBy("topic").agg(F.array_join(F.collect_list("t"), "&").alias("t"), F.min("topic").alias("topic")).select(F.regexp_replace("topic", "[^A-Za-z0-9._-]", "_"), F.substring(F.sha2("t", 256), 1, 24)).first()
        return f"kafka-{row[0]}-{row[1]}"
    return f"stream-{name}-{batch_number}"


def write_batch(batch: DataFrame, batch_number: int, lake: str, name: str) -> None:
    """Check one micro-batch and write it, unless the ledger has it."""
    spark = batch.sparkSession
    batch_id = stream_batch_id(batch, batch_number, name)
    if not L.table(spark, lake, "ledger").where(F.col("batch_id") == batch_id).isEmpty():
        return
    order = "offset" if "offset" in batch.columns else None
    index = F.col(order) if order else F.xxhash64("value").bitwiseAND(F.lit((1 << 62) - 1))
    raw = contract.decode_messages(batch, as_text=False).select(
        F.lit(batch_id).alias("batch_id"), F.lit("stream").alias("source"), "sensor_id", "capture_id", "capture_file", "completion_state", F.current_timestamp().alias("ingested_at"), index.alias("record_index"), "raw", "flow", "bare", "envelope_error"
    )
    told = contract.checked(raw)
    # a bad envelope is the error, whatever the text looks like as a flow
    told = told.withColumn("error_type", F.coalesce("envelope_error", "error_type"))
    row = spark.createDataFrame([(batch_id, "stream", f"{name}/{batch_number}", None, "ingested", None)], "batch_id string, source string, input_ref string, sensor_id string, status string, reason string")
    L.commit(told, row, lake)


def without_replays(stream: DataFrame, time: str, within: str) -> DataFrame:
    """The stream without messages whose value came before, within the given time by their column `time`.

    The state has a digest for each message of that time and goes with the watermark; it is part of the checkpoint, so a
    replay after a restart is known too. What is replayed later is still once in the fact, by record_id.
    """
    kept = stream.columns
    marked = stream.withColumn("__digest", F.sha2(F.col("value").cast("binary"), 256)).withWatermark(time, within)
    return marked.dropDuplicatesWithinWatermark(["__digest"]).select(*kept)


def stream_to_bronze(stream: DataFrame, lake: str, checkpoint: str, name: str = "flows", available_now: bool = False, seconds: int = 5, time: str | None = None, within: str = "1 hour") -> StreamingQuery:
    """Start the stream; available_now: drain what is there and stop; time: the column by which replays are left out."""
    if time is not None:
        stream = without_replays(stream, time, within)
    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: write_batch(df, n, lake, name))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")).start()


def windowed_scans(facts: DataFrame, min_distinct_ports: int = 50, lateness: str = "1 hour") -> DataFrame:
    """Streaming form of the port-scan windows: TCP flows by source, destination and hour, with a watermark. Distinct ports are exact."""
    tcp = facts.where("protocol = 6").withWatermark("first_seen", lateness)
    grouped = tcp.groupBy(F.window("first_seen", "1 hour"), "initiator_ip", "responder_ip").agg(F.size(F.collect_set("responder_port")).alias("distinct_ports"), F.count("*").alias("flows"))
    return grouped.where(F.col("distinct_ports") >= min_distinct_ports).select(F.col("initiator_ip").alias("src_ip"), F.col("responder_ip").alias("dst_ip"), "window.start", "window.end", "distinct_ports", "flows")
