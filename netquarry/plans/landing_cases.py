"""Landing files, documents and messages made from the `events` table, for the queries of the sources; and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.operators import serving
from netquarry.sources import captures
from netquarry.streaming import bronze

_ID = "CAST(event_id AS STRING)"
PATH = f"concat('/landing/', CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'sensor=s1/' WHEN 2 THEN concat('sensor=a.b/x/sensor=s', CAST(event_id % 3 AS STRING), '/') ELSE 'x/sensor=late/y/' END, 'f', {_ID}, '.json')"
SENSOR = "CASE event_id % 4 WHEN 0 THEN 'default' WHEN 1 THEN 's1' WHEN 2 THEN concat('s', CAST(event_id % 3 AS STRING)) ELSE 'late' END"
#: Broken JSON, an error document, another document, one with a bare NaN beside a text that looks like one, and plain ones.
TEXT = (
    "CASE event_id % 5 WHEN 0 THEN '{\"flows\": [' WHEN 1 THEN '{\"error\": {\"code\": \"bad_magic\", \"category\": \"c\", \"message\": \"m\"}}' WHEN 2 THEN '{\"flows\": 5}' "
    f"WHEN 3 THEN concat('{{\"capture\": {{\"file_name\": \"a.pcap\"}}, \"completion_state\": \"complete\", \"flows\": [{{\"id\":', {_ID}, ',\"x\":NaN,\"t\":\"path: NaN, z\"}}]}}') "
    f"ELSE concat('{{\"capture\": {{\"file_name\": \"b.pcap\"}}, \"completion_state\": \"complete\", \"flows\": [{{\"id\":', {_ID}, '}},{{\"id\":0}}]}}') END"
)
ERROR = "CASE event_id % 5 WHEN 0 THEN 'not valid JSON' WHEN 1 THEN 'upstream error: bad_magic' WHEN 2 THEN 'not a flows document' END"
FLOW_COUNT = "CASE event_id % 5 WHEN 3 THEN 1 WHEN 4 THEN 2 END"
MAGIC = "CASE event_id % 5 WHEN 0 THEN 'D4C3B2A1' WHEN 1 THEN 'A1B23C4D' WHEN 2 THEN '0A0D0D0A' WHEN 3 THEN 'A1B2C3D4' ELSE '00000000' END"
FORMAT = "CASE event_id % 5 WHEN 2 THEN 'pcapng' WHEN 4 THEN 'unknown' ELSE 'pcap' END"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures.capture_documents(_events(spark, sf_dir).select(F.expr(PATH).alias("path"), F.expr(f"CAST({TEXT} AS BINARY)").alias("content")))


def sensor_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", captures.sensor_from_path(F.expr(PATH)).alias("sensor_id"))


def document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("path", "sensor_id", "batch_id", "status", "error", F.when(F.col("status") == "valid", F.size("flows")).alias("n"))


def stream_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.encode_messages(_documents(spark, sf_dir)).select("key", "value")


def stream_batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of all events as one batch of two topics."""
    batch = _events(spark, sf_dir).select(F.expr("concat('t.', CAST(event_id % 2 AS STRING))").alias("topic"), F.expr("CAST(event_id % 3 AS INT)").alias("partition"), F.col("event_id").alias("offset"))
    return spark.createDataFrame([(bronze.stream_batch_id(batch, 0, "n"),)], "batch_id string")


def capture_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.concat(F.unhex(F.expr(MAGIC)), F.expr(f"CAST({_ID} AS BINARY)"))
    files = _events(spark, sf_dir).select(F.concat(F.lit("/c/"), F.col("event_id").cast("string"), F.lit(".cap")).alias("path"), F.octet_length(content).cast("long").alias("length"), content.alias("content"))
    return captures.capture_inventory(files)


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.expr("CASE event_id % 4 WHEN 0 THEN 'rejected' ELSE 'ingested' END").alias("status")
    return serving.batch_summary(_events(spark, sf_dir).select(status, (F.col("event_id") % 7).alias("records_written"), (F.col("event_id") % 3).alias("records_quarantined"))).withColumnRenamed("records_quarantined", "records")


QUERIES = {f.__name__: f for f in (sensor_from_path, document_status, stream_encode, stream_batch_id, capture_inventory, batch_summary)}


def oracle_sql() -> dict[str, str]:
    docs = f"d AS (SELECT event_id, {PATH} AS path, {SENSOR} AS sensor_id, {TEXT} AS t, {ERROR} AS error, {FLOW_COUNT} AS n FROM events)"
    flow = "unnest(CASE event_id % 5 WHEN 3 THEN ['{\"id\":' || event_id || ',\"x\":NaN,\"t\":\"path: NaN, z\"}'] ELSE ['{\"id\":' || event_id || '}', '{\"id\":0}'] END)"
    head = "'{\"contract_version\":1,\"sensor_id\":\"' || sensor_id || '\",\"capture_id\":\"sha256:' || sha256(t) || '\",\"capture_file\":\"' || CASE event_id % 5 WHEN 3 THEN 'a' ELSE 'b' END || '.pcap\",\"completion_state\":\"complete\",\"flow\":'"
    return {
        "sensor_from_path": f"SELECT event_id, {SENSOR} AS sensor_id FROM events",
        "document_status": f"WITH {docs} SELECT path, sensor_id, concat('file-', substr(sha256(sensor_id || ':' || sha256(t)), 1, 32)) AS batch_id, CASE WHEN error IS NULL THEN 'valid' ELSE 'rejected' END AS status, error, CAST(n AS BIGINT) AS n FROM d",
        "stream_encode": f"WITH {docs}, f AS (SELECT event_id, sensor_id, t, {flow} AS flow FROM d WHERE error IS NULL) SELECT sensor_id || '|sha256:' || sha256(t) AS key, {head} || flow || '}}' AS value FROM f",
        "stream_batch_id": "WITH r AS (SELECT 't.' || (event_id % 2) AS topic, event_id % 3 AS p, min(event_id) AS lo, max(event_id) AS hi FROM events GROUP BY ALL), t AS (SELECT topic, topic || '|' || string_agg(p || ':' || lo || '-' || hi, ';' ORDER BY p) AS t FROM r GROUP BY topic) "
            "SELECT 'kafka-' || min(topic) || '-' || substr(sha256(string_agg(t, '&' ORDER BY topic)), 1, 24) AS batch_id FROM t",
        "capture_inventory": f"SELECT '/c/' || event_id || '.cap' AS path, CAST(4 + length(CAST(event_id AS VARCHAR)) AS BIGINT) AS length, sha256(unhex({MAGIC}) || encode(CAST(event_id AS VARCHAR))) AS sha256, {FORMAT} AS format FROM events",
        "batch_summary": "SELECT CASE event_id % 4 WHEN 0 THEN 'rejected' ELSE 'ingested' END AS status, count(*) AS batches, CAST(sum(event_id % 7) AS BIGINT) AS records_written, CAST(sum(event_id % 3) AS BIGINT) AS records FROM events GROUP BY 1",
    }
