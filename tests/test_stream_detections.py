"""Detections over a stream give the rows of the batch forms, whatever batches the flows come in."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from netquarry.operators import detections as batch
from netquarry.operators.serving import snapshot_difference
from netquarry.plans import registry
from netquarry.streaming import detections as stream

SF = "/root/testdata/sf0.001"
T = batch.Thresholds.of(
    port_scan_min_distinct_ports=2, port_scan_min_failed_ratio=0.1, beaconing_min_connections=3, beaconing_max_cv=9, beaconing_min_interval_seconds=0, beaconing_max_interval_seconds=86_400, exfiltration_min_bytes_out=1,
    exfiltration_min_upload_ratio=0.1, dns_tunneling_min_distinct_names=1, dns_tunneling_min_avg_label_length=1,
)


@pytest.fixture(scope="module")
def rows(spark):
    """The fact of sf0.001 with a steady and an unsteady connection, of several names and some null, over two days."""
    facts = registry.Lake(spark, SF).facts
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    made = spark.range(400).selectExpr(
        "CAST(id % 2 AS INT) AS port", "timestamp'2024-02-01 22:00:00' + make_dt_interval(0, 0, 0, CAST(id * 31 + (id % 2) * (id * 7919 % 29) AS DECIMAL(18, 6))) AS first_seen",
        "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('n', id % 3) END AS responder_name",
    )
    flows = made.selectExpr("'10.9.9.9' AS initiator_ip", "'8.8.4.4' AS responder_ip", "port AS responder_port", "first_seen", "first_seen AS last_seen", "to_date(first_seen) AS event_date", "date_trunc('hour', first_seen) AS flow_hour", "responder_name", "'outbound' AS direction", "17 AS protocol")
    yield facts.unionByName(flows.select(*[F.col(c).cast(k).alias(c) if c in flows.columns else F.lit(None).cast(k).alias(c) for c, k in facts.dtypes]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def streamed(spark, rows, path, make, runs):
    """The rows of a stream over the given runs' flows, each after a restart; the last flow is far later and closes the windows."""
    last = rows.limit(1).withColumns({"first_seen": F.lit(datetime(2030, 1, 1)), "initiator_ip": F.lit(None).cast("string"), "direction": F.lit("outbound"), "protocol": F.lit(17).cast(rows.schema["protocol"].dataType), "service": F.lit("dns"), "dns_queries": F.array(F.lit("x.y.z"))})
    for more in (*runs, last, last.withColumn("protocol", F.lit(6).cast(rows.schema["protocol"].dataType))):
        more.coalesce(2).write.mode("append").parquet(f"{path}/flows")
        facts = spark.readStream.schema(rows.schema).parquet(f"{path}/flows")
        make(facts).writeStream.option("checkpointLocation", f"{path}/checkpoint").format("parquet").option("path", f"{path}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


def rounded(df):
    return df.select(*[F.round(c, 5).alias(c) if k == "double" else F.col(c).cast("string").alias(c) for c, k in sorted(df.dtypes)])


def test_streams_give_the_rows_of_the_batch_forms(spark, rows, tmp_path):
    allowlist = spark.createDataFrame([("beaconing", "10.9.9.9", "*", "0")], "rule_id string, src_ip string, dst_ip string, dst_port string")
    days = [r[0] for r in rows.select("event_date").distinct().orderBy("event_date").collect()]
    cut = days[len(days) // 2]
    # the first run's flows come in any order, the second's are all later than the first's
    runs = [rows.where(F.col("event_date") < F.lit(cut)).orderBy(F.xxhash64("record_id", "first_seen")), rows.where(F.col("event_date") >= F.lit(cut))]
    pairs = {
        "beacons": (lambda f: stream.beacons(f, allowlist, T), batch.det_beaconing(rows, allowlist, T)),
        "scans": (lambda f: stream.port_scans(f, T), batch.det_port_scan(rows, T)),
        "uploads": (lambda f: stream.uploads(f, T), batch.det_exfiltration(rows, T)),
        "tunnels": (lambda f: stream.tunnels(f, T), batch.det_dns_tunneling(rows, T)),
    }
    for name, (make, expected) in pairs.items():
        found = streamed(spark, rows, f"{tmp_path}/{name}", make, runs)
        assert set(found.columns) == set(expected.columns), name
        want = rounded(expected)
        assert want.count() > 0, name
        assert snapshot_difference(rounded(found), want).collect() == [], name
        if name == "beacons":
            assert {r["dst_port"] for r in found.where("src_ip = '10.9.9.9'").collect()} == {1}


def test_days_of_another_time_zone_are_refused(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            stream.uploads(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
