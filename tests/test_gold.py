"""The stored gold models: built once, kept up by what is new, and checked."""

from datetime import datetime

from pyspark.sql import functions as F

from netquarry.operators import facts, gold, ocsf
from netquarry.operators.detections import Thresholds
from netquarry.operators.serving import snapshot_difference
from netquarry.plans import adapter, stored

SF = "/root/testdata/sf0.001"
OPEN = Thresholds.of(
    port_scan_min_distinct_ports=3, port_scan_min_failed_ratio=0.6, beaconing_min_connections=8, beaconing_max_cv=0.8, beaconing_max_interval_seconds=86_400, exfiltration_min_bytes_out=300_000,
    exfiltration_min_upload_ratio=0.7, dns_tunneling_min_distinct_names=2, dns_tunneling_min_avg_label_length=6,
)


def test_late_rows_give_what_a_full_refresh_gives(spark, tmp_path):
    inputs, rows = stored._inputs(spark, SF), adapter.bronze(spark, SF)
    one, other = f"{tmp_path}/one", f"{tmp_path}/other"
    early, late = rows.where("ingested_at < '2024-01-20'"), rows
    gold.build(spark, inputs | {"flows": early}, one, datetime(2024, 3, 1), OPEN)
    by_steps = gold.build(spark, inputs | {"flows": late}, one, datetime(2024, 3, 2), OPEN)
    at_once = gold.build(spark, inputs | {"flows": late}, other, datetime(2024, 3, 2), OPEN)
    for name in ("fct_flows", "agg_traffic_hourly", "dim_hosts", "dim_host_names", "fct_alerts", "dq_batches"):
        drop = ("loaded_at", "max_loaded_at", "quarantine_reasons", "flow_warnings")
        assert snapshot_difference(by_steps(name).drop(*drop), at_once(name).drop(*drop)).isEmpty(), name
    assert at_once("fct_alerts").count() > 0
    failed = {(r["table"], r["check"]): r["severity"] for r in gold.run_checks(at_once).collect()}
    assert set(failed.values()) <= {"warn"}
    broken = at_once("dim_hosts").withColumn("flows", F.col("flows") + 1)
    told = gold.run_checks(lambda name: broken if name == "dim_hosts" else at_once(name)).where("severity = 'error'").collect()
    assert [(r["table"], r["violations"]) for r in told] == [("dim_hosts", broken.count())]


def test_a_day_that_rows_left_is_counted_anew(spark, tmp_path):
    rows = adapter.bronze(spark, SF, replay=False).where("flow_id <= 40")
    inputs = stored._inputs(spark, SF)
    first = gold.build(spark, inputs | {"flows": rows}, f"{tmp_path}/g", datetime(2024, 3, 1))
    day = first("fct_flows").agg(F.min("event_date")).first()[0]
    moved = rows.where(F.to_date("first_seen") == F.lit(day))
    later = {"first_seen": F.col("first_seen") + F.expr("interval 300 days"), "last_seen": F.col("last_seen") + F.expr("interval 300 days"), "ingested_at": F.lit("2024-03-05").cast("timestamp"), "ingest_date": F.lit("2024-03-05").cast("date")}
    again = gold.build(spark, inputs | {"flows": rows.unionByName(moved.withColumns(later))}, f"{tmp_path}/g", datetime(2024, 3, 6))
    assert again("fct_flows").count() == first("fct_flows").count() and again("fct_flows").where(F.col("event_date") == F.lit(day)).isEmpty()
    assert again("agg_traffic_hourly").where(F.to_date("hour_start") == F.lit(day)).isEmpty() and again("agg_traffic_hourly").agg(F.sum("flows")).first()[0] == again("fct_flows").count()


def test_export_is_read_back(spark, tmp_path):
    rows = stored._inputs(spark, SF)
    fact = facts.fct_flows(facts.stage_flows(rows["flows"].limit(50)), rows["network_zones"], rows["service_ports"], datetime(2024, 3, 1))
    for form in ("parquet", "json"):
        ocsf.export(fact, f"{tmp_path}/{form}", form)
        assert spark.read.format(form).load(f"{tmp_path}/{form}").select("metadata.uid").distinct().count() == fact.count()


