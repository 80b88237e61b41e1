"""Serving datasets and the scoring of alerts against labelled incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netquarry.functions.network import severity_rank


def kpis(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count("*").alias("flows"), F.coalesce(F.sum("bytes_total"), F.lit(0)).alias("bytes"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.count_distinct("sensor_id").alias("sensors"))


def host_counts(hosts: DataFrame) -> DataFrame:
    return hosts.agg(F.count_if("is_internal").alias("internal"), F.count_if(~F.col("is_internal")).alias("external"))


def hourly_by_direction(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("hour_start", "direction").agg(F.sum("flows").alias("flows"), F.sum("bytes").alias("bytes")).orderBy("hour_start", "direction")


def dense_hour_axis(hourly: DataFrame) -> DataFrame:
    """Every hour from the first to the last for every direction, zero where nothing was seen."""
    sums = hourly_by_direction(hourly)
    axis = hourly.agg(F.min("hour_start").alias("lo"), F.max("hour_start").alias("hi")).where("lo is not null").select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias("hour_start"))
    # one row of four directions for each hour
    every = axis.select("hour_start", F.explode(F.array(*map(F.lit, ("internal", "outbound", "inbound", "external")))).alias("direction"))
    return every.join(sums, ["hour_start", "direction"], "left").select("hour_start", "direction", F.coalesce("flows", F.lit(0)).alias("flows"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def upload_peak_median(hourly: DataFrame, direction: str = "outbound") -> DataFrame:
    """The hour of most bytes in a direction and the upper median hour over the dense axis.

    The median is the smallest value with more than half of the hours at or below it: counts by value, not a sort in one task.
    """
    axis = dense_hour_axis(hourly).where(F.col("direction") == direction)
    peak = axis.agg(F.min_by(F.struct("hour_start", "bytes"), F.struct(-F.col("bytes"), "hour_start")).alias("p"), F.percentile("bytes", 0.5).alias("mid"), F.count("*").alias("n"))
    # the interpolated median is at most the upper one: that is the smallest value from it on
    return axis.join(F.broadcast(peak)).where("bytes >= mid").groupBy("p", "n").agg(F.min("bytes").alias("median_bytes")).select(F.col("p.hour_start").alias("peak_hour"), F.col("p.bytes").alias("peak_bytes"), "median_bytes")


def top_talkers(hosts: DataFrame, n: int = 10) -> DataFrame:
    return hosts.where("is_internal").orderBy(F.desc("bytes_sent"), "ip").limit(n).select("ip", "zone", "flows", "bytes_sent", "bytes_received", "distinct_peers")


def alerts_ranked(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(severity_rank(F.col("severity")), "window_start", "alert_id")


def alerts_by_time(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy("window_start", "rule_id", "alert_id")


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    counts = alerts.groupBy("severity").agg(F.count("*").alias("alerts"))
    return counts.withColumn("rank", severity_rank(F.col("severity"))).orderBy("rank", "severity")


def quarantine_by_type(quarantine: DataFrame) -> DataFrame:
    """error_type, records, most frequent first."""
    return quarantine.groupBy("error_type").agg(F.count("*").alias("records")).orderBy(F.desc("records"), "error_type")


def quarantine_difference(quarantine: DataFrame, expected: DataFrame) -> DataFrame:
    """Error types whose counts differ from the expected ones (error_type, records)."""
    got = quarantine_by_type(quarantine).alias("g")
    both = got.join(expected.alias("e"), F.col("g.error_type") == F.col("e.error_type"), "full")
    return both.select(F.coalesce("g.error_type", "e.error_type").alias("error_type"), F.coalesce("e.records", F.lit(0)).alias("expected"), F.coalesce("g.records", F.lit(0)).alias("found")).where("expected <> found")


def batch_totals(batches: DataFrame) -> DataFrame:
    return batches.agg(F.count("*").alias("batches"), F.coalesce(F.sum("records_accepted"), F.lit(0)).alias("accepted"), F.coalesce(F.sum("records_quarantined"), F.lit(0)).alias("quarantined"), F.count_if("capture_was_cut_short").alias("cut_short"))


def renamed_hosts(versions: DataFrame, n: int = 20) -> DataFrame:
    """Versions of the addresses that had several names, the first n by address and version."""
    several = versions.groupBy("ip").count().where("count > 1").select("ip")
    return versions.join(several, "ip", "left_semi").orderBy("ip", "version").limit(n).select("ip", "hostname", "version", "valid_from", "valid_to", "is_current")


def batch_summary(ledger: DataFrame) -> DataFrame:
    """Counts by status with records written and quarantined."""
    return ledger.groupBy("status").agg(F.count("*").alias("batches"), F.sum("records_written").alias("records_written"), F.sum("records_quarantined").alias("records_quarantined"))


def quarantine_reasons(ledger: DataFrame) -> DataFrame:
    return ledger.select(F.explode("reasons").alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("records"))


def lake_quarantine_rate(accepted: DataFrame, quarantined: DataFrame, limit: float = 0.05) -> DataFrame:
    """rate of rejected records, 0 for an empty lake, and whether it is within the limit."""
    a, q = accepted.agg(F.count("*").alias("accepted")), quarantined.agg(F.count("*").alias("rejected"))
    rate = F.coalesce(F.try_divide("rejected", F.col("accepted") + F.col("rejected")), F.lit(0.0))
    return a.join(q, F.lit(True)).select("accepted", "rejected", rate.alias("rate"), (rate <= limit).alias("passed"))


def source_freshness(bronze: DataFrame, now, warn_hours: int = 6, error_hours: int = 24) -> DataFrame:
    newest = bronze.agg(F.max("ingested_at").alias("newest"))
    age = (F.lit(now).cast("timestamp").cast("double") - F.col("newest").cast("double")) / 3600
    status = F.when(F.col("newest").isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")
    return newest.select("newest", age.alias("age_hours"), status.alias("status"))


# ---------------------------------------------------------------- scoring


#: Windows meet by bins of so many seconds.
BIN = 86_400


def incident_overlap(alerts: DataFrame, incidents: DataFrame) -> DataFrame:
    """(alert_id, incident_id, rule_id) of alerts and incidents of one rule and source that overlap in time.

    Both come once for each bin that they touch and meet by (rule, source, bin); a pair counts in the bin of the later start.
    """
    at = lambda c: F.floor(F.unix_timestamp(c) / BIN)
    binned = lambda df, start, end, names: df.select(*names, start, end, at(start).alias(f"{start}_bin"), F.explode(F.sequence(at(start), F.greatest(at(start), at(end)))).alias("bin"))
    a = binned(alerts, "window_start", "window_end", ("alert_id", "rule_id", "src_ip"))
    i = binned(incidents, "start", "end", ("incident_id", "rule_id", "src_ip"))
    meets = (F.col("window_start") <= F.col("end")) & (F.col("start") < F.col("window_end")) & (F.col("bin") == F.greatest("window_start_bin", "start_bin"))
    return a.join(i, ["rule_id", "src_ip", "bin"]).where(meets).select("alert_id", "incident_id", "rule_id")


def rule_scores(alerts: DataFrame, incidents: DataFrame) -> DataFrame:
    """Precision and recall by rule and over all; 1.0 where there is nothing to find or nothing was alerted."""
    hits = incident_overlap(alerts, incidents)
    detected = hits.groupBy("rule_id").agg(F.count_distinct("incident_id").alias("detected"), F.count_distinct("alert_id").alias("true_alerts"))
    counted = alerts.groupBy("rule_id").agg(F.count("*").alias("alerts")).join(incidents.groupBy("rule_id").agg(F.count("*").alias("incidents")), "rule_id", "full").join(detected, "rule_id", "left")
    zero = counted.na.fill(0)
    names = ("incidents", "detected", "alerts", "true_alerts")
    every = zero.agg(F.lit("all").alias("rule_id"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    share = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(1.0))
    return zero.select("rule_id", *names).unionByName(every).select("rule_id", *names, share("true_alerts", "alerts").alias("precision"), share("detected", "incidents").alias("recall"))


def missed_incidents(alerts: DataFrame, incidents: DataFrame) -> DataFrame:
    return incidents.join(incident_overlap(alerts, incidents).select("incident_id").distinct(), "incident_id", "left_anti")


def false_alerts(alerts: DataFrame, incidents: DataFrame) -> DataFrame:
    return alerts.join(incident_overlap(alerts, incidents).select("alert_id").distinct(), "alert_id", "left_anti")


def snapshot_difference(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, both ways; no row means they are equal."""
    only = lambda a, b, side: a.exceptAll(b).withColumn("only_in", F.lit(side))
    return only(one, other.select(*one.columns), "one").unionByName(only(other.select(*one.columns), one, "other"))
