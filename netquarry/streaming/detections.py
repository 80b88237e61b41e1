"""Streaming forms of the four detections: the rows of netquarry.operators.detections, told as soon as a window is over.

Each takes a stream of fact rows and returns a stream in append mode: a row comes once the watermark (the latest first_seen
less `lateness`) has passed the end of its window, and later flows of that window are left out. Whoever needs these runs the
batch form. Windows of a day are those of UTC, as the session's time zone must be.
State is kept by aggregations alone, so it is partitioned, checkpointed and dropped by Spark: none of it holds more of a busy
key than the flows of a minute, the names of a day or the 65,536 ports there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netquarry.operators.detections import Thresholds, allowed, dns_queries

_HOUR, _DAY = "1 hour", "1 day"


def watched(facts: DataFrame, lateness: str) -> DataFrame:
    """The stream with its watermark; a null first_seen is in no window."""
    zone = facts.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"days are those of UTC, but the session's time zone is {zone}")
    return facts.withWatermark("first_seen", lateness)


def _named(column: str, count: Column) -> Column:
    """Aggregate: the value of `column` with the greatest count, of equals the smallest; null values don't count."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.struct(-count, F.col(column))))


def port_scans(facts: DataFrame, t: Thresholds = Thresholds(), lateness: str = "1 hour") -> DataFrame:
    """det_port_scan over a stream."""
    failed = F.avg(F.when(F.col("tcp_state").isin("reset", "syn_sent"), 1.0).otherwise(0.0))
    tcp = watched(facts, lateness).where("protocol = 6")
    grouped = tcp.groupBy(F.window("first_seen", _HOUR).alias("w"), F.col("initiator_ip").alias("src_ip"), F.col("responder_ip").alias("dst_ip")).agg(
        F.count("*").alias("flows"), F.array_sort(F.collect_set("responder_port")).alias("ports"), failed.alias("failed_ratio"), F.sum("bytes_total").alias("bytes"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )
    kept = grouped.where((F.size("ports") >= t.port_scan_min_distinct_ports) & (F.col("failed_ratio") >= t.port_scan_min_failed_ratio))
    return kept.select(
        "src_ip", "dst_ip", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "flows", F.size("ports").cast("bigint").alias("distinct_ports"),
        "failed_ratio", "bytes", "first_seen", "last_seen", F.slice("ports", 1, 10).alias("sample_ports"),
    )


def _moments(times: Column) -> Column:
    """n, mean and m2 (sum of squared differences from the mean) of the gaps in a sorted array of seconds."""
    gaps = F.transform(F.slice(times, F.lit(2), F.greatest(F.size(times) - 1, F.lit(0))), lambda x, i: x - F.get(times, i))
    n = F.size(gaps)
    mean = F.coalesce(F.try_divide(F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x), n), F.lit(0.0))
    squares = F.aggregate(gaps, F.struct(F.lit(0.0).alias("s"), mean.alias("m")), lambda a, x: F.struct((a["s"] + (x - a["m"]) * (x - a["m"])).alias("s"), a["m"].alias("m")), lambda a: a["s"])
    return F.struct(n.cast("bigint").alias("n"), mean.alias("mean"), squares.alias("m2"))


def _joined(a: Column, n: Column, mean: Column, m2: Column) -> Column:
    """Moments of two sets of gaps as one."""
    total, delta = a["n"] + n, mean - a["mean"]
    share = F.coalesce(F.try_divide(n.cast("double"), total), F.lit(0.0))
    return F.struct(total.alias("n"), (a["mean"] + delta * share).alias("mean"), (a["m2"] + m2 + delta * delta * a["n"] * share).alias("m2"))


def _day_moments(minutes: Column) -> Column:
    """Moments of all gaps of a day from its minutes in order: those within each, and the gap from each to the next."""
    start = F.struct(F.lit(None).cast("double").alias("last"), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")).alias("m"))

    def step(a: Column, x: Column) -> Column:
        carried = a["last"].isNotNull()
        over = _joined(a["m"], carried.cast("bigint"), F.when(carried, x["first"] - a["last"]).otherwise(a["m"]["mean"]), F.lit(0.0))
        return F.struct(x["last"].alias("last"), _joined(over, x["m"]["n"], x["m"]["mean"], x["m"]["m2"]).alias("m"))

    return F.aggregate(minutes, start, step, lambda a: a["m"])


def _most_frequent(counted: Column) -> Column:
    """The name of the greatest summed count in an array of (name, n), of equals the smallest; one pass over the sorted array."""
    start = F.struct(F.lit(None).cast("string").alias("name"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("string").alias("best"), F.lit(0).cast("bigint").alias("most"))

    def step(a: Column, x: Column) -> Column:
        n = F.when(a["name"].eqNullSafe(x["name"]), a["n"] + x["n"]).otherwise(x["n"])
        return F.struct(x["name"].alias("name"), n.alias("n"), F.when(n > a["most"], x["name"]).otherwise(a["best"]).alias("best"), F.greatest(n, a["most"]).alias("most"))

    return F.aggregate(F.array_sort(F.filter(counted, lambda x: x["name"].isNotNull())), start, step, lambda a: a["best"])


def beacons(facts: DataFrame, allowlist: DataFrame, t: Thresholds = Thresholds(), lateness: str = "1 hour") -> DataFrame:
    """det_beaconing over a stream.

    Three steps of state: the times of each minute by name, the minute's gaps as moments, and the day as at most 1,440 of
    these. So a connection's order is told within a minute, and flows may come in any order as long as they aren't late.
    """
    keys = ["src_ip", "dst_ip", "dst_port"]
    outbound = watched(facts, lateness).where("direction = 'outbound' and protocol in (6, 17)")
    named = outbound.groupBy(F.window("first_seen", "1 minute").alias("w"), F.col("initiator_ip").alias("src_ip"), F.col("responder_ip").alias("dst_ip"), F.col("responder_port").alias("dst_port"), F.col("responder_name").alias("name")).agg(
        F.collect_list(F.col("first_seen").cast("double")).alias("times"), F.min("first_seen").alias("first_seen"), F.max("first_seen").alias("last_seen")
    )
    minutes = named.groupBy("w", *keys).agg(
        F.array_sort(F.flatten(F.collect_list("times"))).alias("times"), F.collect_list(F.struct("name", F.size("times").cast("bigint").alias("n"))).alias("names"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )
    told = minutes.select("w", *keys, "names", "first_seen", "last_seen", F.struct(F.element_at("times", 1).alias("first"), F.element_at("times", -1).alias("last"), _moments(F.col("times")).alias("m")).alias("minute"))
    days = told.groupBy(F.window("w", _DAY).alias("day"), *keys).agg(
        _day_moments(F.array_sort(F.collect_list("minute"))).alias("m"), _most_frequent(F.flatten(F.collect_list("names"))).alias("dst_name"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )
    deviation = F.when(F.col("m.n") > 1, F.sqrt(F.col("m.m2") / (F.col("m.n") - 1)))
    pairs = days.select(
        *keys, F.to_date("day.start").alias("event_date"), (F.col("m.n") + 1).alias("connections"), F.when(F.col("m.n") > 0, F.col("m.mean")).alias("mean_interval_seconds"),
        deviation.alias("stddev_interval_seconds"), "first_seen", "last_seen", "dst_name",
    )
    rated = pairs.withColumn("interval_cv", F.try_divide("stddev_interval_seconds", "mean_interval_seconds"))
    mean = F.col("mean_interval_seconds").between(t.beaconing_min_interval_seconds, t.beaconing_max_interval_seconds)
    regular = rated.where((F.col("connections") >= t.beaconing_min_connections) & mean & (F.col("interval_cv") <= t.beaconing_max_cv))
    return allowed(regular.withColumn("rule_id", F.lit("beaconing")), allowlist).drop("rule_id")


def uploads(facts: DataFrame, t: Thresholds = Thresholds(), lateness: str = "1 hour") -> DataFrame:
    """det_exfiltration over a stream: sums of a day by name, then of all names."""
    outbound = watched(facts, lateness).where("direction = 'outbound'")
    named = outbound.groupBy(F.window("first_seen", _DAY).alias("w"), F.col("initiator_ip").alias("src_ip"), F.col("responder_ip").alias("dst_ip"), F.col("responder_name").alias("name")).agg(
        F.count("*").alias("flows"), F.sum("i2r_bytes").alias("bytes_out"), F.sum("r2i_bytes").alias("bytes_in"), F.sum("bytes_total").alias("bytes"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )
    sums = named.groupBy("w", "src_ip", "dst_ip").agg(
        *[F.sum(c).alias(c) for c in ("flows", "bytes_out", "bytes_in", "bytes")], F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        _named("name", F.col("flows")).alias("dst_name"),
    )
    rated = sums.withColumn("upload_ratio", F.try_divide("bytes_out", "bytes"))
    kept = rated.where((F.col("bytes_out") >= t.exfiltration_min_bytes_out) & (F.col("upload_ratio") >= t.exfiltration_min_upload_ratio))
    return kept.select("src_ip", "dst_ip", F.to_date("w.start").alias("event_date"), "flows", "bytes_out", "bytes_in", "upload_ratio", "first_seen", "last_seen", "dst_name")


def tunnels(facts: DataFrame, t: Thresholds = Thresholds(), lateness: str = "1 hour") -> DataFrame:
    """det_dns_tunneling over a stream: by name, then by parent domain."""
    asked = dns_queries(watched(facts, lateness))
    named = asked.groupBy(F.window("first_seen", _HOUR).alias("w"), "src_ip", "parent_domain", "query").agg(
        F.count("*").alias("n"), F.first(F.length("first_label")).alias("label"), F.min("first_seen").alias("first_seen"), F.max("first_seen").alias("last_seen")
    )
    sums = named.groupBy("w", "src_ip", "parent_domain").agg(
        F.sum("n").alias("queries"), F.count("*").alias("distinct_names"), (F.sum(F.col("n") * F.col("label")) / F.sum("n")).alias("avg_label_length"),
        F.max(F.length("query")).cast("bigint").alias("max_name_length"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.min("query").alias("sample_query"),
    )
    kept = sums.where((F.col("distinct_names") >= t.dns_tunneling_min_distinct_names) & (F.col("avg_label_length") >= t.dns_tunneling_min_avg_label_length))
    return kept.select(
        "src_ip", "parent_domain", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "queries", "distinct_names", "avg_label_length", "max_name_length", "first_seen", "last_seen", "sample_query"
    )
