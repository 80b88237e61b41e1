"""Host dimensions: activity profile and the history of host names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netquarry.functions.network import utc_text


def with_mode(found: DataFrame, rows: DataFrame, column: str, name: str) -> DataFrame:
    """found with `name`: the most frequent value of `column` among the rows that share found's key columns, of equals the smallest.

    The keys are the columns of rows other than `column`; null values don't count. Values are counted before they are
    compared, so a key of very many values is summed on the map side, and only keys that are in found come along.
    """
    keys = [c for c in rows.columns if c != column]
    same = rows.where(F.col(column).isNotNull()).join(found.select(*keys).distinct(), keys, "left_semi")
    counts = same.groupBy(*keys, column).agg(F.count("*").alias("__n"))
    best = counts.groupBy(*keys).agg(F.min_by(column, F.struct(-F.col("__n"), column)).alias(name))
    return found.join(best, keys, "left")


def endpoints(facts: DataFrame) -> DataFrame:
    """Two rows for each flow, one for each role, in one pass."""
    role = lambda own, other, sent, received, first, name: F.struct(
        F.col(f"{own}_ip").alias("ip"), F.col(f"{own}_zone").alias("zone"), F.col(f"{own}_is_internal").alias("is_internal"), F.col(sent).alias("bytes_sent"), F.col(received).alias("bytes_received"),
        F.lit(first).alias("initiated"), F.col(f"{other}_ip").alias("peer_ip"), name.cast("string").alias("observed_name"),
    )
    both = F.array(role("initiator", "responder", "i2r_bytes", "r2i_bytes", 1, F.lit(None)), role("responder", "initiator", "r2i_bytes", "i2r_bytes", 0, F.col("responder_name")))
    return facts.select("first_seen", "last_seen", F.inline(both))


def dim_hosts(facts: DataFrame) -> DataFrame:
    """One row for each address with its activity profile.

    Rows are summed by (address, peer, name) first, so an address that meets everyone is not one task's work.
    """
    at = F.struct("last_seen", "zone")
    by_peer = endpoints(facts).groupBy("ip", "peer_ip", "observed_name").agg(
        F.max_by(F.struct("zone", "is_internal"), at).alias("z"), F.max(at).alias("at"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.count("*").alias("flows"), F.sum("initiated").alias("initiated"), F.sum("bytes_sent").alias("bytes_sent"), F.sum("bytes_received").alias("bytes_received"),
    )
    sums = [F.sum("flows").alias("flows"), F.sum("initiated").alias("initiated"), F.sum("bytes_sent").alias("bytes_sent"), F.sum("bytes_received").alias("bytes_received")]
    times = [F.max_by("z", "at").alias("z"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")]
    profile = by_peer.groupBy("ip").agg(*times, *sums, F.count_distinct("peer_ip").alias("distinct_peers"))
    names = by_peer.where("observed_name is not null").groupBy("ip", "observed_name").agg(F.sum("flows").alias("n"))
    common = names.groupBy("ip").agg(F.min_by("observed_name", F.struct(-F.col("n"), "observed_name")).alias("most_common_name"))
    return profile.join(common, "ip", "left").select(
        "ip", "z.zone", "z.is_internal", "first_seen", "last_seen", "flows", F.col("initiated").alias("flows_initiated"), (F.col("flows") - F.col("initiated")).alias("flows_received"),
        "bytes_sent", "bytes_received", "distinct_peers", "most_common_name",
    )


def named_hours(facts: DataFrame) -> DataFrame:
    """ip, flow_hour, hostname, flows."""
    return facts.where("responder_name is not null").groupBy(F.col("responder_ip").alias("ip"), "flow_hour", F.col("responder_name").alias("hostname")).agg(F.count("*").alias("flows"))


def dominant_names(named: DataFrame) -> DataFrame:
    """The name with most flows of each address and hour, of equals the smallest."""
    best = F.min_by(F.struct("hostname", "flows"), F.struct(-F.col("flows"), "hostname")).alias("b")
    return named.groupBy("ip", "flow_hour").agg(best).select("ip", "flow_hour", "b.hostname", "b.flows")


def name_changes(hourly: DataFrame) -> DataFrame:
    """is_change: 1 where the name differs from that of the address's hour before."""
    by_hour = Window.partitionBy("ip").orderBy("flow_hour")
    return hourly.withColumn("is_change", (~F.col("hostname").eqNullSafe(F.lag("hostname").over(by_hour))).cast("int"))


def islands(changes: DataFrame) -> DataFrame:
    by_hour = Window.partitionBy("ip").orderBy("flow_hour").rowsBetween(Window.unboundedPreceding, 0)
    return changes.withColumn("island", F.sum("is_change").over(by_hour))


def name_versions(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy("ip", "island", "hostname").agg(F.min("flow_hour").alias("valid_from"), (F.max("flow_hour") + F.expr("interval 1 hour")).alias("observed_until"), F.sum("flows").alias("flows")).drop("island")


def scd2_validity(versions: DataFrame) -> DataFrame:
    by_time = Window.partitionBy("ip").orderBy("valid_from")
    after = F.lead("valid_from").over(by_time)
    return versions.select(
        F.md5(F.concat("ip", F.lit("|"), utc_text(F.col("valid_from")))).alias("host_name_key"), "ip", "hostname", F.row_number().over(by_time).cast("bigint").alias("version"),
        "valid_from", after.alias("valid_to"), after.isNull().alias("is_current"), "observed_until", "flows",
    )


def host_names_scd2(facts: DataFrame) -> DataFrame:
    """History of the name that each address served: a version ends when another name takes over, not by a silent gap.

    Windows see one row for each address and hour at most, whatever the number of flows.
    """
    return scd2_validity(name_versions(islands(name_changes(dominant_names(named_hours(facts))))))
