"""Network zones: CIDR parsing and longest-prefix lookup as an equi join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netquarry.functions.network import ipv4_to_int, is_private_ipv6
from netquarry.sources.lake import stored


def parse_zones(zones: DataFrame) -> DataFrame:
    """zone, cidr, is_internal, prefix_length, range_start, range_end."""
    parts = F.split("cidr", "/")
    length = F.get(parts, F.lit(1)).cast("int")
    start = ipv4_to_int(F.get(parts, F.lit(0)))
    sized = zones.select("zone", "cidr", "is_internal", length.alias("prefix_length"), start.alias("range_start"))
    return sized.withColumn("range_end", F.col("range_start") + F.pow(F.lit(2.0), 32 - F.col("prefix_length")).cast("bigint") - 1)


def zone_lookup(addresses: DataFrame, zones: DataFrame) -> DataFrame:
    """ip, zone, is_internal for each distinct address of `addresses` (ip): the most specific zone wins.

    An address belongs to a zone iff its leading bits equal the zone's, so the range join is an equi join on (prefix
    length, leading bits), once for each prefix length in use (33 at most). Of two zones with one CIDR the smaller name wins.
    The result is a table: Spark knows its size when flows are joined with it, so that a few addresses that have nearly all
    flows don't bring these to as few tasks.
    """
    parsed = parse_zones(zones)
    lengths = sorted(r[0] for r in parsed.select("prefix_length").distinct().collect())
    keyed = parsed.select("prefix_length", F.expr("shiftright(range_start, 32 - prefix_length)").alias("bits"), "zone", "is_internal").groupBy("prefix_length", "bits").agg(F.min_by(F.struct("zone", "is_internal"), "zone").alias("z"))
    numbered = addresses.select("ip", ipv4_to_int(F.col("ip")).alias("n"))
    private = is_private_ipv6(F.col("ip"))
    if not lengths:
        return stored(numbered.select("ip", F.when(private, "private").otherwise("external").alias("zone"), private.alias("is_internal")), "zones")
    tries = F.array(*[F.struct(F.lit(p).alias("prefix_length"), F.shiftright("n", 32 - p).alias("bits")) for p in lengths])
    tried = numbered.where("n is not null").select("ip", F.inline(tries)).join(keyed, ["prefix_length", "bits"])
    best = tried.groupBy("ip").agg(F.max_by("z", "prefix_length").alias("z"))
    known = numbered.join(best, "ip", "left")
    zone = F.coalesce("z.zone", F.when(private, "private").otherwise("external")).alias("zone")
    return stored(known.select("ip", zone, F.coalesce("z.is_internal", private).alias("is_internal")), "zones")
