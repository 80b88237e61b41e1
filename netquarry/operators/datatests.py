"""Data tests over many tables in one pass over each.

A table's row rules become counts of one aggregation. Its key is grouped by first, which counts keys that occur more than
once in the same pass; parents are joined as flags before that. Sums that must agree between tables are taken along and
compared at the end. The result has a row for each test, also for those that hold.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Suite:
    """The tests of one table, as (name, severity, expression).

    rows: expressions that are true for a violation (null isn't); key: an expression that occurs once (null isn't
    counted); parents: (name, severity, column, parent table, its column), null passes; totals: (name, severity, part,
    expression), where the sums of each part over all tables of the same name must be zero; scd2: whether versions must be
    contiguous and one of each address current.
    """

    rows: tuple[tuple[str, str, str], ...] = ()
    key: tuple[str, str, str] | None = None
    parents: tuple[tuple[str, str, str, str, str], ...] = ()
    totals: tuple[tuple[str, str, str, str], ...] = ()
    scd2: tuple[str, str] | None = None


def not_null(column: str) -> tuple[str, str, str]:
    return f"not_null({column})", "error", f"{column} IS NULL"


def accepted(column: str, values: str, severity: str = "error") -> tuple[str, str, str]:
    return f"accepted_values({column})", severity, f"{column} NOT IN ({', '.join(repr(v) for v in values.split())})"


def holds(expression: str, severity: str = "error") -> tuple[str, str, str]:
    return f"expression({expression})", severity, f"NOT ({expression})"


def unique(key: str) -> tuple[str, str, str]:
    return f"unique({key})", "error", key


def parent(column: str, table: str, own: str) -> tuple[str, str, str, str, str]:
    return f"relationships({column})", "error", column, table, own


RECONCILED = ("hourly_traffic_reconciles", "error")
#: The tests of a full build: 22 not_null, 9 unique, 6 accepted_values, 2 relationships, 8 expressions and 2 over whole tables.
DECLARED: dict[str, Suite] = {
    "flows": Suite((not_null("record_id"),)),
    "stg_flows": Suite((not_null("record_id"), not_null("first_seen"))),
    "stg_quarantine": Suite((not_null("error_type"),)),
    "stg_network_zones": Suite((holds("range_end >= range_start"), holds("prefix_length between 0 and 32"))),
    "network_zones": Suite((not_null("cidr"),), unique("cidr")),
    "service_ports": Suite((), unique("concat(protocol, '/', port)")),
    "mitre_techniques": Suite((not_null("technique_id"),), unique("technique_id")),
    "detection_rules": Suite((not_null("rule_id"), accepted("severity", "low medium high critical")), unique("rule_id"), (parent("mitre_technique_id", "mitre_techniques", "technique_id"),)),
    "fct_flows": Suite(
        (
            *[not_null(c) for c in ("record_id", "first_seen", "initiator_zone", "responder_zone", "direction")], holds("bytes_total = i2r_bytes + r2i_bytes"),
            holds("packets_total = i2r_packets + r2i_packets"), holds("last_seen >= first_seen"), accepted("direction", "internal outbound inbound external"),
            accepted("tcp_state", "syn_sent syn_received established midstream closing closed reset", "warn"), accepted("end_reason", "idle_timeout tcp_finished evicted capture_end clock_reset", "warn"),
        ), unique("record_id"), (), tuple((*RECONCILED, part, sql) for part, sql in (("flows", "1L"), ("packets", "packets_total"), ("bytes", "bytes_total"))),
    ),
    "agg_traffic_hourly": Suite((not_null("hour_start"), holds("flows > 0")), totals=tuple((*RECONCILED, part, f"-{part}") for part in ("flows", "packets", "bytes"))),
    "dim_hosts": Suite((not_null("ip"), not_null("zone")), unique("ip")),
    "dim_host_names": Suite((not_null("host_name_key"), not_null("hostname")), unique("host_name_key"), scd2=("scd2_versions_are_contiguous", "error")),
    # two beacons to two ports of one host share an alert_id by its definition: that is told and stops nothing
    "fct_alerts": Suite(tuple(not_null(c) for c in ("alert_id", "rule_id", "src_ip", "evidence")), ("unique(alert_id)", "warn", "alert_id"), (parent("rule_id", "detection_rules", "rule_id"),)),
    "dq_batches": Suite((not_null("batch_id"), accepted("capture_was_cut_short", "false", "warn"), holds("quarantine_rate between 0 and 1"), holds("quarantine_rate <= 0.05", "warn")), unique("batch_id")),
    "ocsf_network_activity": Suite((accepted("type_uid", "400106"),)),
}


def measured(df: DataFrame, suite: Suite, x: Tables) -> DataFrame:
    """(test, severity, part, value) of one table: violations (part null), or sums that are compared with other tables'."""
    flags = [(name, severity, None, F.expr(sql)) for name, severity, sql in suite.rows]
    for k, (name, severity, column, table, own) in enumerate(suite.parents):
        keys = x(table).select(F.col(own).alias(f"__parent{k}")).where(F.col(own).isNotNull()).distinct()
        df = df.join(keys, F.col(column) == F.col(f"__parent{k}"), "left")
        flags.append((name, severity, None, F.col(column).isNotNull() & F.col(f"__parent{k}").isNull()))
    if suite.scd2:
        versions, all_of = Window.partitionBy("ip").orderBy("version"), Window.partitionBy("ip")
        after = F.lead("valid_from").over(versions)
        df = df.withColumns({"__after": after, "__current": F.count_if("is_current").over(all_of), "__first": F.row_number().over(versions)})
        # a gap counts once, and so does an address without exactly one current version
        gap = F.col("__after").isNotNull() & ~F.col("valid_to").eqNullSafe(F.col("__after"))
        flags.append((*suite.scd2, "gaps", gap))
        flags.append((*suite.scd2, "current", (F.col("__first") == 1) & (F.col("__current") != 1)))
    values = [F.count_if(c).alias(f"v{k}") for k, (*_, c) in enumerate(flags)]
    sums = [F.coalesce(F.sum(F.expr(sql)), F.lit(0)).alias(f"s{k}") for k, (*_, sql) in enumerate(suite.totals)]
    if suite.key:
        by_key = df.groupBy(F.expr(suite.key[2]).cast("string").alias("__key")).agg(F.count("*").alias("__n"), *values, *sums)
        df, values = by_key, [F.coalesce(F.sum(f"v{k}"), F.lit(0)).alias(f"v{k}") for k in range(len(values))]
        sums = [F.coalesce(F.sum(f"s{k}"), F.lit(0)).alias(f"s{k}") for k in range(len(sums))]
        values.append(F.count_if(F.col("__key").isNotNull() & (F.col("__n") > 1)).alias("unique"))
    one = df.agg(*values, *sums)
    told = [(name, severity, part, f"v{k}") for k, (name, severity, part, _) in enumerate(flags)]
    told += [(name, severity, part, f"s{k}") for k, (name, severity, part, _) in enumerate(suite.totals)]
    told += [(*suite.key[:2], None, "unique")] if suite.key else []
    rows = [F.struct(F.lit(n).alias("test"), F.lit(s).alias("severity"), F.lit(p).cast("string").alias("part"), F.col(v).cast("bigint").alias("value")) for n, s, p, v in told]
    return one.select(F.inline(F.array(*rows)))


def run(x: Tables, suites: dict[str, Suite] = DECLARED) -> DataFrame:
    """(table, test, severity, violations, status) of every test: pass, warn or fail.

    A test over sums counts the parts that differ, and has the table that comes first by name.
    """
    every = reduce(DataFrame.unionByName, [measured(x(table), suite, x).withColumn("table", F.lit(table)) for table, suite in suites.items()])
    sums = every.groupBy("test", "severity", "part", F.when(F.col("part").isNull(), F.col("table")).alias("own")).agg(F.min("table").alias("table"), F.sum("value").alias("value"))
    counted = F.when(F.col("part").isNull() | F.col("part").isin("gaps", "current"), F.col("value")).otherwise((F.col("value") != 0).cast("bigint"))
    tests = sums.groupBy("test", "severity", "own").agg(F.min("table").alias("table"), F.sum(counted).alias("violations"))
    status = F.when(F.col("violations") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return tests.select("table", "test", "severity", "violations", status.alias("status"))
