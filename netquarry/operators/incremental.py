"""Incremental maintenance of gold tables by days and hours.

The fact is a versioned table by event_date. Its keys are (sensor_id, capture_id) for each day: a record_id is made of both
and the flow's number, so an older version of a row can only be in a day that holds rows of the same capture, and only
such days are opened. What is new is told by the watermark in the fact's own manifest, what has changed by a list of hours
in it, so every table behind it can tell from its own manifest what it lacks, also after a run that stopped on the way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.operators.detections import Thresholds
from netquarry.operators.facts import agg_traffic_hourly, fct_flows, stage_flows
from netquarry.sources.lake import remove
from netquarry.sources.versions import Versioned, part_name

DAY = "event_date"
KEYS = ("sensor_id", "capture_id")
#: A version that changes more hours says so and not which; the tables behind are then built whole.
MOST_HOURS = 24 * 400


def new_rows(bronze: DataFrame, watermark: int | None, lookback_minutes: int) -> DataFrame:
    """Bronze rows ingested after the watermark (microseconds) less the lookback. The bounds fold to literals, so old partitions aren't opened."""
    if watermark is None:
        return bronze
    since = F.timestamp_micros(F.lit(watermark - lookback_minutes * 60_000_000))
    return bronze.where((F.col("ingested_at") > since) & (F.col("ingest_date") >= F.to_date(since)))


def _latest(rows: DataFrame) -> int | None:
    return rows.agg(F.max(F.unix_micros("ingested_at"))).first()[0]


def update_facts(spark: SparkSession, bronze: DataFrame, path: str, zones: DataFrame, services: DataFrame, run_started_at: datetime, lookback_minutes: int = 30, full_refresh: bool = False) -> dict | None:
    """Merge new bronze rows into the fact at `path` by record_id; only days of new or replaced rows are rewritten.

    Returns the manifest of the version after it, None if there are no rows at all. Each version notes the watermark and the
    hours that differ from its base (None: all).
    """
    table = Versioned(spark, path)
    base = table.manifest()
    old = base is not None and not full_refresh
    work = f"{path}_fresh_{uuid.uuid4().hex}"
    rows = new_rows(bronze, base["note"]["ingested_at"], lookback_minutes) if old else bronze
    fct_flows(stage_flows(rows), zones, services, run_started_at).write.parquet(work)
    fresh = spark.read.parquet(work)
    try:
        if old:
            return merge(table, base, fresh, f"{work}_old")
        watermark = _latest(fresh)
        if watermark is None and base is None:
            return None
        return table.write(fresh, DAY, keys=KEYS, note={"ingested_at": watermark, "hours": None, "days": None}, base=base, sort=[DAY, "flow_hour"])
    finally:
        remove(spark, work)
        remove(spark, f"{work}_old")


def merge(table: Versioned, base: dict, fresh: DataFrame, work: str) -> dict:
    """The version with the fresh rows in place of their older versions. fresh: stored rows, each record_id once; work: a folder for the meantime.

    Ids of fresh rows may be many while a column of their table looks small, so they are never broadcast: ids and places of
    what is replaced are found by a shuffle of these columns alone, and are a table of their own.
    """
    ids, place = fresh.select("record_id"), (F.col(DAY).cast("string").alias("day"), F.unix_timestamp("flow_hour").alias("hour"))
    opened = table.read(table.parts_with(fresh.select(*KEYS)), manifest=base)
    opened.select("record_id", *place).join(ids.hint("merge"), "record_id", "left_semi").write.parquet(work)
    replaced = table.spark.read.schema("record_id string, day string, hour bigint").parquet(work)
    # what changes: hours of new rows and those that hold an older version of one
    hours = fresh.select(*place).unionByName(replaced.select("day", "hour")).distinct().limit(MOST_HOURS + 1).collect()
    if not hours:
        return base
    if len(hours) > MOST_HOURS:
        days, told = None, None
    else:
        days, told = sorted({part_name(DAY, r["day"]) for r in hours}), sorted({r["hour"] for r in hours})
    kept = table.read(days, manifest=base).join(replaced.select("record_id"), "record_id", "left_anti")
    newest = max(x for x in (_latest(fresh), base["note"]["ingested_at"]) if x is not None)
    return table.write(kept.unionByName(fresh, allowMissingColumns=True), DAY, replaced=days, keys=KEYS, note={"ingested_at": newest, "hours": told, "days": days}, base=base, sort=[DAY, "flow_hour"])


def update(facts: Versioned, table: Versioned, make: Callable[[DataFrame], DataFrame], hour: str | None = None, made_by: str = "") -> None:
    """Bring a table of the fact up to the fact's version: what `make` gives for the days, or hours, that have changed.

    make: rows with DAY, each of them from facts of that day alone; hour: the column of the result that tells the hour of
    its facts, if each row is from facts of one hour alone: then only changed hours are computed. made_by: what `make`
    depends on besides the facts; where that, or what has changed, isn't known, the table is made whole.
    """
    current, base = facts.manifest(), table.manifest()
    if current is None:
        return
    note = {"facts": current["version"], "made_by": made_by}
    known = base is not None and base["note"]["made_by"] == made_by
    if known and base["note"]["facts"] == current["version"]:
        return
    versions = facts.since(base["note"]["facts"]) if known else None
    if versions is None or any(v["note"]["hours"] is None for v in versions):
        table.write(make(facts.read(manifest=current)), DAY, note=note, base=base)
        return
    days = sorted({d for v in versions for d in v["note"]["days"]})
    rows = facts.read(days, manifest=current)
    if hour is None:
        made = make(rows)
    else:
        stale = sorted({h for v in versions for h in v["note"]["hours"]})
        rest = table.read(days, manifest=base).where(~F.unix_timestamp(hour).isin(stale))
        made = make(rows.where(F.col("flow_hour").isin([F.timestamp_seconds(F.lit(h)) for h in stale]))).unionByName(rest, allowMissingColumns=True)
    table.write(made, DAY, replaced=days, note=note, base=base)


def hourly(facts: DataFrame) -> DataFrame:
    return agg_traffic_hourly(facts).withColumn(DAY, F.to_date("hour_start"))


def build(spark: SparkSession, bronze: DataFrame, gold: str, zones: DataFrame, services: DataFrame, run_started_at: datetime, thresholds: Thresholds = Thresholds(), full_refresh: bool = False) -> None:
    """Bring the stored fact and hours up to date."""
    update_facts(spark, bronze, f"{gold}/fct_flows", zones, services, run_started_at, thresholds.incremental_lookback_minutes, full_refresh)
    update(Versioned(spark, f"{gold}/fct_flows"), Versioned(spark, f"{gold}/agg_traffic_hourly"), hourly, "hour_start")
