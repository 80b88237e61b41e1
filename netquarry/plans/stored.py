"""Queries over tables that are written and read again: landing files, lake, incremental gold and stream."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netquarry.operators import contract, facts, gold, incremental, ocsf, serving
from netquarry.plans import adapter, contract_cases
from netquarry.sources import captures
from netquarry.sources import lake as L
from netquarry.sources.discovery import Listing
from netquarry.sources.reference import SITE_ZONES, reference_table
from netquarry.sources.versions import Versioned
from netquarry.streaming import bronze

_RUNS = [datetime(2024, 3, 1), datetime(2024, 3, 2), datetime(2024, 3, 3)]


#: Most flows in one capture document, about 4 MB of JSON.
FLOWS_A_DOCUMENT = 4000
_CAPTURES = 20


def landing(spark: SparkSession, sf_dir: str) -> str:
    """The contract cases of `events` as capture documents, one file each; returns their folder.

    A capture goes on in as many documents as it needs, as the files of a capture tool that starts a new one at a fixed
    size; file_name tells the capture and the number of its flows in the documents before.
    """
    part = F.expr(f"record_index div {_CAPTURES * FLOWS_A_DOCUMENT}")
    raw = contract_cases.raw(spark, sf_dir).withColumn("part", part)
    # one row a document, not a flow, comes to the window
    sizes = raw.groupBy("batch_id", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("batch_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sizes.select("batch_id", "part", before.cast("string").alias("first"))
    flows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record_index", "raw"))), lambda x: x.raw), ",")
    documents = raw.groupBy("batch_id", "part").agg(flows.alias("flows")).join(first, ["batch_id", "part"])
    head = F.concat(F.lit('{"capture":{"file_name":"'), "batch_id", F.lit("_"), "first", F.lit('.pcap"},"completion_state":"complete","flows":['))
    value = documents.select(F.concat(head, "flows", F.lit("]}")).alias("value"), F.lit("s1").alias("sensor"), "batch_id", "part")
    path = L.work_dir(spark, "landing")
    value.repartition("batch_id", "part").write.partitionBy("sensor", "batch_id", "part").text(f"{path}/out")
    # text files get the suffix of captures by name only: they are read by their folder
    return f"{path}/out"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing(spark, sf_dir)).select(F.regexp_replace("path", r"\.txt$", ".json").alias("path"), "length", "content")
    return captures.capture_documents(files)


def capture_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of one capture count as one."""
    capture = F.coalesce(F.nullif(F.regexp_extract("capture_file", r"^(.*)_\d+\.pcap$", 1), F.lit("")), F.col("path"))
    return documents(spark, sf_dir).groupBy("sensor_id", "status", "completion_state").agg(F.count_distinct(capture).alias("documents"), F.sum(F.size("flows")).cast("bigint").alias("flows"))


def explode_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_index counts on through the documents of a capture."""
    first = F.regexp_extract("capture_file", r"_(\d+)\.pcap$", 1).cast("bigint")
    return captures.explode_flows(documents(spark, sf_dir)).groupBy((first + F.col("record_index")).alias("record_index")).agg(F.count("*").alias("n"))


def _loads(spark: SparkSession, sf_dir: str) -> str:
    """Three incremental builds as the ingestion dates go by; returns the gold folder."""
    rows, folder = adapter.bronze(spark, sf_dir), L.work_dir(spark, "gold")
    ref = reference_table(spark, "network_zones", SITE_ZONES), reference_table(spark, "service_ports")
    for cut, run in zip(("2024-01-10", "2024-01-20", "9999-01-01"), _RUNS, strict=True):
        incremental.build(spark, rows.where(f"ingested_at < '{cut}'"), folder, *ref, run)
    return folder


def fct_flows_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Versioned(spark, f"{_loads(spark, sf_dir)}/fct_flows").read().select("record_id", "direction", "service", "bytes_total", "batch_id")


def agg_hourly_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Versioned(spark, f"{_loads(spark, sf_dir)}/agg_traffic_hourly").read().select("hour_start", "direction", "protocol_name", "service", "flows", "packets", "bytes", "distinct_initiators", "distinct_responders")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables kept by three incremental builds against those of one full refresh: rows of each and how many the other lacks."""
    steps, whole = _loads(spark, sf_dir), L.work_dir(spark, "gold")
    ref = reference_table(spark, "network_zones", SITE_ZONES), reference_table(spark, "service_ports")
    incremental.build(spark, adapter.bronze(spark, sf_dir), whole, *ref, _RUNS[2], full_refresh=True)
    out = []
    for name in ("fct_flows", "agg_traffic_hourly"):
        one, other = (Versioned(spark, f"{top}/{name}").read().drop("loaded_at", "max_loaded_at", "flow_warnings") for top in (steps, whole))
        rows = one.select(F.lit("incremental").alias("side")).unionByName(other.select(F.lit("full").alias("side")))
        rows = rows.unionByName(serving.snapshot_difference(one, other).select(F.concat(F.lit("only_in_"), "only_in").alias("side")))
        out.append(rows.groupBy(F.lit(name).alias("model")).agg(*[F.count_if(F.col("side") == side).alias(as_) for side, as_ in (("incremental", "found"), ("full", "expected"), ("only_in_one", "more"), ("only_in_other", "missing"))]))
    return reduce(DataFrame.unionByName, out)


def _inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    refs = {x: reference_table(spark, x, SITE_ZONES if x == "network_zones" else None) for x in ("network_zones", "service_ports", "detection_rules", "mitre_techniques", "detection_allowlist")}
    return refs | {"flows": adapter.bronze(spark, sf_dir), "quarantine": adapter.quarantine(spark, sf_dir)}


def gold_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every gold model after one full build."""
    x = gold.build(spark, _inputs(spark, sf_dir), L.work_dir(spark, "gold"), _RUNS[0])
    counted = [x(name).select(F.lit(name).alias("model")) for name in ("fct_flows", "agg_traffic_hourly", "stg_quarantine", "stg_network_zones", "dim_hosts", "dim_host_names", "dq_batches", "ocsf_network_activity")]
    return reduce(DataFrame.unionByName, counted).groupBy("model").agg(F.count("*").alias("n"))


def gold_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks that fail on a full build."""
    return gold.run_checks(gold.build(spark, _inputs(spark, sf_dir), L.work_dir(spark, "gold"), _RUNS[0]))


def ocsf_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and bytes of each day of the export, read back from its JSON lines."""
    rows, path = _inputs(spark, sf_dir), L.work_dir(spark, "ocsf")
    ocsf.export(facts.fct_flows(facts.stage_flows(rows["flows"]), rows["network_zones"], rows["service_ports"], _RUNS[0]), path, "json")
    read = spark.read.schema("metadata struct<uid: string>, traffic struct<bytes: bigint>, day date").json(path)
    return read.groupBy("day").agg(F.count_distinct("metadata.uid").alias("n"), F.sum("traffic.bytes").alias("bytes"))


def lake_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract cases committed as batches of their documents, and once more as after a failure: nothing is doubled.

    Rows of the lake by outcome, and what the ledger says was written by both attempts.
    """
    # four reads of the documents follow, which would else make and parse them each time
    lake, docs = L.work_dir(spark, "lake"), L.stored(documents(spark, sf_dir), "documents")
    for run in _RUNS[:2]:
        told = contract.checked(captures.explode_flows(docs).withColumn("ingested_at", F.lit(run).cast("timestamp")))
        batches = docs.select("batch_id", F.lit("file").alias("source"), F.col("path").alias("input_ref"), "sensor_id", F.lit("ingested").alias("status"), F.col("error").alias("reason"))
        L.commit(told, batches, lake)
    ledger = serving.batch_summary(L.table(spark, lake, "ledger")).select(F.concat(F.lit("ledger "), "status").alias("outcome"), F.col("records_written").alias("records"))
    reasons = serving.quarantine_reasons(L.table(spark, lake, "ledger")).select(F.concat(F.lit("ledger "), "reason").alias("outcome"), "records")
    return _outcomes(spark, lake).unionByName(ledger).unionByName(reasons)


def _outcomes(spark: SparkSession, lake: str) -> DataFrame:
    good = L.table(spark, lake, "flows").select(F.lit("valid").alias("outcome"))
    return good.unionByName(L.table(spark, lake, "quarantine").select(F.col("error_type").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("records"))


def stream_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract cases as messages through a file stream into a lake: rows written and quarantined by error type."""
    top = L.work_dir(spark, "stream")
    raw = contract_cases.raw(spark, sf_dir)
    head = F.to_json(F.struct(F.lit(1).alias("contract_version"), "sensor_id", "capture_id", "completion_state"))
    raw.withColumn("h", head).select(F.concat(F.expr("left(h, length(h) - 1)"), F.lit(',"flow":'), "raw", F.lit("}")).alias("value")).write.parquet(f"{top}/messages")
    stream = spark.readStream.schema("value string").parquet(f"{top}/messages")
    bronze.stream_to_bronze(stream, f"{top}/lake", f"{top}/checkpoint", available_now=True).awaitTermination()
    return _outcomes(spark, f"{top}/lake")


# ---------------------------------------------------------------- landing folders


def json_landing(spark: SparkSession, sf_dir: str, where: str = "true", path: str | None = None) -> str:
    """The contract cases without bare NaN as JSON files, one for each capture and part, in a new folder or at `path`; returns it."""
    part = F.expr(f"record_index div {_CAPTURES * FLOWS_A_DOCUMENT}")
    raw = contract_cases.raw(spark, sf_dir).where("record_index % 40 <> 4").where(where).withColumn("part", part)
    flows = F.transform(F.array_sort(F.collect_list(F.struct("record_index", "raw"))), lambda x: F.parse_json(x.raw))
    name = F.struct(F.concat("batch_id", F.lit(".pcap")).alias("file_name"))
    documents = raw.groupBy("batch_id", "part").agg(flows.alias("flows")).select(name.alias("capture"), F.lit("complete").alias("completion_state"), "flows", F.lit("s1").alias("sensor"), "batch_id", "part")
    path = path or L.work_dir(spark, "landing")
    documents.repartition("batch_id", "part").write.mode("append").partitionBy("sensor", "batch_id", "part").json(path)
    return path


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found below the landing folder, by the sensor that their folder names."""
    found = captures.landing_files(spark, json_landing(spark, sf_dir))
    return found.groupBy(captures.sensor_from_path(F.col("path")).alias("sensor_id"), F.lower(F.substring_index("path", ".", -1)).alias("suffix")).agg(F.count_distinct("path").alias("n"))


def ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing folder ingested twice: documents by status, then rows of the lake by outcome."""
    path, lake, out = json_landing(spark, sf_dir), L.work_dir(spark, "lake"), []
    for name, run in zip(("first ", "again "), _RUNS, strict=False):
        found = L.ingest(spark, lake, path, ingested_at=run)
        out.append(found.groupBy(F.concat(F.lit(name), "status").alias("outcome")).agg(F.count("*").alias("records")))
    return reduce(DataFrame.unionByName, [*out, _outcomes(spark, lake)])


def changed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ingestions by changed folders, over half the captures, over all of them, and over the same again: what each did."""
    path, lake, out = L.work_dir(spark, "landing"), L.work_dir(spark, "lake"), []
    for k, (run, half) in enumerate(zip(_RUNS, (0, 1, None), strict=True), 1):
        if half is not None:
            json_landing(spark, sf_dir, f"record_index % 2 = {half}", path)
        listing = Listing(spark, f"{lake}/_listing", path, settle=0)
        found = L.ingest(spark, lake, path, ingested_at=run, listing=listing)
        note = listing.table.manifest()["note"]
        done = found.agg(F.count_if(F.col("status") == "ingested").alias("ingested"), F.count_if(F.col("status") != "ingested").alias("others"))
        out.append(done.select(F.lit(k).cast("long").alias("run"), "ingested", "others", F.lit(note["listed"]).cast("long").alias("listed"), F.lit(note["unchanged"]).cast("long").alias("unchanged")))
    return reduce(DataFrame.unionByName, out)


def ledger_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of four commits, one batch an event, compacted with commits before and after it: batches and records by status."""
    lake, events = L.work_dir(spark, "lake"), spark.read.parquet(f"{sf_dir}/events.parquet")
    for k in range(4):
        rows = events.where(F.col("event_id") % 4 == k).selectExpr(
            "CAST(event_id AS STRING) AS batch_id", "CASE WHEN event_id % 3 = 0 THEN 'rejected' ELSE 'ingested' END AS status", "'file' AS source", "concat('/f', event_id) AS input_ref", "'s1' AS sensor_id",
            "event_id % 7 AS records_written", "event_id % 5 AS records_quarantined", "map('x', event_id) AS reasons", "CAST(NULL AS STRING) AS reason", "array('f') AS files", "ts AS modified", "current_timestamp() AS finished_at", f"'c{k}' AS commit",
        )
        L.write_ledger(rows, lake)
        if k > 0:
            L.compact_ledger(spark, lake, hours=0)
    return serving.batch_summary(L.table(spark, lake, "ledger")).withColumnRenamed("records_quarantined", "records")


def ingest_in_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing folder ingested as files that are too large for one value, and its hashes: rows of the lake, files by outcome."""
    path, lake = json_landing(spark, sf_dir), L.work_dir(spark, "lake")
    found = L.ingest(spark, lake, path, ingested_at=_RUNS[0], largest=0).groupBy("status").agg(F.count("*").alias("n")).select(F.col("status").alias("outcome"), F.col("n").alias("records"))
    files = captures.landing_files(spark, path)
    whole, pieces = captures.capture_inventory(files), captures.capture_inventory(files, largest=0)
    same = whole.join(pieces, ["path", "length", "sha256", "format"]).agg(F.count("*").alias("records")).select(F.lit("hashed alike").alias("outcome"), "records")
    return reduce(DataFrame.unionByName, [found, same, _outcomes(spark, lake)])


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows before and after the days before the second run are dropped; late events lie below the day they came."""
    path, lake = json_landing(spark, sf_dir), L.work_dir(spark, "lake")
    for part, run in zip("12", _RUNS, strict=False):
        L.ingest(spark, lake, f"{path}/sensor=s1/batch_id=b-{part}*", "s1", ingested_at=run)
    days = lambda when: L.table(spark, lake, "flows").groupBy(F.lit(when).alias("at"), "ingest_date").agg(F.count("*").alias("n"))
    # a row for each day
    before = spark.createDataFrame(days("before").collect(), "at string, ingest_date date, n bigint")
    L.drop_before(spark, lake, "flows", str(_RUNS[1].date()))
    return before.unionByName(days("after"))


def empty_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table of a lake that nothing was written to, beside the number of events that could have been."""
    lake, events = L.work_dir(spark, "lake"), spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.count("*").alias("events"))
    counts = [L.table(spark, lake, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name in ("flows", "quarantine", "ledger")]
    return reduce(DataFrame.unionByName, counts).join(events, F.lit(True))


def reference_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service ports of the users of the events, written as CSV and read as a reference table."""
    path = L.work_dir(spark, "service_ports")
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    users.selectExpr("CAST(user_id % 2 * 11 + 6 AS SMALLINT) AS protocol", "CAST(user_id AS INT) AS port", "concat('s, \"', user_id % 7, '\"') AS service").write.option("header", "true").option("escape", '"').csv(path)
    return reference_table(spark, "service_ports", path=path).select("protocol", "port", "service")


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after two incremental builds and a full refresh over the same folder: every row is of the last run."""
    rows, folder = adapter.bronze(spark, sf_dir), L.work_dir(spark, "gold")
    ref = reference_table(spark, "network_zones", SITE_ZONES), reference_table(spark, "service_ports")
    for cut, run, whole in (("2024-01-10", _RUNS[0], False), ("9999-01-01", _RUNS[1], False), ("9999-01-01", _RUNS[2], True)):
        incremental.update_facts(spark, rows.where(f"ingested_at < '{cut}'"), f"{folder}/fct_flows", *ref, run, full_refresh=whole)
    return Versioned(spark, f"{folder}/fct_flows").read().groupBy("loaded_at", "direction").agg(F.count("*").alias("flows"), F.sum("bytes_total").alias("bytes"))


def _replayed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A folder with the messages of the contract cases in two files, the second with a third of them once more; and its stream."""
    top, raw = L.work_dir(spark, "stream"), contract_cases.raw(spark, sf_dir)
    head = F.to_json(F.struct(F.lit(1).alias("contract_version"), "sensor_id", "capture_id", "completion_state"))
    made = raw.withColumn("h", head).select(F.concat(F.expr("left(h, length(h) - 1)"), F.lit(',"flow":'), "raw", F.lit("}")).alias("value"), F.col("ingested_at").alias("timestamp"), "record_index")
    made.drop("record_index").write.parquet(f"{top}/messages")
    again = made.where("record_index % 3 = 0").withColumn("timestamp", F.col("timestamp") + F.expr("interval 5 minutes")).drop("record_index")
    return top, again


def replay_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the messages come once more after a restart of the stream: bronze rows by outcome."""
    top, again = _replayed(spark, sf_dir)
    for more in (None, again):
        if more is not None:
            more.write.mode("append").parquet(f"{top}/messages")
        stream = spark.readStream.schema("value string, timestamp timestamp").parquet(f"{top}/messages")
        bronze.stream_to_bronze(stream, f"{top}/lake", f"{top}/checkpoint", available_now=True, time="timestamp", within="3650 days").awaitTermination()
    return _outcomes(spark, f"{top}/lake")


def drain_and_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream drained three times, with messages coming before the third: batches and rows after each."""
    top, again = _replayed(spark, sf_dir)
    out = []
    for k in range(3):
        if k == 2:
            again.write.mode("append").parquet(f"{top}/messages")
        stream = spark.readStream.schema("value string, timestamp timestamp").parquet(f"{top}/messages")
        bronze.stream_to_bronze(stream, f"{top}/lake", f"{top}/checkpoint", available_now=True).awaitTermination()
        rows = _outcomes(spark, f"{top}/lake").agg(F.sum("records").alias("records"))
        out.append((k, rows.first()[0]))
    return spark.createDataFrame(out, "run bigint, records bigint")


QUERIES = {
    f.__name__: f
    for f in (
        capture_documents, explode_flows, fct_flows_incremental, agg_hourly_incremental, stream_to_bronze, lake_commit, gold_build, gold_checks, ocsf_export, landing_files, ingest_all, changed_folders, ledger_compaction, ingest_in_pieces, retention, empty_lake, reference_tables, full_refresh,
        replay_dedupe, drain_and_stop,
    )
}
