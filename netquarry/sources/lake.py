"""The lake's tables: bronze flows, quarantine and ledger; batch ingestion."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.operators import contract
from netquarry.schemas import BRONZE, LEDGER, QUARANTINE
from netquarry.sources import pieces
from netquarry.sources.captures import LARGEST, SENSOR, capture_documents, check_sensor_id, explode_flows, landing_files, large_documents, large_flows, named_files, sensor_folder
from netquarry.sources.discovery import Listing


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir or the folder given to setCheckpointDir().

    Only in local mode, where all run on one machine, a temporary one does where neither is set (tests).
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        java = spark.sparkContext._jsc.sc().getCheckpointDir()
        top = java.get() if java.isDefined() else None
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = tempfile.mkdtemp(prefix="spark-lake-")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows as an intermediate table, of which Spark knows the size."""
    spark, path = rows.sparkSession, work_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored_table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """All rows of a table's files, with `commit`; empty with its schema if nothing was written yet.

    A row of the ledger is known by batch and commit, so that it counts once while a compaction has it in two files.
    """
    schema = {"flows": BRONZE.replace(" not null", "") + ", ingest_date date, commit string", "quarantine": QUARANTINE + ", ingest_date date, commit string", "ledger": LEDGER}[name]
    empty = spark.createDataFrame([], schema)
    if not exists(spark, f"{lake}/{name}"):
        return empty
    rows = spark.read.schema(schema).parquet(f"{lake}/{name}").select(*empty.columns)
    return _once(rows) if name == "ledger" else rows


def _once(ledger: DataFrame) -> DataFrame:
    """One row for each batch and commit. Spark's dropDuplicates below exceptAll leaves a plan that it can't run."""
    keys = ["batch_id", "commit"]
    return ledger.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ledger.columns if c not in keys]).select(*ledger.columns)


def table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """A table of the lake as its ledger has it; empty with its schema if nothing was written yet.

    Rows count from the moment that the ledger names their commit, all rows of a commit at once; of a batch that was written
    again, the rows of its last commit. `commit` is a partition, so files of no commit aren't opened; batches written more
    than once are few, and only they are compared.
    """
    rows = stored_table(spark, lake, name)
    if name == "ledger":
        return rows
    ledger = stored_table(spark, lake, "ledger").where("commit IS NOT NULL").select("batch_id", "commit", "finished_at")
    last = ledger.groupBy("batch_id").agg(F.max(F.struct("finished_at", "commit")).alias("last"), F.count("*").alias("n")).where("n > 1")
    old = ledger.join(last, "batch_id").where("commit <> last.commit").select("batch_id", "commit").distinct()
    return rows.join(ledger.select("commit").distinct(), "commit", "left_semi").join(old, ["batch_id", "commit"], "left_anti").drop("commit").select(*[c for c in rows.columns if c != "commit"])


def write_batches(df: DataFrame, lake: str, name: str, commit: str) -> None:
    """Write rows below their ingestion date and commit; ingested_at must be set. Nothing of older commits is touched."""
    dated = df.withColumns({"ingest_date": F.to_date("ingested_at"), "commit": F.lit(commit)}).hint("rebalance", "ingest_date")
    dated.write.mode("append").option("compression", "zstd").partitionBy("ingest_date", "commit").parquet(f"{lake}/{name}")


def vacuum(spark: SparkSession, lake: str, hours: float = 24) -> list[str]:
    """Delete files of commits that the ledger doesn't name and that are older than the given hours, as a failed write leaves them.

    One folder for each day and commit passes the driver, as in any listing of partitions.
    """
    finished = {r[0] for r in stored_table(spark, lake, "ledger").where("commit IS NOT NULL").select("commit").distinct().collect()}
    before, gone = datetime.now(timezone.utc).timestamp() * 1000 - hours * 3_600_000, []
    for name in ("flows", "quarantine"):
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{lake}/{name}/ingest_date=*/commit=*")
        fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in fs.globStatus(pattern) or []:
            commit = found.getPath().getName().removeprefix("commit=")
            if commit not in finished and found.getModificationTime() <= before:
                fs.delete(found.getPath(), True)
                gone.append(commit)
    return sorted(set(gone))


def write_ledger(rows: DataFrame, lake: str) -> None:
    names = [x.split()[0] for x in "batch_id,status,source,input_ref,sensor_id,records_written,records_quarantined,reasons,reason,files,modified,finished_at,commit".split(",")]
    rows.select(*names).write.mode("append").parquet(f"{lake}/ledger")


def compact_ledger(spark: SparkSession, lake: str, hours: float = 1) -> int:
    """Write the ledger's rows, one small file a commit, as few files; returns the number of files deleted.

    Rows are written beside the old ones and count once (see stored_table), so readers and writers go on meanwhile, and a run
    that stops anywhere loses nothing. The replaced files are named in a list, and deleted by the first compaction that
    comes `hours` later, when no reader has them in its plan any more. File names pass the driver, as in any listing.
    """
    if not exists(spark, f"{lake}/ledger"):
        return 0
    path, conf, gone = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), 0
    folder = path(f"{lake}/_replaced")
    fs = folder.getFileSystem(conf)
    before = datetime.now(timezone.utc).timestamp() * 1000 - hours * 3_600_000
    for done in fs.globStatus(path(f"{lake}/_replaced/*/_SUCCESS")) or []:
        if done.getModificationTime() <= before:
            listed = done.getPath().getParent()
            gone += sum(fs.delete(path(r[0]), False) for r in spark.read.parquet(listed.toString()).toLocalIterator())
            fs.delete(listed, True)
    # what is replaced is fixed before it is read: a file that comes now is in no list
    files = [f.getPath().toString() for f in fs.listStatus(path(f"{lake}/ledger")) if f.getPath().getName().startswith("part-")]
    if len(files) > 1:
        rows = spark.read.schema(LEDGER).parquet(*files)
        _once(rows).hint("rebalance").write.mode("append").option("compression", "zstd").parquet(f"{lake}/ledger")
        spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.parquet(f"{lake}/_replaced/{uuid.uuid4().hex}")
    return gone


def commit(told: DataFrame, batches: DataFrame, lake: str) -> DataFrame:
    """Write checked flows as bronze and quarantine rows, then the ledger, which makes them count.

    batches: batch_id, source, input_ref, sensor_id, status, reason, and `modified` if known. A batch that failed on the way
    is simply written again: what its first attempt wrote never counts. The checks are a table first, as both writes read them.
    """
    spark, own = told.sparkSession, uuid.uuid4().hex
    work = f"{lake}/_work/{own}"
    context = ["batch_id", "source", "sensor_id", "capture_id", "capture_file", "completion_state", "ingested_at", "record_index"]
    more = [c for c in told.columns if c in ("envelope_error", "__shaped")]
    # the text is evidence of what is refused; what is right is kept by its fields
    evidence = F.when(F.col("error_type").isNotNull(), F.col("raw")).alias("raw")
    told.select(*context, evidence, "v", "__ip_initiator", "__ip_responder", "error_type", *more).write.parquet(work)
    done = spark.read.parquet(work)
    write_batches(contract.flattened(done.where("error_type is null")), lake, "flows", own)
    write_batches(contract.quarantined(done.where("error_type is not null")), lake, "quarantine", own)
    by_type = done.groupBy("batch_id", "error_type").agg(F.count("*").alias("n"))
    counts = by_type.groupBy("batch_id").agg(
        F.coalesce(F.sum(F.when(F.col("error_type").isNull(), F.col("n"))), F.lit(0)).alias("records_written"), F.coalesce(F.sum(F.when(F.col("error_type").isNotNull(), F.col("n"))), F.lit(0)).alias("records_quarantined"),
        F.map_from_entries(F.filter(F.collect_list(F.struct("error_type", "n")), lambda e: e["error_type"].isNotNull())).alias("reasons"),
    )
    rows = batches.join(counts, "batch_id", "left").na.fill(0, ["records_written", "records_quarantined"]).withColumns({"files": F.array("input_ref"), "finished_at": F.current_timestamp(), "commit": F.lit(own)})
    write_ledger(rows if "modified" in batches.columns else rows.withColumn("modified", F.lit(None).cast("timestamp")), lake)
    remove(spark, work)
    return table(spark, lake, "ledger")


def ingest(spark: SparkSession, lake: str, path: str, sensor: str | None = None, force: bool = False, ingested_at: datetime | None = None, largest: int = LARGEST, open_file: pieces.Opener = pieces.open_path, listing: Listing | None = None) -> DataFrame:
    """Ingest all capture documents below `path`, each as a batch of its own; finished batches are skipped unless forced.

    Returns (batch_id, path, status) of every document: ingested, rejected, skipped, or failed for files that couldn't be
    read; those leave no ledger entry and are tried again. Files over `largest` bytes are read in pieces by `open_file`. Files
    that the ledger knows by path and time of change aren't opened. With a listing of `path` (discovery.Listing) only folders that
    changed since the last such run are listed, and only their documents are in the result; a forced run lists all. A folder that names no valid sensor stops the run before anything is written.
    """
    work, report = f"{lake}/_work/{uuid.uuid4().hex}", f"{lake}/_runs/{uuid.uuid4().hex}"
    if listing and not force:
        listing.walk(f"{work}/listing")
    found = listing.files() if listing and not force else landing_files(spark, path).select("path", "modified", "length")
    files = found.where(F.lower("path").endswith(".json"))
    if sensor is None:
        bad = files.where(~sensor_folder(F.col("path")).rlike(rf"\A{SENSOR}\z")).select(sensor_folder(F.col("path"))).first()
        check_sensor_id(bad[0] if bad else "default")
    finished = table(spark, lake, "ledger").where("status in ('ingested', 'rejected')")
    files.write.parquet(f"{work}/files")
    listed = spark.read.schema("path string, modified timestamp, length bigint").parquet(f"{work}/files")
    known = finished.groupBy(F.col("input_ref").alias("path"), "modified").agg(F.min("batch_id").alias("batch_id"))
    opened = listed if force else listed.join(known, ["path", "modified"], "left_anti")
    capture_documents(named_files(spark, path, opened.where(F.col("length") <= largest)), sensor).write.parquet(f"{work}/documents")
    large = opened.where(F.col("length") > largest)
    # a file is read by one task, but its flows are checked by as many as there are partitions
    spread = int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("path", "record_index")
    pieces.parsed(large, open_file).repartition(*spread).write.parquet(f"{work}/large")
    read = spark.read.schema(pieces.PARSED).parquet(f"{work}/large")
    large_documents(large, read, sensor).write.mode("append").parquet(f"{work}/documents")
    documents = spark.read.parquet(f"{work}/documents")
    first = documents.groupBy("batch_id").agg(F.min("path").alias("path"))
    unique = documents.join(first, ["batch_id", "path"])
    todo = unique if force else unique.join(finished.select("batch_id").distinct(), "batch_id", "left_anti")
    # what is to do is fixed before the ledger changes
    new = F.when(F.col("status") == "valid", "ingested").otherwise("rejected").alias("status")
    found = todo.select("batch_id", "path", new).unionByName(unique.join(todo.select("batch_id"), "batch_id", "left_anti").select("batch_id", "path", F.lit("skipped").alias("status")))
    if not force:
        found = found.unionByName(listed.join(known, ["path", "modified"]).select("batch_id", "path", F.lit("skipped").alias("status")))
    unread = listed.join(known, ["path", "modified"], "left_anti") if not force else listed
    unread = unread.join(documents.select("path"), "path", "left_anti")
    failed = unread.select(F.concat(F.lit("unread-"), F.substring(F.sha2("path", 256), 1, 32)).alias("batch_id"), "path", F.lit("failed").alias("status"))
    found.unionByName(failed).write.parquet(report)
    # on the way the ledger may gain batches; the report and the list of what is to do don't follow it
    todo = documents.join(spark.read.parquet(report).where("status in ('ingested', 'rejected')").select("batch_id", "path"), ["batch_id", "path"])
    stamp = F.lit(ingested_at or datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp")
    told = contract.checked(explode_flows(todo).unionByName(large_flows(todo, read)).withColumn("ingested_at", stamp))
    batches = todo.select("batch_id", F.lit("file").alias("source"), F.col("path").alias("input_ref"), "sensor_id", "modified", new, F.col("error").alias("reason"))
    commit(told, batches, lake)
    if listing and not force:
        # only now: a run that stops before is done again from the same state
        listing.remember(spark.read.parquet(report).where("status = 'failed'"))
    remove(spark, work)
    return spark.read.schema("batch_id string, path string, status string").parquet(report)


def drop_before(spark: SparkSession, lake: str, name: str, day: str) -> list[str]:
    """Retention: delete the partitions of ingestion dates before `day`; a full refresh must follow."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{lake}/{name}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("ingest_date=") and s.getPath().getName() < f"ingest_date={day}"]
    for p in old:
        fs.delete(p, True)
    return sorted(p.getName() for p in old)
