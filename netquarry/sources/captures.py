"""Capture documents: discovery, identities, parsing and raw flows, as one Spark job over all files."""

from __future__ import annotations

import re
from contextlib import suppress

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.operators.contract import marked
from netquarry.sources import pieces

SENSOR = "[A-Za-z0-9][A-Za-z0-9._-]{0,63}"
CAPTURES = r"\.(json|pcap|pcapng|cap)$"
_GLOB = "*.{[jJ][sS][oO][nN],[pP][cC][aA][pP],[pP][cC][aA][pP][nN][gG],[cC][aA][pP]}"
#: Spark holds a file's content in one value of under 2 GB; larger files are read in pieces.
LARGEST = (1 << 31) - (1 << 20)
#: Files that are opened by name in one run.
MOST_NAMES = 100_000
DOCUMENT = "capture struct<file_name: string, packets_processed: bigint>, completion_state string, flows array<string>, error struct<code: string, category: string, message: string>"


def landing_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, modified, length, content of the capture files below `path` (or at these paths); Spark leaves out what starts with `_` or `.`.

    Files that vanish or can't be read leave no row. Their content is read only where it is selected.
    """
    options = {"recursiveFileLookup": "true", "ignoreMissingFiles": "true", "ignoreCorruptFiles": "true", "pathGlobFilter": _GLOB}
    files = spark.read.format("binaryFile").options(**options).load(path)
    return files.where(F.lower("path").rlike(CAPTURES)).select("path", F.col("modificationTime").alias("modified"), "length", "content")


def named_files(spark: SparkSession, path: str, wanted: DataFrame, most: int = MOST_NAMES) -> DataFrame:
    """landing_files of the wanted (path, modified) alone; no other file is opened.

    Their names pass the driver, as in any listing. More than `most` of them, names that read as patterns, and files that
    vanish meanwhile are taken from a scan of all files below `path`, which opens each; the rows are the same.
    """
    names = [r[0] for r in wanted.select("path").limit(most + 1).collect()]
    if not names:
        return spark.createDataFrame([], "path string, modified timestamp, length bigint, content binary")
    if len(names) <= most and not any(c in x for x in names for c in "{}[]*?\\"):
        with suppress(AnalysisException):
            return landing_files(spark, names)
    return landing_files(spark, path).join(wanted.select("path", "modified"), ["path", "modified"], "left_semi")


def check_sensor_id(sensor: str) -> str:
    """The id if it is valid: 1 to 64 letters, digits, `.`, `_` or `-`, the first a letter or digit."""
    if not re.fullmatch(SENSOR, sensor, re.ASCII):
        raise ValueError(f"{sensor!r} is no sensor id: 1 to 64 letters, digits, '.', '_' or '-', the first a letter or digit")
    return sensor


def sensor_folder(path: Column) -> Column:
    """What the innermost `sensor=` folder names, valid or not; null without one."""
    return F.when(path.rlike("/sensor=[^/]*/"), F.regexp_extract(path, r".*/sensor=([^/]*)/", 1))


def sensor_from_path(path: Column, sensor: str | None = None) -> Column:
    """The given sensor, else the id of the innermost `sensor=<id>` folder, else `default`. An id that is none is an error."""
    if sensor is not None:
        return F.lit(check_sensor_id(sensor))
    found = sensor_folder(path)
    refused = F.raise_error(F.concat(F.lit("no sensor id: "), found, F.lit(" in "), path)).cast("string")
    return F.when(found.isNull(), "default").when(found.rlike(rf"\A{SENSOR}\z"), found).otherwise(refused)


def file_batch_id(sensor_id: Column, content_sha256: Column) -> Column:
    return F.concat(F.lit("file-"), F.substring(F.sha2(F.concat(sensor_id, F.lit(":"), content_sha256), 256), 1, 32))


def capture_documents(files: DataFrame, sensor: str | None = None) -> DataFrame:
    """One row for each JSON file: identities, completion_state, flows (JSON text of each), status and error.

    status: `valid`, or `rejected` for an error document, broken JSON or another document.
    """
    text = F.col("content").cast("string")
    given = [c for c in ("path", "modified", "length") if c in files.columns]
    read = files.where(F.lower("path").endswith(".json")).select(*given, text.alias("text"), F.sha2("content", 256).alias("content_sha256"), sensor_from_path(F.col("path"), sensor).alias("sensor_id"))
    # bare NaN is no JSON but may stand in a flow; the whole is then still a document, and the flow gets it back below
    told = read.withColumn("text", F.when(F.try_parse_json("text").isNull(), marked(F.col("text"), "__bare__$2")).otherwise(F.col("text")))
    told = told.withColumns({"whole": F.try_parse_json("text"), "d": F.from_json("text", DOCUMENT)})
    # whether flows are a list is asked once, and not by their schema, which is that of all of them
    lists = {"__no_flows": F.expr("variant_get(whole, '$.flows', 'variant') IS NULL"), "__listed": F.expr("try_variant_get(whole, '$.flows', 'array<variant>') IS NOT NULL")}
    told = told.withColumns(lists)
    kind = lambda field: F.expr(f"schema_of_variant(variant_get(whole, '$.{field}', 'variant'))")
    is_document = F.coalesce(F.col("__listed") & kind("capture").startswith("OBJECT") & (F.length("d.completion_state") > 0), F.lit(False))
    is_error = F.coalesce(kind("error").startswith("OBJECT") & F.col("__no_flows"), F.lit(False))
    told_error = F.lit(True)
    for x in ("code", "category", "message"):
        told_error &= F.coalesce(kind(f"error.{x}") == "STRING", F.lit(False))
    refused = F.when(told_error, F.concat(F.lit("upstream error: "), "d.error.code")).otherwise("malformed error document")
    error = F.when(F.col("whole").isNull(), "not valid JSON").when(is_error, refused).when(~is_document, "not a flows document")
    flows = F.transform("d.flows", lambda x: F.regexp_replace(x, '"__bare__(-?Infinity|NaN)"', "$1"))
    found = told.select(*given, "content_sha256", "sensor_id", F.col("d.capture.file_name").alias("capture_file"), "d.completion_state", F.when(error.isNull(), flows).alias("flows"), error.alias("error"))
    return _identified(found, given)


def _identified(found: DataFrame, given: list[str]) -> DataFrame:
    return found.select(
        *given, "content_sha256", "sensor_id", file_batch_id(F.col("sensor_id"), F.col("content_sha256")).alias("batch_id"), F.concat(F.lit("sha256:"), "content_sha256").alias("capture_id"),
        "capture_file", "completion_state", "flows", F.when(F.col("error").isNull(), "valid").otherwise("rejected").alias("status"), "error",
    )


def large_documents(files: DataFrame, rows: DataFrame, sensor: str | None = None) -> DataFrame:
    """capture_documents of files read in pieces, with null for flows; rows: what pieces.parsed made of the files, as a table."""
    given = [c for c in ("path", "modified", "length") if c in files.columns]
    heads = rows.where("content_sha256 is not null").drop("section", "record_index", "raw")
    found = files.select(*given).join(heads, "path").withColumns({"sensor_id": sensor_from_path(F.col("path"), sensor), "flows": F.lit(None).cast("array<string>")})
    return _identified(found, given)


def large_flows(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """explode_flows of the valid documents that were read in pieces."""
    last = rows.where("content_sha256 is not null").select("path", "section")
    counted = rows.where("record_index is not null").select("path", "section", "record_index", "raw").join(last, ["path", "section"], "left_semi")
    context = documents.where("status = 'valid'").select("path", "batch_id", F.lit("file").alias("source"), "sensor_id", "capture_id", "capture_file", "completion_state")
    return counted.join(context, "path").select(*context.columns[1:], "record_index", "raw")


def explode_flows(documents: DataFrame) -> DataFrame:
    """raw, record_index and the context of each flow of the valid documents."""
    return documents.where("status = 'valid'").select("batch_id", F.lit("file").alias("source"), "sensor_id", "capture_id", "capture_file", "completion_state", F.posexplode("flows").alias("record_index", "raw")).withColumn("record_index", F.col("record_index").cast("bigint"))


def capture_inventory(files: DataFrame, largest: int = LARGEST, open_file: pieces.Opener = pieces.open_path) -> DataFrame:
    """path, length, sha256, format of every capture file, by its first four bytes.

    Files over `largest` bytes are hashed in pieces; sha256 and format are null for those of them that can't be read.
    """
    small = files.where(F.col("length") <= largest).select("path", "length", F.sha2("content", 256).alias("sha256"), F.hex(F.substring("content", 1, 4)).alias("magic"))
    found = small.unionByName(pieces.hashed(files.where(F.col("length") > largest), open_file))
    magic = F.col("magic")
    # The magic numbers of capture files.
    kind = F.when(magic.isin("D4C3B2A1", "4D3CB2A1"), "pcap").when(magic.isin("A1B2C3D4", "A1B23C4D"), "pcap").when(magic == "0A0D0D0A", "pcapng").when(magic.isNotNull(), "unknown")
    return found.select("path", "length", "sha256", kind.alias("format"))
