"""Incremental discovery: of the folders below a landing path only those that have changed are listed again.

A folder's time of change moves when something comes into it or leaves it. A run looks up the times of the folders it knows,
in tasks, lists those whose time has moved, and goes on level by level into folders that it doesn't know. A folder is settled
once its own time and those of its files are older than `settle`; until then it is listed each time, so that neither
coarse clocks nor files that are still being written hide anything. A file that is changed in place in a settled folder is
seen by a whole listing alone. Where a filesystem tells no times of folders (object stores) every folder is listed.

Results for special rows: names that start with `_` or `.` are left out with all below them; folders that vanish leave no
row; an empty or missing landing path has no files; links count as what they point to.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.sources.versions import Versioned

if TYPE_CHECKING:
    from pyarrow.fs import FileSystem

#: Milliseconds without a change after which a folder is settled.
SETTLE = 60_000
#: Entries in one batch of rows that leaves a task.
ENTRIES = 10_000

FOLDERS = "folder string, settled bigint"
VISITED = "folder string, kind string, path string, modified bigint, length bigint"
FolderOpener = Callable[[str], "tuple[FileSystem, str]"]


def open_folder(path: str) -> tuple[FileSystem, str]:
    """The filesystem of a folder and its path there, for any that pyarrow knows (local, HDFS, S3, GCS)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@=+,"))


def visited(folders: DataFrame, opener: FolderOpener = open_folder) -> DataFrame:
    """VISITED rows of FOLDERS: `same` for a folder at its settled time, else `changed` with a `file` or `folder` row for each entry."""
    names = [x.split()[0] for x in VISITED.split(", ")]

    def told(folder: str, settled: int | None) -> Iterator[tuple]:
        from pyarrow import fs

        system, inner = opener(folder)
        own = system.get_file_info(inner)
        if own.type != fs.FileType.Directory:
            return
        # the time is taken before the listing: what comes meanwhile moves it, and is seen by the next run
        at = own.mtime_ns and own.mtime_ns // 1_000_000
        if at is not None and at == settled:
            yield folder, "same", None, at, None
            return
        yield folder, "changed", None, at, None
        for x in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            if x.base_name[0] not in "_.":
                is_file = x.type == fs.FileType.File
                yield folder, "file" if is_file else "folder", f"{folder.rstrip('/')}/{x.base_name}", x.mtime_ns and x.mtime_ns // 1_000_000, x.size if is_file else None

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for folder, settled in zip(batch["folder"], batch["settled"], strict=True):
                for row in told(folder, None if pd.isna(settled) else int(settled)):
                    rows.append(row)
                    if len(rows) >= ENTRIES:
                        yield _frame(rows, names)
                        rows = []
            yield _frame(rows, names)

    spread = int(folders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return folders.select("folder", "settled").repartition(spread, F.xxhash64("folder")).mapInPandas(tell, VISITED)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"modified": "Int64", "length": "Int64"})


class Listing:
    """What earlier runs have seen below the folder `top`, kept as a versioned table at `path`."""

    def __init__(self, spark: SparkSession, path: str, top: str, opener: FolderOpener = open_folder, settle: int = SETTLE) -> None:
        self.spark, self.opener, self.settle = spark, opener, settle
        p = spark._jvm.org.apache.hadoop.fs.Path(top)
        self.top = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
        self.table = Versioned(spark, path)

    def walk(self, work: str) -> DataFrame:
        """VISITED rows of this run, as a table below `work`: a row for each known folder, and all entries of those that changed."""
        self.base, self.started = self.table.manifest(), time.time_ns() // 1_000_000
        first = self.spark.createDataFrame([(self.top, None)], FOLDERS)
        todo = first
        if self.base:
            known = self.table.read(manifest=self.base)
            todo = known.unionByName(first.join(known, "folder", "left_anti"))
        steps: list[str] = []
        while True:
            steps.append(f"{work}/step-{len(steps)}")
            visited(todo, self.opener).write.parquet(steps[-1])
            self.seen = self.spark.read.schema(VISITED).parquet(*steps)
            done = self.seen.where("kind IN ('same', 'changed')").select("folder")
            found = self.spark.read.schema(VISITED).parquet(steps[-1]).where("kind = 'folder'").select(F.col("path").alias("folder"))
            todo = found.distinct().join(done, "folder", "left_anti").withColumn("settled", F.lit(None).cast("bigint"))
            if todo.isEmpty():
                return self.seen

    def files(self) -> DataFrame:
        """path, modified, length of the files in the folders that have changed."""
        return self.seen.where("kind = 'file'").select("path", F.timestamp_millis("modified").alias("modified"), "length")

    def remember(self, again: DataFrame) -> dict:
        """Make what walk() has seen the state for the next run, once its files are dealt with; again: paths to be looked for anew.

        Returns the table's new manifest, which notes how many folders were listed and how many hadn't changed.
        """
        newest = self.seen.where("kind = 'file'").groupBy("folder").agg(F.max("modified").alias("newest"))
        unread = again.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().withColumn("unread", F.lit(True))
        told = self.seen.where("kind IN ('same', 'changed')").select("folder", "kind", "modified").join(newest, "folder", "left").join(unread, "folder", "left")
        calm = F.greatest("modified", F.coalesce("newest", "modified")) <= self.started - self.settle
        settled = F.when(F.col("unread").isNull() & ((F.col("kind") == "same") | calm), F.col("modified"))
        kinds = dict(self.seen.groupBy("kind").count().collect())
        note = {"listed": kinds.get("changed", 0), "unchanged": kinds.get("same", 0)}
        return self.table.write(told.select("folder", settled.alias("settled")), base=self.base, note=note)
