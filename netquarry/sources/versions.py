"""Tables with versions: Parquet below one folder, and a small manifest for each version that names the files that count.

    <table>/data/commit=<id>/<partition>=<value>/*.parquet    rows, written before their version exists
    <table>/keys/commit=<id>/<partition>=<value>/*.parquet    distinct keys of the same rows, if the table has keys
    <table>/_versions/000000000007.json                       schema, parts and notes of version 7

A write puts its files beside the old ones and then makes the next manifest, which is the switch: until then readers see the
old version, after it the new one, and a write that stops on the way leaves files that nothing names. The same write may
then simply be done again. A reader lists one folder and reads one manifest; it has an entry for each partition, not for
each file. Columns that come later are added to the schema, and are null in the files from before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Versions whose files stay: the current one and those that readers may still be at.
KEPT = 3
_COMMIT = "commit"


class Conflict(RuntimeError):
    """Another writer has made a version meanwhile."""


class Versioned:
    """The table at `path`."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ manifests

    def _at(self, *parts: str) -> tuple[Any, Any]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, *parts: str) -> list[str]:
        fs, p = self._at(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _load(self, name: str) -> dict | None:
        fs, p = self._at("_versions", name)
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:  # its writer stopped within it, so it never counted
            return None

    def manifest(self) -> dict | None:
        """The current version's, or None if there is none yet."""
        for name in reversed([n for n in self._names("_versions") if n.endswith(".json")]):
            if found := self._load(name):
                return found
        return None

    def since(self, version: int) -> list[dict] | None:
        """The manifests after `version`, in order; None if they don't go on from it."""
        found = [m for n in self._names("_versions") if n.endswith(".json") and int(n[:-5]) > version and (m := self._load(n))]
        return found if not found or found[0]["base"] == version else None

    # ------------------------------------------------------------ reading

    def read(self, parts: Iterable[str] | None = None, tree: str = "data", manifest: dict | None = None) -> DataFrame:
        """The current version's rows (or those of the given manifest); parts: only these partitions, no other is opened."""
        found = manifest or self.manifest()
        if found is None:
            raise ValueError(f"no version of {self.path}")
        schema = StructType.fromJson(found["schema"])
        if tree == "keys":
            schema = StructType([f for f in schema if f.name in [*found["keys"], found["partition"]]])
        wanted = found["parts"] if parts is None else {k: found["parts"][k] for k in dict.fromkeys(parts) if k in found["parts"]}
        folders = ["/".join(x for x in (self.path, tree, f"{_COMMIT}={commit}", part) if x) for part, commit in wanted.items()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(StructType([*schema, StructField(_COMMIT, StringType())])).option("basePath", f"{self.path}/{tree}").parquet(*folders)
        return rows.select(*schema.names)

    def parts_with(self, keys: DataFrame) -> list[str]:
        """The partitions that hold any of the keys (rows with the table's key columns), by the stored keys alone."""
        found = self.manifest()
        if not found or not found["parts"]:
            return []
        names, partition = found["keys"], found["partition"]
        wanted = keys.select(*[F.col(k).alias(f"wanted_{k}") for k in names]).distinct()
        own = self.read(tree="keys", manifest=found)
        same = [own[k].eqNullSafe(wanted[f"wanted_{k}"]) for k in names]
        return sorted(part_name(partition, r[0]) for r in own.join(wanted, same, "left_semi").select(F.col(partition).cast("string")).distinct().collect())

    # ------------------------------------------------------------ writing

    def write(
        self, df: DataFrame, partition: str | None = None, replaced: Iterable[str] | None = None, keys: Sequence[str] = (), note: Mapping[str, Any] | None = None, base: dict | None = None, sort: Sequence[str] = ()
    ) -> dict:
        """Make a version: df's partitions and those of `replaced` in place of the old ones; replaced None: in place of all.

        base: the manifest that the writer has started from (None: there was none); if another version came meanwhile, that is
        a Conflict and nothing changes. Returns the new manifest.
        """
        commit = uuid.uuid4().hex
        folder = f"{self.path}/data/{_COMMIT}={commit}"
        # a partition's rows come together, in as many tasks as they need: no file for each partition from every task
        rows = df.hint("rebalance", partition) if partition else df
        rows = rows.sortWithinPartitions(*sort) if sort else rows
        writer = rows.write.option("compression", "zstd")
        (writer.partitionBy(partition) if partition else writer).parquet(folder)
        if keys:
            self.spark.read.schema(df.schema).parquet(folder).select(*keys, partition).distinct().write.option("compression", "zstd").partitionBy(partition).parquet(f"{self.path}/keys/{_COMMIT}={commit}")
        written = [n for n in self._names("data", f"{_COMMIT}={commit}") if "=" in n] if partition else [""]
        old = base["parts"] if base and replaced is not None else {}
        gone = {*(replaced or ()), *written}
        parts = {k: v for k, v in old.items() if k not in gone} | dict.fromkeys(written, commit)
        schema = widened(StructType.fromJson(base["schema"]), df.schema) if base and replaced is not None else df.schema
        made = {"base": base["version"] if base else 0, "schema": schema.jsonValue(), "partition": partition, "keys": list(keys), "parts": dict(sorted(parts.items())), "note": dict(note or {})}
        return self._switch(made)

    def _switch(self, made: dict) -> dict:
        names = [n for n in self._names("_versions") if n.endswith(".json")]
        current = self.manifest()
        if (current["version"] if current else 0) != made["base"]:
            raise Conflict(f"{self.path}: version {current['version'] if current else 0} came after {made['base']}")
        made = {"version": (int(names[-1][:-5]) if names else 0) + 1} | made
        fs, p = self._at("_versions", f"{made['version']:012d}.json")
        out = fs.create(p, False)  # fails if another writer has made it
        try:
            out.write(bytearray(json.dumps(made).encode()))
        finally:
            out.close()
        self._clean(made)
        return made

    def _clean(self, made: dict) -> None:
        """Delete the files that only versions before the last KEPT name; manifests are small and stay longer."""
        names = [n for n in self._names("_versions") if n.endswith(".json")]
        told = [m for n in names[-KEPT - 1 :] if (m := self._load(n))]
        if len(told) <= KEPT:
            return
        used = {c for m in told[-KEPT:] for c in m["parts"].values()}
        for commit in {*told[0]["parts"].values()} - used:
            for tree in ("data", "keys"):
                fs, p = self._at(tree, f"{_COMMIT}={commit}")
                fs.delete(p, True)


def part_name(partition: str, value: object) -> str:
    return f"{partition}={value}"


def widened(old: StructType, new: StructType) -> StructType:
    """The old columns and behind them the new ones; a column that has changed its type is an error."""
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and known[f.name].dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()} in the table and {f.dataType.simpleString()} in the new rows")
    return StructType([StructField(f.name, f.dataType, True) for f in [*old, *[f for f in new if f.name not in known]]])
