"""What the training-data operators share: shared-folder tables, words and rolling hashes in numpy, id ranges."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step handles; a longer document is a step of its own.
STEP = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod5(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


# ---------------------------------------------------------------- shared folder


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the one given to setCheckpointDir().

    Only in local mode, where all run on one machine, a temporary one does where neither is set (tests).
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        java = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = java.get() if java.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


@contextmanager
def shuffles_cleaned(spark: SparkSession):
    """Shuffle files of the queries run inside go as soon as each has ended; their results are in written tables."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Cut the lineage: df written as a table in the shared folder, and the table. Lost executors lose nothing of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    with shuffles_cleaned(spark):
        df.write.option("compression", codec).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def dropped(*tables: DataFrame) -> None:
    """Delete tables that stored() has written and nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def blocks_for(df: DataFrame, text: str, target: int = 16 << 20) -> int:
    """Number of blocks of about `target` bytes of text, one for each core at least.

    Blocks follow the data, not the shuffle partitions: many small ones would each repeat what they have in common.
    """
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total // target))


def free(name: str, *taken: str) -> str:
    """The name, or a longer one if it is among those taken (in any case)."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name += "_"
    return name


def on(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Equi join on one key where null equals null; the key is kept once, from the left."""
    own = free("right_key", *left.columns, *right.columns)
    renamed = right.withColumnRenamed(key, own)
    return left.join(renamed, F.col(key).eqNullSafe(F.col(own)), how).drop(own)


# ---------------------------------------------------------------- id ranges


def range_bounds(df: DataFrame, parts: int, doc_id: str = "doc_id") -> np.ndarray:
    """About `parts` ids, ascending, that cut df into ranges of about equal rows: every k-th id of the sorted ids.

    They are all that passes through the driver, eight bytes for each range. Plans that must agree share one list.
    """
    ids = df.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("id"))
    every = max(-(-ids.count() // parts), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange(-seen % every, batch.num_rows, every)
            seen += batch.num_rows
            yield batch.take(pa.array(at))

    spread = ids.repartitionByRange(max(parts // 64, 1), "id").sortWithinPartitions("id").mapInArrow(run, "id long")
    return np.unique(np.array([r[0] for r in spread.collect()], np.int64))


def ranged(df: DataFrame, bounds: np.ndarray, doc_id: str = "doc_id") -> DataFrame:
    """df with `part`: the number of bounds at or below its id, ascending by id. Null ids go to part 0.

    The bounds are broadcast as one array, so the plan doesn't grow with them.
    """
    sent = df.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sent.value, ids.to_numpy(np.int64), "right").astype(np.int32))

    return df.withColumn("part", part(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))))


# ---------------------------------------------------------------- numpy on texts


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def steps(values: list[bytes], size: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges (lo, hi) of consecutive texts of about `size` bytes."""
    lo = total = 0
    for i, x in enumerate(values):
        if total and total + len(x) > size:
            yield lo, i
            lo, total = i, 0
        total += len(x) + 1
    if lo < len(values):
        yield lo, len(values)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least n of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 2 * STEP:
            _powers[base] = have
    return have


def rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[starts:ends] for each pair; values: uint64. The same values give the same hash anywhere."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(BASE, n)[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * powers(UNBASE, n + 1)[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


#: A 64-bit number for each byte.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: White space, ASCII punctuation and controls: what separates words for matching.
BREAKS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def spans(buf: np.ndarray, breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in buf (uint8)."""
    gap = np.ones(len(buf) + 2, np.int8)
    gap[1:-1] = breaks[buf]
    step = np.diff(gap)
    return np.flatnonzero(step == -1), np.flatnonzero(step == 1)


def words(values: list[bytes], breaks: np.ndarray = SPACES, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, bounds): words of text i are hashes[bounds[i]:bounds[i+1]]."""
    buf = np.frombuffer(b" ".join(values) + b" ", np.uint8)
    if lower:
        buf = LOWER[buf]
    starts, ends = spans(buf, breaks)
    first = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in values], out=first[1:])
    return rolled(BYTES[buf], starts, ends), np.searchsorted(starts, first)


def windows(hashes: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, position in the text) of every window of `length` words within one text."""
    n = np.maximum(np.diff(bounds) - length + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = bounds[:-1][text] + at
    return rolled(hashes, start, start + length), text, at
