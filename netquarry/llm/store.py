"""Token-id output as a content-addressed store.

The ids of a document are cut into chunks where a rolling hash over the last ids says so, so an insertion moves the cuts
near it only. Parquet tables in one folder (and `format`, with the width of an id):

- chunks: (hash, ids, root, at, shared): every distinct chunk once, with a document (by its root) and a place in it that
  has the chunk; shared: other places have it too. ids: little-endian unsigned integers of 16 bits, or of 32 bits for
  vocabularies of over 65,536 ids.
- recipes: (part, doc_id, start, n_tokens, hashes, root): for each document, ascending by doc_id, its chunk hashes and the
  Merkle root over them; start counts the ids of all documents before it. `part` is a range of ids.
- manifest: (part, documents, n_tokens, root): for each part the Merkle root over its documents' roots.

Reading sends each chunk to the place that it names; only shared chunks are joined with the recipes for their other
places, so the ids are shuffled once. It puts the chunks of a document in order and verifies chunk hashes, document roots
and lengths; any difference is an error naming the document. Documents with the same recipe share its reconstruction.

The library encodes each distinct word once for a worker's table (see bpe.WordTable).

Results for special rows: null and empty texts hold the end id alone; very long texts are many chunks; repeated rows and
ties of doc_id are ordered by the ids' root, equal ones have places of their own; null ids come first; an empty table
gives empty tables; columns other than doc_id and text aren't stored.
"""

from __future__ import annotations

import hashlib
import os
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from netquarry.llm import bpe
from netquarry.llm.common import BASE, UNBASE, blocks_for, dropped, mix, powers, shuffles_cleaned, stored

END_ID = 2
#: The rolling hash covers this many ids and cuts once in AVERAGE places on average; chunks have at most LONGEST ids.
SPAN, AVERAGE, LONGEST = 16, 256, 2048
HASH_BYTES = 16


#: Words in a line for the library.
TOGETHER = 128
#: Bytes of text in a part of the recipes, and parts in a group whose totals are summed first.
PART, GROUP = 256 << 20, 1024


class Library:
    """The tokenizers library as the encoder of a table of words."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.source = f.read()
        self.splitter = bpe.vocabulary(path).splitter
        self.load()

    def load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_buffer(self.source)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        # words come normalized as parts of their text; alone some would come out otherwise
        self.tokenizer.normalizer = normalizers.Sequence([])
        self.special = [self.tokenizer.token_to_id(x) for x in self.splitter.marks]
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        self.width = 2 if self.tokenizer.get_vocab_size() <= 65536 else 4
        self.table = bpe.WordTable(self.splitter, self.learn)

    def __getstate__(self) -> dict:
        return {"source": self.source, "splitter": self.splitter}

    def __setstate__(self, state: dict) -> None:
        self.source, self.splitter = state["source"], state["splitter"]
        self.load()

    def learn(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of the words buf[starts:ends]; words go to the library in lines of TOGETHER."""
        raw, special = buf.tobytes(), buf[starts] >= bpe.MARK
        plain = np.flatnonzero(~special)
        words = [raw[a:b].decode() for a, b in zip(starts[plain].tolist(), ends[plain].tolist(), strict=True)]
        lines = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate([*found, np.zeros(0, np.int32)])
        # a word's last token alone has the end mark
        upto = np.flatnonzero(self.last[flat]) + 1
        each = np.diff(upto, prepend=0)
        if len(upto) != len(words):  # a word that the library would cut further: each on its own
            found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            flat, each = np.concatenate([*found, np.zeros(0, np.int32)]), np.array([len(x) for x in found], np.int64)
        size = np.ones(len(starts), np.int64)
        size[plain] = each
        out = np.zeros(int(size.sum()), np.int32)
        marked = (np.cumsum(size) - size)[special]
        out[marked] = np.array(self.special, np.int32)[buf[starts[special]].astype(np.int64) - bpe.MARK]
        out[np.delete(np.arange(len(out)), marked)] = flat
        return out, size


def cuts(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the chunks of all documents: flat[bounds[i]:bounds[i+1]] are the ids of document i (none is empty)."""
    n = len(flat)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(flat.astype(np.uint64) + np.uint64(1)) * powers(BASE, n)[:n], out=total[1:])
    at = np.arange(1, n + 1)
    rolling = mix((total[SPAN:] - total[:-SPAN]) * powers(UNBASE, n + 1)[: max(n + 1 - SPAN, 0)]) if n >= SPAN else np.zeros(0, np.uint64)
    place = at[SPAN - 1 :][rolling % np.uint64(AVERAGE) == 0] if n >= SPAN else at[:0]
    # a span that reaches into the document before says nothing about this one
    doc = np.searchsorted(bounds, place, "left") - 1
    place = place[place - bounds[doc] >= SPAN]
    ends = np.union1d(place, bounds[1:])
    size = np.diff(np.concatenate([[0], ends]))
    if size.max(initial=0) > LONGEST:
        more = [np.arange(e - s + LONGEST, e, LONGEST) for e, s in zip(ends[size > LONGEST], size[size > LONGEST], strict=True)]
        ends = np.union1d(ends, np.concatenate(more))
    return ends


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=HASH_BYTES).digest()


class Merkle:
    """Root of the binary hash tree over the leaves added, whose level and order count; of no leaves: the hash of nothing.

    It holds one hash for each level, however many leaves there are.
    """

    def __init__(self) -> None:
        self.waiting: list[bytes | None] = []

    def add(self, leaf: bytes) -> None:
        for level, left in enumerate(self.waiting):
            if left is None:
                self.waiting[level] = leaf
                return
            leaf, self.waiting[level] = digest(b"\x00" + left + leaf), None
        self.waiting.append(leaf)

    def root(self) -> bytes:
        tail = None
        for level, left in enumerate(self.waiting):
            last = level == len(self.waiting) - 1
            if left is not None and tail is not None:
                tail = digest(b"\x00" + left + tail)
            elif left is not None:
                tail = left if last else digest(b"\x00" + left)
            elif tail is not None:
                tail = digest(b"\x00" + tail)
        return digest(b"\x01" + (digest(b"") if tail is None else tail))


def merkle(hashes: list[bytes]) -> bytes:
    tree = Merkle()
    for x in hashes:
        tree.add(x)
    return tree.root()


def chunked(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, tie, n_tokens, hashes, root, chunks): chunks: the ids of each chunk, aligned with hashes; tie: a random number."""
    sent = docs.sparkSession.sparkContext.broadcast(Library(path))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        pick = np.random.default_rng(secrets.randbits(64))
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                flat, n = vocabulary.table.encode(batch.column(1).to_pylist())
                bounds = np.concatenate([[0], np.cumsum(n)])
                flat = np.insert(flat, bounds[1:], end_id)
                bounds += np.arange(len(bounds))
                ends = cuts(flat, bounds)
                w = vocabulary.width
                raw = flat.astype(f"<u{w}").tobytes()
                pieces = [raw[w * a : w * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                hashes = [digest(x) for x in pieces]
                of = np.searchsorted(ends, bounds[1:], "left") + 1
                of = np.concatenate([[0], of])
                roots = [merkle(hashes[a:b]) for a, b in zip(of[:-1], of[1:], strict=True)]
                offsets = pa.array(of, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.binary())) for x in (hashes, pieces)]
                columns = [batch.column(0), pa.array(pick.integers(1 << 62, size=len(n))), pa.array(np.diff(bounds), pa.int64()), lists[0], pa.array(roots, pa.binary()), lists[1]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "n_tokens", "hashes", "root", "chunks"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, tie long, n_tokens long, hashes array<binary>, root binary, chunks array<binary>")


def placed(recipes: DataFrame, parts: int) -> DataFrame:
    """recipes with part and upto (the part's ids up to each document, itself included); parts are ranges of doc_id, each in order."""
    kind = dict(recipes.dtypes)["doc_id"]
    order = [F.asc_nulls_first("doc_id"), F.asc("root"), F.asc("tie")]
    names = ["part", "doc_id", "upto", "n_tokens", "hashes", "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            upto = before + np.cumsum(batch.column("n_tokens").to_numpy())
            before = int(upto[-1]) if len(upto) else before
            columns = {"part": pa.array(np.full(len(upto), part, np.int32)), "upto": pa.array(upto, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[c] if c in columns else batch.column(c) for c in names], names=names)

    dealt = recipes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, f"part int, doc_id {kind}, upto long, n_tokens long, hashes array<binary>, root binary")


def write(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> None:
    """Encode documents (doc_id, text) and write the tables into `folder`, which Spark can reach."""
    spark = docs.sparkSession
    parts = blocks_for(docs, "text", PART)
    made = stored(chunked(docs.select("doc_id", "text"), path, end_id))
    recipes = stored(placed(made.select("doc_id", "tie", "n_tokens", "hashes", "root"), parts))
    pairs = made.select("root", F.posexplode(F.arrays_zip("hashes", "chunks")).alias("at", "c"))
    place = F.struct("root", "at")
    # the aggregate keeps one of each on the map side already; equal hashes have equal ids
    found = pairs.groupBy(F.col("c.hashes").alias("hash")).agg(F.any_value("c.chunks").alias("ids"), F.min(place).alias("a"), F.max(place).alias("b"))
    with shuffles_cleaned(spark):
        found.select("hash", "ids", "a.root", "a.at", (F.col("a") != F.col("b")).alias("shared")).write.option("compression", "zstd").parquet(f"{folder}/chunks")
        dropped(made)
        # totals of groups of parts first: no task meets more rows than a group has parts, or than there are groups
        totals = recipes.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("g", F.expr(f"part div {GROUP}"))
        groups = totals.groupBy("g").agg(F.sum("n").alias("of_group")).withColumn("before_group", F.sum("of_group").over(Window.orderBy("g")) - F.col("of_group"))
        inside = F.sum("n").over(Window.partitionBy("g").orderBy("part")) - F.col("n")
        before = totals.withColumn("inside", inside).join(groups, "g").select("part", (F.col("before_group") + F.col("inside")).alias("before"))
        ordered = recipes.join(before, "part").withColumn("start", F.col("before") + F.col("upto") - F.col("n_tokens"))
        ordered.select("part", "doc_id", "start", "n_tokens", "hashes", "root").sortWithinPartitions("part", "start").write.option("compression", "zstd").parquet(f"{folder}/recipes")
        dropped(recipes)
        spark.createDataFrame([(Library(path).width, end_id)], "width int, end_id int").coalesce(1).write.parquet(f"{folder}/format")
        manifest_of(spark.read.parquet(f"{folder}/recipes")).write.parquet(f"{folder}/manifest")


def manifest_of(recipes: DataFrame) -> DataFrame:
    """(part, documents, n_tokens, root) of recipes, each part read in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, documents, n, tree = None, 0, 0, Merkle()
        for batch in batches:
            told = []
            for p, size, root in zip(*(batch.column(c).to_pylist() for c in ("part", "n_tokens", "root")), strict=True):
                if p != part:
                    if part is not None:
                        told.append((part, documents, n, tree.root()))
                    part, documents, n, tree = p, 0, 0, Merkle()
                tree.add(root)
                documents, n = documents + 1, n + size
            yield rows(told)
        yield rows([(part, documents, n, tree.root())] if part is not None else [])

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    rows = lambda told: pa.RecordBatch.from_arrays([pa.array([x[k] for x in told], kinds[k]) for k in range(4)], names=["part", "documents", "n_tokens", "root"])
    return recipes.select("part", "start", "n_tokens", "root").repartition("part").sortWithinPartitions("part", "start").mapInArrow(run, "part int, documents long, n_tokens long, root binary")


def rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """(root, ids) of every distinct document, put together from its chunks and verified; ids: little-endian unsigned 32-bit integers."""
    recipes, chunks = spark.read.parquet(f"{folder}/recipes"), spark.read.parquet(f"{folder}/chunks")
    width = spark.read.parquet(f"{folder}/format").first()["width"]
    unique = recipes.groupBy("root").agg(F.any_value("hashes").alias("hashes"))
    own = chunks.select("root", "at", "hash", "ids")
    wanted = unique.select("root", F.posexplode("hashes").alias("at", "hash"))
    named = chunks.where("shared").select("hash", "ids", F.col("root").alias("__root"), F.col("at").alias("__at"))
    elsewhere = (F.col("root") != F.col("__root")) | (F.col("at") != F.col("__at"))
    others = wanted.join(named, "hash").where(elsewhere).select("root", "at", "hash", "ids")
    found = own.unionByName(others).groupBy("root").agg(F.array_sort(F.collect_list(F.struct("at", "hash", "ids"))).alias("c"))
    # a document without any chunk left is an error as well
    whole = unique.join(found.withColumnRenamed("root", "__root"), F.col("root") == F.col("__root"), "left").select("root", F.coalesce("c.hash", F.array().cast("array<binary>")).alias("hashes"), F.coalesce("c.ids", F.array().cast("array<binary>")).alias("parts"), F.col("hashes").alias("want"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for root, hashes, parts, want in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if hashes != want or [digest(x) for x in parts] != hashes or merkle(hashes) != root:
                    raise ValueError(f"the document with root {root.hex()} can't be put together: a chunk is missing or differs")
                out.append(np.frombuffer(b"".join(parts), f"<u{width}").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["root", "ids"])

    return whole.mapInArrow(run, "root binary, ids binary")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, in recipes' order within its files."""
    return spark.read.parquet(f"{folder}/recipes").select("doc_id", "start", "n_tokens", "root").join(rebuilt(spark, folder), "root", "left").drop("root")


def verify_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Parts whose recipes differ from the manifest: none if all is well."""
    want, got = spark.read.parquet(f"{folder}/manifest"), manifest_of(spark.read.parquet(f"{folder}/recipes"))
    return want.exceptAll(got).unionByName(got.exceptAll(want)).select("part").distinct()


def op7_token_store(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Writes the store into `folder`, reads it back: doc_id, start, n_tokens, ids_crc32."""
    write(docs, path, folder)
    spark = docs.sparkSession
    with shuffles_cleaned(spark):
        bad = verify_manifest(spark, folder).first()
    if bad:
        raise ValueError(f"part {bad[0]} differs from its manifest")
    # the checksum of equal documents is taken once
    sums = rebuilt(spark, folder).select("root", F.crc32("ids").alias("ids_crc32"), (F.octet_length("ids") / 4).cast("long").alias("n_read"))
    done = spark.read.parquet(f"{folder}/recipes").select("doc_id", "start", "n_tokens", "root").join(sums, "root", "left")
    right = F.assert_true(F.coalesce(F.col("n_read") == F.col("n_tokens"), F.lit(False)), "a document's length differs from its recipe")
    return done.where(right.isNull()).select("doc_id", "start", "n_tokens", "ids_crc32")
