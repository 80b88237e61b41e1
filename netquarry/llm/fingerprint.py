"""Document fingerprints by locally consistent parsing.

Level by level a text is cut into short phrases by deterministic coin tossing: each symbol is compared with its left
neighbour, and the position of the lowest bit in which the two differ, with that bit, becomes its label. A few rounds
bring 64-bit names down to a handful of labels, neighbours still differ, and phrases begin at local maxima of the
labels; so a cut depends on a bounded number of symbols around it alone, and equal substrings are cut alike inside,
wherever they stand. Runs of one symbol are collapsed into one symbol first. A phrase's name is the hash of its symbols;
the names are the next level's symbols.

The fingerprint has SLOTS slots of four hex digits: the names of the phrases of levels FIRST and up are dealt to the
slots by hash, each slot keeps the smallest (empty ones borrow from the next full one). The likeness of two fingerprints is the share of
slots that agree, corrected for chance agreement; it estimates the Jaccard similarity of the phrase sets.

Results for special rows: null and empty texts have the fingerprint of no phrase, all zeros (like each other: 1, like
any other text: 0); texts too short for phrases at level FIRST are one phrase; very long texts are parsed whole; equal
texts have equal fingerprints; ties cannot change anything, as the smallest name is kept; an empty table gives an empty
table; clashing names don't matter, as only doc_id and text are read. Rows that share a doc_id follow each other in the
order of their texts; null ids come first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netquarry.llm.common import blocks_for, mix, range_bounds, ranged, rolled

#: Bytes of text in a range of ids.
RANGE = 32 << 20
#: Rows of (part, part before, first id) that are broadcast, 20 bytes each.
BROADCAST = 1 << 18

SLOTS = 128
#: Phrases of level 1 have about 4 characters, each level about 3 to 4 times as many.
FIRST, LEVELS = 2, 3
ROUNDS = 3


def labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Small labels (below 16) of symbols such that neighbours within a text differ; first: a text starts here.

    Equal neighbours must have been collapsed. One round brings k-bit labels down to 2k values.
    """
    label = names
    for _ in range(ROUNDS):
        left = np.roll(label, 1)
        left[first] = ~label[first]
        differ = label ^ left
        low = differ & (~differ + np.uint64(1))
        # exact: a power of two below 2**64 is a float's exact value
        place = np.log2(low.astype(np.float64)).astype(np.uint64)
        label = place * np.uint64(2) + ((label & low) != 0)
    return label


def parse(names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names, text) of the phrases of the next level; names: uint64 symbols, text: the index of each one's text, ascending."""
    if not len(names):
        return names, text
    # runs of one symbol become one symbol that knows its length
    new = np.concatenate([[True], (names[1:] != names[:-1]) | (text[1:] != text[:-1])])
    start = np.flatnonzero(new)
    run = np.diff(np.append(start, len(names)))
    names, text = names[start], text[start]
    names = np.where(run > 1, mix(names + run.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), names)
    first = np.concatenate([[True], text[1:] != text[:-1]])
    last = np.append(first[1:], True)
    label = labels(names, first)
    before = np.where(first, np.uint64(99), np.roll(label, 1))
    after = np.where(last, np.uint64(99), np.roll(label, -1))
    cut = first | ((label > before) & (label >= after) & ~last)
    begin = np.flatnonzero(cut)
    return rolled(names, begin, np.append(begin[1:], len(names))), text[begin]


def sketch(names: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """(n x SLOTS) of uint16: the smallest name's digits in each slot, 1..65535; 0 only in texts without names."""
    slot = (names % np.uint64(SLOTS)).astype(np.int64)
    best = np.full(n * SLOTS, np.iinfo(np.uint64).max)
    value = mix(names ^ np.uint64(0x2545F4914F6CDD1D))
    np.minimum.at(best, text * SLOTS + slot, value)
    best = best.reshape(n, SLOTS)
    empty = best == np.iinfo(np.uint64).max
    digits = (1 + best % np.uint64(65535)).astype(np.uint16)
    if empty.any():
        # an empty slot borrows from the next full one, round the ring; with the distance, so that borrowing isn't plain agreement
        at = np.arange(2 * SLOTS)
        full = np.where(np.tile(~empty, 2), at, 4 * SLOTS)
        nearest = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1][:, :SLOTS]
        some = nearest < 4 * SLOTS
        taken = np.take_along_axis(digits, np.where(some, nearest % SLOTS, 0), 1)
        shifted = (1 + mix(taken.astype(np.uint64) + ((nearest - at[:SLOTS]).astype(np.uint64) << np.uint64(20))) % np.uint64(65535)).astype(np.uint16)
        digits = np.where(empty, np.where(some, shifted, 0), digits).astype(np.uint16)
    return digits


#: Characters that one numpy step handles.
STEP = 1 << 19


def fingerprints(values: list[str]) -> np.ndarray:
    """(texts x SLOTS) of uint16."""
    out = np.zeros((len(values), SLOTS), np.uint16)
    lo = total = 0
    for hi in range(1, len(values) + 1):
        total += len(values[hi - 1])
        if hi == len(values) or total + len(values[hi]) > STEP:
            out[lo:hi] = _fingerprints(values[lo:hi])
            lo, total = hi, 0
    return out


def _fingerprints(values: list[str]) -> np.ndarray:
    size = np.array(list(map(len, values)), np.int64)
    names = mix(np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1))
    text = np.repeat(np.arange(len(values)), size)
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for level in range(1, LEVELS + 1):
        names, text = parse(names, text)
        if level >= FIRST:
            kept.append((mix(names + np.uint64(level)), text))
    names, text = (np.concatenate(x) for x in zip(*kept, strict=True))
    return sketch(names, text, len(values))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: the share of slots that agree (two fingerprints of no phrase agree, one of them with another never)."""
    same = (a == b).mean(1)
    none = (a[:, 0] == 0) != (b[:, 0] == 0)
    return np.where(none, 0.0, np.clip((same - 1 / 65535) / (1 - 1 / 65535), 0, 1))


def hexed(digits: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in digits.astype(">u2")]


def fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """docs with their fingerprint (replaced if there)."""
    kept = [f for f in docs.schema.fields if f.name != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = hexed(fingerprints([x or "" for x in batch.column(text).to_pylist()]))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(found, pa.string())], names=[*(f.name for f in kept), name])

    return docs.select(*[f.name for f in kept]).mapInArrow(run, docs.select(*[f.name for f in kept], F.lit("").alias(name)).schema)


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """(part, is_edge, doc_id, text) such that within a part, sorted by is_edge, doc_id and text, each row but the last
    is followed by its next document. Ranges of ids, dealt to parts; the first row of a range is also the edge of the range before.

    What passes through the driver is one id for each part.
    """
    bounds = range_bounds(docs, parts)
    placed = ranged(docs.select("doc_id", "text"), bounds)
    # the first id of each range, found without reading the texts; ranges without rows have none
    first = ranged(docs.select("doc_id"), bounds)
    rows = first.groupBy("part").agg(F.min("doc_id").alias("id"), F.max(F.col("doc_id").isNull()).alias("null")).orderBy("part").collect()
    follows = {rows[i]["part"]: (rows[i - 1]["part"], None if rows[i]["null"] else rows[i]["id"]) for i in range(len(rows))}
    if not follows:
        return placed.select("part", F.lit(0).alias("is_edge"), "doc_id", "text")
    table = docs.sparkSession.createDataFrame([(p, q, x) for p, (q, x) in follows.items()], "part int, before int, first_id long")
    # a row for each part; broadcast up to some megabytes, so that the texts aren't shuffled for it
    both = placed.join(F.broadcast(table) if len(follows) <= BROADCAST else table, "part")
    itself = F.struct(F.col("part").alias("part"), F.lit(0).alias("is_edge"))
    edge = F.struct(F.col("before").alias("part"), F.lit(1).alias("is_edge"))
    copies = F.when(F.col("doc_id").eqNullSafe(F.col("first_id")), F.array(itself, edge)).otherwise(F.array(itself))
    return both.select(F.explode(copies).alias("c"), "doc_id", "text").select("c.part", "c.is_edge", "doc_id", "text")


def with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    parts = blocks_for(docs, "text", RANGE)
    # by range, as hashes of so few numbers would put several parts into one task
    dealt = with_next(docs, parts).repartitionByRange(parts, "part").sortWithinPartitions("part", "is_edge", F.asc_nulls_first("doc_id"), F.coalesce("text", F.lit("")))
    digest = dealt.select("part", "is_edge", "doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row whose next one hasn't come yet
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                part, edge, ids, texts = (batch.column(k).to_pylist() for k in range(4))
                prints = fingerprints(texts)
                if held is not None:
                    part, edge, ids, texts = [held[0], *part], [held[1], *edge], [held[2], *ids], [held[3], *texts]
                    prints = np.vstack([held[4][None, :], prints])
                use = [i for i in range(len(part) - 1) if not edge[i] and part[i] == part[i + 1]]
                if use:
                    edited = []
                    for i in use:
                        k = len(texts[i]) // 4
                        edited.append(texts[i][: len(texts[i]) - k] + texts[i + 1][:k])
                    changed, own, after = fingerprints(edited), prints[use], prints[np.array(use) + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[i] for i in use], pa.int64()), pa.array([len(texts[i]) for i in use], pa.int64()), pa.array(edited, pa.string()), pa.array(hexed(own), pa.string()), pa.array(hexed(changed), pa.string()), pa.array(likeness(own, changed)), pa.array(likeness(own, after))],
                        names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                    )
                held = part[-1], edge[-1], ids[-1], texts[-1], prints[-1]

    schema = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return digest.mapInArrow(run, schema)


def op6_fingerprints(docs: DataFrame) -> DataFrame:
    return with_edits(docs).select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
