"""Benchmark decontamination with spaced seeds that no allowed overlap can miss.

An item overlaps a document if, laid along some line, at least `min_share` of the item's words agree (items longer than
`longest` words: of any stretch of that many words). Seeds are fixed masks over an item's words: if k words may differ, the
k + 1 masks keep every (k + 1)-th word, each from another word on, and ignore all others. No two keep the same word, so k
substitutions spoil k masks at most and one is whole, wherever they are. Items longer than `longest` have a mask of that
step from each word on, so that every stretch of `longest` words holds k + 1 that share no word.

The hashes of the words that each mask keeps are joined with the hashes that the same masks (some twenty steps and
lengths) give at each word of the documents. Each hit fixes how the item lies in the document; along that line all words
are compared, and the share that agree decides.

The benchmark is the stated query set: it is sent in blocks of at most BLOCK_BYTES of text, whatever its size, and each
block is matched against all documents where they are. Items with the same text are one query.

Words: runs of anything but white space, ASCII punctuation and controls; A-Z are lower-cased. Results for special rows:
null and empty texts match nothing; items of up to four words must agree as a whole (0.8 of them is all of them); items
without words match nothing; very long texts are matched step by step without loss at the
seams, as a step ends between documents; a document matched by many items gets each item once; repeated rows get equal
results; a null doc_id or item_id is kept as a value; other columns and clashing names don't matter, as only doc_id and
text (item_id and text) are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netquarry.llm.common import BREAKS, free, mix, steps, texts, words

MIN_SHARE = 0.8
LONGEST = 50
BLOCK_BYTES = 8 << 20
#: Lines that are compared at once.
LINES = 1 << 13


def masks(n: int, min_share: float, longest: int) -> tuple[int, int, np.ndarray]:
    """(step, kept words, starts) of the masks of an item of n words: any allowed overlap leaves one of them whole."""
    need = min(n, longest)
    step = need - max(math.ceil(min_share * need - 1e-9), 1) + 1
    kept = need // step
    return step, kept, np.arange(step) if n <= longest else np.arange(n - step * (kept - 1))


#: Odd multipliers for the first, second, ... word that a mask keeps.
_FACTORS = mix(np.arange(1, 1025, dtype=np.uint64)) | np.uint64(1)


def seeds(hashes: np.ndarray, starts: np.ndarray, step: int, kept: int) -> np.ndarray:
    """Hash of the words hashes[start], hashes[start + step], ... of each start."""
    total = np.zeros(len(starts), np.uint64)
    for k in range(kept):
        total += hashes[starts + k * step] * _FACTORS[k % len(_FACTORS)]
    return mix(total)


class QuerySet:
    """One block of benchmark items: their words, and where each seed's hash lies in them."""

    def __init__(self, items: list[tuple[object, bytes]], min_share: float, longest: int) -> None:
        by_text: dict[bytes, list] = {}
        for i, t in items:
            by_text.setdefault(t, []).append(i)
        self.ids = list(by_text.values())
        self.hashes, self.bounds = words(list(by_text), BREAKS, lower=True)
        self.min_share, self.longest = min_share, longest
        size = np.diff(self.bounds)
        self.item = np.repeat(np.arange(len(by_text)), size)
        by_mask: dict[tuple[int, int], list[np.ndarray]] = {}
        for n in np.unique(size[size > 0]).tolist():
            step, kept, starts = masks(n, min_share, longest)
            by_mask.setdefault((step, kept), []).append((self.bounds[:-1][size == n][:, None] + starts).ravel())
        self.seeds = []
        for (step, kept), places in sorted(by_mask.items()):
            at = np.concatenate(places)
            self._add(seeds(self.hashes, at, step, kept), at, step, kept)

    def _add(self, h: np.ndarray, at: np.ndarray, step: int, kept: int) -> None:
        order = np.argsort(h, kind="stable")
        h, at = h[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        bits = np.zeros(1 << min(max(len(h) * 8, 1 << 16).bit_length(), 23), bool)
        bits[(h & np.uint64(len(bits) - 1)).astype(np.int64)] = True
        self.seeds.append((step, kept, h[first], first, np.diff(np.append(first, len(h))), at, bits))

    def matches(self, hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, item, first word, agreeing words) of every verified overlap; the best of each document and item."""
        good = []
        for step, kept, keys, first, count, at, bits in self.seeds:
            length = step * (kept - 1) + 1
            h = seeds(hashes, np.arange(max(len(hashes) - length + 1, 0)), step, kept)
            place = np.flatnonzero(bits[(h & np.uint64(len(bits) - 1)).astype(np.int64)])
            slot = np.searchsorted(keys, h[place])
            slot[slot == len(keys)] = 0
            doc = np.searchsorted(bounds, place, "right") - 1
            ok = (keys[slot] == h[place]) & (place + length <= bounds[doc + 1])
            place, slot, doc = place[ok], slot[ok], doc[ok]
            ends = np.cumsum(count[slot])
            for lo in range(0, int(ends[-1]) if len(ends) else 0, LINES):
                line = np.arange(lo, min(lo + LINES, int(ends[-1])))
                hit = np.searchsorted(ends, line, "right")
                where = at[first[slot[hit]] + line - (ends[hit] - count[slot[hit]])]
                good.append(self._verified(hashes, bounds, place[hit], doc[hit], where, length))
        if not good:
            return []
        d, i, shift, at, agree = np.concatenate(good, axis=1)
        order = np.lexsort((shift, -agree, i, d))
        d, i, at, agree = d[order], i[order], at[order], agree[order]
        best = np.concatenate([[True], (d[1:] != d[:-1]) | (i[1:] != i[:-1])]) if len(d) else np.zeros(0, bool)
        return list(zip(d[best].tolist(), i[best].tolist(), at[best].tolist(), agree[best].tolist(), strict=True))

    def _verified(self, hashes: np.ndarray, bounds: np.ndarray, place: np.ndarray, doc: np.ndarray, where: np.ndarray, length: int) -> np.ndarray:
        """Rows document, item, shift, first word, agreeing words of the lines on which enough words agree."""
        item, shift = self.item[where], place - where
        lo, hi = self.bounds[item], self.bounds[item + 1]
        a, b = np.maximum(lo + shift, bounds[doc]), np.minimum(hi + shift, bounds[doc + 1])
        need = self.min_share * np.minimum(hi - lo, self.longest)
        go = np.flatnonzero(b - a >= need)
        doc, item, shift, place, a, b, need = (x[go] for x in (doc, item, shift, place, a, b, need))
        # every stretch that holds the seed; in items of up to `longest` words that is the whole item
        left, right = np.maximum(a, place + length - self.longest), np.minimum(b, place + self.longest)
        span = max(int((right - left).max(initial=0)), self.longest)
        grid = left[:, None] + np.arange(span)
        inside = grid < right[:, None]
        grid = np.where(inside, grid, place[:, None])
        same = (hashes[grid] == self.hashes[grid - shift[:, None]]) & inside
        total = np.zeros((len(go), span + 1), np.int32)
        np.cumsum(same, axis=1, out=total[:, 1:])
        agree = (total[:, self.longest :] - total[:, : span + 1 - self.longest]).max(1).astype(np.int64)
        ok = agree >= need
        return np.stack([doc, item, shift, a - bounds[doc], agree])[:, ok]


def blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[object, bytes]]]:
    """Items in blocks of at most BLOCK_BYTES of text (a longer item is a block of its own)."""
    block, total = [], 0
    for row in items.select(item_id, text).where(F.col(text).isNotNull()).toLocalIterator():
        value = row[1].encode()
        if block and total + len(value) > BLOCK_BYTES:
            yield block
            block, total = [], 0
        block.append((row[0], value))
        total += len(value)
    yield block


def overlaps(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", min_share: float = MIN_SHARE, longest: int = LONGEST) -> DataFrame:
    """(doc_id, item_id, first_word, n_agree): every document that holds a verified overlap with a benchmark item."""
    spark = docs.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}, {f.name: f.dataType.simpleString() for f in items.schema.fields}
    schema = f"doc_id {kinds[0][doc_id]}, item_id {kinds[1][item_id]}, first_word long, n_agree long"
    out = None
    for block in blocks(items, item_id, text):
        sent = spark.sparkContext.broadcast(QuerySet(block, min_share, longest))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values, ids = texts(batch.column(1)), batch.column(0)
                for lo, hi in steps(values):
                    found = sent.value.matches(*words(values[lo:hi], BREAKS, lower=True))
                    if found:
                        # a row for each item that has the text
                        d, i, at, n = zip(*[(d, x, at, n) for d, i, at, n in found for x in sent.value.ids[i]], strict=True)
                        names = pa.array(i)
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array([lo + x for x in d])), names, pa.array(at, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "item_id", "first_word", "n_agree"])

        found = docs.select(doc_id, text).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def contaminated(found: DataFrame) -> DataFrame:
    """One row for each document with overlaps."""
    return found.groupBy("doc_id").agg(F.lit(True).alias("contaminated"), F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("n_agree").alias("n_agree"))


def op5_decontamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for each contaminated document, whole table against whole benchmark: doc_id, contaminated (true), item_ids, n_agree."""
    return contaminated(overlaps(docs, items)).select("doc_id", "contaminated", "item_ids", "n_agree")


def keep_uncontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that hold a benchmark item."""
    hit = free("hit", *docs.columns)
    hits = overlaps(docs, items).select(F.col("doc_id").alias(hit)).distinct()
    return docs.join(hits, F.col("doc_id").eqNullSafe(F.col(hit)), "left_anti")
