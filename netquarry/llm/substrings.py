"""Substring dedup by level-wise doubling of repeated windows.

A window of words can only be repeated if its halves are. So windows of half the length go first: of them those are looked
up that the smallest hash in each full-length window picks, which every occurrence of a full-length window picks alike (a
quarter of the places, no loss). Half windows that occur in several documents survive; only where one survived is the
window of full length hashed and looked up, again with those that occur in several documents surviving. `levels` goes on
doubling until no candidates survive. At the full length every place with a smaller document that holds the same window
is known; the words that such places cover are merged and removed.

Each level is an aggregation by hash with the smallest and largest document (computed on the map side as well, so that a
window that a third of all documents share is one row a task) and a join back, whose large keys Spark can split.

Words: `[^\\x20\\x09-\\x0D]+`, unchanged. Results for special rows: null and empty texts have no words; texts with fewer
words than a window lose nothing; a null doc_id is smaller than all others; rows that share a doc_id are one document, so
they don't take words from each other, and each loses the words that any of them has at places to remove; an empty table
gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netquarry.llm.common import SPACES, dropped, spans, steps, stored, texts, windows, words

WINDOW = 13
#: Stands for a null doc_id.
_NULL = -(1 << 63)


def picked(hashes: np.ndarray, bounds: np.ndarray, half: int, full: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place) of the half windows that are the smallest of some full window (the first of equals)."""
    h, text, at = windows(hashes, bounds, half)
    width = full - half + 1
    if len(h) < width:
        return h[:0], text[:0], at[:0]
    view = np.lib.stride_tricks.sliding_window_view(h, width)
    best = view.argmin(1) + np.arange(len(view))
    best = np.unique(best[text[: len(view)] == text[width - 1 :]])
    return h[best], text[best], at[best]


def _places(docs: DataFrame, select) -> DataFrame:
    """(h, doc, at) of what select(hashes, bounds) picks in each document; docs: (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = batch.column(0).to_numpy(zero_copy_only=False), texts(batch.column(1))
            for lo, hi in steps(values):
                h, text, at = select(*words(values[lo:hi]))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[lo:hi][text]), pa.array(at, pa.int32())], names=["h", "doc", "at"])

    return docs.mapInArrow(run, "h long, doc long, at int")


def shared(places: DataFrame) -> DataFrame:
    """(h, lo): hashes in several documents, with the smallest of them."""
    return places.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h", "lo")


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL)).alias("doc"), F.col(text).alias("text"))


def candidates(docs: DataFrame, half: int, full: int) -> DataFrame:
    """(doc, starts): where full windows may be repeated; docs: (doc, text). Sorted starts of the picked half windows that survive."""
    half_windows = _places(docs, lambda h, b: picked(h, b, half, full))
    alive = stored(shared(half_windows).select("h"))
    found = stored(half_windows.join(alive, "h").groupBy("doc").agg(F.array_sort(F.collect_set("at")).alias("starts")))
    dropped(alive)
    return found


def full_windows(docs: DataFrame, found: DataFrame, half: int, full: int) -> DataFrame:
    """(h, doc, at) of the windows of `full` words that hold a surviving picked half window, hashed anew from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values, starts = batch.column(0).to_numpy(), texts(batch.column(1)), batch.column(2)
            for lo, hi in steps(values):
                hashes, bounds = words(values[lo:hi])
                h, text, at = windows(hashes, bounds, full)
                chosen = starts.slice(lo, hi - lo)
                place = bounds[:-1][np.repeat(np.arange(hi - lo), chosen.value_lengths().to_numpy())] + chosen.flatten().to_numpy()
                # a full window at s holds the half windows at s .. s + full - half
                count = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(count, place[place < len(hashes)] + 1, 1)
                count = np.cumsum(count)
                begin = bounds[:-1][text] + at
                ok = count[begin + (full - half + 1)] > count[begin]
                yield pa.RecordBatch.from_arrays([pa.array(h[ok].view(np.int64)), pa.array(ids[lo:hi][text[ok]]), pa.array(at[ok], pa.int32())], names=["h", "doc", "at"])

    return docs.join(found, "doc").select("doc", "text", "starts").mapInArrow(run, "h long, doc long, at int")


def survivors(places: DataFrame) -> DataFrame:
    """(doc, starts, later): sorted starts of windows in several documents, and of those that a smaller document has."""
    later = F.collect_set(F.when(F.col("lo") < F.col("doc"), F.col("at")))
    # as a table of its own, not an aggregate of the join's own stage: so Spark can split the rows of a frequent window
    return places.join(stored(shared(places)), "h").groupBy("doc").agg(F.array_sort(F.collect_set("at")).alias("starts"), F.array_sort(later).alias("later"))


def repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """survivors() at the length `window`; docs: (doc, text)."""
    half = -(-window // 2)
    found = candidates(docs, half, window)
    places = stored(full_windows(docs, found, half, window))
    done = stored(survivors(places))
    dropped(found, places)
    return done


def levels(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc, length, starts, later): survivors of `window` words, of twice as many, and so on until there are none."""
    docs = keyed(docs, text, doc_id)
    found, length = repeated(docs, window), window
    out = found.select("doc", F.lit(length).alias("length"), "starts", "later")
    while not found.isEmpty():
        places = stored(doubled(docs, found, length))
        length *= 2
        found = stored(survivors(places))
        dropped(places)
        out = out.unionByName(found.select("doc", F.lit(length).alias("length"), "starts", "later"))
    return out


def doubled(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """(h, doc, at) of the windows of twice `length` words of which both halves survived."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values, starts = batch.column(0).to_numpy(), texts(batch.column(1)), batch.column(2)
            for lo, hi in steps(values):
                hashes, bounds = words(values[lo:hi])
                h, text, at = windows(hashes, bounds, 2 * length)
                chosen = starts.slice(lo, hi - lo)
                survived = np.zeros(len(hashes) + 1, bool)
                survived[bounds[:-1][np.repeat(np.arange(hi - lo), chosen.value_lengths().to_numpy())] + chosen.flatten().to_numpy()] = True
                begin = bounds[:-1][text] + at
                ok = survived[begin] & survived[begin + length]
                yield pa.RecordBatch.from_arrays([pa.array(h[ok].view(np.int64)), pa.array(ids[lo:hi][text[ok]]), pa.array(at[ok], pa.int32())], names=["h", "doc", "at"])

    return docs.join(found, "doc").select("doc", "text", "starts").mapInArrow(run, "h long, doc long, at int")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept: the words left, joined by one space."""
    docs = keyed(docs, text, doc_id)
    marked = docs.join(repeated(docs, window), "doc", "left").select("doc", "text", F.col("later").alias("starts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values, starts = batch.column(0), texts(batch.column(1)), batch.column(2)
            total, removed, kept = [], [], []
            for k, x in enumerate(values):
                first, last = spans(np.frombuffer(x, np.uint8), SPACES)
                n = len(first)
                gone = np.zeros(n + window + 1, np.int64)
                if starts[k].is_valid and len(starts[k]):
                    at = starts[k].values.to_numpy()
                    at = at[at < n]
                    gone[at] += 1
                    np.add.at(gone, at + window, -1)
                gone = np.cumsum(gone)[:n] > 0
                total.append(n)
                removed.append(int(gone.sum()))
                parts = x.split()
                kept.append(b" ".join(parts) if not removed[-1] else b" ".join([w for w, g in zip(parts, gone.tolist(), strict=True) if not g]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc", "n_words", "n_removed", "kept"])

    done = marked.mapInArrow(run, "doc long, n_words long, n_removed long, kept string")
    return done.select(F.when(F.col("doc") != _NULL, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept")


def op8_substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return dedup_substrings(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 13], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 12)) AS i FROM words WHERE len(w) >= 13)),
first AS (
  SELECT h, min(doc_id) AS lo FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN first USING (h) WHERE lo < doc_id),
kept AS (
  SELECT doc_id, i, w[i + 1] AS word FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM words)
  ANTI JOIN gone USING (doc_id, i)),
left_over AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM kept GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN left_over ON words.doc_id = left_over.doc_id
"""
