"""Language ID by prediction by partial matching: one variable-order byte context tree per language.

Each tree holds the byte counts of the contexts of 2, 1 and 0 bytes in a bounded sample of labelled texts. A byte's
probability comes from the longest context that the sample has; a byte unseen there escapes to the next shorter one
(escape weight: the number of distinct bytes of the context), where the bytes of the longer context are excluded; below
order 0 the bytes left are equally likely. The statistics are frozen, so a probability depends on the two bytes before
alone and the exact code length of a whole text is a sum of table entries.

Size bounds: the sample has at most `per_language` distinct texts of a language, the first SAMPLE_CHARS of each, cut before they
are gathered, and a tree at most 65,536 + 257 rows of 256 four-byte entries (67 MB; a few MB for one script); over
MAX_LANGUAGES labels are refused. So what is gathered and broadcast doesn't grow with the data.

Results for special rows: a null, empty or letterless text is `und` with score 0; very long texts are scored whole,
step by step; ties go to the first language in alphabetic order; repeated rows get equal results; without any learned
language every row is `und`; other columns are kept as they are, except that columns with the names of the results are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquarry.llm.common import LOWER, crc_mod5, free, steps, texts

#: Labelled texts of each language that the trees are fitted on: the documented bound of the sample.
PER_LANGUAGE = 400
#: Characters that a sampled text gives to its tree at most.
SAMPLE_CHARS = 1 << 16
#: Distinct labels that a model may have.
MAX_LANGUAGES = 200
#: keep_identified() rejects a text that takes its best tree more bits a byte. Labelled texts take 2 to 3, and up to 7 where
#: they are full of keys and numbers; letters drawn at random take 12, other scripts 20, as they hardly meet a known context.
MAX_BITS = 10.0
UND = "und"


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, text) of at most per_language distinct labelled texts of each language, picked by a hash of the text.

    The pick is an aggregate of few rows, not a sort of all, and of cut texts; copies of a text count once.
    """
    # the hash orders the texts at random; those under the language's quantile of it are the sample
    labelled = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("lang"), F.substring(text, 1, SAMPLE_CHARS).alias("text"), F.xxhash64(text).alias("h"))
    # a row for each language; twice the share is as good as never too little
    counts = labelled.select("lang", "h").distinct().groupBy("lang").count()
    # broadcast: far less than the tree that each of these languages has in what is broadcast later
    bound = F.broadcast(counts.select(F.col("lang").alias("l"), (F.lit(float(per_language)) / F.col("count")).alias("share")))
    picked = labelled.join(bound, F.col("lang") == F.col("l")).where(F.pmod("h", F.lit(1 << 40)) < F.col("share") * 2 * (1 << 40))
    top = F.slice(F.array_sort(F.collect_set(F.struct("h", "text"))), 1, per_language)
    return picked.groupBy("lang").agg(top.alias("top")).select("lang", F.explode("top.text").alias("text"))


def context_tree(samples: list[bytes], order: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(row of each two-byte context, log2 probability of each byte in each row) of one language.

    Row 0 is order 0, rows 1..256 are the one-byte contexts, then come the two-byte contexts that the sample has; an
    unseen context has the row of its suffix.
    """
    data = LOWER[np.frombuffer(b"\n".join(samples), np.uint8)].astype(np.int64)
    table = _chain([np.bincount(data, minlength=256)[None, :]])
    pairs = np.bincount(data[:-1] * 256 + data[1:], minlength=65536).reshape(256, 256)
    zero = np.repeat(np.bincount(data, minlength=256)[None, :], 256, 0)
    one = _chain([pairs, zero])
    three, n = np.unique((data[:-2] << 16) | (data[1:-1] << 8) | data[2:], return_counts=True)
    seen, row = np.unique(three >> 8, return_inverse=True)
    counts = np.zeros((len(seen), 256), np.int64)
    counts[row, three & 255] = n
    two = _chain([counts, pairs[seen & 255], np.repeat(zero[:1], len(seen), 0)])
    rows = 1 + (np.arange(65536) & 255)
    rows[seen] = 257 + np.arange(len(seen))
    return rows.astype(np.int32), np.log2(np.vstack([table, one, two])).astype(np.float32)


def _chain(levels: list[np.ndarray]) -> np.ndarray:
    """Probabilities by rows; levels: counts of the longest context first, each row's suffix contexts after it."""
    shape = levels[0].shape
    found, left, excluded = np.zeros(shape), np.ones((shape[0], 1)), np.zeros(shape, bool)
    for counts in levels:
        n = np.where(excluded, 0, counts)
        distinct = (n > 0).sum(1, keepdims=True)
        whole = n.sum(1, keepdims=True) + distinct
        last = excluded.sum(1, keepdims=True) + distinct == 256  # nothing is left to escape to
        whole = np.where(last, whole - distinct, whole)
        found += np.where(n > 0, left * n / np.maximum(whole, 1), 0)
        left = np.where(whole > 0, left * np.where(last, 0, distinct) / np.maximum(whole, 1), left)
        excluded |= counts > 0
    rest = (~excluded).sum(1, keepdims=True)
    return np.where(excluded, found, left / np.maximum(rest, 1))


def code_lengths(values: list[bytes], trees: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Bits of each whole text (rows) under each tree (columns); the two bytes before a text count as line ends."""
    out = np.zeros((len(values), len(trees)))
    for lo, hi in steps(values):
        buf = LOWER[np.frombuffer(b"\n\n" + b"\n\n".join(values[lo:hi]), np.uint8)].astype(np.int32)
        context, byte = (buf[:-2] << 8) | buf[1:-1], buf[2:]
        size = np.array([len(x) for x in values[lo:hi]], np.int64)
        start = np.concatenate([[0], np.cumsum(size + 2)[:-1]])
        full = size > 0
        inside = np.repeat(full, np.maximum(size, 0))
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
        context, byte = context[at[inside]], byte[at[inside]]
        ends = np.concatenate([[0], np.cumsum(size[full])[:-1]]).astype(np.int64)
        for k, (rows, table) in enumerate(trees):
            bits = -table.ravel()[rows[context].astype(np.int64) * 256 + byte]
            if len(bits):
                out[lo:hi, k][full] = np.add.reduceat(bits, ends, dtype=np.float64)
    return out


def identify(docs: DataFrame, learned: DataFrame, text: str = "text", per_language: int = PER_LANGUAGE) -> DataFrame:
    """docs with lang_pred, score and bits_per_byte, by trees fitted on `learned` (text, lang).

    score: the probability of lang_pred among the learned languages, all equally likely before, at the text's mean
    code length over min(bytes, 64) bytes (code lengths of whole long texts would always round to 1). bits_per_byte: the
    code length of the whole text under that language's tree over its bytes; null for `und`.
    """
    spark = docs.sparkSession
    by: dict[str, list[bytes]] = {}
    for row in sample(learned, per_language).toLocalIterator():
        by.setdefault(row["lang"], []).append(row["text"].encode())
        if len(by) > MAX_LANGUAGES:
            raise ValueError(f"over {MAX_LANGUAGES} languages")
    names = sorted(by)
    model = spark.sparkContext.broadcast([context_tree(sorted(by[x])) if sum(map(len, by[x])) > 2 else None for x in names])
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "bits_per_byte")]
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    flag = free("letters", *keep)
    docs = docs.select(*keep, has_letter.alias(flag))
    fields = [f for f in docs.schema.fields if f.name != flag]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usable = [i for i, t in enumerate(model.value) if t is not None]
        trees = [model.value[i] for i in usable]
        for batch in batches:
            values = texts(batch.column(text))
            letters = np.array(batch.column(flag).to_pylist(), bool) & bool(trees)
            bits = code_lengths([x if ok else b"" for x, ok in zip(values, letters, strict=True)], trees) if trees else np.zeros((len(values), 1))
            size = np.maximum([len(x) for x in values], 1)[:, None]
            mean = bits / size * np.minimum(size, 64)
            best = bits.argmin(1)
            score = 1 / np.exp2(np.clip(mean.min(1, keepdims=True) - mean, -1000, 0)).sum(1)
            pred = [names[usable[b]] if ok else UND for b, ok in zip(best, letters, strict=True)]
            found = [pa.array(pred, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(bits.min(1) / size[:, 0], mask=~letters)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], *found], names=schema.names)

    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def op9_language_id(docs: DataFrame) -> DataFrame:
    """The contract's columns: learns from documents whose crc32(doc_id as text) mod 5 is not 0."""
    learned = docs.where(crc_mod5() != 0).select("text", "lang")
    found = identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", (crc_mod5() == 0).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, learned: DataFrame, max_bits: float = MAX_BITS) -> DataFrame:
    """docs without those that language ID rejects: texts without a letter, and texts that even the tree which reads them
    best takes over max_bits bits a byte for, i.e. in no learned language."""
    columns = docs.columns
    return identify(docs, learned).where((F.col("lang_pred") != UND) & (F.col("bits_per_byte") <= max_bits)).select(*columns)
