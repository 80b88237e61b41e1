"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a document are hashed (128 bits: two seeded 64-bit hashes of each). Windows that occur
more than once are found with one aggregation, whose result is the first place (smallest doc_id, then smallest line
number) of each. Every other place is a later occurrence; the lines that later occurrences cover are merged and removed.

Results for special rows: null and empty texts and texts of under three lines have no window and stay as they are; a
null doc_id sorts before all others and equals itself; rows that share a doc_id are one document: the same window at the
same line number of each is one place; ties cannot occur otherwise; an empty table gives an empty table; other columns
are kept. Documents of which every line is removed stay, with an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netquarry.llm.common import free, on, stored

WINDOW = 3


def lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """(doc_id, at, h1, h2): one row for each window; at: its first line, from 0."""
    hashed = docs.where(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.transform(lines(text), lambda x: F.xxhash64(x)).alias("a"), F.transform(lines(text), lambda x: F.xxhash64(x, F.lit(17))).alias("b")
    )
    starts = F.when(F.size("a") >= window, F.sequence(F.lit(0), F.size("a") - window)).otherwise(F.array().cast("array<int>"))
    pick = lambda name, i: F.xxhash64(*[F.get(F.col(name), i + k) for k in range(window)])
    return hashed.select("doc_id", F.inline(F.transform(starts, lambda i: F.struct(i.alias("at"), pick("a", i).alias("h1"), pick("b", i).alias("h2")))))


def repeated(windows: DataFrame) -> DataFrame:
    """(h1, h2, first): windows at more than one place, and the first place."""
    place = F.struct("doc_id", "at")
    return windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last"))).select("h1", "h2", "first")


def removed_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """(doc_id, removed): for documents with later occurrences, the sorted numbers of the lines to remove."""
    found = line_windows(docs, text, doc_id, window)
    # as a table of its own, not an aggregate of the join's own stage: so Spark can split the rows of a frequent window
    later = found.join(stored(repeated(found)), ["h1", "h2"]).where(~F.struct("doc_id", "at").eqNullSafe(F.col("first")))
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform(F.collect_set("at"), lambda i: F.sequence(i, i + (window - 1))))))
    return later.groupBy("doc_id").agg(covered.alias("removed"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """docs with `text` replaced by what is left of it, and n_lines, n_removed (replaced if there)."""
    left = docs.drop("n_lines", "n_removed")
    gone, every = free("removed", *left.columns), free("lines", *left.columns)
    removed = removed_lines(docs, text, doc_id, window).select(F.col("doc_id").alias(doc_id), F.col("removed").alias(gone))
    split = on(left, removed, doc_id, "left").withColumn(every, lines(text))
    numbers = F.sequence(F.lit(0), F.size(every) - 1)
    kept = F.array_join(F.transform(F.array_except(numbers, gone), lambda i: F.get(F.col(every), i)), "\n")
    return split.withColumns({
        "n_lines": F.size(every).cast("long"), "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
        text: F.when(F.col(gone).isNull(), F.col(text)).otherwise(kept),
    }).drop(gone, every)


def op2_line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the text left; null: empty) of every document."""
    found = dedup_lines(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP2_SQL = """
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (
  SELECT doc_id, unnest(range(0, len(l) - 2)) AS pos, l FROM lines WHERE len(l) >= 3),
h AS (
  SELECT doc_id, pos, md5(l[pos + 1] || chr(10) || l[pos + 2] || chr(10) || l[pos + 3]) AS h FROM w),
r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) AS k FROM h),
c AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM r WHERE k > 1),
g AS (
  SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id)
SELECT lines.doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(l, chr(10))
              ELSE coalesce(array_to_string([l[i + 1] FOR i IN range(0, len(l)) IF NOT list_contains(gone, i)], chr(10)), '') END) AS kept_sha256
FROM lines LEFT JOIN g ON lines.doc_id = g.doc_id
"""
