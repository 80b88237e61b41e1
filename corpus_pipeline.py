"""The corpus pipeline: five stages over `documents`, each one of the operators of netquarry.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the driver of the pipeline writes it as Parquet and
reads it again for the next stage. All but the last return the columns of `documents`.

Results for special rows: null, empty and letterless texts go in the first stage, as do texts in no learned language; very
long texts pass whole; repeated rows and rows that share a doc_id pass or go together (of copies under different ids one
stays); a null doc_id is in no class of near-duplicates and stays; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquarry.llm import bpe, decontaminate, langid, linededup, neardup
from netquarry.llm.common import shared_dir, table
from netquarry.llm.registry import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that a learned language's tree can read (see langid.MAX_BITS); lang stays as given."""
    return langid.keep_identified(docs, docs.select("text", "lang"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later occurrences of three-line windows; documents left without a letter or digit go, n_chars follows the text."""
    left = linededup.dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[\p{L}\p{N}]")
    return left.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids of each document, and the number of characters that its ids decode to."""
    done = bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.length("decoded").cast("long").alias("decoded_chars"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Language ID and near-dedup are not expressible in SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over `documents`; between stages the kept documents are a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    top = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}-{name}")
        docs = spark.read.parquet(f"{top}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
