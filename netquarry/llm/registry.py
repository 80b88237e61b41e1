"""The numbered queries, one for each operator, and their oracles."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netquarry.llm import bpe, decontaminate, fingerprint, langid, linededup, lmscore, neardup, runs, secretscan, store, substrings, urlfilter, variants
from netquarry.llm.common import shared_dir, table


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.op3_lm_score(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.op4_url_filter(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op5_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op6_fingerprints(table(spark, sf_dir, "documents"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.op7_token_store(table(spark, sf_dir, "documents"), tokenizer_path(), f"{shared_dir(spark)}/store-{uuid.uuid4().hex}")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.op8_substring_dedup(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op9_language_id(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The tokenizer file of the numbered queries; it stays where the installed package has it."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.op2_line_dedup(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op10_near_dedup(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.op11_periodic_runs(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.op12_spelling_variants(table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.op13_secret_scan(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = (
        op1_bpe, op2_line_dedup, op3_lm_score, op4_url_filter, op5_decontamination, op6_fingerprints, op7_token_store, op8_substring_dedup, op9_language_id, op10_near_dedup,
        op11_periodic_runs, op12_spelling_variants, op13_secret_scan,
    )
    return {f.__name__: f for f in numbered}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": linededup.OP2_SQL, "op4_url_filter": urlfilter.oracle(), "op8_substring_dedup": substrings.OP8_SQL}
