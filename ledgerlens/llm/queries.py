"""The registered queries of the text operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, langid, mixing, neardup, pii, quality_mil, quality_rules, resampling, spelling, tokens, toxicity, urltree, warc
from ledgerlens.llm.common import read
from ledgerlens.plans import scratch


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op2_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op3_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), least=1)


def op4_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op5_url_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.judge(read(spark, sf_dir, "pages"))


def op6_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digest(read(spark, sf_dir, "documents"))


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


def op10_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.judge(read(spark, sf_dir, "pages"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: scratch.tidy(f) for f in (op1_simhash_near_dedup, op2_language_bitmask, op3_spaced_seed_decontamination, op4_poisson_mixing, op5_url_template_tree, op6_pii_deobfuscation, op7_toxicity_chain, op8_token_records, op9_quality_votes, op10_quality_attention, op11_importance_resampling, op12_warc_archive, op13_spelling_variants)}
    return found


def oracle_sql() -> dict[str, str]:
    return {"op4_poisson_mixing": mixing.ORACLE, "op12_warc_archive": warc.ORACLE}
