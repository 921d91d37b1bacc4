"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cotraining, decontamination, html_text, mixing, near_dedup, oracles, quality_rules, secrets, substring_dedup, suffix_dedup, toxicity
from .common import read


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source"), block=16, power=0.5)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(read(spark, sf_dir, "documents"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = cotraining.features(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return cotraining.scored(feats, cotraining.co_train(feats), least=0.4)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_secret_scans": op4_secret_scans,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_toxicity": op8_toxicity,
    "op9_html_extraction": op9_html_extraction,
    "op10_near_dedup": op10_near_dedup,
}
ORACLES: dict[str, str] = {
    "op1_mixing": oracles.MIXING,
    "op2_suffix_array_dedup": oracles.SUFFIX_DEDUP,
    "op3_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op5_quality_rules": oracles.QUALITY,
    "op9_html_extraction": oracles.HTML,
    "op10_near_dedup": oracles.NEAR_DEDUP,
}
