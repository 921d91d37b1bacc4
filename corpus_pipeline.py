"""The training-corpus pipeline: five stages, each written as Parquet and read again by the next.

Null and empty texts are judged like others: the classifier scores them, no stage links or matches them, and they are mixed
where they pass. Of equal rows with words one stays, as of any near duplicates; rows that share or lack a doc_id are
documents of their own. Extra columns of documents come through. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandloom.llm import common, cotraining, decontamination, mixing, near_dedup, secrets

#: Documents whose combined quality score is below this go.
LEAST_QUALITY = 0.4


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the co-trained classifier rejects."""
    return cotraining.keep(docs, cotraining.fit(docs, common.read(spark, sf_dir, "labels")), least=LEAST_QUALITY)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.first_of_group(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item or a re-parameterised one."""
    return decontamination.clean(docs, common.read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by placeholders; n_chars follows. No document goes."""
    return secrets.redacted(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds block, slot and position of the mix; source weights are the square roots of the counts."""
    return mixing.mix(docs, block=16, power=0.5)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("mixing_sources", mixing_sources),
]
#: The classifier, sketches and randomness tests have no SQL form; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again. Only the last is left there."""
    return applied(spark, common.read(spark, sf_dir, "documents"), sf_dir)


def applied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder, before = f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        path, mark = f"{folder}/{name}", common.stored_so_far()
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        common.drop_stored(mark)  # what the stage held on its way
        if before:
            common.delete(spark, before)
        before = path
    common.kept_until_exit(spark, path)
    return docs
