"""Which samples may enter a genome's matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLDS = ("coverage", "breadth", "ber")


def thresholds(minimum: dict[str, float | None]):
    """A predicate of the thresholds that are given; a null statistic counts as 0."""
    out = F.lit(True)
    for column, least in minimum.items():
        if least is not None:
            out = out & (F.coalesce(F.col(column), F.lit(0.0)) >= F.lit(float(least)))
    return out


def eligible(samples: DataFrame, stats: DataFrame, abundance: DataFrame | None = None, *, min_coverage=None, min_breadth=None, min_ber=None, min_abundance=None, genome: str | None = None) -> DataFrame:
    """genome and sample_id of complete samples that meet every given threshold, for one genome or all at once."""
    rows = stats if genome is None else stats.filter(F.col("genome") == genome)
    rows = rows.filter(thresholds({"coverage": min_coverage, "breadth": min_breadth, "ber": min_ber}))
    rows = rows.join(samples.filter(F.col("status") == "complete").select("sample_id"), "sample_id", "left_semi")
    if min_abundance is not None:
        enough = abundance.filter(F.coalesce("abundance", F.lit(0.0)) >= float(min_abundance))
        # the genome may be named or given by accession: one key column instead of an OR in the join
        named = enough.select("sample_id", F.explode(F.array("genome", "accession")).alias("genome")).filter("genome is not null")
        rows = rows.join(named, ["sample_id", "genome"], "left_semi")
    return rows.select("genome", "sample_id").distinct()


def by_stores(samples: DataFrame, stats: DataFrame, abundance: DataFrame, stores: DataFrame) -> DataFrame:
    """genome and sample_id that meet the thresholds each stored matrix (matrix_id is its genome) was built with."""
    limits = stores.select(F.col("matrix_id").alias("genome"), "min_coverage", "min_breadth", "min_ber", "min_sylph_abundance")
    rows = stats.join(limits, "genome").join(samples.filter(F.col("status") == "complete").select("sample_id"), "sample_id", "left_semi")
    for c in THRESHOLDS:
        rows = rows.filter(F.col(f"min_{c}").isNull() | (F.coalesce(F.col(c), F.lit(0.0)) >= F.col(f"min_{c}")))
    named = abundance.select("sample_id", F.explode(F.array_distinct(F.array("genome", "accession"))).alias("genome"), "abundance").filter("genome is not null")
    top = named.groupBy("sample_id", "genome").agg(F.max(F.coalesce("abundance", F.lit(0.0))).alias("top"))
    rows = rows.join(top, ["sample_id", "genome"], "left").filter("min_sylph_abundance is null or top >= min_sylph_abundance")
    return rows.select("genome", "sample_id").distinct()


def unmaterialized(eligible_rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Eligible samples that the genome's matrix does not hold."""
    return eligible_rows.join(stored.select(F.col("matrix_id").alias("genome"), "sample_id"), ["genome", "sample_id"], "left_anti")


def genomes_with_complete_samples(samples: DataFrame, stats: DataFrame) -> DataFrame:
    return stats.join(samples.filter(F.col("status") == "complete").select("sample_id"), "sample_id", "left_semi").select("genome").distinct()
