"""Coordinate files derived from genome and gene FASTA."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contract
from . import ingest


def derive(spark: SparkSession, genomes: dict[str, str], genes: dict[str, str] | None = None, step: int = 500_000) -> dict[str, DataFrame]:
    """bed (scaffold tiles), stb (scaffold, genome), gene_ranges and the sequences, from FASTA paths by accession."""
    records = None
    for accession, path in sorted(genomes.items()):
        part = ingest.fasta(spark, path).withColumn("genome", F.lit(accession))
        records = part if records is None else records.unionByName(part)
    lengths = ingest.scaffold_lengths(records)
    out = {
        "fasta": records.select("chrom", "sequence", "genome"),
        "stb": records.select(F.col("chrom").alias("scaffold"), "genome").distinct(),
        "bed": contract.tiles(lengths, step).select(F.col("scaffold").alias("chrom"), "start_pos", "end_pos"),
    }
    ranges = None
    for _, path in sorted((genes or {}).items()):
        part = ingest.genes_from_headers(ingest.fasta(spark, path))
        ranges = part if ranges is None else ranges.unionByName(part)
    out["gene_ranges"] = ranges if ranges is not None else spark.createDataFrame([], "gene string, scaffold string, start_pos bigint, end_pos bigint")
    return out
