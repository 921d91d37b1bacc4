"""The shared coordinate axis: scaffolds laid end to end, one separator cell between neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def reject(df: DataFrame, message: str, *columns: str) -> None:
    """Raises if df has rows; names up to five of them."""
    bad = df.select(*columns).distinct().limit(5).collect()
    if bad:
        raise ValueError(f"{message}: {', '.join(' '.join(map(str, r)) for r in sorted(bad, key=str))}")


def spans(bed: DataFrame) -> DataFrame:
    return bed.groupBy("chrom").agg(F.min("start_pos").alias("min_start"), F.max("end_pos").alias("max_end"))


def duplicate_scaffolds(stb: DataFrame) -> DataFrame:
    return stb.groupBy("scaffold").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def axis(bed: DataFrame, stb: DataFrame, *, check: bool = True) -> DataFrame:
    """genome, chrom, scaffold_ordinal, index_base, min_pos, max_pos, vector_length, axis_start. A row a scaffold."""
    if check:
        reject(duplicate_scaffolds(stb), "scaffolds assigned more than once", "scaffold")
        reject(stb.join(spans(bed), stb["scaffold"] == F.col("chrom"), "left_anti"), "scaffolds without intervals", "scaffold")
    rows = stb.join(spans(bed), stb["scaffold"] == F.col("chrom")).select("genome", "chrom", (F.col("min_start") + 1).alias("index_base"), F.col("max_end").alias("max_pos"), (F.col("max_end") - F.col("min_start")).alias("vector_length"))
    order = W.partitionBy("genome").orderBy("chrom", "index_base")
    start = F.coalesce(F.sum(F.col("vector_length") + 1).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.select("genome", "chrom", (F.row_number().over(order) - 1).alias("scaffold_ordinal"), "index_base", F.col("index_base").alias("min_pos"), "max_pos", "vector_length", start.alias("axis_start"))


def lengths(axis_rows: DataFrame) -> DataFrame:
    """genome_idx, genome, true_length and matrix_length (with separators)."""
    each = axis_rows.groupBy("genome").agg(F.sum("vector_length").alias("true_length"), (F.sum("vector_length") + F.count(F.lit(1)) - 1).alias("matrix_length"))
    return each.withColumn("genome_idx", F.row_number().over(W.orderBy("genome")) - 1)  # a row a genome


def gene_axis(genes: DataFrame, axis_rows: DataFrame, *, check: bool = True) -> DataFrame:
    """Gene intervals on the axis; genes on unknown scaffolds are skipped."""
    rows = genes.join(axis_rows, genes["scaffold"] == axis_rows["chrom"])
    if check:
        reject(rows.filter((F.col("end_pos") < F.col("start_pos")) | (F.col("start_pos") < F.col("min_pos")) | (F.col("end_pos") > axis_rows["max_pos"])), "gene ranges outside their scaffold", "gene")
    shift = F.col("axis_start") - F.col("index_base")
    rows = rows.select("genome", "gene", (F.col("start_pos") + shift).alias("gene_start"), (F.col("end_pos") + shift).alias("gene_end"))
    return rows.withColumn("gene_idx", F.row_number().over(W.partitionBy("genome").orderBy("gene_start", "gene_end", "gene")) - 1)


def tiles(lengths_by_scaffold: DataFrame, step: int = 500_000) -> DataFrame:
    """Intervals of at most `step` over scaffolds (scaffold, length)."""
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(step).cast("bigint"))).alias("start_pos")
    return lengths_by_scaffold.filter("length > 0").select("scaffold", "length", starts).select("scaffold", "start_pos", F.least(F.col("start_pos") + step, "length").alias("end_pos"))
