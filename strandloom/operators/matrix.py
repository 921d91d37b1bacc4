"""Sample-by-position matrices in long form: one row a covered position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import masks
from ..schemas import CHANNELS
from .contract import reject

MIN_COV = 5


def covered(positions: DataFrame, min_cov: int = MIN_COV) -> DataFrame:
    """sample_id, genome, chrom, pos, gene, mask and counts of the positions at min_cov or more."""
    return positions.filter(masks.coverage() >= min_cov).withColumn("mask", masks.mask())


def on_axis(positions: DataFrame, axis: DataFrame, *, check: bool = False) -> DataFrame:
    """positions with axis_pos. The axis has a row a scaffold; Spark broadcasts it while it is small."""
    a = axis.select("genome", "chrom", "index_base", "max_pos", "axis_start")
    if check:
        reject(positions.join(a, ["genome", "chrom"], "left_anti"), "positions on unknown scaffolds", "genome", "chrom")
    rows = positions.join(a, ["genome", "chrom"])
    if check:
        reject(rows.filter(~F.col("pos").between(F.col("index_base"), F.col("max_pos"))), "positions outside their scaffold", "chrom", "pos")
    return rows.withColumn("axis_pos", F.col("pos") - F.col("index_base") + F.col("axis_start")).drop("index_base", "max_pos", "axis_start")


def bitmask(positions: DataFrame, axis: DataFrame, min_cov: int = MIN_COV) -> DataFrame:
    return on_axis(covered(positions, min_cov), axis).select("genome", "sample_id", "axis_pos", "mask")


def from_masks(masks_of: DataFrame, axis: DataFrame) -> DataFrame:
    """The bitmask matrix from decoded masks (sample_id, genome, chrom, pos, mask). A mask beyond its scaffold's range on the axis is an error, not cut off."""
    a = axis.select("genome", "chrom", "index_base", "max_pos", "axis_start")
    at = F.col("pos") - F.col("index_base") + F.col("axis_start")
    say = F.raise_error(F.concat(F.lit("masks outside the axis: "), F.concat_ws(" ", "sample_id", "genome", "chrom", F.col("pos").cast("string")))).cast("bigint")
    rows = masks_of.join(a, ["genome", "chrom"], "left")
    return rows.select("genome", "sample_id", F.when(F.col("pos").between(F.col("index_base"), F.col("max_pos")), at).otherwise(say).alias("axis_pos"), "mask")


def counts(positions: DataFrame, axis: DataFrame, min_cov: int = MIN_COV) -> DataFrame:
    return on_axis(covered(positions, min_cov), axis).select("genome", "sample_id", "axis_pos", *CHANNELS)


def presence(positions: DataFrame, axis: DataFrame, min_cov: int = MIN_COV) -> DataFrame:
    """0 or 1 for each channel."""
    return on_axis(covered(positions, min_cov), axis).select("genome", "sample_id", "axis_pos", *[(F.col(c) > 0).cast("int").alias(c) for c in CHANNELS])


def flat_counts(matrix: DataFrame) -> DataFrame:
    """Non-zero cells of a count matrix with index axis_pos * 4 + channel."""
    cells = F.posexplode(F.array(*CHANNELS)).alias("channel", "value")
    return matrix.select("genome", "sample_id", "axis_pos", cells).filter("value > 0").select("genome", "sample_id", (F.col("axis_pos") * 4 + F.col("channel")).alias("cell"), "value")


def row_pointers(matrix: DataFrame, catalog: DataFrame) -> DataFrame:
    """sample_idx and the end of each sample's row in compressed form; samples without cells keep a row."""
    n = matrix.groupBy("genome", "sample_id").agg(F.count(F.lit(1)).alias("nnz"))
    rows = catalog.select("genome", "sample_id").join(n, ["genome", "sample_id"], "left").withColumn("nnz", F.coalesce("nnz", F.lit(0)))
    order = W.partitionBy("genome").orderBy("sample_id")
    return rows.select("genome", "sample_id", (F.row_number().over(order) - 1).alias("sample_idx"), F.sum("nnz").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("row_end"))


def zero_rows(matrix: DataFrame, catalog: DataFrame) -> DataFrame:
    return catalog.select("genome", "sample_id").join(matrix, ["genome", "sample_id"], "left_anti")


def largest_count(positions: DataFrame) -> DataFrame:
    """The largest of all counts; it must fit 16 bits without sign."""
    return positions.agg(F.greatest(*[F.coalesce(F.max(c), F.lit(0)) for c in CHANNELS]).alias("max_count"))


def storage_mode(mode: str | None, count_dtype: str | None) -> str:
    if mode == "bitmask" and count_dtype:
        raise ValueError("a bitmask matrix has no count type")
    if mode not in (None, "bitmask", "counts"):
        raise ValueError(f"unknown storage mode {mode}")
    return mode or ("counts" if count_dtype else "bitmask")


def append_rows(new: DataFrame, stored_samples: DataFrame, known: DataFrame) -> DataFrame:
    """new (genome, sample_id) with the row each takes; duplicates and unknown genomes are refused."""
    reject(new.join(stored_samples, ["genome", "sample_id"], "left_semi"), "samples already stored", "genome", "sample_id")
    reject(new.join(known.select("genome"), "genome", "left_anti"), "unknown genomes", "genome")
    count = stored_samples.groupBy("genome").agg(F.count(F.lit(1)).alias("offset"))
    order = W.partitionBy("genome").orderBy("sample_id")
    return new.distinct().join(count, "genome", "left").select("genome", "sample_id", (F.coalesce("offset", F.lit(0)) + F.row_number().over(order) - 1).alias("sample_idx"))


def dense(matrix: DataFrame, catalog: DataFrame, lengths: DataFrame) -> DataFrame:
    """One byte a cell for each sample: a grouped write-out for consumers that need vectors."""
    cells = matrix.groupBy("genome", "sample_id").agg(F.map_from_entries(F.collect_list(F.struct("axis_pos", "mask"))).alias("cells"))
    rows = catalog.select("genome", "sample_id").join(cells, ["genome", "sample_id"], "left").join(F.broadcast(lengths.select("genome", "matrix_length")), "genome")  # a row a genome
    value = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("matrix_length") - 1), lambda p: F.coalesce(F.element_at("cells", p), F.lit(0)))
    return rows.select("genome", "sample_id", value.alias("vector"))


def appended_pointers(old: DataFrame, added: DataFrame) -> DataFrame:
    """The compressed rows (genome, sample_id, sample_idx, row_end) of a matrix after those of other samples; old rows keep their places and ends."""
    last = old.groupBy("genome").agg((F.max("sample_idx") + 1).alias("rows"), F.max("row_end").alias("cells"))
    moved = added.join(last, "genome", "left").select("genome", "sample_id", (F.col("sample_idx") + F.coalesce("rows", F.lit(0))).alias("sample_idx"), (F.col("row_end") + F.coalesce("cells", F.lit(0))).alias("row_end"))
    return old.select("genome", "sample_id", "sample_idx", "row_end").unionByName(moved)


def memory_guard(lengths: DataFrame, limit_gb: float, channels: int = 1, bytes_per_cell: int = 1) -> None:
    """Refuses dense vectors that would not fit in limit_gb."""
    too_long = lengths.filter(F.col("matrix_length") * channels * bytes_per_cell > F.lit(limit_gb * 2**30))
    reject(too_long, "vectors beyond the memory limit", "genome")


__all__ = ["append_rows", "appended_pointers", "bitmask", "from_masks", "counts", "covered", "dense", "flat_counts", "largest_count", "memory_guard", "on_axis", "presence", "row_pointers", "storage_mode", "zero_rows"]
