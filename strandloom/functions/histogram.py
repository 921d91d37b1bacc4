"""Equal-width histograms that SQL engines agree on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(column):
    value = F.col(column) if isinstance(column, str) else column
    value = value.cast("double")
    return F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), F.lit(None)).otherwise(value)


def fixed_histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int) -> DataFrame:
    """bin and n for every bin; the last bin takes hi, values outside are dropped."""
    x = finite(column)
    place = F.least(F.floor((x - lo) * bins / (hi - lo)).cast("int"), F.lit(bins - 1))
    counts = df.select(x.alias("x"), place.alias("bin")).filter((F.col("x") >= lo) & (F.col("x") <= hi)).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counts), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))  # at most `bins` rows


def auto_histogram(df: DataFrame, column: str, bins: int, *keys: str) -> DataFrame:
    """Per key: bin, n and the edges, over the range of the finite values; a single value is padded by 1 %, 0.5 at least."""
    rows = df.select(*keys, finite(column).alias("x")).filter("x is not null")
    ends = rows.groupBy(*keys).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.count(F.lit(1)).alias("value_count"))
    pad = F.when(F.col("x0") == F.col("x1"), F.greatest(F.abs("x0") * 0.01, F.lit(0.5))).otherwise(0.0)
    ends = ends.select(*keys, (F.col("x0") - pad).alias("lo"), (F.col("x1") + pad).alias("hi"), "value_count")
    joined = rows.join(ends, list(keys)) if keys else rows.crossJoin(F.broadcast(ends))  # one row
    place = F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))).cast("int"), F.lit(bins - 1))
    return joined.groupBy(*keys, "lo", "hi", "value_count", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
