"""Connected components of an edge table, by contraction to smallest neighbours with pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for every node of the edges (a, b: long, neither null).

    Each round maps every node to its smallest neighbour, jumps along that map, and relabels edges and nodes; copies of
    an edge meet in partial aggregates, so a hub is no hot group. Each round is a written table.
    """
    spark = edges.sparkSession
    edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("e")).select("e.*")
        to = stored(both.groupBy("node").agg(F.least(F.min("to"), F.first("node")).alias("to")), "least")
        for _ in range(2):
            to = to.join(to.select(F.col("node").alias("n2"), F.col("to").alias("t2")), F.col("to") == F.col("n2")).select("node", F.col("t2").alias("to"))
        to = stored(to, "jump")
        labels = to.withColumnRenamed("to", "component") if labels is None else labels.join(to, labels["component"] == to["node"], "left").select(labels["node"], F.coalesce(to["to"], labels["component"]).alias("component"))
        labels = stored(labels, "labels")
        a, b = to.select(F.col("node").alias("a"), F.col("to").alias("ta")), to.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        edges = stored(edges.join(a, "a").join(b, "b").filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    return spark.createDataFrame([], "node long, component long") if labels is None else labels
