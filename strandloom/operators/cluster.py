"""Hierarchical clustering, a genome a task, and single linkage as distributed components.

The dense matrix is the result's own size (n samples of one genome, n squared cells), so a genome is the unit of work;
MAX_SAMPLES guards it. Linkage is the nearest-neighbour chain, exact for the four reducible methods offered.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METHODS = ("single", "complete", "average", "weighted")
MAX_SAMPLES = 8000


def linkage(distance: np.ndarray, method: str = "average") -> np.ndarray:
    """Merges (left, right, distance, size) sorted by distance; cluster n + i is the i-th merge, left < right."""
    if method not in METHODS:
        raise ValueError(f"linkage method must be one of {', '.join(METHODS)}")
    d = distance.astype(np.float64).copy()
    n = len(d)
    np.fill_diagonal(d, np.inf)
    size = np.ones(n)
    alive = np.ones(n, bool)
    chain: list[int] = []
    merges = []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.argmax(alive)))
        while True:
            x = chain[-1]
            row = np.where(alive, d[x], np.inf)
            y = int(np.argmin(row))
            if len(chain) > 1 and row[chain[-2]] <= row[y]:
                y = chain[-2]
                break
            chain.append(y)
        chain.pop()
        chain.pop()
        a, b = (x, y) if x < y else (y, x)
        merges.append((a, b, d[a, b]))
        if method == "single":
            new = np.minimum(d[a], d[b])
        elif method == "complete":
            new = np.maximum(d[a], d[b])
        elif method == "average":
            new = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        else:
            new = (d[a] + d[b]) / 2
        d[b], d[:, b] = new, new
        d[b, b] = np.inf
        size[b] += size[a]
        alive[a] = False
        d[a], d[:, a] = np.inf, np.inf
    order = sorted(range(len(merges)), key=lambda i: merges[i][2])
    parent = list(range(2 * n - 1))
    label, count = list(range(n)), [1] * (2 * n - 1)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = np.zeros((max(0, n - 1), 4))
    for k, i in enumerate(order):
        a, b, at = merges[i]
        x, y = root(label[a]), root(label[b])
        x, y = min(x, y), max(x, y)
        parent[x] = parent[y] = n + k
        count[n + k] = count[x] + count[y]
        out[k] = x, y, at, count[n + k]
    return out


def leaves(merges: np.ndarray) -> list[int]:
    """Leaves from left to right."""
    n = len(merges) + 1
    out, stack = [], [2 * n - 2]
    while stack:
        node = stack.pop()
        if node < n:
            out.append(node)
        else:
            left, right = int(merges[node - n, 0]), int(merges[node - n, 1])
            stack += [right, left]
    return out


def flat(merges: np.ndarray, cut: float) -> list[int]:
    """Cluster of each leaf when merges up to `cut` hold; numbered by first leaf."""
    n = len(merges) + 1
    parent = list(range(2 * n - 1))
    for k, (a, b, at, _) in enumerate(merges):
        if at <= cut:
            parent[int(a)] = parent[int(b)] = n + k
    names: dict[int, int] = {}
    out = []
    for i in range(n):
        r = i
        while parent[r] != r:
            r = parent[r]
        out.append(names.setdefault(r, len(names) + 1))
    return out


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    n = int(pdf["n"].iloc[0])
    if n > MAX_SAMPLES:
        raise MemoryError(f"{n} samples of one genome; at most {MAX_SAMPLES} are clustered at once")
    d = np.zeros((n, n), np.float32)
    i, j = pdf["i"].to_numpy(), pdf["j"].to_numpy()
    d[i, j] = d[j, i] = np.float32(1) - pdf["ani"].to_numpy(np.float32) / np.float32(100)
    return d


def _with_n(condensed: DataFrame) -> DataFrame:
    n = condensed.groupBy("genome").agg((F.max("j") + 1).alias("n"))
    return condensed.join(F.broadcast(n), "genome")  # a row a genome


def merge_rows(condensed: DataFrame, method: str = "average") -> DataFrame:
    """genome, merge_id, left, right, distance, size of each genome's dendrogram; the root is 2 n - 2."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        m = linkage(_matrix(pdf), method)
        n = len(m) + 1
        return pd.DataFrame({"genome": key[0], "merge_id": np.arange(n, n + len(m)), "left": m[:, 0].astype(int), "right": m[:, 1].astype(int), "distance": m[:, 2], "size": m[:, 3].astype(int)})

    return _with_n(condensed).groupBy("genome").applyInPandas(run, "genome string, merge_id bigint, left bigint, right bigint, distance double, size bigint")


def assignments(condensed: DataFrame, method: str = "average", clonal: float = 99.93, strain: float = 99.8) -> DataFrame:
    """genome, i, leaf_rank, strain_cluster and clonal_cluster."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        m = linkage(_matrix(pdf), method)
        order = leaves(m)
        rank = np.empty(len(order), int)
        rank[order] = np.arange(len(order))
        return pd.DataFrame({"genome": key[0], "i": np.arange(len(order)), "leaf_rank": rank, "strain_cluster": flat(m, 1 - strain / 100), "clonal_cluster": flat(m, 1 - clonal / 100)})

    return _with_n(condensed).groupBy("genome").applyInPandas(run, "genome string, i bigint, leaf_rank bigint, strain_cluster bigint, clonal_cluster bigint")


def single_linkage(pairs: DataFrame, kept: DataFrame, least_ani: float, max_rounds: int = 50) -> DataFrame:
    """genome, sample_id and cluster (its smallest member) when pairs of at least least_ani are joined; no task sees a whole genome."""
    both = pairs.filter(F.col("ani") >= least_ani).select("genome", F.explode(F.array(F.struct(F.col("sample_1").alias("a"), F.col("sample_2").alias("b")), F.struct(F.col("sample_2").alias("a"), F.col("sample_1").alias("b")))).alias("e")).select("genome", "e.a", "e.b")
    labels = kept.select("genome", "sample_id", F.col("sample_id").alias("cluster"))
    for _ in range(max_rounds):
        offered = both.join(labels.select("genome", F.col("sample_id").alias("b"), F.col("cluster").alias("offer")), ["genome", "b"]).groupBy("genome", "a").agg(F.min("offer").alias("offer"))
        step = labels.join(offered.withColumnRenamed("a", "sample_id"), ["genome", "sample_id"], "left").select("genome", "sample_id", F.least("cluster", F.coalesce("offer", "cluster")).alias("cluster"), "cluster").toDF("genome", "sample_id", "cluster", "before")
        jump = step.select("genome", F.col("sample_id").alias("cluster"), F.col("cluster").alias("further"))
        step = step.join(jump, ["genome", "cluster"]).select("genome", "sample_id", F.col("further").alias("cluster"), "before").checkpoint()
        labels = step.select("genome", "sample_id", "cluster")
        if step.filter("cluster <> before").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def cluster_sizes(clusters: DataFrame, column: str = "cluster") -> DataFrame:
    return clusters.groupBy("genome", column).agg(F.count(F.lit(1)).alias("size"), F.sort_array(F.collect_list("sample_id")).alias("members"))
