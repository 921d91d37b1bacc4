"""From pair results to graphs: completeness, qualification, connectivity, neighbours, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.histogram import auto_histogram, fixed_histogram
from .contract import reject

#: Members of a block, and pairs that a task is to form.
BLOCK, FORMED = 512, 4_000_000
ANI_COLUMNS = ("genome_ani", "genome_pop_ani")


def ani_column(results: DataFrame) -> str:
    """The ANI column of this or an earlier result layout."""
    needed = {"sample_1", "sample_2", "total_positions"}
    if needed - set(results.columns):
        raise ValueError(f"comparison results lack {', '.join(sorted(needed - set(results.columns)))}")
    for c in ANI_COLUMNS:
        if c in results.columns:
            return c
    raise ValueError("comparison results lack an ANI column")


def sample_index(results: DataFrame) -> DataFrame:
    """sample_idx by name for results without a catalog."""
    names = results.select(F.explode(F.array("sample_1", "sample_2")).alias("sample_name")).distinct()
    return names.select((F.row_number().over(W.orderBy("sample_name")) - 1).alias("sample_idx"), "sample_name")  # a row a sample


def sample_catalog(results: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """sample_idx and sample_name of one genome's results: from its catalog, else from the indices in the rows (the first name
    of each), else by name."""
    if catalog is not None:
        return catalog.select(F.col("sample_idx").cast("int").alias("sample_idx"), F.col("sample_name").cast("string").alias("sample_name"))
    if {"sample_idx_1", "sample_idx_2"} <= set(results.columns):
        ends = F.explode(F.array(*[F.struct(F.col(f"sample_idx_{k}").cast("int").alias("sample_idx"), F.col(f"sample_{k}").alias("sample_name")) for k in (1, 2)])).alias("e")
        return results.select(ends).groupBy(F.col("e.sample_idx").alias("sample_idx")).agg(F.min("e.sample_name").alias("sample_name"))
    return sample_index(results).withColumn("sample_idx", F.col("sample_idx").cast("int"))


def indexed(kept: DataFrame) -> DataFrame:
    """genome, sample_id and i, the place of each kept sample in its genome's matrix."""
    order = W.partitionBy("genome").orderBy("sample_id")
    return kept.select("genome", "sample_id", (F.row_number().over(order) - 1).cast("bigint").alias("i"))


def distinct_pairs(results: DataFrame) -> DataFrame:
    """Unordered pairs, once each."""
    return results.select("genome", F.least("sample_1", "sample_2").alias("sample_1"), F.greatest("sample_1", "sample_2").alias("sample_2")).distinct()


def pairs_among(members: DataFrame) -> DataFrame:
    """genome, sample_1 < sample_2 of all pairs among each genome's members (genome, sample_id), once each.

    Members are made distinct before pairs are formed, which are then neither moved nor compared: sorted blocks of members meet."""
    names = members.select("genome", "sample_id").dropna().distinct()
    formed = names.groupBy("genome").agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(F.expr("n * (n - 1) / 2"))).first()[0] or 0
    place = F.row_number().over(W.partitionBy("genome").orderBy("sample_id")) - 1
    lists = names.withColumn("block", F.floor(place / BLOCK)).groupBy("genome", "block").agg(F.collect_list("sample_id").alias("l"))
    side = lambda k: lists.select("genome", F.col("block").alias(f"block_{k}"), F.col("l").alias(f"l_{k}"))
    met = side(1).join(side(2), "genome").filter("block_1 <= block_2").repartition(int(formed // FORMED) + 1, "genome", "block_1", "block_2")
    rows = met.select("genome", "block_1", "block_2", "l_2", F.explode("l_1").alias("sample_1")).select("genome", "block_1", "block_2", "sample_1", F.explode("l_2").alias("sample_2"))
    return rows.filter("block_1 < block_2 or sample_1 < sample_2").select("genome", "sample_1", "sample_2")


def completeness(catalog: DataFrame, completed: DataFrame) -> DataFrame:
    """Per genome: samples, expected and completed pairs, and whether all are there."""
    n = catalog.select("genome", "sample_id").distinct().groupBy("genome").agg(F.count(F.lit(1)).alias("samples"))
    done = distinct_pairs(completed).groupBy("genome").agg(F.count(F.lit(1)).alias("completed"))
    rows = n.join(done, "genome", "left").select("genome", "samples", F.expr("samples * (samples - 1) div 2").alias("expected"), F.coalesce("completed", F.lit(0)).alias("completed"))
    return rows.withColumn("complete", F.col("completed") >= F.col("expected"))


def only_genome(results: DataFrame) -> str:
    found = [r.genome for r in results.select("genome").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError("a comparison must hold exactly one genome")
    return found[0]


def qualifying(results: DataFrame, min_comp_len: int) -> DataFrame:
    """genome, sample_1 < sample_2, ani (mean, float) and total_positions (largest) of pairs above min_comp_len (strict)."""
    ani = F.col(ani_column(results))
    rows = results.filter((F.col("total_positions") > min_comp_len) & ani.isNotNull())
    keys = F.least("sample_1", "sample_2").alias("sample_1"), F.greatest("sample_1", "sample_2").alias("sample_2")
    return rows.groupBy("genome", *keys).agg(F.avg(ani).cast("float").alias("ani"), F.max("total_positions").alias("total_positions"))


def degrees(pairs: DataFrame) -> DataFrame:
    return pairs.select("genome", F.explode(F.array("sample_1", "sample_2")).alias("sample_id")).groupBy("genome", "sample_id").agg(F.count(F.lit(1)).alias("degree"))


def degree_summary(deg: DataFrame) -> DataFrame:
    return deg.groupBy("genome").agg(F.min("degree").alias("min_degree"), F.percentile("degree", F.lit(0.5)).alias("median_degree"), F.max("degree").alias("max_degree"))


def retained(pairs: DataFrame, *, max_null_fraction: float = 0.20, max_null_samples: int | None = None) -> DataFrame:
    """Candidates (degree 1 or more) that lack few enough partners; one pass. A sample limit overrides the fraction."""
    deg = degrees(pairs)
    counts = deg.groupBy("genome").agg(F.count(F.lit(1)).alias("candidates"))
    rows = deg.join(F.broadcast(counts), "genome").withColumn("missing", F.col("candidates") - 1 - F.col("degree"))  # a row a genome
    if max_null_samples is not None:
        keep = F.col("missing") <= max_null_samples
    else:
        share = F.col("missing").cast("double") / F.greatest(F.col("candidates") - 1, F.lit(1)).cast("double")
        keep = share <= F.lit(float(max_null_fraction))
    return rows.filter(keep).select("genome", "sample_id", "degree", "missing", "candidates")


def among(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Pairs with both ends kept."""
    ends = kept.select("genome", "sample_id")
    out = pairs
    for c in ("sample_1", "sample_2"):
        out = out.join(ends.withColumnRenamed("sample_id", c), ["genome", c], "left_semi")
    return out.select(*pairs.columns)


def null_fraction(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Share of a sample's matrix row that is missing; the row's length counts the sample itself."""
    n = kept.groupBy("genome").agg(F.count(F.lit(1)).alias("n"))
    deg = degrees(among(pairs, kept)).select("genome", "sample_id", F.col("degree").alias("d"))
    rows = kept.select("genome", "sample_id").join(deg, ["genome", "sample_id"], "left").join(F.broadcast(n), "genome")  # a row a genome
    return rows.select("genome", "sample_id", ((F.col("n") - 1 - F.coalesce("d", F.lit(0))).cast("double") / F.col("n").cast("double")).alias("null_fraction"))


def condensed(pairs: DataFrame, kept: DataFrame, impute_ani: float = 97.0) -> DataFrame:
    """The upper triangle of the similarity matrix: k = n i - i (i + 1) / 2 + j - i - 1, ani imputed where missing."""
    order = W.partitionBy("genome").orderBy("sample_id")
    idx = kept.select("genome", "sample_id", (F.row_number().over(order) - 1).cast("bigint").alias("i"), F.count(F.lit(1)).over(W.partitionBy("genome")).alias("n"))
    a = idx.select("genome", F.col("sample_id").alias("sample_1"), "i", "n")
    b = idx.select("genome", F.col("sample_id").alias("sample_2"), F.col("i").alias("j"))
    cells = a.join(b, "genome").filter("i < j")  # the matrix itself: n (n - 1) / 2 cells of one genome
    rows = cells.join(pairs.select("genome", "sample_1", "sample_2", "ani", "total_positions"), ["genome", "sample_1", "sample_2"], "left")
    k = F.expr("n * i - i * (i + 1) div 2 + j - i - 1")
    return rows.select("genome", k.alias("k"), "i", "j", F.coalesce(F.col("ani"), F.lit(float(impute_ani)).cast("float")).alias("ani"), F.coalesce("total_positions", F.lit(0)).alias("total_positions"))


def neighbours(pairs: DataFrame, k: int = 20) -> DataFrame:
    """Undirected union of every sample's k nearest, ties by name; ani is the largest seen."""
    both = pairs.select("genome", "ani", F.explode(F.array(F.struct(F.col("sample_1").alias("src"), F.col("sample_2").alias("dst")), F.struct(F.col("sample_2").alias("src"), F.col("sample_1").alias("dst")))).alias("e")).select("genome", "e.src", "e.dst", "ani")
    rank = F.row_number().over(W.partitionBy("genome", "src").orderBy(F.desc("ani"), "dst"))
    near = both.withColumn("rank", rank).filter(F.col("rank") <= k)
    return near.groupBy("genome", F.least("src", "dst").alias("sample_1"), F.greatest("src", "dst").alias("sample_2")).agg(F.max("ani").alias("ani"))


def sample_stats(stats: DataFrame, abundance: DataFrame, genome: str | None = None) -> DataFrame:
    """Statistics of each sample with the largest abundance under the genome's name or accession."""
    if genome is not None:
        stats = stats.filter(F.col("genome") == genome)
    named = abundance.select("sample_id", F.explode(F.array_distinct(F.array("genome", "accession"))).alias("genome"), "abundance").filter("genome is not null")
    top = named.groupBy("sample_id", "genome").agg(F.max("abundance").alias("abundance"))
    return stats.join(top, ["sample_id", "genome"], "left")


def distributions(pairs: DataFrame, stats: DataFrame) -> dict[str, DataFrame]:
    out = {
        "ani": fixed_histogram(pairs, "ani", 95.0, 100.0, 250),
        "ani_full": fixed_histogram(pairs, "ani", 0.0, 100.0, 200),
        "total_positions": auto_histogram(pairs, "total_positions", 100),
    }
    return out | {c: auto_histogram(stats, c, 100) for c in ("coverage", "breadth", "ber", "ref_ani", "abundance") if c in stats.columns}


def network_nodes(kept: DataFrame, stats: DataFrame, edges: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """A node for each kept sample: statistics, number of graph neighbours, clusters."""
    deg = degrees(edges).withColumnRenamed("degree", "neighbours")
    rows = kept.select("genome", "sample_id").join(stats, ["genome", "sample_id"], "left").join(deg, ["genome", "sample_id"], "left").withColumn("neighbours", F.coalesce("neighbours", F.lit(0)))
    return rows if clusters is None else rows.join(clusters, ["genome", "sample_id"], "left")


def in_leaf_order(clusters: DataFrame, stats: DataFrame) -> DataFrame:
    """leaf_rank and the statistics of each clustered sample (genome, sample_id, leaf_rank); one row a sample, or an error."""
    ranks = clusters.select("genome", "sample_id", "leaf_rank")
    own = stats.join(ranks.select("genome", "sample_id"), ["genome", "sample_id"], "left_semi")
    reject(own.groupBy("genome", "sample_id").count().filter("count > 1"), "samples with more than one row of statistics", "genome", "sample_id")
    return ranks.join(own, ["genome", "sample_id"], "left")


def signature(stats: DataFrame, options: dict) -> DataFrame:
    from .registry import checksum

    return checksum(stats).withColumns({k: F.lit(str(v)) for k, v in sorted(options.items())})


def search_catalog(genomes: DataFrame, text: str = "", by: str = "samples") -> DataFrame:
    """Catalog rows (genome, samples) whose name holds the text, the largest first or by name."""
    rows = genomes.filter(F.contains(F.lower("genome"), F.lit(text.lower())))
    return rows.orderBy(F.desc("samples"), "genome") if by == "samples" else rows.orderBy("genome")


def search_samples(stats: DataFrame, text: str = "", rows: int = 5000) -> DataFrame:
    """The first rows of the sample table whose name holds the text."""
    return stats.filter(F.contains(F.lower("sample_id"), F.lit(text.lower()))).orderBy("sample_id", "genome").limit(rows)
