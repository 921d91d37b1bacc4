"""Incremental work: what is wanted minus what is there, as one set-based job a step."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import compare, eligibility, matrix, registry, views
from ..sources import discovery, sinks
from ..sources.config import ViewOptions
from ..sources.store import Files, Store


def profiles(store: Store, folder: str) -> DataFrame:
    """Imports the bundles of all remaining runs; a run that fails is marked and tried again next time."""
    out = []
    for run in sorted(r.run_id for r in store.remaining().select("run_id").collect()):
        try:
            b = discovery.bundle(store.spark, folder, run)
            store.import_bundle(run, b["profile"], b["genome_stats"], b["sylph"], b["gene_stats"])
            out.append((run, "imported", None))
        except Exception as e:  # reported with its run
            store.mark(run, "failed", str(e)[:500])
            out.append((run, "failed", str(e)[:500]))
    return store.spark.createDataFrame(out, "run_id string, outcome string, error string")


def matrices(cells: DataFrame, wanted: DataFrame, stored: DataFrame, root: str) -> tuple[DataFrame, str]:
    """Writes the cells (genome, sample_id, axis_pos, mask) of missing samples of all genomes to a new folder below root.

    Returns the outcome of each genome and the folder, which counts once the caller commits it: a build that fails before
    leaves a folder that nobody reads.
    """
    new = eligibility.unmaterialized(wanted, stored)
    folder = f"{root}/build={uuid.uuid4().hex}"
    rows = cells.join(new, ["genome", "sample_id"], "left_semi")
    rows.repartition("genome", F.expr("axis_pos div 65536")).sortWithinPartitions("genome", "axis_pos", "sample_id").write.partitionBy("genome").parquet(folder)
    n = lambda df, key, name: df.groupBy(F.col(key).alias("genome")).agg(F.count(F.lit(1)).alias(name))
    table = n(wanted, "genome", "eligible").join(n(new, "genome", "added"), "genome", "full_outer").join(n(stored, "matrix_id", "before"), "genome", "full_outer").fillna(0)
    outcome = F.when(F.col("eligible") == 0, "skipped").when(F.col("added") == 0, "up_to_date").when(F.col("before") == 0, "built").otherwise("appended")
    return table.withColumn("outcome", outcome), folder


def build(store: Store, axis: DataFrame, root: str, *, min_cov: int = matrix.MIN_COV, storage: str = "bitmask", genome: str | None = None, **least: float | None) -> DataFrame:
    """Brings the matrices below root up to the samples that qualify, and commits cells, samples and stores in one step.

    A genome that has a matrix keeps the thresholds it was built with; `least` (min_coverage, min_breadth, min_ber,
    min_abundance) holds for new ones. Projects of masks are decoded, under the threshold they were stored with. All matrices
    of a project are of one kind: masks, or counts (`storage`), which masks cannot give.
    """
    state, contract = store.state(), store.contract()
    t = store.table
    stores, held = t("matrix_stores"), t("matrix_store_samples")
    storage = matrix.storage_mode(storage, None)
    if not stores.filter(F.col("storage_layout") != storage).isEmpty():
        raise ValueError(f"the project's matrices are not of kind {storage}")
    rows = eligibility.eligible(t("samples"), t("genome_stats"), t("sylph_abundance"), genome=genome, **least)
    again = eligibility.by_stores(t("samples"), t("genome_stats"), t("sylph_abundance"), stores)
    if genome is not None:
        again = again.filter(F.col("genome") == genome)
    wanted = rows.join(stores.select(F.col("matrix_id").alias("genome")), "genome", "left_anti").unionByName(again)
    if contract["mode"] == "allele_mask":
        if min_cov != contract["min_cov"]:
            raise ValueError(f"masks were stored at a coverage of {contract['min_cov']}, not {min_cov}")
        if storage != "bitmask":
            raise ValueError("a project of masks has no counts for its matrices")
        cells = matrix.from_masks(store.masks(), axis)
    else:
        cells = (matrix.bitmask if storage == "bitmask" else matrix.counts)(t("profile_positions"), axis, min_cov)
    outcome, folder = matrices(cells, wanted, held, root)
    now = time.time()
    added = eligibility.unmaterialized(wanted, held).select(F.col("genome").alias("matrix_id"), "sample_id", F.lit(now).alias("added_at"))
    members = held.unionByName(added)
    made = members.select("matrix_id").distinct().join(stores.select("matrix_id"), "matrix_id", "left_anti")
    values = {"genome": F.col("matrix_id"), "matrix_file": F.lit(root), "profile_count": F.lit(0).cast("bigint"), "storage_layout": F.lit(storage), "created_at": F.lit(now)}
    values |= {c: F.lit(least.get(o)).cast("double") for c, o in (("min_coverage", "min_coverage"), ("min_breadth", "min_breadth"), ("min_ber", "min_ber"), ("min_sylph_abundance", "min_abundance"))}
    fresh = made.withColumns(values | {"updated_at": F.lit(now)}).select(*stores.columns)
    rows = outcome.collect()  # a row a genome

    def edit(state: dict) -> None:
        state.setdefault("matrices", {}).setdefault(root, []).append(folder)

    if any(r.added for r in rows):
        store.replace({"matrix_store_samples": members, "matrix_stores": registry.store_counts(stores.unionByName(fresh), members)}, edit, state=state)
    else:
        store.files.delete(folder)
    return store.spark.createDataFrame(rows, outcome.schema)


def comparisons(rows: DataFrame, path: str, method: str = "popani") -> None:
    """Appends the pairs of rows from compare.alleles() that are not there yet; the first time, all."""
    spark, keys = rows.sparkSession, "genome string, sample_1 string, sample_2 string"
    # a first run may have found no pair and left an empty folder
    completed = spark.read.schema(keys).parquet(path) if Files(spark).exists(path) else spark.createDataFrame([], keys)
    out = compare.missing_pairs(rows, completed, method)
    out.repartition("genome", F.pmod(F.xxhash64("sample_1", "sample_2"), F.lit(64))).write.mode("append").partitionBy("genome").parquet(path)


def genome_views(store: Store, results: DataFrame, catalog: DataFrame, stats: DataFrame, abundance: DataFrame, root: str, options: ViewOptions) -> DataFrame:
    """Builds the bundle of each complete genome whose signature changed."""
    spark, out = store.spark, []
    state = views.completeness(catalog, results)
    for row in state.orderBy("genome").collect():  # a row a genome
        if not row.complete:
            out.append((row.genome, "skipped"))
            continue
        own, own_stats = results.filter(F.col("genome") == row.genome), views.sample_stats(stats, abundance, row.genome)
        signature = {"samples": row.samples, "pairs": row.completed, "options": vars(options)} | views.signature(own_stats, {}).first().asDict()
        path = f"{root}/genome={row.genome}"
        if sinks.up_to_date(spark, path, signature):
            out.append((row.genome, "up_to_date"))
            continue
        with shared(own, options) as (pairs, kept, condensed, clusters):
            found = clusters.agg(F.count_distinct("strain_cluster").alias("strain_clusters"), F.count_distinct("clonal_cluster").alias("clonal_clusters")).first().asDict()
            sinks.bundle(spark, path, row.genome, view_parts(pairs, kept, condensed, clusters, own_stats, options), {"signature": signature} | found)
        sinks.view_files(spark, path, row.genome)
        out.append((row.genome, "built"))
    sinks.catalog(spark, root)
    return spark.createDataFrame(out, "genome string, outcome string")


@contextmanager
def shared(results: DataFrame, options: ViewOptions) -> Iterator[tuple[DataFrame, ...]]:
    """The frames that several tables of a view are made from, held on executor disks while it is written: qualifying pairs,
    kept samples, the condensed matrix, clusters by sample. A lost executor's part is computed again."""
    from ..operators import cluster

    pairs = views.qualifying(results, options.min_comp_len).persist(StorageLevel.DISK_ONLY)
    kept = views.retained(pairs, max_null_fraction=options.max_null_fraction, max_null_samples=options.max_null_samples).persist(StorageLevel.DISK_ONLY)
    condensed = views.condensed(views.among(pairs, kept), kept, options.impute_ani).persist(StorageLevel.DISK_ONLY)
    by_place = cluster.assignments(condensed, options.linkage_method, options.clonal_cluster_threshold, options.strain_cluster_threshold)
    clusters = by_place.join(views.indexed(kept), ["genome", "i"]).persist(StorageLevel.DISK_ONLY)
    held = (pairs, kept, condensed, clusters)
    try:
        yield held
    finally:
        for df in held:
            df.unpersist()


def view_parts(pairs: DataFrame, kept: DataFrame, condensed: DataFrame, clusters: DataFrame, stats: DataFrame, options: ViewOptions) -> dict[str, DataFrame]:
    """All tables of one genome's view."""
    from ..operators import cluster

    inner = views.among(pairs, kept)
    edges = views.neighbours(inner, options.neighbor_k)
    parts = {
        "pairs": inner,
        "condensed": condensed,
        "null_fraction": views.null_fraction(pairs, kept),
        "merges": cluster.merge_rows(condensed, options.linkage_method),
        "clusters": clusters,
        "sample_stats": views.in_leaf_order(clusters, stats),
        "edges": edges,
        "nodes": views.network_nodes(kept, stats, edges, clusters.select("genome", "sample_id", "strain_cluster", "clonal_cluster")),
    }
    return parts | {f"histogram_{k}": df for k, df in views.distributions(inner, stats).items()}


def read_profile_stream(spark, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def positions_stream(stream: DataFrame, store_path: str, checkpoint: str):
    """Appends new position files exactly once, each micro-batch without repeated positions."""

    def write(batch: DataFrame, _: int) -> None:
        batch.dropDuplicates(["sample_id", "chrom", "pos"]).write.mode("append").partitionBy("genome").parquet(store_path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(stream: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by window and type under a watermark; runs on streams and tables alike."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


__all__ = ["build", "comparisons", "event_counts", "genome_views", "matrices", "positions_stream", "profiles", "read_profile_stream", "shared", "view_parts"]
