"""Commands over a project folder: `python -m strandloom.cli PROJECT COMMAND …`."""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import compare, contract, matrix, registry
from .sources import config, ingest, reference, sinks
from .sources.store import Store
from .streaming import sync


def _show(df: DataFrame) -> None:
    for row in df.toLocalIterator():
        print(json.dumps(sinks.plain(row.asDict()), default=str))


def _axis(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return contract.axis(ingest.bed(spark, a.bed), ingest.stb(spark, a.stb))


def _sync_build(store: Store, a: argparse.Namespace) -> None:
    min_cov = a.min_cov if a.min_cov is not None else store.state()["contract"]["min_cov"] or matrix.MIN_COV
    _show(sync.build(store, _axis(store.spark, a), a.matrices, min_cov=min_cov, storage=a.storage_mode, genome=a.genome, min_coverage=a.min_coverage, min_breadth=a.min_breadth, min_ber=a.min_ber, min_abundance=a.min_sylph_abundance))


def _compare(store: Store, a: argparse.Namespace) -> None:
    """Pairs go to the folder given; where more is calculated, each table goes to a folder of its name below it."""
    rows = store.matrix_cells(a.matrices)
    rows = rows if a.genome is None else rows.filter(F.col("genome") == a.genome)
    genes = contract.gene_axis(ingest.gene_ranges(store.spark, a.gene_ranges), _axis(store.spark, a)) if a.gene_ranges else None
    made = compare.matrix_results(rows, a.calculate, a.method, genes)
    for name, df in made.items():
        sinks.to_parquet(df, a.out if list(made) == ["ani"] else f"{a.out}/{name}", overwrite=a.overwrite)
    now = time.time()
    done = rows.select("genome").distinct().select(F.concat_ws("@", "genome", F.lit(a.out)).alias("compare_id"), F.col("genome").alias("matrix_id"), F.lit(a.out).alias("compare_db_file"), F.lit(a.calculate).alias("calculate"), F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"))
    store.replace({"matrix_compares": registry.upsert(store.table("matrix_compares"), done, ["compare_id"])})


def _sync_compare(store: Store, a: argparse.Namespace) -> None:
    if store.contract()["mode"] == "allele_mask":
        if a.method != "popani":
            raise ValueError("masks hold no counts: only popani can be compared")
        rows = store.masks().withColumnRenamed("mask", "allele")
    else:
        rows = compare.alleles(store.table("profile_positions"), a.method)
    sync.comparisons(rows, a.completed, a.method)


def _references(store: Store, a: argparse.Namespace) -> None:
    from .operators import codec

    made = reference.derive(store.spark, dict(x.split("=", 1) for x in a.genome_fasta))
    store.set_references(codec.reference_segments(made["fasta"].drop("genome"), made["stb"]))


def _views(store: Store, a: argparse.Namespace) -> None:
    c = config.over(config.load(a.config), min_comp_len=a.min_comp_len, impute_ani=a.impute_ani, max_null_fraction=a.max_null_fraction, max_null_samples=a.max_null_samples, linkage_method=a.linkage_method, neighbor_k=a.neighbor_k)
    catalog = store.table("matrix_store_samples").select(F.col("matrix_id").alias("genome"), "sample_id")
    _show(sync.genome_views(store, store.spark.read.parquet(a.results), catalog, store.table("genome_stats"), store.table("sylph_abundance"), a.out, c.view))


def _derive(store: Store, a: argparse.Namespace) -> None:
    made = reference.derive(store.spark, dict(x.split("=", 1) for x in a.genome_fasta), dict(x.split("=", 1) for x in a.gene_fasta))
    sinks.to_bed(made["bed"], f"{a.out}/bed")
    sinks.to_stb(made["stb"], f"{a.out}/stb")
    made["gene_ranges"].write.csv(f"{a.out}/gene_ranges", sep="\t")


def _migrate(store: Store, a: argparse.Namespace) -> None:
    from .operators import codec

    made = reference.derive(store.spark, dict(x.split("=", 1) for x in a.genome_fasta))
    print(json.dumps(store.migrate(Store(store.spark, a.target), codec.reference_segments(made["fasta"].drop("genome"), made["stb"]), a.min_cov)))


def _status(store: Store, _: argparse.Namespace) -> None:
    t = store.table
    _show(registry.status(t("sra_runs"), t("samples"), t("profile_positions"), t("mask_blocks"), t("matrix_stores"), t("matrix_compares"), store.state()["contract"]))


def _manifest(store: Store, a: argparse.Namespace) -> None:
    used: dict[str, None] = {}
    for r in ingest.manifest(store.spark, a.manifest).collect():
        store.import_bundle(r.run_id, r.profile_file, r.genome_stats_file, r.sylph_abundance_file, r.gene_stats_file)
        used |= dict.fromkeys(p for p in (r.profile_file, r.genome_stats_file, r.sylph_abundance_file, r.gene_stats_file) if p)
    if a.delete_files:  # bundles may share files: only once all are in, each once
        for path in used:
            store.files.delete(path)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strandloom")
    p.add_argument("project")
    commands = p.add_subparsers(dest="command", required=True)

    def add(name: str, run, *arguments: tuple, thresholds: bool = False) -> None:
        c = commands.add_parser(name)
        c.set_defaults(run=run)
        for flags, options in arguments:
            c.add_argument(*([flags] if isinstance(flags, str) else flags), **options)
        if thresholds:
            c.add_argument("--genome")
            for t in ("--min-coverage", "--min-breadth", "--min-ber", "--min-sylph-abundance"):
                c.add_argument(t, type=float)

    ids = ("run_ids", {"nargs": "+"})
    axis = (("--bed", {"required": True}), ("--stb", {"required": True}))
    add("init", lambda s, a: s.set_contract(a.mode, a.min_cov), ("--mode", {"default": "full", "choices": ["full", "allele_mask"]}), ("--min-cov", {"type": int}))
    add("runs-add", lambda s, a: print(json.dumps(s.add_runs(a.run_ids))), ids)
    add("runs-delete", lambda s, a: print(s.delete_runs(a.run_ids)), ids)
    add("runs-list", lambda s, a: _show(registry.active(s.table("sra_runs")).orderBy("run_id")))
    add("profiles-remaining", lambda s, a: sinks.run_list(s.remaining(), a.out) if a.out else _show(s.remaining().select("run_id").orderBy("run_id")), ("--out", {}))
    add("profiles-import", _manifest, ("manifest", {}), ("--delete-files", {"action": "store_true"}))
    add("profiles-add", lambda s, a: s.import_bundle(a.run_id, a.profile, a.genome_stats, a.sylph, a.gene_stats), ("run_id", {}), ("--profile", {"required": True}), ("--genome-stats", {"required": True}), ("--sylph", {"required": True}), ("--gene-stats", {}))
    add("profiles-list", lambda s, a: _show(s.table("profiles").orderBy("run_id")))
    add("profiles-sync", lambda s, a: _show(sync.profiles(s, a.folder)), ("folder", {}))
    add("profiles-export", lambda s, a: sinks.per_sample(s.table("profile_positions"), a.out), ("out", {}))
    add("compact-database", _migrate, ("target", {}), ("--genome-fasta", {"nargs": "+", "required": True}), ("--min-cov", {"type": int, "default": 5}))
    add("cache-build-matrix-files", _derive, ("out", {}), ("--genome-fasta", {"nargs": "+", "required": True}), ("--gene-fasta", {"nargs": "*", "default": []}))
    add("matrix-sync-build", _sync_build, ("matrices", {}), *axis, ("--min-cov", {"type": int}), ("--storage-mode", {"default": "bitmask", "choices": ["bitmask", "counts"]}), thresholds=True)
    add("matrix-compare", _compare, ("matrices", {}), ("out", {}), ("--genome", {}), ("--overwrite", {"action": "store_true"}), ("--calculate", {"default": "ani"}), ("--method", {"default": "popani"}), ("--bed", {}), ("--stb", {}), ("--gene-ranges", {}))
    add("matrix-sync-compare", _sync_compare, ("completed", {}), ("--method", {"default": "popani"}))
    add("references-set", _references, ("--genome-fasta", {"nargs": "+", "required": True}))
    numbers = [(f"--{n}", {"type": t}) for n, t in (("min-comp-len", int), ("impute-ani", float), ("max-null-fraction", float), ("max-null-samples", int), ("linkage-method", str), ("neighbor-k", int))]
    add("sync-genome-views", _views, ("results", {}), ("out", {}), ("--config", {}), *numbers)
    add("status", _status)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    a.run(Store(spark, a.project), a)


if __name__ == "__main__":
    main()
