"""Which files of a run, and which stored genomes, are there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from .store import Files

# File names of a run's bundle and accession list, in order of preference.
BUNDLE = {
    "profile": ("{run}.profile.parquet", "{run}.parquet"),
    "genome_stats": ("{run}.genome_stats.parquet", "{run}_genome_stats.parquet"),
    "sylph": ("{run}.sylph.parquet", "{run}.sylph.csv", "{run}.sylph.tsv", "{run}_sylph.parquet", "{run}_sylph.csv", "{run}_sylph.tsv"),
    "gene_stats": ("{run}.gene_stats.parquet", "{run}_gene_stats.parquet"),
}
ACCESSIONS = ("{run}.accessions.txt", "{run}.accessions.csv", "{run}.txt", "{run}.csv", "{run}/accessions.txt", "{run}/accessions.csv")


def bundle(spark: SparkSession, folder: str, run: str) -> dict[str, str | None]:
    """The first file there is of each kind; gene statistics may be missing."""
    files, found = Files(spark), {}
    for kind, names in BUNDLE.items():
        tried = [f"{folder}/{n.format(run=run)}" for n in names]
        found[kind] = next((p for p in tried if files.exists(p)), None)
        if found[kind] is None and kind != "gene_stats":
            raise FileNotFoundError(f"run {run} has no {kind}; looked for {', '.join(tried)}")
    return found


def stored_genomes(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> list[str]:
    """Genomes with a partition in a folder; asking for one that is missing is an error."""
    held = sorted(n.removeprefix("genome=") for n in Files(spark).list(folder) if n.startswith("genome="))
    missing = sorted(set(only or ()) - set(held))
    if missing:
        raise FileNotFoundError(f"no stored genome {', '.join(missing)}")
    return [g for g in held if only is None or g in set(only)]


def accession_file(spark: SparkSession, folder: str, run: str) -> str | None:
    files = Files(spark)
    return next((p for n in ACCESSIONS if files.exists(p := f"{folder}/{n.format(run=run)}")), None)
