"""The query API: a project, and its slices by genome or by sample, as lazy DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.names import required
from .sources import sinks
from .sources.store import Store


class ModeError(RuntimeError):
    """The project stores masks, so it has no counts to query."""


@dataclass(frozen=True)
class Query:
    """A DataFrame not yet run; filters added to lazy() still reach the scan."""

    frame: DataFrame

    def collect(self) -> list:
        return self.frame.collect()

    def lazy(self) -> DataFrame:
        return self.frame

    def sink_parquet(self, path: str, *, overwrite: bool = False) -> None:
        sinks.to_parquet(self.frame, path, overwrite=overwrite)


def _ordered(df: DataFrame, *columns: str) -> Query:
    return Query(df.orderBy(*[F.asc_nulls_last(c) for c in columns]))


class Database:
    def __init__(self, store: Store):
        self.store = store

    def genome(self, genome: str) -> GenomeView:
        return GenomeView(self, required(genome, "genome"))

    def sample(self, sample_id: str) -> SampleView:
        return SampleView(self, required(sample_id, "sample"))

    def genomes(self, pattern: str | None = None) -> Query:
        """Names of all genomes that any sample has statistics of, in order; with a pattern, those it is found in."""
        df = self.store.table("genome_stats").select("genome").filter("genome is not null").distinct()
        if pattern is not None:
            df = df.filter(F.col("genome").rlike(required(pattern, "pattern")))
        return _ordered(df, "genome")

    def samples(self, pattern: str | None = None, *, complete_only: bool = True) -> Query:
        df = self.store.table("samples")
        if complete_only:
            df = df.filter(F.col("status") == "complete")
        if pattern is not None:
            df = df.filter(F.col("sample_id").rlike(required(pattern, "pattern")))
        return _ordered(df, "sample_id")

    def _positions(self) -> DataFrame:
        if self.store.contract()["mode"] != "full":
            raise ModeError("this project stores allele masks; counts are not available")
        return self.store.table("profile_positions")


class _View:
    key: str

    def __init__(self, database: Database, value: str):
        self.database, self.value = database, value

    def _own(self, table: str, **equal: str | None) -> DataFrame:
        store = self.database.store
        df = (store.of_sample(table, self.value) if self.key == "sample_id" else store.table(table)).filter(F.col(self.key) == self.value)
        for column, v in equal.items():
            if v is not None:
                df = df.filter(F.col(column) == required(v, column))
        return df


class GenomeView(_View):
    key = "genome"

    def genome_stats(self) -> Query:
        return _ordered(self._own("genome_stats"), "sample_id")

    def gene_stats(self, gene: str | None = None) -> Query:
        return _ordered(self._own("gene_stats", gene=gene), "sample_id", "gene")

    def profiles(self, gene: str | None = None) -> Query:
        self.database._positions()
        return Query(self._own("profile_positions", gene=gene))

    def sylph_abundance(self) -> Query:
        """Rows named by the genome or by its accession."""
        df = self.database.store.table("sylph_abundance")
        return _ordered(df.filter((F.col("genome") == self.value) | (F.col("accession") == self.value)), "sample_id")


class SampleView(_View):
    key = "sample_id"

    def genome_stats(self, genome: str | None = None) -> Query:
        return _ordered(self._own("genome_stats", genome=genome), "genome")

    def gene_stats(self, genome: str | None = None, gene: str | None = None) -> Query:
        return _ordered(self._own("gene_stats", genome=genome, gene=gene), "genome", "gene")

    def profile(self, genome: str | None = None, gene: str | None = None) -> Query:
        self.database._positions()
        return Query(self._own("profile_positions", genome=genome, gene=gene))

    def sylph_abundance(self, genome: str | None = None) -> Query:
        df = self._own("sylph_abundance")
        if genome is not None:
            required(genome, "genome")
            df = df.filter((F.col("genome") == genome) | (F.col("accession") == genome))
        return _ordered(df, "genome", "accession")


def open_database(spark: SparkSession, root: str) -> Database:
    store = Store(spark, root)
    if not store.exists():
        raise FileNotFoundError(f"no project at {root}")
    return Database(store)
