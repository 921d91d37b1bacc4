"""Queries that go through files and projects: what is written is read back by the engine's own readers.

One run, R1, holds the positions of all samples. Its bundle (Parquet, TSV and CSV under other column names) is imported into a
project of full profiles, which is compacted into a project of masks; each is made once a session and folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..api import Database, Query
from ..operators import compare, contract, eligibility, matrix, registry, views
from ..sources import ingest, reference, sinks
from ..sources.store import Store
from ..streaming import sync
from .adapters import scratch, view, with_views
from .catalog import _REMAINING, AXIS, COVERED, MASK, ORACLES, QUERIES, Views, _segments, query

_PROJECTS: dict[tuple[str, str, str], Store] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, make: Callable[[], Store]) -> Store:
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _PROJECTS:
        _PROJECTS[key] = make()
    return _PROJECTS[key]


def _full(spark: SparkSession, sf_dir: str) -> Store:
    def make() -> Store:
        v = lambda table: view(spark, sf_dir, table)
        at, store = scratch(spark, "bundle"), Store(spark, scratch(spark, "project"))
        v("pooled").withColumns({c: F.col(c).cast("double") for c in "ACGT"}).write.parquet(f"{at}/profile.parquet")
        stats = {"genome": "reference", "coverage": "mean_coverage", "breadth": "breadth_cov", "ber": "BER", "genome_length": "length"}
        v("pooled_stats").withColumnsRenamed(stats).write.csv(f"{at}/stats.tsv", sep="\t", header=True)
        v("pooled_genes").withColumnsRenamed({"gene": "gene_id", "coverage": "cov", "length": "gene_length"}).write.parquet(f"{at}/genes.parquet")
        v("pooled_abundance").withColumnsRenamed({"genome_file": "Genome_file", "abundance": "Taxonomic_abundance"}).write.csv(f"{at}/sylph.csv", header=True)
        files = [f"{at}/{n}" for n in ("profile.parquet", "stats.tsv", "sylph.csv", "genes.parquet")]
        listed = spark.createDataFrame([("R1", *files)], "run_id string, profile_file string, genome_stats_file string, sylph_abundance_file string, gene_stats_file string")
        listed.write.csv(f"{at}/manifest", header=True)
        store.set_contract("full")
        store.add_runs(["R1", " R2 ", "R1", "", "R3"])
        store.delete_runs(["R3"])
        for r in ingest.manifest(spark, f"{at}/manifest").collect():  # one row
            store.import_bundle(r.run_id, r.profile_file, r.genome_stats_file, r.sylph_abundance_file, r.gene_stats_file)
        return store

    return _once("full", spark, sf_dir, make)


def _masks(spark: SparkSession, sf_dir: str) -> Store:
    def make() -> Store:
        target = Store(spark, scratch(spark, "masks"))
        _full(spark, sf_dir).migrate(target, _segments(lambda table: view(spark, sf_dir, table)))
        return target

    return _once("masks", spark, sf_dir, make)


def project_query(name: str, sql: str, store: Callable[[SparkSession, str], Store] = _full) -> Callable:
    """Registers fn(store, v) over the project of the driver's tables."""

    def register(fn: Callable[[Store, Views], DataFrame]) -> Callable[[Store, Views], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(store(spark, sf_dir), lambda table: view(spark, sf_dir, table))
        ORACLES[name] = with_views(sql)
        return fn

    return register


# Projects -----------------------------------------------------------------------------------------------------------

_POOLED = "'R1' AS sample_id, chrom, pos, genome, gene, A, C, G, T"


@project_query("project_positions", f"SELECT {_POOLED} FROM {{pooled}}")
def _(s, v):
    return s.table("profile_positions").drop("ref_base_bitmask")


@project_query("project_genome_profiles", f"SELECT {_POOLED} FROM {{pooled}} WHERE genome = 'G1' AND gene = 'G1_c0_1'")
def _(s, v):
    return Database(s).genome("G1").profiles("G1_c0_1").lazy().drop("ref_base_bitmask")


@project_query("project_genome_stats", "SELECT 'R1' AS sample_id, genome, coverage, breadth, ber, CAST(NULL AS DOUBLE) AS ref_ani, genome_length, CAST(NULL AS BIGINT) AS \"5x_cov_sites\", CAST(NULL AS VARCHAR) AS presence FROM {pooled_stats}")
def _(s, v):
    return Database(s).sample("R1").genome_stats().lazy().select("sample_id", "genome", "coverage", "breadth", "ber", "ref_ani", "genome_length", "5x_cov_sites", "presence")


@project_query("project_gene_stats", "SELECT 'R1' AS sample_id, genome, gene, coverage, breadth, CAST(NULL AS DOUBLE) AS ber, length FROM {pooled_genes}")
def _(s, v):
    return Database(s).sample("R1").gene_stats().lazy().drop("ref_ani")


@project_query("project_abundance", "SELECT 'R1' AS sample_id, substr(genome_file, 8, 12) AS genome, substr(genome_file, 8, 12) AS accession, abundance FROM {pooled_abundance}")
def _(s, v):
    return Database(s).sample("R1").sylph_abundance().lazy()


@project_query("project_genomes", "SELECT DISTINCT genome FROM {pooled_stats} WHERE regexp_matches(genome, '[024]')")
def _(s, v):
    return Database(s).genomes("[024]").lazy()


@project_query("project_runs", "SELECT * FROM (VALUES ('R1', 'complete', false, 'full'), ('R2', 'added', false, NULL), ('R3', 'deleted', true, NULL)) t(run_id, status, deleted, profile_storage_mode)")
def _(s, v):
    modes = s.table("profiles").select("run_id", "profile_storage_mode")
    return s.table("sra_runs").select("run_id", "status", F.col("deleted_at").isNotNull().alias("deleted")).join(modes, "run_id", "left")


_BLOCKS = f"blocks AS (SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(c) AS BIGINT) AS total FROM (SELECT chrom, COUNT(*) AS c FROM {{pooled}} WHERE {COVERED} GROUP BY 1) b)"


@project_query("project_status", f"WITH {_BLOCKS} SELECT CAST(2 AS BIGINT) AS active_runs, CAST(1 AS BIGINT) AS deleted_runs, CAST(1 AS BIGINT) AS complete_samples, CAST(0 AS BIGINT) AS profile_rows, n AS allele_mask_blocks, total AS allele_mask_positions, CAST(1 AS BIGINT) AS remaining_profiles, 'allele_mask' AS profile_storage, '5' AS profile_min_cov FROM blocks", _masks)
def _(s, v):
    t = s.table
    return registry.status(t("sra_runs"), t("samples"), t("profile_positions"), t("mask_blocks"), t("matrix_stores"), t("matrix_compares"), s.contract()).drop("matrix_stores", "matrix_compares")


@project_query("project_compacted_masks", f"SELECT 'R1' AS sample_id, genome, chrom, pos, {MASK} AS mask FROM {{pooled}} WHERE {COVERED}", _masks)
def _(s, v):
    return s.masks()


_CELLS = f"WITH {AXIS} SELECT a.genome, 'R1' AS sample_id, p.pos - a.index_base + a.axis_start AS axis_pos, {MASK} AS mask FROM {{pooled}} p JOIN axis a ON a.genome = p.genome AND a.chrom = p.chrom WHERE {COVERED}"


def _built(s: Store, v: Views) -> DataFrame:
    root = f"{s.root}/matrices"
    axis = contract.axis(v("bed"), v("stb"))
    sync.build(s, axis, root)
    sync.build(s, axis, root)  # nothing is left to add
    return s.matrix_cells(root).select("genome", "sample_id", "axis_pos", "mask")


@project_query("project_matrix_build", _CELLS)
def _(s, v):
    return _built(s, v)


@project_query("project_matrix_from_masks", _CELLS, _masks)
def _(s, v):
    return _built(s, v)


@project_query("project_matrix_stores", "SELECT genome AS matrix_id, CAST(1 AS BIGINT) AS profile_count, 'bitmask' AS storage_layout FROM {pooled_stats}")
def _(s, v):
    _built(s, v)
    return s.table("matrix_stores").select("matrix_id", "profile_count", "storage_layout")


# Files --------------------------------------------------------------------------------------------------------------


def _lengths(v: Views) -> DataFrame:
    return v("bed").groupBy(F.col("chrom").alias("scaffold")).agg(F.max("end_pos").alias("length"))


_LENGTHS = "(SELECT chrom AS scaffold, MAX(end_pos) AS length FROM {bed} GROUP BY 1)"


def _tiles(step: int) -> str:
    return f"SELECT scaffold AS chrom, start_pos, least(start_pos + {step}, length) AS end_pos FROM (SELECT scaffold, length, unnest(range(0, length, {step})) AS start_pos FROM {_LENGTHS} x) y"


@query("file_bed", _tiles(100))
def _(v):
    at = scratch(v("region").sparkSession, "bed")
    sinks.to_bed(contract.tiles(_lengths(v), 100).select("scaffold", "start_pos", "end_pos"), at)
    return ingest.bed(v("region").sparkSession, at)


@query("file_stb", "SELECT DISTINCT scaffold, genome FROM {stb}")
def _(v):
    at = scratch(v("region").sparkSession, "stb")
    rows = v("stb")
    sinks.to_stb(rows.unionByName(rows), at)  # a line may stand twice
    return ingest.stb(v("region").sparkSession, at)


@query("file_run_list", f"SELECT run_id FROM ({_REMAINING}) r")
def _(v):
    at = scratch(v("region").sparkSession, "runs")
    sinks.run_list(registry.remaining(v("sra_runs"), v("samples")), at)
    return ingest.run_list(v("region").sparkSession, at)


@query("file_accessions", "SELECT DISTINCT substr(genome_file, 8, 12) AS accession FROM {sylph_raw} WHERE abundance > 0")
def _(v):
    spark, at = v("region").sparkSession, scratch(v("region").sparkSession, "accessions")
    found = ingest.accession_list(v("sylph_raw"))
    found.select(F.concat(F.lit("  "), "accession", F.lit("\tgenome")).alias("value")).write.text(f"{at}/list.txt")
    found.write.csv(f"{at}/list.csv", header=True)
    return ingest.accessions(spark, f"{at}/list.txt").join(ingest.accessions(spark, f"{at}/list.csv"), "accession")


@query("file_abundance_table", "SELECT genome_file, abundance FROM {pooled_abundance}")
def _(v):
    at = f"{scratch(v('region').sparkSession, 'abundance')}.txt"
    v("pooled_abundance").write.csv(at, sep="\t", header=True)
    return ingest.table(v("region").sparkSession, at, ingest.ABUNDANCE_SUFFIXES)


@query("export_per_sample", "SELECT sample_id, chrom, pos, genome, gene, A, C, G, T FROM {profile_positions}")
def _(v):
    at = scratch(v("region").sparkSession, "samples")
    sinks.per_sample(v("profile_positions"), at)
    return v("region").sparkSession.read.parquet(at)


@query("export_lazy_query", "SELECT sample_id, genome, coverage FROM {genome_stats} WHERE coverage > 5")
def _(v):
    at = scratch(v("region").sparkSession, "export")
    Query(v("genome_stats").select("sample_id", "genome", "coverage").filter("coverage > 5")).sink_parquet(at)
    return v("region").sparkSession.read.parquet(at)


@query("json_rows", "SELECT CAST(to_json({'sample_id': sample_id, 'genome': genome, 'genome_length': genome_length, 'missing': CAST(NULL AS DOUBLE)}) AS VARCHAR) AS value FROM {genome_stats}")
def _(v):
    missing = F.when(F.col("ber").isNull(), F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    return sinks.json_rows(v("genome_stats").select("sample_id", "genome", "genome_length", missing.alias("missing")))


def _fasta(v: Views) -> tuple[dict[str, str], dict[str, str]]:
    """Paths by genome: sequences of two lines a scaffold, and genes whose headers carry their range."""
    spark = v("region").sparkSession
    at = scratch(spark, "fasta")
    half = "cast(length div 2 as int)"
    scaffolds = _lengths(v).join(v("stb"), "scaffold").select("genome", F.concat(F.lit(">"), "scaffold", F.lit(" made\n"), F.expr(f"repeat('A', {half})"), F.lit("\r\n"), F.expr(f"repeat('c', cast(length as int) - {half})")).alias("value"))
    scaffolds.write.partitionBy("genome").text(f"{at}/genomes")
    genes = v("gene_ranges").join(v("stb"), "scaffold").select("genome", F.concat(F.lit(">"), "gene", F.lit(" # "), "start_pos", F.lit(" # "), "end_pos", F.lit(" # 1 # ID=1\nATG")).alias("value"))
    genes.write.partitionBy("genome").text(f"{at}/genes")
    names = sorted(r.genome for r in v("stb").select("genome").distinct().collect())  # a row a genome
    return {g: f"{at}/genomes/genome={g}" for g in names}, {g: f"{at}/genes/genome={g}" for g in names}


def _derived(v: Views) -> dict[str, DataFrame]:
    return reference.derive(v("region").sparkSession, *_fasta(v), step=100)


@query("fasta_bed", _tiles(100))
def _(v):
    return _derived(v)["bed"]


@query("fasta_stb", "SELECT DISTINCT scaffold, genome FROM {stb}")
def _(v):
    return _derived(v)["stb"]


@query("fasta_gene_ranges", "SELECT gene, scaffold, start_pos, end_pos FROM {gene_ranges}")
def _(v):
    return _derived(v)["gene_ranges"]


@query("fasta_sequences", f"SELECT s.genome, l.scaffold AS chrom, CAST(l.length AS BIGINT) AS n, CAST(l.length // 2 AS BIGINT) AS n_a FROM {_LENGTHS} l JOIN {{stb}} s ON s.scaffold = l.scaffold")
def _(v):
    return _derived(v)["fasta"].select("genome", "chrom", F.char_length("sequence").cast("bigint").alias("n"), F.char_length(F.regexp_replace("sequence", "[^A]", "")).cast("bigint").alias("n_a"))


# Checked plans and stored thresholds --------------------------------------------------------------------------------


@query("scaffold_axis_checked", f"WITH {AXIS} SELECT * FROM axis")
def _(v):
    return contract.axis(v("bed"), v("stb")).withColumn("scaffold_ordinal", F.col("scaffold_ordinal").cast("bigint"))


@query("matrix_counts_checked", f"WITH {AXIS} SELECT p.genome, p.sample_id, p.pos - a.index_base + a.axis_start AS axis_pos FROM {{profile_positions}} p JOIN axis a ON a.genome = p.genome AND a.chrom = p.chrom WHERE {COVERED}")
def _(v):
    positions = matrix.covered(v("profile_positions"))
    return matrix.on_axis(positions, contract.axis(v("bed"), v("stb")), check=True).select("genome", "sample_id", "axis_pos")


_STORES = "(VALUES ('G1', 2.0, NULL, NULL, NULL), ('G2', NULL, 0.1, 0.5, NULL), ('GCF_000003.1', 1.0, NULL, NULL, NULL), ('G4', NULL, NULL, NULL, 0.0001)) t(matrix_id, min_coverage, min_breadth, min_ber, min_sylph_abundance)"


@query(
    "eligible_by_stores",
    f"""SELECT DISTINCT g.genome, g.sample_id FROM {{genome_stats}} g JOIN (SELECT * FROM {_STORES}) t ON t.matrix_id = g.genome JOIN {{samples}} s ON s.sample_id = g.sample_id AND s.status = 'complete'
    WHERE (t.min_coverage IS NULL OR coalesce(g.coverage, 0) >= t.min_coverage) AND (t.min_breadth IS NULL OR coalesce(g.breadth, 0) >= t.min_breadth) AND (t.min_ber IS NULL OR coalesce(g.ber, 0) >= t.min_ber)
    AND (t.min_sylph_abundance IS NULL OR EXISTS (SELECT 1 FROM {{sylph_abundance}} a WHERE a.sample_id = g.sample_id AND (a.genome = g.genome OR a.accession = g.genome) AND coalesce(a.abundance, 0) >= t.min_sylph_abundance))""",
)
def _(v):
    stores = v("region").sparkSession.sql("SELECT matrix_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("min_coverage", "min_breadth", "min_ber", "min_sylph_abundance")) + f" FROM {_STORES}")
    return eligibility.by_stores(v("samples"), v("genome_stats"), v("sylph_abundance"), stores)


# Comparisons of stored matrices of counts ----------------------------------------------------------------------------


def _from_counts(v: Views, calculate: str, method: str = "popani") -> DataFrame:
    spark = v("region").sparkSession
    axis_at, at = scratch(spark, "axis"), scratch(spark, "counts")
    # read back, the axis has a known size: positions are not shuffled to meet it while it is small
    contract.axis(v("bed"), v("stb")).write.parquet(axis_at)
    axis = spark.read.parquet(axis_at)
    matrix.counts(v("profile_positions"), axis).write.partitionBy("genome").parquet(at, compression="zstd")
    genes = contract.gene_axis(v("gene_ranges"), axis) if "gene" in compare.calculations(calculate) else None
    return compare.matrix_results(spark.read.parquet(at), calculate, method, genes)[calculate]


@query("stored_counts_conani", ORACLES["conani_pairs"])
def _(v):
    return _from_counts(v, "ani", "conani")


@query("stored_counts_cosani", ORACLES["cosani_pairs"])
def _(v):
    return _from_counts(v, "ani", "cosani_0.9")


@query("stored_counts_gene", ORACLES["gene_popani_pairs"])
def _(v):
    return _from_counts(v, "gene")


@query("stored_counts_runs", ORACLES["max_consecutive_run"])
def _(v):
    return _from_counts(v, "ibs")


@query("qualifying_earlier_layout", ORACLES["qualifying_pairs"])
def _(v):
    return views.qualifying(compare.pairs(v("profile_positions"), above=20).withColumnRenamed("genome_ani", "genome_pop_ani"), 20)
