"""Table schemas, bit conventions and input aliases."""

from __future__ import annotations

from pyspark.sql import types as T

# Allele bits and channel order, column aliases, accession patterns, abundance columns.
BITS = {"A": 1, "T": 2, "C": 4, "G": 8}
CHANNELS = ("A", "T", "C", "G")
MAX_COUNT = 65535
SKIPPED_GENOMES = ("", "NA", "None", "null")
ACCESSION = r"(GC[AF]_\d+(?:\.\d+)?)"
ACCESSION_AT_WORD = r"\b((?:GC[AF])_\d+(?:\.\d+)?)"
GENOME_ALIASES = ("genome", "genome_name", "reference", "accession")
GENE_ALIASES = ("gene", "gene_id")
GENOME_STATS_ALIASES = {
    "coverage": (("coverage", "cov", "mean_coverage"), "double"),
    "breadth": (("breadth", "breadth_coverage", "breadth_cov"), "double"),
    "ber": (("ber", "BER"), "double"),
    "ref_ani": (("ref_ani", "reference_ani"), "double"),
    "coverage_median": (("coverage_median",), "double"),
    "coverage_std": (("coverage_std",), "double"),
    "genome_length": (("genome_length", "length"), "bigint"),
    "gap_mean": (("gap_mean",), "double"),
    "gap_std": (("gap_std",), "double"),
    "5x_cov_sites": (("5x_cov_sites",), "bigint"),
    "heterogeneity": (("heterogeneity",), "double"),
    "fug": (("fug", "FUG"), "double"),
    "reads_mapped": (("reads_mapped",), "bigint"),
    "conANI_reference": (("conANI_reference", "conani_reference"), "double"),
    "SNS_count": (("SNS_count", "sns_count"), "bigint"),
    "SNV_count": (("SNV_count", "snv_count"), "bigint"),
    "presence": (("presence",), "string"),
    "genome_taxonomy": (("genome_taxonomy", "taxonomy"), "string"),
}
GENE_STATS_ALIASES = {
    "coverage": (("coverage", "cov", "mean_coverage"), "double"),
    "breadth": (("breadth", "breadth_coverage", "breadth_cov"), "double"),
    "ber": (("ber", "BER"), "double"),
    "ref_ani": (("ref_ani", "reference_ani"), "double"),
    "length": (("length", "gene_length"), "bigint"),
}
ABUNDANCE_GENOME = ("genome", "genome_name")
ABUNDANCE_SOURCES = ("accession", "genome", "genome_name", "reference", "Genome_file", "name")
ABUNDANCE_ALIASES = ("abundance", "relative_abundance", "Taxonomic_abundance", "ANI")
LIST_GENOME_ALIASES = ("Genome_file", "genome_file", "genome", "Genome", "Reference", "reference", "target")
LIST_ABUNDANCE_ALIASES = ("eff_cov", "genome_cov", "abundance", "relative_abundance", "rel_abundance", "Taxonomic_abundance")
# Defaults of a view.
VIEW_DEFAULTS = {
    "min_comp_len": 10_000, "impute_ani": 97.0, "max_null_fraction": 0.20, "max_null_samples": None,
    "linkage_method": "average", "neighbor_k": 20, "clonal_cluster_threshold": 99.93, "strain_cluster_threshold": 99.8,
}


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "binary": T.BinaryType()}


def _schema(text: str) -> T.StructType:
    """`name type, ...`, read without a session so that workers can import this module."""
    parts = [x.strip().rsplit(" ", 1) for x in text.split(",")]
    return T.StructType([T.StructField(name.strip("`"), _TYPES[kind]) for name, kind in parts])


# Tables and columns of a project. Three names are shorter than usual, as folders carry them: mask_blocks,
# reference_segments and migration_state stand for allele_mask_profiles, allele_mask_reference_segments and
# allele_mask_migration_state.
TABLES: dict[str, T.StructType] = {
    "sra_runs": _schema("run_id string, status string, added_at double, updated_at double, deleted_at double, last_error string"),
    "samples": _schema("sample_id string, run_id string, status string, created_at double, updated_at double"),
    "profiles": _schema("run_id string, profile_file string, genome_stats_file string, gene_stats_file string, sylph_abundance_file string, profile_storage_mode string, profile_min_cov int, created_at double, updated_at double"),
    "profile_positions": _schema("sample_id string, chrom string, pos bigint, genome string, gene string, A int, C int, G int, T int, ref_base_bitmask int"),
    "profile_storage": _schema("id int, mode string, format_version int, min_cov int, codec string, allele_bit_order string"),
    "reference_segments": _schema("segment_id bigint, genome string, chrom string, segment_ordinal int, start_pos bigint, span bigint, reference_mask binary, reference_hash string"),
    "mask_blocks": _schema("sample_id string, segment_id bigint, presence binary, deviation binary, covered_positions bigint, payload_hash string"),
    "migration_state": _schema("sample_id string, status string, source_rows bigint, compressed_blocks bigint, covered_positions bigint, error string, updated_at double"),
    "genome_stats": _schema("sample_id string, genome string, " + ", ".join(f"`{k}` {t}" for k, (_, t) in GENOME_STATS_ALIASES.items())),
    "gene_stats": _schema("sample_id string, genome string, gene string, " + ", ".join(f"`{k}` {t}" for k, (_, t) in GENE_STATS_ALIASES.items())),
    "sylph_abundance": _schema("sample_id string, genome string, accession string, abundance double"),
    "cache_genomes": _schema("accession string, genome_fasta string, gene_fasta string, status string, updated_at double"),
    "matrix_stores": _schema("matrix_id string, genome string, matrix_file string, profile_count bigint, storage_layout string, min_coverage double, min_breadth double, min_ber double, min_sylph_abundance double, created_at double, updated_at double"),
    "matrix_store_samples": _schema("matrix_id string, sample_id string, added_at double"),
    "matrix_compares": _schema("compare_id string, matrix_id string, compare_db_file string, calculate string, created_at double, updated_at double"),
}
