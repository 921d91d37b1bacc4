"""Readers of input files, and the projections that bring them to the table schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import names
from ..operators.contract import reject

#: Separator by file suffix; anything else is comma-separated. Parquet is read as such.
TABLE_SUFFIXES = {".tsv": "\t", ".tab": "\t"}
ABUNDANCE_SUFFIXES = {".tsv": "\t", ".txt": "\t"}


def table(spark: SparkSession, path: str, suffixes: dict[str, str] = TABLE_SUFFIXES) -> DataFrame:
    low = path.lower()
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    sep = next((s for end, s in suffixes.items() if low.endswith(end)), ",")
    return spark.read.csv(path, header=True, sep=sep, inferSchema=True)


def first_existing(columns: Sequence[str], wanted: Sequence[str]) -> str | None:
    """The first wanted column that is there; case counts."""
    return next((w for w in wanted if w in columns), None)


def first_matching(columns: Sequence[str], wanted: Sequence[str]) -> str | None:
    """The same without regard to case."""
    low = {c.lower(): c for c in columns}
    return next((low[w.lower()] for w in wanted if w.lower() in low), None)


def require(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")


def resolved(df: DataFrame, aliases: dict[str, tuple[tuple[str, ...], str]]) -> list:
    """A typed column for each alias list; typed null where no column of the list is there."""
    out = []
    for name, (wanted, kind) in aliases.items():
        found = first_existing(df.columns, wanted)
        out.append((F.col(f"`{found}`").cast(kind) if found else F.lit(None).cast(kind)).alias(name))
    return out


def profile(df: DataFrame, sample_id: str, *, whole: bool = False) -> DataFrame:
    """Positions of one sample. A missing gene column reads 'NA'; nulls in it stay. Counts must fit 16 bits without sign; `whole` refuses fractions, which are rounded otherwise."""
    require(df, ["chrom", "pos", "genome", "A", "C", "G", "T"], "the profile")
    counts = []
    for c in ("A", "C", "G", "T"):
        number = F.col(c).cast("double")
        rounded = F.bround(number).cast("int")
        fits = rounded.between(0, S.MAX_COUNT) & ((rounded == number) if whole else F.lit(True))
        counts.append(F.when(fits, rounded).otherwise(F.raise_error(F.concat(F.lit(f"count {c} out of range: "), number.cast("string")))).alias(c))
    gene = F.col("gene").cast("string") if "gene" in df.columns else F.lit("NA")
    ref = F.col("ref_base_bitmask").cast("int") if "ref_base_bitmask" in df.columns else F.lit(None).cast("int")
    return df.select(F.lit(sample_id).alias("sample_id"), F.col("chrom").cast("string").alias("chrom"), F.col("pos").cast("bigint").alias("pos"), F.col("genome").cast("string").alias("genome"), gene.alias("gene"), *counts, ref.alias("ref_base_bitmask"))


def genome_stats(df: DataFrame, sample_id: str) -> DataFrame:
    key = first_existing(df.columns, S.GENOME_ALIASES)
    if key is None:
        raise ValueError("the genome statistics lack a genome column")
    return df.select(F.lit(sample_id).alias("sample_id"), F.col(key).cast("string").alias("genome"), *resolved(df, S.GENOME_STATS_ALIASES))


def gene_stats(df: DataFrame, sample_id: str) -> DataFrame:
    key = first_existing(df.columns, S.GENE_ALIASES)
    if key is None:
        raise ValueError("the gene statistics lack a gene column")
    genome = first_existing(df.columns, S.GENOME_ALIASES)
    return df.select(F.lit(sample_id).alias("sample_id"), (F.col(genome).cast("string") if genome else F.lit(None).cast("string")).alias("genome"), F.col(key).cast("string").alias("gene"), *resolved(df, S.GENE_STATS_ALIASES))


def abundance(df: DataFrame, sample_id: str) -> DataFrame:
    """Abundances by genome and accession; a value without a recognisable accession is refused."""
    source = first_existing(df.columns, S.ABUNDANCE_SOURCES)
    if source is None:
        raise ValueError("the abundances lack a genome or accession column")
    value = first_existing(df.columns, S.ABUNDANCE_ALIASES)
    accession = names.accession(F.col(source))
    reject(df.filter(accession.isNull()), "abundances without a recognisable accession", source)
    named = first_existing(df.columns, S.ABUNDANCE_GENOME)
    return df.select(F.lit(sample_id).alias("sample_id"), (F.col(named).cast("string") if named else accession).alias("genome"), accession.alias("accession"), (F.col(value).cast("double") if value else F.lit(None).cast("double")).alias("abundance"))


def nonzero(df: DataFrame) -> DataFrame:
    """Rows with a positive abundance: in the preferred column, else in any that looks like one, else in any number."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not numbers:
        return df
    best = first_matching(numbers, S.LIST_ABUNDANCE_ALIASES)
    chosen = [best] if best else [c for c in numbers if "abund" in c.lower() or "cov" in c.lower()] or numbers
    keep = F.lit(False)
    for c in chosen:
        keep = keep | (F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) > 0)
    return df.filter(keep)


def accession_list(df: DataFrame) -> DataFrame:
    """The distinct accessions of genomes with abundance."""
    key = first_matching(df.columns, S.LIST_GENOME_ALIASES)
    if key is None:
        raise ValueError("the abundance table lacks a genome column")
    return nonzero(df).select(names.accession(F.col(key), S.ACCESSION_AT_WORD).alias("accession")).filter("accession is not null").distinct()


def accessions(spark: SparkSession, path: str) -> DataFrame:
    """An accession file: the accession (or first) column of a CSV, or the first word of each line."""
    if path.lower().endswith(".csv"):
        df = spark.read.csv(path, header=True)
        key = "accession" if "accession" in df.columns else df.columns[0]
        rows = df.select(F.trim(F.col(key)).alias("accession"))
    else:
        rows = spark.read.text(path).select(F.split(F.trim("value"), r"\s+")[0].alias("accession"))
    return rows.filter(F.coalesce("accession", F.lit("")) != "").distinct()


def bed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, start_pos bigint, end_pos bigint")


def stb(spark: SparkSession, path: str) -> DataFrame:
    """scaffold and genome; a scaffold given twice is refused unless both lines agree."""
    rows = spark.read.csv(path, sep="\t", schema="scaffold string, genome string").dropDuplicates(["scaffold", "genome"])
    reject(rows.groupBy("scaffold").count().filter("count > 1"), "scaffolds assigned more than once", "scaffold")
    return rows


def gene_ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="gene string, scaffold string, start_pos bigint, end_pos bigint")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True)
    require(df, ["run_id", "profile_file", "genome_stats_file", "sylph_abundance_file"], "the manifest")
    return df if "gene_stats_file" in df.columns else df.withColumn("gene_stats_file", F.lit(None).cast("string"))


def run_list(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True)
    require(df, ["run_id"], "the run list")
    return df.select(F.trim("run_id").alias("run_id")).filter("run_id <> ''").distinct()


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """chrom (first word of the header), header and sequence. Records, not files, are the rows: a file may hold very many."""
    raw = spark.read.option("lineSep", ">").text(path)
    parts = F.split("value", "\n", 2)
    rows = raw.select(F.trim(F.regexp_replace(parts[0], "\r", "")).alias("header"), F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), r"\s+", "").alias("sequence"))
    return rows.filter("header <> ''").select(F.split("header", r"\s+")[0].alias("chrom"), "header", "sequence")


def scaffold_lengths(records: DataFrame) -> DataFrame:
    return records.select(F.col("chrom").alias("scaffold"), F.char_length("sequence").cast("bigint").alias("length"))


def genes_from_headers(records: DataFrame) -> DataFrame:
    """gene, scaffold, start and end from headers like `name_1 # 1 # 2 # …`."""
    f = F.split("header", r"\s*#\s*")
    rows = records.filter(F.size(f) >= 3).select(F.col("chrom").alias("gene"), f[1].cast("bigint").alias("start_pos"), f[2].cast("bigint").alias("end_pos"))
    return rows.select("gene", F.regexp_replace("gene", "_[^_]*$", "").alias("scaffold"), "start_pos", "end_pos")
