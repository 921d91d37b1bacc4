"""Domain tables derived from the driver's star schema, as SQL that Spark and the oracle engine both run.

A name in braces stands for another view or a driver table.
"""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import Files, shared_dir

#: What makes the name and place of a position, one column each.
PLACE = [
    "'SRR' || CAST(l_suppkey AS STRING) AS sample_id",
    "'G' || CAST(l_partkey % 5 AS STRING) || '_c' || CAST(CAST(FLOOR(l_partkey / 5) AS BIGINT) % 2 AS STRING) AS chrom",
    "CAST(FLOOR(l_partkey / 10) AS BIGINT) + 1 AS pos",
    "'G' || CAST(l_partkey % 5 AS STRING) AS genome",
    "'G' || CAST(l_partkey % 5 AS STRING) || '_c' || CAST(CAST(FLOOR(l_partkey / 5) AS BIGINT) % 2 AS STRING)\n           || '_' || CAST(CAST(FLOOR(FLOOR(l_partkey / 10) / 20) AS BIGINT) + 1 AS STRING) AS gene",
]

VIEWS: dict[str, str] = {
    "profile_positions": """
SELECT """ + ",\n       ".join(PLACE) + """,
       CAST(SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS INT) AS A,
       CAST(SUM(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS INT) AS C,
       CAST(SUM(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS INT) AS G,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS INT) AS T
FROM {lineitem} GROUP BY 1, 2, 3, 4, 5""",
    "sra_runs": """
SELECT 'SRR' || CAST(s_suppkey AS STRING) AS run_id,
       CASE WHEN s_suppkey % 10 = 7 THEN 'deleted' WHEN s_suppkey % 8 = 5 THEN 'failed'
            WHEN s_suppkey % 4 = 3 THEN 'added' ELSE 'complete' END AS status,
       CASE WHEN s_suppkey % 10 = 7 THEN CAST(2 AS DOUBLE) END AS deleted_at
FROM {supplier}""",
    "samples": """
SELECT 'SRR' || CAST(s_suppkey AS STRING) AS sample_id, 'SRR' || CAST(s_suppkey AS STRING) AS run_id,
       CASE WHEN s_suppkey % 8 = 5 THEN 'failed' ELSE 'complete' END AS status
FROM {supplier} WHERE s_suppkey % 4 <> 3""",
    "stb": "SELECT DISTINCT chrom AS scaffold, genome FROM {profile_positions}",
    "bed": """
SELECT chrom, MIN(pos) - 1 AS start_pos, MAX(pos) AS end_pos
FROM {profile_positions} GROUP BY chrom, CAST(FLOOR((pos - 1) / 50) AS BIGINT)""",
    "gene_ranges": "SELECT gene, chrom AS scaffold, MIN(pos) AS start_pos, MAX(pos) AS end_pos FROM {profile_positions} GROUP BY gene, chrom",
    "genome_len": """
SELECT s.genome, CAST(SUM(b.len) AS BIGINT) AS genome_length
FROM (SELECT chrom, MAX(end_pos) - MIN(start_pos) AS len FROM {bed} GROUP BY chrom) b
JOIN {stb} s ON s.scaffold = b.chrom GROUP BY s.genome""",
    "genome_stats": """
SELECT p.sample_id, p.genome,
       CAST(SUM(p.A + p.C + p.G + p.T) AS DOUBLE) / CAST(MAX(l.genome_length) AS DOUBLE) AS coverage,
       CAST(COUNT(*) AS DOUBLE) / CAST(MAX(l.genome_length) AS DOUBLE) AS breadth,
       CASE WHEN CAST(SUBSTR(p.sample_id, 4) AS INT) % 9 = 0 THEN NULL
            ELSE CAST(SUM(CASE WHEN p.A + p.C + p.G + p.T >= 20 THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) END AS ber,
       MAX(l.genome_length) AS genome_length
FROM {profile_positions} p JOIN {genome_len} l ON l.genome = p.genome GROUP BY p.sample_id, p.genome""",
    "gene_stats": """
SELECT p.sample_id, p.genome, p.gene,
       CAST(SUM(p.A + p.C + p.G + p.T) AS DOUBLE) / CAST(MAX(g.end_pos - g.start_pos + 1) AS DOUBLE) AS coverage,
       CAST(COUNT(*) AS DOUBLE) / CAST(MAX(g.end_pos - g.start_pos + 1) AS DOUBLE) AS breadth,
       MAX(g.end_pos - g.start_pos + 1) AS length
FROM {profile_positions} p JOIN {gene_ranges} g ON g.gene = p.gene GROUP BY p.sample_id, p.genome, p.gene""",
    "sylph_raw": """
SELECT g.sample_id, 'db/GCF/GCF_00000' || SUBSTR(g.genome, 2) || '.1_genomic.fna.gz' AS genome_file,
       CASE WHEN CAST(SUBSTR(g.sample_id, 4) AS INT) % 7 = 0 AND g.genome = 'G4' THEN CAST(0 AS DOUBLE)
            ELSE CAST(g.q AS DOUBLE) / CAST(t.q AS DOUBLE) END AS abundance
FROM (SELECT sample_id, genome, SUM(A + C + G + T) AS q FROM {profile_positions} GROUP BY sample_id, genome) g
JOIN (SELECT sample_id, SUM(A + C + G + T) AS q FROM {profile_positions} GROUP BY sample_id) t ON t.sample_id = g.sample_id""",
    "sylph_abundance": """
SELECT sample_id, 'G' || SUBSTR(genome_file, 17, 1) AS genome, 'GCF_00000' || SUBSTR(genome_file, 17, 1) || '.1' AS accession, abundance
FROM {sylph_raw}""",
    # all samples as one: what a run's bundle holds
    "pooled": """
SELECT chrom, pos, genome, gene, CAST(SUM(A) AS INT) AS A, CAST(SUM(C) AS INT) AS C, CAST(SUM(G) AS INT) AS G, CAST(SUM(T) AS INT) AS T
FROM {profile_positions} GROUP BY 1, 2, 3, 4""",
    "pooled_stats": "SELECT genome, MAX(coverage) AS coverage, MAX(breadth) AS breadth, MAX(ber) AS ber, MAX(genome_length) AS genome_length FROM {genome_stats} GROUP BY 1",
    "pooled_genes": "SELECT genome, gene, MAX(coverage) AS coverage, MAX(breadth) AS breadth, MAX(length) AS length FROM {gene_stats} GROUP BY 1, 2",
    "pooled_abundance": "SELECT genome_file, MAX(abundance) AS abundance FROM {sylph_raw} GROUP BY 1",
    "matrix_store_samples": "SELECT DISTINCT genome AS matrix_id, sample_id FROM {genome_stats} WHERE CAST(SUBSTR(sample_id, 4) AS INT) % 3 = 0",
}


def _needs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


#: The derived positions are written once a session and folder: every other view is made from them.
_MADE: dict[tuple[str, str], str] = {}


def made_positions(lineitem: DataFrame) -> DataFrame:
    """The rows of profile_positions. A sample is a supplier and a position a part, so the numbers are summed by two keys, and names are made of each sum once.

    Neighbouring positions stand together, so that little is written and later shuffles find them in few tasks."""
    channel = F.expr("CASE WHEN l_returnflag = 'A' THEN 'A' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'C' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'G' WHEN l_returnflag = 'R' THEN 'T' END")
    rows = lineitem.select("l_partkey", "l_suppkey", channel.alias("channel"), "l_quantity").repartitionByRange("l_partkey", "l_suppkey")
    sums = rows.groupBy("l_partkey", "l_suppkey").agg(*[F.sum(F.when(F.col("channel") == c, F.col("l_quantity")).otherwise(0)).cast("int").alias(c) for c in "ACGT"])
    return sums.sortWithinPartitions("l_partkey").selectExpr(*PLACE, *"ACGT")


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MADE:
        path = scratch(spark, "positions")
        made_positions(spark.read.parquet(f"{sf_dir}/lineitem.parquet")).write.parquet(path, compression="zstd")
        _MADE[key] = path
    return spark.read.parquet(_MADE[key])


def scratch(spark: SparkSession, name: str) -> str:
    """A path for a new folder that all executors share; it is deleted when the interpreter ends."""
    path = f"{shared_dir(spark)}/strandloom/{name}-{uuid.uuid4().hex}"
    atexit.register(_dropped, spark, path)
    return path


def _dropped(spark: SparkSession, path: str) -> None:
    try:
        Files(spark).delete(path)
    except Exception:  # the session has ended: nothing can be reached any more
        return


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, or the driver's table of that name."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "profile_positions":
        return _positions(spark, sf_dir)
    return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n) for n in _needs(VIEWS[name])})


def with_views(body: str) -> str:
    """body as one statement: the views it names in braces go in front as common table expressions."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for n in _needs(sql):
            if n in VIEWS and n not in order:
                visit(VIEWS[n])
                order.append(n)

    visit(body)
    plain = lambda sql: re.sub(r"\{(\w+)\}", r"\1", sql)
    heads = [f"{n} AS ({plain(VIEWS[n]).strip()})" for n in order]
    body = plain(body).strip()
    if not heads:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(heads) + ",\n" + body[len("WITH RECURSIVE") :]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(heads) + ",\n" + body[len("WITH ") :]
    return "WITH " + ",\n".join(heads) + "\n" + body
