"""Exports: Parquet, per-sample files, JSON artefacts, condensed matrices and genome bundles."""

from __future__ import annotations

import json
import math
import time
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Files

SCHEMA_VERSION = 1
CELLS = 2**20
BINARIES = {"similarity_ani.condensed.f32.gz": ("ani", "<f4"), "total_positions.condensed.u64.gz": ("total_positions", "<u8")}
JSONS = ("samples.json", "sample_stats.json", "clusters.json", "dendrogram.json", "neighbor_network.json", "distributions.json")


def to_parquet(df: DataFrame, path: str, *, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd").parquet(path)


def row_group(megabytes: float) -> int:
    """Rows of a row group for a batch size, within 10,000 and 250,000."""
    return max(10_000, min(250_000, int(megabytes * 2**20 / 128)))


def per_sample(positions: DataFrame, path: str, *, megabytes: float = 128) -> None:
    """A folder for each sample with positions; a null gene reads 'NA'."""
    positions.withColumn("gene", F.coalesce("gene", F.lit("NA"))).repartition("sample_id").sortWithinPartitions("sample_id", "genome", "chrom", "pos").write.option("maxRecordsPerFile", row_group(megabytes)).partitionBy("sample_id").parquet(path)


def to_bed(tiles: DataFrame, path: str) -> None:
    tiles.write.csv(path, sep="\t")


def to_stb(scaffolds: DataFrame, path: str) -> None:
    scaffolds.select("scaffold", "genome").write.csv(path, sep="\t")


def run_list(runs: DataFrame, path: str) -> None:
    """run_id with a header, in one file, header also when there is no run."""
    runs.select("run_id").orderBy("run_id").coalesce(1).write.csv(path, header=True)


def plain(value):
    """JSON without NaN or infinities."""
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value.isoformat() if hasattr(value, "isoformat") else value


def json_rows(df: DataFrame) -> DataFrame:
    """Rows as JSON text; NaN and infinities become null."""
    clean = [F.when(F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf"))), None).otherwise(F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    return df.select(F.to_json(F.struct(*clean), {"ignoreNullFields": "false"}).alias("value"))


def condensed_bytes(cells: DataFrame, column: str, kind: str) -> Iterator[bytes]:
    """Upper triangle (k, column) in row-major order as one gzip member without a time, little endian.

    Tasks pack runs of CELLS cells; the driver holds one run at a time.
    """

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "raw": [pdf.sort_values("k")[column].to_numpy().astype(kind).tobytes()]})

    parts = cells.select("k", column, F.expr(f"k div {CELLS}").alias("part")).groupBy("part").applyInPandas(pack, "part bigint, raw binary")
    packer = zlib.compressobj(wbits=31)
    for row in parts.orderBy("part").toLocalIterator():
        yield packer.compress(bytes(row.raw))
    yield packer.flush()


def bundle(spark: SparkSession, path: str, genome: str, parts: dict[str, DataFrame], meta: dict) -> None:
    """The artefacts of one genome as Parquet, the manifest last: a bundle without manifest does not count."""
    files = Files(spark)
    files.delete(f"{path}/manifest.json")
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    files.write(f"{path}/manifest.json", json.dumps(plain({"schema_version": SCHEMA_VERSION, "genome": genome, "artifacts": sorted(parts), "created_at": time.time()} | meta), allow_nan=False, sort_keys=True))


def view_files(spark: SparkSession, path: str, genome: str) -> list[str]:
    """The JSON and binary artefacts a static viewer reads, made from one genome's bundle; the list of files comes last.

    Tables of a row a sample, a merge or an edge pass the driver; the triangle passes it in runs.
    """
    files = Files(spark)
    rows = lambda name, *order: [r.asDict() for r in spark.read.parquet(f"{path}/{name}").orderBy(*order).collect()]
    clusters = rows("clusters", "leaf_rank")
    names = [c["sample_id"] for c in clusters]
    histograms = {n.removeprefix("histogram_"): rows(n, "bin") for n in files.list(path) if n.startswith("histogram_")}
    made = {
        "samples.json": {"genome": genome, "samples": names},
        "sample_stats.json": {"genome": genome, "rows": rows("sample_stats", "leaf_rank")},
        "clusters.json": {"genome": genome, "clusters": clusters},
        "dendrogram.json": {"genome": genome, "leaf_order": names, "merges": rows("merges", "merge_id"), "root_id": 2 * len(names) - 2},
        "neighbor_network.json": {"genome": genome, "nodes": rows("nodes", "sample_id"), "edges": rows("edges", F.desc("ani"), "sample_1", "sample_2")},
        "distributions.json": {"genome": genome, "histograms": histograms},
    }
    for name, payload in made.items():
        files.write(f"{path}/{name}", json.dumps(plain(payload), allow_nan=False))
    for name, (column, kind) in BINARIES.items():
        files.write_bytes(f"{path}/{name}", condensed_bytes(spark.read.parquet(f"{path}/condensed"), column, kind))
    return [*made, *BINARIES]


def up_to_date(spark: SparkSession, path: str, signature: dict) -> bool:
    files = Files(spark)
    if not files.exists(f"{path}/manifest.json"):
        return False
    held = json.loads(files.read(f"{path}/manifest.json"))
    return held.get("signature") == plain(signature) and all(files.exists(f"{path}/{a}") for a in [*[f"{x}/_SUCCESS" for x in held["artifacts"]], *JSONS, *BINARIES])


def catalog(spark: SparkSession, root: str) -> list[dict]:
    """Manifests of this schema version below root, also written as catalog.json."""
    files = Files(spark)
    found = []
    for name in files.list(root):
        at = f"{root}/{name}/manifest.json"
        if files.exists(at):
            m = json.loads(files.read(at))
            if m.get("schema_version") == SCHEMA_VERSION:
                found.append({"path": name} | m)
    files.write(f"{root}/catalog.json", json.dumps({"schema_version": SCHEMA_VERSION, "genomes": found}, sort_keys=True))
    return found
