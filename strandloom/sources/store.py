"""A project as Parquet tables with one pointer that commits.

Fact tables are partitioned by the sample they belong to, so an import replaces a sample by overwriting its partitions;
registry tables are small snapshots. Every change writes its files first and its state last, under the next number of
`state/`: readers follow the highest number, so a change that fails before is never seen, and of two writers that start
from one state the second fails. All paths go through Hadoop file systems.
"""

from __future__ import annotations

import json
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import registry
from ..schemas import TABLES
from . import ingest

KEPT = 5
#: How profiles are stored in either mode.
FORMAT = {
    "full": {"format_version": 1, "codec": None, "allele_bit_order": None},
    "allele_mask": {"format_version": 1, "codec": "zstd", "allele_bit_order": "ATCG"},
}
FACTS = ("profile_positions", "mask_blocks", "genome_stats", "gene_stats", "sylph_abundance")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder the session names; a temporary one only where it names none."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    sc.setCheckpointDir(shared_dir(spark))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only on a local master."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='strandloom-')}"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def storage_row(spark: SparkSession, contract: dict) -> DataFrame:
    """The one row that records how a project stores its profiles."""
    values = {"id": 1, **contract, **FORMAT[contract["mode"]]}
    return spark.createDataFrame([tuple(values[f.name] for f in TABLES["profile_storage"].fields)], TABLES["profile_storage"])


class Files:
    """A few file operations on whatever file system a path names."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> str:
        return "\n".join(r.value for r in self.spark.read.text(path, wholetext=True).collect())

    def write(self, path: str, text: str) -> None:
        self.write_bytes(path, text.encode())

    def write_bytes(self, path: str, raw: bytes | Iterable[bytes], *, new: bool = False) -> None:
        """Written beside and renamed in one step, so that readers see the old content or the new; `new` refuses to replace."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        staged, fs = self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(staged, True)
        for piece in [raw] if isinstance(raw, bytes) else raw:
            out.write(bytearray(piece))
        out.close()
        p, _ = self._at(path)
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(kind, 0 if new else 1)
        if not new:
            options[0] = kind.OVERWRITE
        staged, p = fs.makeQualified(staged), fs.makeQualified(p)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark._jsc.hadoopConfiguration()).rename(staged, p, options)
        except Exception as e:
            fs.delete(staged, False)
            raise OSError(f"cannot publish {path}: another writer was faster" if new else f"cannot publish {path}") from e

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def list(self, path: str) -> list[str]:
        p, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


class Store:
    """Tables of one project. State maps a table, or a table and sample, to the folder that holds it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.list(f"{self.root}/state") if re.fullmatch(r"\d+\.json", n))

    def exists(self) -> bool:
        return bool(self._numbers())

    def state(self) -> dict:
        held = self._numbers()
        if held:
            return json.loads(self.files.read(f"{self.root}/state/{held[-1]}.json"))
        if self.files.list(f"{self.root}/data"):
            raise OSError(f"{self.root} holds data but no state")
        return {"version": 0, "tables": {}, "samples": {}, "matrices": {}, "contract": {"mode": "full", "min_cov": None}}

    def commit(self, state: dict) -> None:
        """The state as the version after the one it was read from; older versions but KEPT are deleted."""
        version = state["version"] + 1
        self.files.write_bytes(f"{self.root}/state/{version}.json", json.dumps(state | {"version": version}, sort_keys=True).encode(), new=True)
        for n in self._numbers():
            if n <= version - KEPT:
                self.files.delete(f"{self.root}/state/{n}.json")

    def contract(self) -> dict:
        """Storage mode and threshold, held against the recorded format: a project written another way is not read."""
        contract = self.state()["contract"]
        rows = self.table("profile_storage").collect()  # one row
        if contract["mode"] == "allele_mask" or rows:
            wanted = {"id": 1, **contract, **FORMAT[contract["mode"]]}
            if [r.asDict() for r in rows] != [wanted]:
                raise ValueError(f"the profile storage is not {wanted}")
        return contract

    def of_sample(self, name: str, sample: str) -> DataFrame:
        """The rows of one sample of a fact table, from its own folder."""
        path = self.state()["samples"].get(sample, {}).get(name)
        return self.spark.read.schema(TABLES[name]).parquet(path) if path else self.spark.createDataFrame([], TABLES[name])

    def table(self, name: str) -> DataFrame:
        """The current rows; columns added to the schema later read null."""
        schema, state = TABLES[name], self.state()
        paths = [p[name] for p in state["samples"].values() if name in p] if name in FACTS else [state["tables"][name]] if name in state["tables"] else []
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _write(self, df: DataFrame, name: str) -> str:
        path = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        schema = TABLES[name]
        df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]).write.option("compression", "zstd").parquet(path)
        return path

    def replace(self, changes: dict[str, DataFrame], edit: Callable[[dict], None] | None = None, *, state: dict | None = None) -> None:
        """New snapshots of registry tables, committed together on top of the state they were made from."""
        state = state or self.state()
        for name, df in changes.items():
            state["tables"][name] = self._write(df, name)
        if edit:
            edit(state)
        self.commit(state)

    def set_contract(self, mode: str, min_cov: int | None = None) -> None:
        """Storage mode and threshold; fixed from the first import on, repeating them is allowed."""
        if mode not in ("full", "allele_mask"):
            raise ValueError(f"unknown storage mode {mode}")
        wanted = {"mode": mode, "min_cov": (5 if min_cov is None else min_cov) if mode == "allele_mask" else None}
        state = self.state()
        if state["contract"] != wanted and state["samples"]:
            raise ValueError("the storage contract cannot change after an import")
        state["contract"] = wanted
        self.replace({"profile_storage": storage_row(self.spark, wanted)}, state=state)

    def set_references(self, segments: DataFrame) -> None:
        """The reference segments that masks are stored against; fixed from the first import on."""
        if self.state()["samples"] and "reference_segments" in self.state()["tables"]:
            raise ValueError("the reference segments cannot change after an import")
        self.replace({"reference_segments": segments})

    def add_runs(self, ids: Sequence[str]) -> dict[str, int]:
        from ..functions.names import normalized

        asked = self.spark.createDataFrame([(i,) for i in normalized(ids)], "run_id string")
        now = time.time()
        changed = registry.add_runs(self.table("sra_runs"), asked, now).join(self.table("sra_runs").select("run_id", "added_at", "last_error"), "run_id", "left")
        touched = F.col("change") != "kept"
        rows = changed.withColumns({"added_at": F.coalesce("added_at", F.lit(now)), "updated_at": F.when(touched, F.lit(now))}).cache()
        counts = {r.change: r["count"] for r in rows.groupBy("change").count().collect()}
        self.replace({"sra_runs": rows})
        rows.unpersist()
        return {k: counts.get(k, 0) for k in ("added", "reactivated")}

    def delete_runs(self, ids: Sequence[str]) -> int:
        asked = self.spark.createDataFrame([(i,) for i in ids], "run_id string")
        before = self.table("sra_runs")
        rows = registry.delete_runs(before, asked, time.time()).join(before.select("run_id", "added_at", "last_error"), "run_id", "left").cache()
        n = rows.filter("changed").count()
        self.replace({"sra_runs": rows})
        rows.unpersist()
        return n

    def remaining(self) -> DataFrame:
        return registry.remaining(self.table("sra_runs"), self.table("samples"))

    def mark(self, run_id: str, status: str, error: str | None = None) -> None:
        runs = self.table("sra_runs")
        hit = F.col("run_id") == run_id
        self.replace({"sra_runs": runs.withColumns({"status": F.when(hit, F.lit(status)).otherwise(F.col("status")), "last_error": F.when(hit, F.lit(error)).otherwise(F.col("last_error")), "updated_at": F.when(hit, F.lit(time.time())).otherwise(F.col("updated_at"))})})

    def import_bundle(self, run_id: str, profile: str, genome_stats: str, sylph: str, gene_stats: str | None = None, *, segments: DataFrame | None = None) -> None:
        """All tables of one sample, replaced together; any error leaves the project as it was."""
        if self.table("sra_runs").filter((F.col("run_id") == run_id) & F.col("deleted_at").isNull()).isEmpty():
            raise ValueError(f"run {run_id} is not registered")
        state = self.state()
        contract = self.contract()
        rows = ingest.profile(ingest.table(self.spark, profile), run_id, whole=contract["mode"] == "allele_mask")
        parts = {"genome_stats": ingest.genome_stats(ingest.table(self.spark, genome_stats), run_id), "sylph_abundance": ingest.abundance(ingest.table(self.spark, sylph), run_id)}
        twice = parts["genome_stats"].groupBy("genome").count().filter("count > 1")
        ingest.reject(twice, "genomes with more than one row of statistics", "genome")
        if gene_stats:
            parts["gene_stats"] = ingest.gene_stats(ingest.table(self.spark, gene_stats), run_id)
        if contract["mode"] == "allele_mask":
            from ..operators import codec

            if segments is not None and "reference_segments" not in state["tables"]:
                self.set_references(segments)
                state = self.state()
            if "reference_segments" not in state["tables"]:
                raise ValueError("a project of allele masks needs its reference segments before the first import")
            known = self.table("reference_segments")
            parts["mask_blocks"] = codec.encode(rows, known, contract["min_cov"])
        else:
            parts["profile_positions"] = rows.repartition("genome").sortWithinPartitions("genome", "chrom", "pos")
        made = {name: self._write(df, name) for name, df in parts.items()}
        now = time.time()
        one = lambda text, *values: self.spark.createDataFrame([values], text)
        samples = registry.upsert(self.table("samples"), one("sample_id string, run_id string, status string, created_at double, updated_at double", run_id, run_id, "complete", now, now), ["sample_id"])
        profiles = registry.upsert(self.table("profiles"), one(TABLES["profiles"].simpleString()[7:-1].replace(":", " "), run_id, profile, genome_stats, gene_stats, sylph, contract["mode"], contract["min_cov"], now, now), ["run_id"])
        hit = F.col("run_id") == run_id
        runs = self.table("sra_runs").withColumns({"status": F.when(hit, F.lit("complete")).otherwise(F.col("status")), "updated_at": F.when(hit, F.lit(now)).otherwise(F.col("updated_at"))})

        def edit(state: dict) -> None:
            state["samples"][run_id] = made

        self.replace({"samples": samples, "profiles": profiles, "sra_runs": runs}, edit, state=state)

    def masks(self) -> DataFrame:
        """sample_id, genome, chrom, pos, mask of a project of allele masks."""
        from ..operators import codec

        self.contract()
        return codec.decode(self.table("mask_blocks"), self.table("reference_segments"))

    def matrix_cells(self, root: str) -> DataFrame:
        """The committed cells of the matrices below root; folders of a build that failed are not among them."""
        folders = self.state().get("matrices", {}).get(root)
        if not folders:
            raise FileNotFoundError(f"no matrix at {root}")
        return self.spark.read.option("basePath", root).parquet(*folders)

    def copy_rows(self, source: Store, names: Sequence[str]) -> dict[str, int]:
        """Registry tables of another project, by the columns that both have; rows already there stay as they are."""
        changes, counts = {}, {}
        for name in names:
            old, new = self.table(name), source.table(name)
            common = [c for c in old.columns if c in new.columns]
            key = common[:2] if name == "matrix_store_samples" else common[:1]
            fresh = registry.insert_ignore(old, new.select(*common), key)
            counts[name] = fresh.count()
            changes[name] = old.unionByName(fresh, allowMissingColumns=True)
        self.replace(changes)
        return counts

    def migrate(self, target: Store, segments: DataFrame, min_cov: int = 5) -> dict[str, int]:
        """Full profiles to masks in another project, sample by sample; what is done stays done, the source is untouched."""
        from ..operators import codec

        target.set_contract("allele_mask", min_cov)
        state = target.state()
        if "reference_segments" not in state["tables"]:
            target.replace({"reference_segments": segments, **{n: self.table(n) for n in ("sra_runs", "samples", "profiles")}})
        todo = [r.sample_id for r in codec.pending(self.table("samples").filter("status = 'complete'"), target.table("migration_state")).collect()]
        known, counts = target.table("reference_segments"), {"done": 0, "failed": 0}
        for sample in sorted(todo):
            own = lambda name: self.table(name).filter(F.col("sample_id") == sample)  # noqa: B023, E731
            try:
                made = {n: target._write(own(n), n) for n in ("genome_stats", "gene_stats", "sylph_abundance")}
                made["mask_blocks"] = target._write(codec.encode(own("profile_positions"), known, min_cov), "mask_blocks")
                status, error = "done", None
            except Exception as e:  # the sample is marked and the others go on
                made, status, error = {}, "failed", str(e)[:500]
            row = self.spark.createDataFrame([(sample, status, error, time.time())], "sample_id string, status string, error string, updated_at double")
            old = target.table("migration_state")
            merged = old.join(row.select("sample_id"), "sample_id", "left_anti").unionByName(row, allowMissingColumns=True)
            target.replace({"migration_state": merged}, lambda s: s["samples"].update({sample: made}) if made else None)  # noqa: B023
            counts[status] += 1
        return counts
