"""Runs, samples and the other registry tables: set-based changes that return the new snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("deleted_at").isNull())


def remaining(runs: DataFrame, samples: DataFrame) -> DataFrame:
    """Active runs without a complete sample; failed ones are among them."""
    done = samples.filter(F.col("status") == "complete").select("run_id")
    return active(runs).join(done, "run_id", "left_anti")


def progress(table: DataFrame) -> DataFrame:
    return table.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def add_runs(runs: DataFrame, ids: DataFrame, now: float) -> DataFrame:
    """The runs after adding ids: new ones come in, deleted ones come back, active ones stay. `change` tells which."""
    new = ids.select("run_id").filter(F.trim("run_id") != "").distinct().withColumn("asked", F.lit(True))
    rows = runs.join(new, "run_id", "full_outer")
    back = F.col("asked") & F.col("deleted_at").isNotNull()
    fresh = F.col("asked") & F.col("status").isNull()
    change = F.when(fresh, "added").when(back, "reactivated").otherwise("kept")
    out = rows.select("run_id", F.when(fresh | back, F.lit("added")).otherwise(F.col("status")).alias("status"), F.when(back, F.lit(None)).otherwise(F.col("deleted_at")).alias("deleted_at"), change.alias("change"), F.lit(float(now)).alias("at"))
    return out.drop("at")


def delete_runs(runs: DataFrame, ids: DataFrame, now: float) -> DataFrame:
    """The runs after a soft delete; only active rows change."""
    rows = runs.join(ids.select("run_id").distinct().withColumn("asked", F.lit(True)), "run_id", "left")
    hit = F.col("asked").isNotNull() & F.col("deleted_at").isNull()
    return rows.select("run_id", F.when(hit, F.lit("deleted")).otherwise(F.col("status")).alias("status"), F.when(hit, F.lit(float(now))).otherwise(F.col("deleted_at")).alias("deleted_at"), F.coalesce(hit, F.lit(False)).alias("changed"))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], created: str | None = "created_at") -> DataFrame:
    """new replaces old by key; an old row's creation time lives on."""
    keys = list(keys)
    kept = old.join(new.select(*keys), keys, "left_anti")
    if created and created in old.columns:
        before = old.select(*keys, F.col(created).alias("before"))
        new = new.join(before, keys, "left").withColumn(created, F.coalesce("before", created)).drop("before")
    return kept.unionByName(new.select(*old.columns))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of new whose key is not there yet, once each."""
    return new.dropDuplicates(list(keys)).join(old.select(*keys), list(keys), "left_anti")


def status(runs: DataFrame, samples: DataFrame, positions: DataFrame, blocks: DataFrame | None, stores: DataFrame, compares: DataFrame, contract: dict | None = None) -> DataFrame:
    """One row of counts over the whole project."""
    contract = contract or {"mode": "full", "min_cov": None}
    one = lambda df, name, expr=None: df.agg((expr if expr is not None else F.count(F.lit(1))).alias(name))
    parts = [
        runs.agg(F.count_if(F.col("deleted_at").isNull()).alias("active_runs"), F.count_if(F.col("deleted_at").isNotNull()).alias("deleted_runs")),
        one(samples.filter(F.col("status") == "complete"), "complete_samples"),
        one(positions, "profile_rows"),
        one(blocks, "allele_mask_blocks").join(one(blocks, "allele_mask_positions", F.coalesce(F.sum("covered_positions"), F.lit(0)))) if blocks is not None else runs.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("allele_mask_blocks"), F.lit(0).cast("bigint").alias("allele_mask_positions")),
        one(remaining(runs, samples), "remaining_profiles"),
        one(stores, "matrix_stores"),
        one(compares, "matrix_compares"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out.withColumns({"profile_storage": F.lit(contract["mode"]), "profile_min_cov": F.coalesce(F.lit(contract["min_cov"]).cast("string"), F.lit("NA"))})


def next_key(table: DataFrame, key: str, new: DataFrame, *order: str) -> DataFrame:
    """new with keys that go on from the largest in table, in the given order."""
    from pyspark.sql import Window as W

    top = table.agg(F.coalesce(F.max(key), F.lit(0)).alias("top"))
    return new.crossJoin(F.broadcast(top)).withColumn(key, F.col("top") + F.row_number().over(W.orderBy(*order))).drop("top")


def checksum(table: DataFrame) -> DataFrame:
    """Row count and an order-free hash that tells nulls apart."""
    return table.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"}))).alias("hash"))


def store_counts(stores: DataFrame, store_samples: DataFrame) -> DataFrame:
    """stores with profile_count brought up to the samples they hold."""
    n = store_samples.groupBy("matrix_id").agg(F.count_distinct("sample_id").alias("held"))
    return stores.join(n, "matrix_id", "left").withColumn("profile_count", F.coalesce("held", F.lit(0)).cast("bigint")).drop("held")


def store_filters(stores: DataFrame, matrix_id: str) -> dict:
    """The thresholds a matrix was built with; appends use them again."""
    row = stores.filter(F.col("matrix_id") == matrix_id).first()
    if row is None:
        raise ValueError(f"no matrix {matrix_id}")
    return {k: row[k] for k in ("min_coverage", "min_breadth", "min_ber", "min_sylph_abundance") if row[k] is not None}
