"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Null ids sort after every other id.
LAST_ID = 2**63 - 1
_WRITTEN: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="strandloom-")
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: its lineage is cut and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strandloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def kept_until_exit(spark: SparkSession, path: str) -> None:
    _WRITTEN.append((spark, path))


def stored_so_far() -> int:
    """A mark for drop_stored()."""
    return len(_WRITTEN)


def drop_stored(mark: int = 0) -> None:
    """Deletes what stored() has written in this process since the mark."""
    while len(_WRITTEN) > mark:
        spark, path = _WRITTEN.pop()
        try:
            delete(spark, path)
        except Exception:  # the session has ended: nothing can be reached any more
            continue


atexit.register(drop_stored)


def give_back() -> None:
    """Freed memory goes back to the system: Python workers stay after their tasks, and what they hold counts while later stages run."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        return


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(run, schema); each task gives back its memory when it ends."""

    def ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(ending, schema)


def arrow_map(df: DataFrame, fn: Callable[..., Iterator[dict] | dict], schema: str) -> DataFrame:
    """fn(*columns as Python lists) returns a dict of column lists for each Arrow batch; no batch becomes a pandas frame."""
    fields = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(*[c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return map_batches(df, run, schema)


def id_key(column: str = "doc_id"):
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))

