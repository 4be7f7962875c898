"""Shared folder, materialised steps and small helpers of the llm operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where the setting is absent (tests, a local session) a temporary folder is used."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='lintel-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


_scopes: list[list[str]] = []


def new_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder; the innermost open scratch() deletes it at its end."""
    path = f"{shared_dir(spark)}/lintel/{what}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes the tables that were written inside, other than those it is told to keep: they go to the scope around.

    What is still to be read after the end may depend on kept tables only."""
    mine: list[str] = []
    depth = len(_scopes)
    _scopes.append(mine)

    def keep(df: DataFrame) -> DataFrame:
        mine.remove(df._written_path)
        if depth:
            _scopes[depth - 1].append(df._written_path)
        return df

    try:
        yield keep
    finally:
        del _scopes[depth:]
        for path in mine:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(df: DataFrame) -> None:
    """Delete a table of written()."""
    _delete(df.sparkSession, df._written_path)


def written(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: the lineage is cut, and a lost
    executor costs no more than the tasks it ran."""
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._written_path = path
    return out


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of a Python task, which gives memory back to the system at its end: workers live on idle."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return tidied


def spread(df: DataFrame) -> DataFrame:
    """df dealt out anew where it comes in no more partitions than there are cores, as small files of one row group do:
    else a few tasks would do all the work on texts. Larger inputs are left as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > cores else df.repartition(2 * cores)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of data frames that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
