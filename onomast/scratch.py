"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset one of our own serves, but only if all work is done on this machine: executors elsewhere would not see it.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='onomast-')}"
        sc.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    if _scopes:
        _scopes[-1].append(path)
    return out


_scopes: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what :func:`stored` has written meanwhile; no table read later may be made of it."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`stored` that no later plan reads."""
    path = getattr(df, "_stored_at", None)
    if path:
        remove(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Have the driver forget plans that nothing holds any more: Spark deletes their shuffle files when they are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
