"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onomast.scratch import discard, release, remove, scratch_path, shared_dir, stored

__all__ = ["ascii_lower", "discard", "hot_limit", "join_by_hot_key", "keep", "lean", "parallelism", "release", "remove", "scratch_path", "settle", "shared_dir", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_limit(spark: SparkSession, rows: int) -> int:
    """A key with more rows than this is hot: half a task's fair share.

    At most ``2 * parallelism`` keys can be hot, whatever the data, so a table of hot keys may be broadcast.
    """
    return max(1, -(-rows // (2 * parallelism(spark))))


def join_by_hot_key(left: DataFrame, right: DataFrame, key: str, weight: str, rows: int) -> DataFrame:
    """Left join on ``key`` where a few keys hold much of ``left``.

    ``right`` has one row a key, with ``weight`` rows of ``left`` each, ``rows`` in all. Hot keys (at most twice the
    number of shuffle partitions, see :func:`hot_limit`) are joined by broadcast, all others by shuffle.
    """
    limit = hot_limit(left.sparkSession, rows)
    hot = right.where(F.col(weight) > limit).drop(weight)
    cold = right.where(F.col(weight) <= limit).drop(weight)
    by_hot = left.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    names = [c for c in left.columns if c != key] + [c for c in cold.columns if c != key]
    first = by_hot.where(F.col("_hot").isNotNull()).select(key, *names)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "left").select(key, *names)
    return first.unionByName(rest)


_kept: dict[str, Callable[[], None]] = {}


def keep(owner: str, drop: Callable[[], None]) -> None:
    """Note that this Python worker holds something of the operator ``owner`` from task to task; ``drop`` lets it go."""
    _kept[owner] = drop


def settle(owner: str = "") -> None:
    """Let go of what operators other than ``owner`` keep in this worker, and hand freed memory back to the machine.

    A worker serves one operator after another and its memory counts as the executor's, so what one has left would add to what the next needs.
    """
    for x in [x for x in _kept if x != owner]:
        _kept.pop(x)()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def _settled(batches: Iterator[pa.RecordBatch], owner: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield b
        del b
        settle(owner)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, for ``mapInArrow``, with :func:`settle` at the start, after each batch read and at the end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle(owner)
        yield from run(_settled(batches, owner))
        settle(owner)

    return task


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
