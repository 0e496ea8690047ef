"""Source records: any format that Spark reads, filtered by equality, with the collector's text picked out."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onomast.functions.text import non_empty
from onomast.scratch import stored


def matching(df: DataFrame, equals: Mapping[str, Any] | None) -> DataFrame:
    """Rows in which every named column has the given value; pushed down to the scan."""
    for name, value in (equals or {}).items():
        df = df.where(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return df


def read_records(spark: SparkSession, path: str, format: str = "parquet", equals: Mapping[str, Any] | None = None, **options: Any) -> DataFrame:
    return matching(spark.read.format(format).options(**options).load(path), equals)


def stream_records(spark: SparkSession, path: str, schema: str, format: str = "parquet", equals: Mapping[str, Any] | None = None, files_per_batch: int = 1) -> DataFrame:
    """The same as a stream of files, so many in a batch."""
    return matching(spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path), equals)


#: Rows from which a bound of the first rows is drawn.
_DRAWN = 10_000


def _beginning(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The rows up to some place of the order, with the first ``n`` among them: where that place is comes from a sample, whether it is enough from a count."""
    total = df.count()
    if total <= 4 * n:
        return df
    steps = 1 << 40
    drawn = df.where(F.pmod(F.xxhash64(*order), F.lit(steps)) < int(steps * min(1.0, _DRAWN / total))).select(*order)
    last = drawn.orderBy(*order).limit(int(1.3 * _DRAWN * n / total) + 50).agg(F.max(F.struct(*order)).alias("at"), F.count(F.lit(1)).alias("n")).first()
    if not last.n:
        return df
    kinds = dict(df.dtypes)
    near = stored(df.where(F.struct(*order) <= F.struct(*[F.lit(x).cast(kinds[c]).alias(c) for c, x in zip(order, last.at, strict=True)])), "beginning")
    return near if near.count() >= n else df


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the order of some columns, as a stored table.

    Rows far behind are left out first. The others are dealt out by ranges of that order; of these only the sizes are counted, so neither the driver nor
    one task sorts all.
    """
    placed = stored(_beginning(df, n, *order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", 33)
    left, last, within = n, -1, 0
    for p, size in sorted((r.p, r.n) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):  # a row a range
        if left <= 0:
            break
        last, within = p, min(left, size)
        left -= size
    row = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.where((part < last) | ((part == last) & (row < within))).drop("_at")


def record_id(id_col: str = "_id") -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def collector_text(df: DataFrame, first: str = "collector", second: str = "recordedBy") -> Column:
    """The first column unless it is null or empty, else the second; empty without either."""
    have = [non_empty(F.col(c)) for c in (first, second) if c in df.columns]
    return F.coalesce(*have, F.lit(""))


def with_text(df: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Records that have a collector's text, as ``collector_text``, and their id as ``record_id``."""
    return df.withColumn("record_id", record_id(id_col)).withColumn("collector_text", collector_text(df)).where(F.length("collector_text") > 0)
