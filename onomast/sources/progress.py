"""The progress ledger: which records were processed, in which batch, and a few named values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onomast.schema import LEDGER, METADATA


def first_marks(marks: DataFrame) -> DataFrame:
    """Of several marks of one record the first holds."""
    return marks.groupBy("record_id").agg(F.min(F.struct("processed_at", "batch_number")).alias("m")).select("record_id", "m.processed_at", "m.batch_number")


def unprocessed(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """Records that the ledger does not hold."""
    return records.join(ledger.select("record_id"), "record_id", "left_anti")


def latest_values(metadata: DataFrame) -> DataFrame:
    """Of several values of a key the last set holds."""
    return metadata.groupBy("key").agg(F.max_by("value", "updated_at").alias("value"))


def batch_counts(ledger: DataFrame) -> DataFrame:
    return first_marks(ledger).groupBy("batch_number").agg(F.count(F.lit(1)).alias("records"))


def dealt_into_batches(records: DataFrame, order: str, size: int) -> DataFrame:
    """Number batches of ``size`` records in the order of a column of unique rising numbers from 0."""
    return records.withColumn("batch_number", (F.floor(F.col(order) / size) + 1).cast("int"))


class Progress:
    """A ledger in a folder, a part for each batch.

    With ``upto`` only marks of batches up to that number hold: a run marks its batch first and the entity table then makes
    it valid (see ``EntityStore.batch``); a run that breaks off in between has marked nothing.
    """

    def __init__(self, spark: SparkSession, path: str, upto: Callable[[], int] | None = None):
        self.spark, self.path, self.upto = spark, path.rstrip("/"), upto
        jvm = spark.sparkContext._jvm
        self._at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _read(self, name: str, schema: str) -> DataFrame:
        there = self._fs.exists(self._at(f"{self.path}/{name}"))
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def marks(self) -> DataFrame:
        """All marks that hold; a record may have several."""
        found = self._read("ledger", LEDGER)
        return found.where(F.col("batch_number") <= self.upto()) if self.upto else found

    def ledger(self) -> DataFrame:
        return first_marks(self.marks())

    def is_processed(self, record_id: str) -> bool:
        return bool(self.marks().where(F.col("record_id") == record_id).limit(1).count())

    def mark(self, ids: DataFrame, batch: int, anew: bool = False) -> None:
        """Mark the record_id of every row, by one write. ``anew``: in place of what an earlier try marked under this number."""
        new = ids.select("record_id").distinct() if anew else unprocessed(ids.select("record_id").distinct(), self.marks())
        marked = new.select("record_id", F.current_timestamp().alias("processed_at"), F.lit(batch).cast("int").alias("batch_number"))
        marked.write.mode("overwrite" if anew else "append").parquet(f"{self.path}/ledger/b{batch}")

    def total(self) -> int:
        return self.ledger().count()

    def count_of_batch(self, batch: int) -> int:
        return self.ledger().where(F.col("batch_number") == batch).count()

    def latest_batch(self) -> int:
        return self.marks().agg(F.coalesce(F.max("batch_number"), F.lit(0))).first()[0]

    def set_value(self, key: str, value: str) -> None:
        self.spark.createDataFrame([(key, value)], "key string, value string").withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(f"{self.path}/metadata")

    def value(self, key: str) -> str | None:
        row = latest_values(self._read("metadata", METADATA)).where(F.col("key") == key).first()
        return row.value if row else None

    def reset(self) -> None:
        for name in ("ledger", "metadata"):
            self._fs.delete(self._at(f"{self.path}/{name}"), True)
