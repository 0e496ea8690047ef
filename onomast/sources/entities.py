"""The entity table: Parquet snapshots, partitioned by type, with a pointer to the current one.

Plain Parquet has no row updates. A change writes a new snapshot beside the old ones, whole or of the changed entities only, so a
reader sees the old or the new table and a failed write leaves the old one standing. What is current is the last whole snapshot
with the changes after it, of each entity the newest; after some changes a whole one is written again. A snapshot's name says
which batch of records it holds last, so what was done and what came of it are made valid by one and the same step.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from onomast.operators.canonical import with_ids
from onomast.schema import ENTITY, LEAST_CONFIDENCE, VARIATION, entity_problems, stored_confidence


class EntityStore:
    def __init__(self, spark: SparkSession, path: str, keep: int = 2, changes: int = 8):
        """``keep`` whole snapshots stay, with the changes after them; after so many ``changes`` a whole one is written."""
        self.spark, self.path, self.keep, self.changes = spark, path.rstrip("/"), max(1, keep), changes
        jvm = spark.sparkContext._jvm
        self._at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _snapshots(self) -> list[tuple[int, int, str]]:
        """(number, batch, name) of the snapshots that were written whole, rising; names of changes end in ``-changes``."""
        if not self._fs.exists(self._at(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(self.path))]
        found = [(int(m[1]), int(m[2]), n) for n in names if (m := re.fullmatch(r"v(\d+)-b(\d+)(-changes)?", n)) and self._fs.exists(self._at(f"{self.path}/{n}/_SUCCESS"))]
        return sorted(found)

    def _current(self) -> list[str]:
        """Names of the last whole snapshot and of the changes after it."""
        names = [n for _, _, n in self._snapshots()]
        whole = max((i for i, n in enumerate(names) if not n.endswith("-changes")), default=0)
        return names[whole:]

    def versions(self) -> list[int]:
        """Numbers of the snapshots that were written whole, rising."""
        return [n for n, _, _ in self._snapshots()]

    def batch(self) -> int:
        """The last batch of records whose entities the table holds; 0 before the first."""
        return self._snapshots()[-1][1] if self._snapshots() else 0

    def all(self) -> DataFrame:
        found = self._current()
        if not found:
            return self.spark.createDataFrame([], ENTITY)
        names = [x.name for x in self.spark.createDataFrame([], ENTITY).schema]
        parts = [self.spark.read.schema(ENTITY).parquet(f"{self.path}/{n}").select(*names) for n in found]
        if len(parts) == 1:
            return parts[0]
        changed = reduce(DataFrame.unionByName, [p.withColumn("_at", F.lit(i)) for i, p in enumerate(parts[1:])])
        newest = changed.groupBy("id").agg(F.max_by(F.struct(*names), "_at").alias("e")).select("e.*")
        return parts[0].join(changed.select("id"), "id", "left_anti").select(*names).unionByName(newest)

    def of_type(self, entity_type: str) -> DataFrame:
        """Entities of one type; other types' files are not read."""
        return self.all().where(F.col("entityType") == entity_type)

    def by_name(self, upper_name: str, entity_type: str) -> DataFrame:
        """The oldest entity whose canonical name in capitals is the given one, or none."""
        return self.of_type(entity_type).where(F.upper("canonicalName") == upper_name).orderBy("id").limit(1)

    def replace(self, entities: DataFrame, batch: int | None = None) -> None:
        """Make ``entities`` the current table, up to the given batch of records (the present one, if none is given).

        Rows that break a constraint are an error, and change nothing.
        """
        self._write(entities, batch, "")

    def change_to(self, entities: DataFrame, batch: int | None = None) -> None:
        """As ``replace``, but only entities that are new or differ are written, so what is written follows the change and not the table.

        ``entities`` is worked out more than once: it should be a stored table. Where an entity is gone, or enough changes have gathered, the
        table is written whole.
        """
        current = self._current()
        if not current or len(current) > self.changes:
            return self.replace(entities, batch)
        names = [x.name for x in self.spark.createDataFrame([], ENTITY).schema]
        old = self.all().select("id", F.xxhash64(*names).alias("_mark"))
        if not old.join(entities.select("id"), "id", "left_anti").isEmpty():
            return self.replace(entities, batch)
        changed = entities.withColumn("_mark", F.xxhash64(*names)).join(old, ["id", "_mark"], "left_anti").drop("_mark")
        return self._write(changed, batch, "-changes")

    def _write(self, entities: DataFrame, batch: int | None, kind: str) -> None:
        number, last, _ = (self._snapshots() or [(0, 0, "")])[-1]
        batch = last if batch is None else batch
        bad = entity_problems(F.col("classification_confidence"), F.col("grouping_confidence"), F.col("entityType"), F.col("variations"))
        sound = F.when(F.size(bad) == 0, F.col("entityType")).otherwise(F.raise_error(F.concat(F.lit("unsound entity: "), F.array_join(bad, ", "))).cast("string"))
        names = [x.name for x in self.spark.createDataFrame([], ENTITY).schema]
        entities.select(*names).withColumn("entityType", sound).write.mode("overwrite").partitionBy("entityType").parquet(f"{self.path}/v{number + 1}-b{batch}{kind}")
        found = self._snapshots()
        whole = [i for i, (_, _, n) in enumerate(found) if not n.endswith("-changes")]
        for _, _, n in found[: whole[-self.keep] if len(whole) >= self.keep else 0]:
            self._fs.delete(self._at(f"{self.path}/{n}"), True)

    def upsert(self, new: DataFrame, batch: int | None = None) -> None:
        self.replace(merged(self.all(), new), batch)

    def consolidate(self) -> int:
        """Merge entities of one canonical name and type; gives how many groups there were."""
        now = self.all()
        groups = duplicate_groups(now).count()
        if groups:
            self.replace(consolidated(now))
        return groups

    def reset(self) -> None:
        self._fs.delete(self._at(self.path), True)


def sound_entities(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entities without what breaks a constraint, and (canonicalName, entityType, reason) of what had to go.

    Variations go by themselves where an entity keeps others; an entity goes with all of them.
    """
    fine = lambda v: (v["occurrence_count"] >= 1) & v["association_confidence"].between(LEAST_CONFIDENCE, 1.0)
    problems = lambda variations: entity_problems(F.col("classification_confidence"), F.col("grouping_confidence"), F.col("entityType"), variations)
    kept = entities.withColumn("_kept", F.filter("variations", fine)).withColumn("_bad", problems(F.col("variations")))
    whole = F.size(problems(F.col("_kept"))) == 0
    good = kept.where(whole).withColumn("variations", F.col("_kept")).drop("_kept", "_bad")
    gone = kept.where(F.size("_bad") > 0).select("canonicalName", "entityType", F.concat(F.when(whole, F.lit("without unsound ")).otherwise(F.lit("unsound ")), F.array_join("_bad", ", ")).alias("reason"))
    return good, gone


def merged_variations(exploded: DataFrame, *keys: str) -> DataFrame:
    """One row for each key with the variations of all its rows merged, in the order of (rank, place) where first met.

    ``exploded`` has the keys, rank, place and v (a variation). Equal texts (case counts) become one: counts are added,
    the association of the first is kept, sights are widened.
    """
    per = exploded.groupBy(*keys, F.col("v.variation_text").alias("text")).agg(
        F.sum("v.occurrence_count").alias("n"), F.min(F.struct("rank", "place", "v.association_confidence")).alias("first"), F.min("v.first_seen").alias("first_seen"), F.max("v.last_seen").alias("last_seen")
    )
    v = F.struct(F.col("text").alias("variation_text"), F.col("n").alias("occurrence_count"), F.col("first.association_confidence").alias("association_confidence"), "first_seen", "last_seen")
    return per.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("first.rank", "first.place", v.alias("v")))), lambda x: x["v"]).cast(f"array<{VARIATION}>").alias("variations"))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """The table after adding ``new``: entities of equal type and canonical name (case aside) are merged, others get new ids.

    The oldest entity keeps its id, time of making and classification confidence; name and grouping confidence are the
    newest. Ids of ``new`` play no part.
    """
    both = old.withColumn("rank", F.lit(0)).unionByName(new.withColumn("id", F.lit(None).cast("long")).withColumn("rank", F.lit(1)))
    keyed = both.withColumn("name_key", F.upper("canonicalName"))
    # rows of the old table that share a key stay apart: only the oldest takes new variations
    first = Window.partitionBy("entityType", "name_key")
    keyed = keyed.withColumn("target", F.when(F.col("rank") == 0, F.col("id")).otherwise(F.min("id").over(first))).withColumn("newcomer", F.when(F.col("target").isNull(), F.col("name_key")))
    keys = ("entityType", "target", "newcomer")
    heads = keyed.groupBy(*keys).agg(
        F.min(F.struct("rank", "created_at", "canonicalName", "classification_confidence")).alias("oldest"), F.max(F.struct("rank", "updated_at", "canonicalName", "grouping_confidence")).alias("newest")
    )
    lists = merged_variations(keyed.select(*keys, "rank", F.posexplode("variations").alias("place", "v")), *keys)
    same = (F.col("h.entityType") == F.col("l.entityType")) & F.col("h.target").eqNullSafe(F.col("l.target")) & F.col("h.newcomer").eqNullSafe(F.col("l.newcomer"))
    whole = heads.alias("h").join(lists.alias("l"), same).select(
        F.col("h.target").alias("id"), F.col("newest.canonicalName").alias("canonicalName"), F.col("h.entityType").alias("entityType"), stored_confidence(F.col("oldest.classification_confidence")).alias("classification_confidence"),
        F.col("newest.grouping_confidence").alias("grouping_confidence"), F.col("l.variations").alias("variations"), F.col("oldest.created_at").alias("created_at"), F.col("newest.updated_at").alias("updated_at"),
    )
    last = old.agg(F.max("id")).first()[0] or 0
    made = with_ids(whole.where("id is null").drop("id").withColumn("first_order", F.col("created_at").cast("string")), last)
    return whole.where("id is not null").unionByName(made)


def duplicate_groups(entities: DataFrame) -> DataFrame:
    """canonicalName, entityType and count of those that occur more than once."""
    return entities.groupBy("canonicalName", "entityType").agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def consolidated(entities: DataFrame) -> DataFrame:
    """One entity for each (canonicalName, entityType): the lowest id stays, variations are merged in the order of ids."""
    keys = ("canonicalName", "entityType")
    heads = entities.groupBy(*keys).agg(F.min_by(F.struct("id", "classification_confidence", "grouping_confidence", "created_at"), "id").alias("h"), F.max("updated_at").alias("updated_at"))
    lists = merged_variations(entities.select(*keys, F.col("id").alias("rank"), F.posexplode("variations").alias("place", "v")), *keys)
    return heads.join(lists, list(keys)).select("h.id", "canonicalName", "entityType", "h.classification_confidence", "h.grouping_confidence", "variations", "h.created_at", "updated_at")


def variations_json(variations: Column) -> Column:
    """Variations as JSON text with ISO timestamps, for stores that have no nested types."""
    plain = F.transform(variations, lambda v: F.struct(
        v["variation_text"].alias("variation_text"), v["occurrence_count"].alias("occurrence_count"), v["association_confidence"].alias("association_confidence"),
        F.date_format(v["first_seen"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("first_seen"), F.date_format(v["last_seen"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("last_seen"),
    ))
    return F.to_json(plain)


def variations_from_json(text: Column) -> Column:
    return F.from_json(text, f"array<{VARIATION}>")
