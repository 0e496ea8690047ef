"""Canonical forms, entity types and entity tables without fuzzy matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onomast.functions.text import stripped, titled
from onomast.schema import PERSON, PERSON_SET, VARIATION, stored_confidence
from onomast.scratch import stored


def entity_type(category: Column) -> Column:
    """People named together are stored as people."""
    return F.when(category == PERSON_SET, F.lit(PERSON)).otherwise(category)


def canonical_form(normalized: Column, entity_type: Column) -> Column:
    """A person of the form SURNAME, REST keeps its rest; everything else is put in title case."""
    parts = F.split(normalized, ",")
    surname_first = F.concat(stripped(titled(parts[0])), F.lit(", "), stripped(parts[1]))
    return F.when((entity_type == PERSON) & (F.size(parts) == 2), surname_first).otherwise(titled(normalized))


def by_name(names: DataFrame) -> DataFrame:
    """Equal names of a type counted, with their first and last sight and their canonical form: that is worked out once a name, not once a record.

    Names of records, or of records summed up (see ``plans.resolve.summed``), with n, first_seen and last_seen.
    """
    n, first, last = (F.sum("n"), "first_seen", "last_seen") if "n" in names.columns else (F.count(F.lit(1)), "seen_at", "seen_at")
    per = names.groupBy("entityType", "normalized").agg(
        n.alias("n"), F.min(first).alias("first_seen"), F.max(last).alias("last_seen"), F.min(F.struct("order", "confidence")).alias("first")
    )
    return per.withColumn("canonicalName", canonical_form(F.col("normalized"), F.col("entityType")))


def exact_entities(names: DataFrame) -> DataFrame:
    """Entities of equal canonical form, one row each in the form of the entity table.

    ``names`` has entityType, normalized, confidence, seen_at and order (unique within a record is enough: ties go to the
    smaller name), or is of records summed up. Variations come in the order in which they were first met; ids follow the entities' first appearance.
    """
    per_name = by_name(names)
    variation = F.struct(F.col("normalized").alias("variation_text"), F.col("n").alias("occurrence_count"), F.lit(1.0).alias("association_confidence"), "first_seen", "last_seen")
    grouped = per_name.groupBy("entityType", "canonicalName").agg(
        F.array_sort(F.collect_list(F.struct("first.order", "normalized", variation.alias("v")))).alias("found"), F.min(F.struct("first.order", "first.confidence")).alias("first"), F.min("first_seen").alias("created_at"), F.max("last_seen").alias("updated_at")
    )
    return with_ids(grouped.select(
        F.col("first.order").alias("first_order"), "canonicalName", "entityType", stored_confidence(F.col("first.confidence")).alias("classification_confidence"), F.lit(1.0).alias("grouping_confidence"),
        F.transform("found", lambda x: x["v"]).cast(f"array<{VARIATION}>").alias("variations"), "created_at", "updated_at",
    ))


def with_ids(entities: DataFrame, after: int = 0) -> DataFrame:
    """Number entities from ``after`` + 1 on by (first_order, canonicalName, entityType), which is dropped.

    Rows are dealt out by ranges of that order and numbered within; only the ranges' sizes pass through the driver.
    """
    spark, order = entities.sparkSession, ["first_order", "canonicalName", "entityType"]
    ranged = entities.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("_mono", F.monotonically_increasing_id()), "entities")  # ranges are drawn anew when worked out again
    part = F.shiftright("_mono", 33)
    sizes = placed.groupBy(part.alias("p")).count().collect()
    starts, at = {}, after
    for p, n in sorted((r.p, r["count"]) for r in sizes):
        starts[p] = at
        at += n
    offsets = F.broadcast(spark.createDataFrame(list(starts.items()), "_part int, _start long"))  # a row a range
    return placed.join(offsets, part.cast("int") == F.col("_part")).select((F.col("_start") + F.col("_mono").bitwiseAND((1 << 33) - 1) + 1).cast("long").alias("id"), *[c for c in entities.columns if c != "first_order"])


def numbered(entities: DataFrame, last: int = 0) -> DataFrame:
    """Entities with an id (or null) and first_order: those without one are numbered from ``last`` + 1 on, as by :func:`with_ids`."""
    if not last:
        return with_ids(entities.drop("id"))
    whole = stored(entities, "entities")
    return whole.where("id is not null").drop("first_order").unionByName(with_ids(whole.where("id is null").drop("id"), last))
