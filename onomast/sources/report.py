"""Tab-separated reports of the entity table, and questions asked of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onomast.schema import PERSON
from onomast.sources.entities import consolidated

COLUMNS = ("canonicalName", "entityType", "variations", "occurrenceCounts")


def report_rows(entities: DataFrame) -> DataFrame:
    """Variations and their counts as two lists joined by semicolons, in the same order."""
    texts = F.array_join(F.transform("variations", lambda v: v["variation_text"]), ";")
    counts = F.array_join(F.transform("variations", lambda v: v["occurrence_count"].cast("string")), ";")
    return entities.select("id", "canonicalName", "entityType", texts.alias("variations"), counts.alias("occurrenceCounts"))


def _lines(entities: DataFrame) -> DataFrame:
    rows = report_rows(entities)
    field = lambda c: F.when(F.col(c).rlike(r"[\t\r\n]"), F.raise_error(F.concat(F.lit("no tab or line break may stand in "), F.col(c))).cast("string")).otherwise(F.col(c))
    return rows.select("id", F.concat_ws("\t", *[field(c) for c in COLUMNS]).alias("value"))


def report_lines(entities: DataFrame) -> DataFrame:
    """The report as lines of text: no quotes, tabs between fields. A tab or line break inside a field is an error."""
    return _lines(entities).orderBy("id").select("value")


def write_report(entities: DataFrame, path: str, deduplicated: bool = False) -> None:
    """Write the report as text with a header; with ``deduplicated`` equal names are merged first.

    The folder's files follow one another in the order of ids, the first begins with the header; a small report is one file.
    """
    rows = _lines(consolidated(entities) if deduplicated else entities)
    head = entities.sparkSession.createDataFrame([(-1, "\t".join(COLUMNS))], "id bigint, value string")
    head.unionByName(rows).orderBy("id").select("value").write.mode("overwrite").text(path)


def entity_count(entities: DataFrame) -> DataFrame:
    return entities.agg(F.count(F.lit(1)).alias("entities"))


def count_by_type(entities: DataFrame) -> DataFrame:
    return entities.groupBy("entityType").agg(F.count(F.lit(1)).alias("entities")).orderBy(F.desc("entities"), "entityType")


def most_varied_people(entities: DataFrame, n: int = 5) -> DataFrame:
    return entities.where(F.col("entityType") == PERSON).select("canonicalName", F.size("variations").alias("variations")).orderBy(F.desc("variations"), "canonicalName").limit(n)


def names_with_digits(entities: DataFrame, n: int = 10) -> DataFrame:
    return entities.where(F.col("canonicalName").rlike("[0-9]")).select("id", "canonicalName", "entityType").orderBy("id").limit(n)


def mean_confidences(entities: DataFrame) -> DataFrame:
    return entities.agg(F.avg("classification_confidence").alias("classification"), F.avg("grouping_confidence").alias("grouping"))


def first_entities(entities: DataFrame, n: int = 5) -> DataFrame:
    return entities.select("id", "canonicalName", "entityType").orderBy("id").limit(n)
