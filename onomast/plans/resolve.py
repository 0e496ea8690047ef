"""Whole runs: records to names (one stage of narrow work), names to entities, entities to the store and the report."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from onomast.config import Settings
from onomast.operators.atomize import atomize, names
from onomast.operators.canonical import entity_type, exact_entities
from onomast.operators.classify import classify, sanitized
from onomast.operators.cluster import graph_entities, leader_entities
from onomast.operators.ner import Recogniser, refine
from onomast.operators.normalize import normalize
from onomast.schema import stored_confidence
from onomast.scratch import stored, temporary
from onomast.sources.entities import EntityStore, merged, sound_entities
from onomast.sources.progress import Progress, unprocessed
from onomast.sources.records import first_rows, read_records, with_text
from onomast.sources.report import write_report
from onomast.streaming.metrics import TARGET


def classified(records: DataFrame, recogniser: Callable[[], Recogniser] | None = None) -> DataFrame:
    """Records (with ``collector_text``) and their ``classification``; null where nothing is left of the text."""
    out = classify(records)
    return refine(out, recogniser) if recogniser else out


def resolved_names(records: DataFrame, recogniser: Callable[[], Recogniser] | None = None) -> DataFrame:
    """One row for each name of each record that could be classified: name, normalized, entityType, confidence, position.

    Columns of the records stay. No shuffle.
    """
    # not "classification is not null": pushed down, that would work the decision list out twice
    return names_of(classified(records.where(F.length(sanitized(F.col("collector_text"))) > 0), recogniser))


def by_text(records: DataFrame, work: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """``records`` with what ``work`` makes of their ``collector_text``; it is given each different text once and may give many rows for it, or none.

    Collectors' strings repeat, so the long expressions follow the different texts and not the records. What comes of them is stored: Spark
    knows its size when it joins, by broadcast if it is small, else by shuffle, where it splits the parts of very common texts.
    """
    return records.join(stored(work(different_texts(records)), label), "collector_text")


def summed(records: DataFrame, *by: str) -> DataFrame:
    """Records of one ``collector_text`` (and of one value of the columns ``by``) in one row, as a stored table: n, first_seen, last_seen, arrival and order of the first.

    Where only counts and the first and last sight are wanted this is the one pass over the records: what follows grows with the different texts.
    """
    per = records.groupBy("collector_text", *by).agg(F.count(F.lit(1)).alias("n"), F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), F.min("arrival").alias("arrival"))
    return stored(per, "summed").withColumn("order", arrival_order(F.col("arrival")))


def arrival_order(arrival: Column) -> Column:
    """A number of arrival as a string that sorts like it."""
    return F.lpad(arrival.cast("string"), 12, "0")


def different_texts(records: DataFrame) -> DataFrame:
    """Each ``collector_text`` once, as a stored table.

    It passes through an outer explosion: what the planner knows of a plain column it carries through all expressions made of it, and that takes it minutes.
    """
    return stored(records.select("collector_text").distinct(), "texts").select(F.explode_outer(F.array("collector_text")).alias("collector_text"))


def names_of(whole: DataFrame) -> DataFrame:
    """The names of classified records, see ``resolved_names``."""
    out = normalize(names(atomize(whole)))
    return out.withColumn("entityType", entity_type(F.col("category"))).withColumn("confidence", stored_confidence(F.col("confidence"))).drop("classification", "atoms", "problem", "reason")


def entities_of(names: DataFrame, settings: Settings, known: DataFrame | None = None) -> DataFrame:
    """The entity table after these names, going on from ``known``."""
    a = settings.algorithms
    weights = (a.levenshtein_weight, a.jaro_winkler_weight, a.phonetic_weight)
    if a.clustering == "exact":
        return exact_entities(names) if known is None else merged(known, exact_entities(names))
    made = {"leader": leader_entities, "graph": graph_entities}[a.clustering]
    return made(names, a.similarity_threshold, weights, known)


@dataclass
class Summary:
    """What a run did: records taken, rejected and skipped as done before, entities in all, calls of the recogniser, time."""

    processed: int
    rejected: int
    skipped: int
    entities: int
    recognised: int = 0
    seconds: float = 0.0

    @property
    def total(self) -> int:
        return self.processed + self.rejected + self.skipped

    @property
    def per_second(self) -> float:
        return self.processed / self.seconds if self.seconds > 0 else 0.0

    @property
    def on_track(self) -> bool:
        return self.per_second >= TARGET


def take_batch(todo: DataFrame, store: EntityStore, progress: Progress, settings: Settings, recogniser: Callable[[], Recogniser] | None = None) -> tuple[int, int, int]:
    """Resolve records (with ``collector_text``) that are not in the ledger, as one batch: numbers taken, rejected and recognised.

    With ``max_records`` so many valid records are taken, the first in the order of arrival. Rejected records among them go to the
    folder ``rejects`` beside the table, with the reason (nothing left of the text, or what the recogniser failed with), and are
    not marked; so do entities and spellings that break a constraint of the table. The ledger's part is written first; the
    table's new snapshot, which bears the batch's number, makes it valid. So a batch that breaks off at any point leaves the old
    state, and is simply taken again. Intermediate tables are deleted at the end.
    """
    with temporary(todo.sparkSession):
        return _taken(todo, store, progress, settings, recogniser)


def _taken(todo: DataFrame, store: EntityStore, progress: Progress, settings: Settings, recogniser: Callable[[], Recogniser] | None) -> tuple[int, int, int]:
    batch, most = store.batch() + 1, settings.processing.max_records
    judged = by_text(todo, lambda texts: classified(texts, recogniser), "classified")
    why = F.lit("nothing is left of the text")
    reason = F.when(F.col("classification").isNull(), F.coalesce(F.col("problem"), why) if recogniser else why)
    judged = stored(judged.withColumn("reason", reason), "judged")  # the decision list and the recogniser work once
    valid, rejects = judged.where("reason is null"), judged.where("reason is not null")
    if most:
        place = F.struct("order", "record_id")
        valid = first_rows(valid, most, "order", "record_id")
        last = valid.agg(F.count(F.lit(1)).alias("n"), F.max(place).alias("at")).first()
        if last.n == most:  # what comes later is left for another run
            rejects = rejects.where(place < F.struct(*[F.lit(x) for x in last.at]))
    rejects.drop("classification", "problem").write.mode("overwrite").parquet(f"{store.path}-rejects/b{batch}")
    each = valid.select("collector_text", "classification").dropDuplicates(["collector_text"])
    named = stored(names_of(each), "named")
    names = valid.drop("classification", "problem", "reason").join(named, "collector_text").withColumn("order", F.col("order").cast("string"))
    known = store.all() if store.batch() else None
    progress.mark(valid, batch, anew=True)
    entities, gone = sound_entities(stored(entities_of(names, settings, known), "made"))
    gone.write.mode("overwrite").parquet(f"{store.path}-rejects/b{batch}-entities")
    store.change_to(entities, batch)
    asked = F.coalesce(F.array_contains("classification.patterns_matched", "default_fallback"), F.col("problem").isNotNull()) if recogniser else F.lit(False)
    counts = judged.agg(F.count_if(asked).alias("asked")).first()
    return valid.count(), rejects.count(), counts.asked


def run(spark: SparkSession, settings: Settings, recogniser: Callable[[], Recogniser] | None = None) -> Summary:
    """Read, resolve, bring into the store, note progress, write the report.

    Records need record_id; an ``order`` column gives their order of arrival (the id, if there is none), ``seen_at`` their
    time (now, if there is none). The source is read once.
    """
    began = time.monotonic()
    store = EntityStore(spark, f"{settings.store.path}/entities")
    progress = Progress(spark, f"{settings.store.path}/progress", store.batch)
    if not settings.processing.resume:
        progress.reset()
    records = read_records(spark, settings.source.path, settings.source.format, settings.source.filter)
    for column, default in (("order", F.col("record_id").cast("string")), ("seen_at", F.current_timestamp())):
        if column not in records.columns:
            records = records.withColumn(column, default)
    seen = Observation()
    with temporary(spark):
        todo = stored(unprocessed(with_text(records).observe(seen, F.count(F.lit(1)).alias("n")), progress.marks()), "todo")
        skipped = seen.get["n"] - todo.count()
        processed, rejected, recognised = take_batch(todo, store, progress, settings, recogniser)
    if settings.output.report_path:
        write_report(store.all(), settings.output.report_path, settings.output.deduplicated)
    return Summary(processed, rejected, skipped, store.all().count(), recognised, time.monotonic() - began)
