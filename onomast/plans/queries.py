"""The registered queries, and the same in SQL where another engine can tell."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onomast.functions.similarity import jaro_winkler_score, levenshtein_score, metaphone, prepared, similarity_score
from onomast.functions.text import titled
from onomast.operators import ner
from onomast.operators.atomize import atomize
from onomast.operators.canonical import canonical_form, exact_entities, with_ids
from onomast.operators.classify import classify, needs_review, sanitized
from onomast.operators.cluster import distinct_names, graph_entities, leader_entities
from onomast.operators.cluster import similar_pairs as pairs_over_threshold
from onomast.operators.ner import Recogniser, discards, improved, person_name
from onomast.operators.normalize import normalized
from onomast.plans.fixture import records, records_sql
from onomast.plans.resolve import arrival_order, by_text, different_texts, resolved_names, summed
from onomast.schema import NER_SPAN, stored_confidence
from onomast.scratch import scratch_path, stored
from onomast.sources import progress, report
from onomast.sources.entities import EntityStore, consolidated, duplicate_groups, merged, merged_variations, variations_from_json, variations_json
from onomast.sources.records import first_rows, matching, stream_records, with_text
from onomast.sources.report import write_report
from onomast.streaming import incremental

_PLANTS = {"kingdom": "Plantae"}


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant records with a collector's text, in the shape that the stages read."""
    return with_text(matching(records(spark, sf_dir), _PLANTS)).withColumn("order", arrival_order(F.col("arrival")))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_text(_texts(spark, sf_dir), resolved_names, "names")


def _summed_names(spark: SparkSession, sf_dir: str, **by: Column) -> DataFrame:
    """The names of records summed up by their text and the columns ``by``, which are made of seen_at and arrival."""
    return by_text(summed(_texts(spark, sf_dir).withColumns(by) if by else _texts(spark, sf_dir), *by), resolved_names, "names")


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_text(_texts(spark, sf_dir), classify, "classified")


def resolve_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: collector strings to names to counts, one shuffle."""
    return _summed_names(spark, sf_dir).groupBy("entityType", "normalized").agg(F.sum("n").alias("n"))


def source_filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching(records(spark, sf_dir), _PLANTS).agg(F.count(F.lit(1)).alias("records"))


def collector_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("record_id", "collector_text")


def sanitize_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("record_id", sanitized(F.col("collector_text")).alias("sanitized_text"))


def classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("classification")
    return _classified(spark, sf_dir).where("classification is not null").select("record_id", c["category"].alias("category"), c["confidence"].alias("confidence"), F.array_join(c["patterns_matched"], ",").alias("patterns"), c["should_atomize"].alias("should_atomize"), needs_review(c["confidence"]).alias("needs_review"))


def classify_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_rules(spark, sf_dir).groupBy("category", "patterns").agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("confidence"))


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).agg(F.count_if(F.col("classification").isNull()).alias("rejected"), F.count_if(F.col("classification").isNotNull()).alias("processed"))


def atomize_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    # an outer explode, so that no filter on the atoms is worked out beside them
    atoms = lambda texts: atomize(classify(texts)).select("collector_text", F.explode_outer("atoms").alias("a")).select("collector_text", "a.position", "a.text", "a.separator_used").where("position is not null")
    return by_text(_texts(spark, sf_dir), atoms, "atoms").select("record_id", "position", "text", "separator_used")


def names_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("record_id", "position", "name")


def normalize_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("record_id", "position", "normalized", F.array_join("rules_applied", ",").alias("rules"))


def type_map_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summed_names(spark, sf_dir).groupBy("category", "entityType", "confidence").agg(F.sum("n").alias("n"))


def canonical_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved_names(different_texts(_texts(spark, sf_dir))).select("entityType", "normalized").distinct().withColumn("canonicalName", canonical_form(F.col("normalized"), F.col("entityType")))


def title_case_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title case of the words of whole documents, counted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(F.explode(F.split("text", r"(?U)\s+")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("w <> ''").select("w", titled(F.col("w")).alias("titled"), "n")


def classify_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision list on free text of several languages: how often each rule decides."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("text").alias("collector_text"))
    return classify(turns).groupBy(F.col("classification.category").alias("category"), F.array_join("classification.patterns_matched", ",").alias("patterns")).agg(F.count(F.lit(1)).alias("n"))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored, as a self-join would otherwise work them out once for each side."""
    names = resolved_names(different_texts(_texts(spark, sf_dir)))
    return stored(names.groupBy("entityType", "normalized").count().where("entityType = 'Pessoa'").select("normalized"), "people")


def _close_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of people whose names begin with the same three letters."""
    own = _people(spark, sf_dir).withColumn("block", F.substring("normalized", 1, 3))
    return own.select("block", F.col("normalized").alias("a")).join(own.select("block", F.col("normalized").alias("b")), "block").where("a < b").select("a", "b")


def lev_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _close_pairs(spark, sf_dir).select("a", "b", F.round(levenshtein_score(F.col("a"), F.col("b")), 9).alias("score"))


def jw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _close_pairs(spark, sf_dir).select("a", "b", F.round(jaro_winkler_score(F.col("a"), F.col("b")), 9).alias("score"))


def prepared_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("normalized", prepared(F.col("normalized")).alias("prepared"))


def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full scores, the phonetic part included."""
    return _close_pairs(spark, sf_dir).select("a", "b", F.round(similarity_score(F.col("a"), F.col("b")), 9).alias("score"))


_stores: dict[tuple[str, str], EntityStore] = {}


def _store(spark: SparkSession, sf_dir: str) -> EntityStore:
    """The entity table of the tables in a folder, made at its first use in an application and read from then on."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        store = EntityStore(spark, scratch_path(spark, "store"))
        store.replace(exact_entities(_summed_names(spark, sf_dir)), 1)
        _stores[key] = store
    return _stores[key]


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).all()


def entities_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_entities(_summed_names(spark, sf_dir)).select("canonicalName", "entityType", "classification_confidence", F.size("variations").alias("n_variations"), F.aggregate("variations", F.lit(0).cast("long"), lambda n, v: n + v["occurrence_count"]).alias("occurrences"), "created_at", "updated_at")


def entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(spark, sf_dir).select("id", "canonicalName", "entityType")


def entities_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One type's entities; the other types' files are not read."""
    return _store(spark, sf_dir).of_type("GrupoPessoas").select("id", "canonicalName")


def entity_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).by_name("SEM COLETOR", "NaoDeterminado").select("id", "canonicalName", "classification_confidence")


def _run_ledger(spark: SparkSession, sf_dir: str) -> progress.Progress:
    """A ledger of records in three batches, of which the last was never made valid and the second was marked anew."""
    ledger = progress.Progress(spark, scratch_path(spark, "progress"), lambda: 2)
    ids = _texts(spark, sf_dir).select("record_id", "arrival")
    ledger.mark(ids.where("arrival % 5 = 0"), 1)
    ledger.mark(ids.where("arrival % 5 = 3"), 2, anew=True)
    ledger.mark(ids.where("arrival % 5 in (0, 1)"), 2, anew=True)
    ledger.mark(ids.where("arrival % 5 = 2"), 3, anew=True)
    return ledger


def ledger_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a ledger in a folder holds after batches that were marked, marked anew, and never made valid."""
    ledger = _run_ledger(spark, sf_dir)
    return progress.batch_counts(ledger.marks()).withColumn("latest_batch", F.lit(ledger.latest_batch())).withColumn("total", F.lit(ledger.total()).cast("long"))


def entity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest entity for each canonical name in capitals and type."""
    found = _entities(spark, sf_dir)
    return found.groupBy(F.upper("canonicalName").alias("upper_name"), "entityType").agg(F.min("id").alias("id"))


def _flat(entities: DataFrame) -> DataFrame:
    spelled = F.array_join(F.array_sort(F.transform("variations", lambda v: F.concat(v["variation_text"], F.lit("*"), v["occurrence_count"].cast("string")))), ";")
    return entities.select("canonicalName", "entityType", "classification_confidence", spelled.alias("variations"), "created_at", "updated_at")


def entities_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(leader_entities(_names(spark, sf_dir)))


def entities_leader_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of records of the first and of the second half of all orders, in two runs that follow one another."""
    names = stored(_names(spark, sf_dir).select("entityType", "normalized", "confidence", "order", "position", "seen_at", "arrival"), "names")  # worked out once for both runs
    middle = F.lpad(F.lit(names.agg(F.max("arrival")).first()[0] // 2).cast("string"), 12, "0")
    first = stored(leader_entities(names.where(F.col("order") <= middle)), "first")
    return _flat(leader_entities(names.where(F.col("order") > middle), known=first))


def entities_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(graph_entities(_names(spark, sf_dir)))


def matching_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of names of a type that reach the threshold, by the candidate joins of the graph grouping."""
    found = pairs_over_threshold(stored(distinct_names(_names(spark, sf_dir)), "names"))
    return found.select("entityType", "a", "b", F.round("score", 9).alias("score"))


def phonetic_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("normalized", metaphone(F.col("normalized")).alias("code"))


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_rows(_entities(spark, sf_dir)).drop("id")


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_lines(_entities(spark, sf_dir))


def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities made month by month, so that many occur more than once."""
    names = _summed_names(spark, sf_dir, month=F.date_format("seen_at", "yyyy-MM"))
    v = F.struct(F.col("normalized").alias("variation_text"), F.sum("n").alias("occurrence_count"), F.lit(1.0).alias("association_confidence"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    per = names.groupBy("month", "entityType", "normalized").agg(v.alias("v")).withColumn("canonicalName", canonical_form(F.col("normalized"), F.col("entityType")))
    grouped = per.groupBy("month", "entityType", "canonicalName").agg(F.array_sort(F.collect_list("v")).alias("variations"), F.min("v.first_seen").alias("created_at"), F.max("v.last_seen").alias("updated_at"))
    return with_ids(grouped.select(F.col("month").alias("first_order"), "canonicalName", "entityType", F.lit(0.7).alias("classification_confidence"), F.lit(1.0).alias("grouping_confidence"), "variations", "created_at", "updated_at"))


def variation_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _by_month(spark, sf_dir).select("canonicalName", "entityType", F.col("id").alias("rank"), F.posexplode("variations").alias("place", "v"))
    found = merged_variations(rows, "canonicalName", "entityType").select("canonicalName", "entityType", F.explode("variations").alias("v"))
    return found.select("canonicalName", "entityType", "v.variation_text", "v.occurrence_count", "v.first_seen", "v.last_seen")


def consolidate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = consolidated(_by_month(spark, sf_dir))
    return found.select("canonicalName", "entityType", F.size("variations").alias("n_variations"), "created_at", "updated_at")


def duplicate_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(_by_month(spark, sf_dir))


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of even arrival stored first, the others merged in."""
    names = _summed_names(spark, sf_dir, half=F.col("arrival") % 2)
    half = lambda k: exact_entities(names.where(F.col("half") == k))
    found = merged(stored(half(0), "old"), half(1))
    return found.select("canonicalName", "entityType", F.size("variations").alias("n_variations"), F.aggregate("variations", F.lit(0).cast("long"), lambda n, v: n + v["occurrence_count"]).alias("occurrences"))


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _entities(spark, sf_dir).withColumn("json", variations_json(F.col("variations")))
    return texts.select("canonicalName", "entityType", F.explode(variations_from_json(F.col("json"))).alias("v")).select("canonicalName", "entityType", "v.variation_text", "v.occurrence_count", "v.first_seen", "v.last_seen")


def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = _texts(spark, sf_dir)
    return progress.unprocessed(have, have.where("arrival % 3 = 0")).select("record_id")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event marks its user as processed; batches of a thousand."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return progress.dealt_into_batches(events, "event_id", 1000).select(F.col("user_id").cast("string").alias("record_id"), F.col("ts").alias("processed_at"), "batch_number")


def ledger_first_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.first_marks(_ledger(spark, sf_dir))


def ledger_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.batch_counts(_ledger(spark, sf_dir))


def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.first_marks(_ledger(spark, sf_dir)).agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.max("batch_number"), F.lit(0)).alias("latest_batch"))


def metadata_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    per = events.groupBy(F.col("event_type").alias("key"), F.col("ts").alias("updated_at")).agg(F.max("event_id").cast("string").alias("value"))
    return progress.latest_values(per)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_of_them = matching(records(spark, sf_dir), _PLANTS)
    c = classify(all_of_them.withColumn("collector_text", F.coalesce(F.nullif("collector", F.lit("")), F.col("recordedBy"), F.lit(""))))
    has = F.length("collector_text") > 0
    return c.agg(F.count(F.lit(1)).alias("total"), F.count_if(has & F.col("classification").isNotNull()).alias("processed"), F.count_if(~has).alias("without_text"), F.count_if(F.array_contains("classification.patterns_matched", "default_fallback")).alias("ner_candidates"))


def ner_postprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows from recognised spans; the spans are made from the text, as no model is at hand."""
    doubtful = lambda texts: classify(texts).where("array_contains(classification.patterns_matched, 'default_fallback')").select("collector_text", F.col("classification.sanitized_text").alias("text"))
    texts = by_text(_texts(spark, sf_dir), doubtful, "doubtful").select("record_id", "text", "arrival")
    score = 0.4 + (F.col("arrival") % 6) / 10
    one = lambda label, start, end, text: F.struct(text.alias("text"), F.lit(label).alias("label"), score.alias("score"), start.cast("int").alias("start"), end.cast("int").alias("end"))
    first, second = (F.split_part("text", F.lit(" "), F.lit(i)) for i in (1, 2))
    after = F.length(first) + 1
    people = F.array(one("PER", F.lit(0), F.length(first), first), one("PER", after, after + F.length(second), second), one("ORG", F.lit(0), F.length("text"), F.col("text")))
    firm = F.array(one("ORG", F.lit(0), F.length("text"), F.col("text")))
    kind = f"array<{NER_SPAN}>"
    spans = texts.withColumn("spans", F.when(F.col("arrival") % 5 == 0, F.array().cast(kind)).when(F.col("arrival") % 2 == 0, people.cast(kind)).otherwise(firm.cast(kind)))
    gone = discards(F.col("text"), F.col("spans"))
    return spans.select("record_id", person_name(F.col("text"), F.col("spans")).alias("name"), gone.alias("discard"), F.round(improved(F.lit(0.60), F.col("spans"), gone), 6).alias("confidence"))


def _by_length() -> Recogniser:
    """A recogniser that any SQL engine can follow: words of six letters and more are people, of four and five firms; scores go by length."""
    label = lambda w: "PER" if len(w) >= 6 else "ORG"

    def one(text: str) -> list[dict]:
        places = [m.span() for m in re.finditer(r"[^ ]{4,}", text)]
        return [{"text": text[a:b], "label": label(text[a:b]), "score": (3 + (b - a) % 8) / 10, "start": a, "end": b} for a, b in places]

    return lambda texts: [one(t) for t in texts]


def ner_recategorise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fallback over all records: strings that only the default rule took are recognised, narrowed, recognised again and judged anew."""
    ner.register("by_length", _by_length)
    c = by_text(_texts(spark, sf_dir), lambda texts: ner.refine(classify(texts), ner.recogniser("by_length")), "refined").where("classification is not null")
    return c.select("record_id", "classification.category", "classification.sanitized_text", F.round("classification.confidence", 6).alias("confidence"), F.array_join("classification.patterns_matched", ",").alias("patterns"), "classification.should_atomize")


def first_valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten thousand records that can be classified, in the order of arrival: what a run with a limit takes."""
    valid = by_text(_texts(spark, sf_dir), lambda texts: classify(texts).where("classification is not null").select("collector_text"), "valid")
    return first_rows(stored(valid.select("order", "record_id"), "arrivals"), 10_000, "order", "record_id").select("record_id")


def report_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities made month by month, written as a deduplicated report and read back: each spelling with its count."""
    path = scratch_path(spark, "report")
    write_report(_by_month(spark, sf_dir), path, deduplicated=True)
    cells = spark.read.text(path).where(~F.col("value").startswith("canonicalName\t")).select(F.split("value", "\t").alias("c"))
    both = F.zip_with(F.split(F.col("c")[2], ";"), F.split(F.col("c")[3], ";"), lambda text, n: F.concat(text, F.lit("*"), n))
    return cells.select(F.col("c")[0].alias("canonicalName"), F.col("c")[1].alias("entityType"), F.array_join(F.array_sort(both), ";").alias("variations"))


def stream_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records as a stream of files, two in a batch, resolved batch by batch into a store; the table after the last."""
    folder = scratch_path(spark, "stream")
    made = _texts(spark, sf_dir).select("record_id", "kingdom", "collector", "recordedBy", "order", "seen_at")
    made.repartition(6, "record_id").write.parquet(f"{folder}/in")
    incremental.start(spark, stream_records(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema, equals=_PLANTS, files_per_batch=2), folder).awaitTermination()
    return _flat(EntityStore(spark, f"{folder}/entities").all()).select("canonicalName", "entityType", "variations")


def q1_entity_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.entity_count(_entities(spark, sf_dir))


def q2_count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.count_by_type(_entities(spark, sf_dir))


def q3_most_varied_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.most_varied_people(_entities(spark, sf_dir))


def q4_names_with_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.names_with_digits(_entities(spark, sf_dir))


def q5_mean_confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = report.mean_confidences(_entities(spark, sf_dir))
    return found.select(F.round("classification", 9).alias("classification"), F.round("grouping", 9).alias("grouping"))


def q6_first_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.first_entities(_entities(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    resolve_counts, source_filter_count, collector_pick, sanitize_codes, classify_rules, classify_distribution, rejected_records, atomize_explode, names_fallback, normalize_rules,
    type_map_confidence, canonical_format, title_case_texts, classify_conversations, lev_pairs, jw_pairs, prepared_names, similar_pairs, entities_exact, entity_ids, entities_of_type, entity_by_name, entity_lookup, entities_leader, entities_leader_resumed,
    entities_graph, matching_pairs, phonetic_codes, report_rows, report_lines, variation_merge, consolidate_duplicates, duplicate_entities, upsert_merge, json_round_trip, resume_anti_join, ledger_first_marks, ledger_batches,
    ledger_latest, ledger_of_runs, metadata_latest, run_summary, ner_postprocess, ner_recategorise, first_valid_records, report_deduplicated, stream_entities, q1_entity_count, q2_count_by_type, q3_most_varied_people, q4_names_with_digits, q5_mean_confidences, q6_first_entities,
)}

# --- the same in SQL -------------------------------------------------------------------------------------------------

# Patterns, word lists and confidences below are the fixed values of the stages, said again in the other engine's words.
_PICKED = f"""records AS ({records_sql().replace('AS STRING', 'AS VARCHAR')}),
texts AS (SELECT *, lpad(CAST(arrival AS VARCHAR), 12, '0') AS ord FROM (SELECT *, coalesce(nullif(collector, ''), recordedBy, '') AS collector_text FROM records WHERE kingdom = 'Plantae') p WHERE collector_text <> '')"""

_SANITIZED = r"""clean AS (SELECT *, trim(regexp_replace(regexp_replace(trim(collector_text), '\s*\(\d+[A-Za-z]?\)\s*$', ''), '[\s,;-]*\b\d+[A-Za-z]?\b\s*$', ''), ' ,;-') AS st FROM texts)"""

_FLAGS = r"""flags AS (SELECT *,
    contains(st, ';') OR contains(st, '&') OR contains(st, 'et al.') OR contains(st, ' e ') OR contains(st, ' and ') OR contains(st, '|') AS sep,
    regexp_matches(st, '\b[A-Z]\.\s*[A-Z]\.?') AS ini,
    len(regexp_extract_all(st, '[A-Z][a-z]+,\s*[A-Z]\.')) >= 2 OR len(regexp_extract_all(st, '[A-Z]\.\s*[A-Z]\.\s*[A-Z][A-Z\-]+(?:,|$|\s*&)')) >= 2 OR len(st) - len(replace(st, ',', '')) >= 3
        OR regexp_matches(st, '[A-Za-z]+\s+\d+[,;\s]+[A-Z]\.?') OR regexp_matches(st, '(?i),\s*(ALUNOS|EQUIPE|GRUPO)') OR regexp_matches(st, '[A-Z][a-z]+,\s*[A-Z]\.\s*[A-Z]?\.*\s*&')
        OR len(regexp_extract_all(st, '[A-Z]\.\s*[A-Z][a-z]+')) >= 2 AS many
    FROM clean WHERE st <> ''),
ruled AS (SELECT *, CASE
    WHEN lower(st) IN ('?', 'sem coletor', 'não identificado', 's.c.', 's/c') THEN 'exact_match'
    WHEN regexp_matches(st, '^[A-Z]{2,}$') THEN 'all_caps_acronym'
    WHEN (sep AND ini) OR many THEN 'multiple_names,separator_detected'
    WHEN regexp_matches(st, '^[A-ZÀ-Ú][a-zà-ú]+(?:-[A-ZÀ-Ú][a-zà-ú]+)?,\s*[A-ZÀ-Ú]\.(?:[A-ZÀ-Ú]\.)*') THEN 'surname_initials_format'
    WHEN ini AND NOT sep THEN 'single_name_with_initials'
    WHEN NOT regexp_matches(st, '[ ,.]') AND (len(st) <= 3 OR (st = upper(st) AND st <> lower(st)) OR (st = lower(st) AND st <> upper(st))) THEN 'generic_single_name'
    WHEN NOT regexp_matches(st, '[ ,.]') THEN 'single_surname_only'
    WHEN regexp_matches(lower(st), 'pesquisas|grupo|equipe|time|laboratório|lab|turma|bioveg') THEN 'group_keyword'
    ELSE 'default_fallback' END AS patterns FROM flags),
classes AS (SELECT *, CASE patterns WHEN 'exact_match' THEN 'NaoDeterminado' WHEN 'generic_single_name' THEN 'NaoDeterminado' WHEN 'all_caps_acronym' THEN 'Empresa' WHEN 'multiple_names,separator_detected' THEN 'ConjuntoPessoas'
        WHEN 'group_keyword' THEN 'GrupoPessoas' ELSE 'Pessoa' END AS category,
    CAST(CASE patterns WHEN 'exact_match' THEN 1.0 WHEN 'all_caps_acronym' THEN 0.85 WHEN 'multiple_names,separator_detected' THEN 0.82 WHEN 'surname_initials_format' THEN 0.80 WHEN 'single_name_with_initials' THEN 0.65
        WHEN 'generic_single_name' THEN 0.0 WHEN 'single_surname_only' THEN 0.55 WHEN 'group_keyword' THEN 0.75 ELSE 0.60 END AS DOUBLE) AS confidence FROM ruled)"""

_ATOMS = r"""cut AS (SELECT *, regexp_replace(regexp_replace(CASE WHEN regexp_matches(st, '(?i)et\.?\s*al\.?') THEN regexp_replace(regexp_replace(st, '(?i)\s*et\.?\s*al\.?\s*$', ''), '(?i)\s*et\.?\s*alli\.?\s*$', '') ELSE st END,
        '\s+\d+([,;\s|]|$)', '\1', 'g'), ',\s*\d+([,;\s|]|$)', '\1', 'g') AS ct FROM classes),
parts AS (SELECT *, CASE WHEN category <> 'ConjuntoPessoas' THEN [] WHEN contains(ct, '|') THEN string_split(ct, '|') WHEN contains(ct, ';') THEN string_split(ct, ';') WHEN contains(ct, '&') THEN string_split(ct, '&')
        WHEN regexp_matches(ct, '[A-Z][a-z]+,\s*[A-Z]\..*,\s*[A-Z]') THEN string_split(regexp_replace(ct, ',\s*([A-Z][a-z]+)', chr(31) || '\1', 'g'), chr(31))
        WHEN contains(lower(ct), ' e ') THEN regexp_split_to_array(ct, '(?i)\s+e\s+') WHEN contains(lower(ct), ' and ') THEN regexp_split_to_array(ct, '(?i)\s+and\s+') ELSE [ct] END AS ps,
    CASE WHEN contains(ct, '|') OR contains(ct, ';') THEN ';' WHEN contains(ct, '&') THEN '&' WHEN regexp_matches(ct, '[A-Z][a-z]+,\s*[A-Z]\..*,\s*[A-Z]') THEN ';' WHEN contains(lower(ct), ' e ') OR contains(lower(ct), ' and ') THEN '&' ELSE 'none' END AS sp FROM cut),
atoms AS (SELECT record_id, category, confidence, patterns, arrival, ord, seen_at, CAST(i - 1 AS INT) AS position, trim(ps[i]) AS text, CASE WHEN i > 1 THEN sp ELSE 'none' END AS separator_used
    FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM parts) e WHERE trim(ps[i]) <> ''),
named AS (SELECT record_id, category, confidence, arrival, ord, seen_at, position, text AS name FROM atoms
    UNION ALL SELECT record_id, category, confidence, arrival, ord, seen_at, 0, st FROM parts WHERE len([p for p in ps if trim(p) <> '']) = 0)"""

_NORMAL = r"""n1 AS (SELECT *, regexp_replace(name, '^[;,&\s]+', '') AS s1 FROM named), n2 AS (SELECT *, regexp_replace(s1, '[;,&\s]+$', '') AS s2 FROM n1),
n3 AS (SELECT *, CASE WHEN contains(s2, '  ') OR s2 <> trim(s2) THEN trim(regexp_replace(s2, '\s+', ' ', 'g')) ELSE s2 END AS s3 FROM n2),
n4 AS (SELECT *, trim(regexp_replace(s3, '\s*([,;.&])\s*', '\1 ', 'g')) AS s4 FROM n3), n5 AS (SELECT *, upper(s4) AS s5 FROM n4), n6 AS (SELECT *, regexp_replace(s5, '^[;\s]+', '') AS s6 FROM n5),
n7 AS (SELECT *, CASE WHEN starts_with(s6, 'E ') THEN substr(s6, 3) ELSE s6 END AS normalized FROM n6),
normal AS (SELECT *, concat_ws(',', CASE WHEN name <> s1 THEN 'remove_leading_separators' END, CASE WHEN s1 <> s2 THEN 'remove_trailing_separators' END, CASE WHEN s2 <> s3 THEN 'remove_extra_spaces' END,
        CASE WHEN s3 <> s4 THEN 'standardize_punctuation' END, CASE WHEN s4 <> s5 THEN 'uppercase' END, CASE WHEN s5 <> s6 THEN 'strip_leading_separators_post' END, CASE WHEN s6 <> normalized THEN 'remove_leading_conjunction_e' END) AS rules,
    CASE WHEN category = 'ConjuntoPessoas' THEN 'Pessoa' ELSE category END AS entityType, CAST(CASE WHEN confidence < 0.701 THEN 0.7 ELSE confidence END AS DOUBLE) AS conf FROM n7)"""

#: Title case of ASCII names, word by word; what no word holds keeps its place.
_TITLE = r"array_to_string([upper(substr(w, 1, 1)) || lower(substr(w, 2)) for w in string_split({x}, ' ')], ' ')"
_CANON = f"""canon AS (SELECT *, CASE WHEN entityType = 'Pessoa' AND len(string_split(normalized, ',')) = 2 THEN trim({_TITLE.format(x="string_split(normalized, ',')[1]")}) || ', ' || trim(string_split(normalized, ',')[2])
    ELSE {_TITLE.format(x='normalized')} END AS canonicalName FROM normal)"""

_ENTITIES = """firsts AS (SELECT entityType, canonicalName, normalized, count(*) AS n, min(seen_at) AS first_seen, max(seen_at) AS last_seen, min(ord) AS ord, arg_min(conf, (ord, conf)) AS conf FROM canon GROUP BY ALL),
entities AS (SELECT row_number() OVER (ORDER BY min(ord), canonicalName, entityType) AS id, canonicalName, entityType, arg_min(conf, (ord, conf)) AS classification_confidence, count(*)::INT AS n_variations, sum(n)::BIGINT AS occurrences,
    min(first_seen) AS created_at, max(last_seen) AS updated_at, string_agg(normalized, ';' ORDER BY ord, normalized) AS variations, string_agg(n::VARCHAR, ';' ORDER BY ord, normalized) AS counts FROM firsts GROUP BY canonicalName, entityType)"""

_MONTHS = """months AS (SELECT strftime(seen_at, '%Y-%m') AS month, entityType, canonicalName, normalized, count(*) AS n, min(seen_at) AS first_seen, max(seen_at) AS last_seen FROM canon GROUP BY ALL),
monthly AS (SELECT month, entityType, canonicalName, min(first_seen) AS created_at, max(last_seen) AS updated_at FROM months GROUP BY ALL)"""

_PAIRS = """people AS (SELECT DISTINCT normalized FROM normal WHERE entityType = 'Pessoa'),
close AS (SELECT x.normalized AS a, y.normalized AS b FROM people x JOIN people y ON substr(x.normalized, 1, 3) = substr(y.normalized, 1, 3) AND x.normalized < y.normalized)"""

def _code_sql(name: str) -> str:
    """The phonetic code of ASCII names in capitals, as ``functions.similarity`` works it out, letter by letter."""
    once = "w"
    for c in "ABDEFGHIJKLMNOPQRSTUVWXYZ":
        once = f"replace({once}, '{c}{c}', '{c}')"
    headed = """CASE WHEN substr(w, 1, 2) IN ('AE', 'GN', 'KN', 'PN', 'WR') THEN substr(w, 2) WHEN starts_with(w, 'X') THEN 'S' || substr(w, 2) WHEN starts_with(w, 'WH') THEN 'W' || substr(w, 3) ELSE w END"""
    at = lambda k: f"substr(w, i + {k}, 1)"
    before = "CASE WHEN i > 1 THEN substr(w, i - 1, 1) ELSE '' END"
    vowel, soft = "('A', 'E', 'I', 'O', 'U')", "('E', 'I', 'Y')"
    letter = f"""CASE
        WHEN {at(0)} = 'H' AND {before} IN ('C', 'S', 'T') THEN '' WHEN {at(0)} = 'G' AND {before} = 'D' AND {at(1)} IN {soft} THEN ''
        WHEN {at(0)} IN {vowel} THEN CASE WHEN i = 1 THEN {at(0)} ELSE '' END
        WHEN {at(0)} = 'B' THEN CASE WHEN {before} = 'M' AND i = len(w) THEN '' ELSE 'B' END
        WHEN {at(0)} = 'C' THEN CASE WHEN {at(1)} IN {soft} THEN CASE WHEN {before} = 'S' THEN '' WHEN substr(w, i + 1, 2) = 'IA' THEN 'X' ELSE 'S' END
            WHEN {at(1)} = 'H' THEN CASE WHEN {before} = 'S' OR (i = 1 AND {at(2)} NOT IN {vowel}) THEN 'K' ELSE 'X' END ELSE 'K' END
        WHEN {at(0)} = 'D' THEN CASE WHEN {at(1)} = 'G' AND {at(2)} IN {soft} THEN 'J' ELSE 'T' END
        WHEN {at(0)} = 'G' THEN CASE WHEN {at(1)} = 'H' AND NOT (i + 2 > len(w) OR {at(2)} IN {vowel}) THEN '' WHEN {at(1)} = 'N' AND (i + 2 > len(w) OR substr(w, i + 1) = 'NED') THEN ''
            WHEN {at(1)} IN {soft} AND {before} <> 'G' THEN 'J' ELSE 'K' END
        WHEN {at(0)} = 'H' THEN CASE WHEN {at(1)} IN {vowel} AND {before} NOT IN ('C', 'S', 'P', 'T', 'G') THEN 'H' ELSE '' END
        WHEN {at(0)} = 'K' THEN CASE WHEN {before} = 'C' THEN '' ELSE 'K' END
        WHEN {at(0)} = 'P' THEN CASE WHEN {at(1)} = 'H' THEN 'F' ELSE 'P' END
        WHEN {at(0)} = 'Q' THEN 'K'
        WHEN {at(0)} = 'S' THEN CASE WHEN {at(1)} = 'H' OR ({at(1)} = 'I' AND {at(2)} IN ('O', 'A')) THEN 'X' ELSE 'S' END
        WHEN {at(0)} = 'T' THEN CASE WHEN {at(1)} = 'I' AND {at(2)} IN ('O', 'A') THEN 'X' WHEN {at(1)} = 'H' THEN '0' WHEN substr(w, i + 1, 2) = 'CH' THEN '' ELSE 'T' END
        WHEN {at(0)} = 'V' THEN 'F' WHEN {at(0)} IN ('W', 'Y') THEN CASE WHEN {at(1)} IN {vowel} THEN {at(0)} ELSE '' END
        WHEN {at(0)} = 'X' THEN 'KS' WHEN {at(0)} = 'Z' THEN 'S' ELSE {at(0)} END"""
    words = rf"string_split(trim(regexp_replace(regexp_replace({name}, '[^A-Z\s]', '', 'g'), '\s+', ' ', 'g')), ' ')"
    plain = f"list_transform(list_transform({words}, lambda w: {once}), lambda w: {headed})"
    coded = f"list_transform({plain}, lambda w: array_to_string(list_transform(range(1, len(w) + 1), lambda i: {letter}), ''))"
    return f"array_to_string(list_filter({coded}, lambda c: c <> ''), ' ')"


_PREPARED = r"trim(regexp_replace(regexp_replace(normalized, '\b([A-Z])\.\b', '\1', 'g'), '\s+', ' ', 'g'))"
#: Names with all that scores need, and what two of them score.
_SCORED = f"""forms AS MATERIALIZED (SELECT *, {_code_sql('p')} AS code FROM (SELECT *, {_PREPARED} AS p FROM (SELECT entityType, normalized, count(*) AS n, min(seen_at) AS first_seen, max(seen_at) AS last_seen, min(ord) AS ord, arg_min(conf, (ord, conf)) AS conf
    FROM normal WHERE normalized <> '' GROUP BY ALL) d) e)"""
_SCORE = """(CASE WHEN x.p = '' OR y.p = '' THEN 0 ELSE 0.4::DOUBLE * (1 - levenshtein(x.p, y.p) / greatest(len(x.p), len(y.p))::DOUBLE) + 0.4::DOUBLE * jaro_winkler_similarity(x.p, y.p) + CASE WHEN x.code = y.code THEN 0.2::DOUBLE ELSE 0 END END)"""
_MATCHES = f"""matched AS MATERIALIZED (SELECT * FROM (SELECT x.entityType, x.normalized AS a, y.normalized AS b, x.n AS na, y.n AS nb, {_SCORE} AS score FROM forms x JOIN forms y ON x.entityType = y.entityType AND x.normalized < y.normalized) s WHERE score >= 0.7)"""
_GRAPH = """ranked AS (SELECT entityType, a AS x, b AS y, na AS nx, nb AS ny, score FROM matched UNION ALL SELECT entityType, b, a, nb, na, score FROM matched),
beaten AS (SELECT DISTINCT entityType, x FROM ranked WHERE ny > nx OR (ny = nx AND y < x)),
chosen AS (SELECT r.entityType, r.x, arg_min(r.y, (-round(r.score, 9), -r.ny, r.y)) AS y FROM ranked r JOIN beaten t ON r.entityType = t.entityType AND r.x = t.x
    WHERE NOT EXISTS (SELECT 1 FROM beaten b WHERE b.entityType = r.entityType AND b.x = r.y) GROUP BY ALL),
placed AS (SELECT f.*, coalesce(c.y, f.normalized) AS leader FROM forms f LEFT JOIN chosen c ON c.entityType = f.entityType AND c.x = f.normalized),
grouped AS (SELECT entityType, leader, arg_max(normalized, (len(string_split(normalized, ' ')), normalized = leader, n, normalized)) AS longest, arg_min(conf, (ord, conf)) AS conf, array_to_string(list_sort(list(normalized || '*' || n::VARCHAR)), ';') AS variations, min(first_seen) AS created_at, max(last_seen) AS updated_at FROM placed GROUP BY ALL)"""

#: The leader grouping by its changes: between two of them every name goes on joining what it joins. A step of the recursion finds, for each type, the
#: next sight of a name that makes an entity or renames one, and holds the entities after it; the sights are dealt out at the end.
_LEADER = f"""sights AS MATERIALIZED (SELECT entityType, normalized AS x, conf, seen_at, row_number() OVER (ORDER BY ord, position, normalized) AS t FROM normal WHERE normalized <> ''),
own AS MATERIALIZED (SELECT *, CASE WHEN entityType = 'Pessoa' AND len(string_split(normalized, ',')) = 2 THEN trim(string_split(normalized, ',')[1]) || ', ' || trim(string_split(normalized, ',')[2]) ELSE normalized END AS k FROM forms),
spelled AS MATERIALIZED (SELECT *, {_code_sql('p')} AS code FROM (SELECT entityType, normalized, {_PREPARED} AS p FROM (SELECT DISTINCT entityType, k AS normalized FROM own) d) e),
near AS MATERIALIZED (SELECT entityType, a AS x, b AS k, score FROM (SELECT x.entityType, x.normalized AS a, y.normalized AS b, CASE WHEN x.normalized = y.normalized THEN 2 ELSE round({_SCORE}, 9) END AS score
    FROM forms x JOIN spelled y ON x.entityType = y.entityType) s WHERE score >= 0.7),
changes(entityType, t, i, name, k, words) AS (
    SELECT DISTINCT entityType, 0::BIGINT, -1::BIGINT, NULL::VARCHAR, NULL::VARCHAR, 0::BIGINT FROM own
    UNION ALL
    SELECT u.* FROM (
        WITH best AS (SELECT c.entityType, n.x, max(c.t) AS t, arg_max(c.i, (n.score, -c.i)) AS i, arg_max(c.words, (n.score, -c.i)) AS words FROM changes c JOIN near n ON n.entityType = c.entityType AND n.k = c.k GROUP BY ALL),
        now AS (SELECT entityType, max(t) AS t, max(i) AS last FROM changes GROUP BY entityType),
        moved AS (SELECT o.entityType, o.normalized AS x, o.k, len(string_split(o.k, ' ')) AS kw, w.t, b.i, w.last FROM own o JOIN now w ON w.entityType = o.entityType LEFT JOIN best b ON b.entityType = o.entityType AND b.x = o.normalized
            WHERE b.i IS NULL OR (o.entityType = 'Pessoa' AND len(string_split(o.normalized, ' ')) > b.words)),
        next AS (SELECT m.entityType, min(s.t) AS t, arg_min(m.x, s.t) AS x, arg_min(m.k, s.t) AS k, arg_min(m.kw, s.t) AS kw, arg_min(coalesce(m.i, m.last + 1), s.t) AS i, arg_min(m.i IS NULL, s.t) AS fresh FROM moved m JOIN sights s ON s.entityType = m.entityType AND s.x = m.x AND s.t > m.t GROUP BY m.entityType)
        SELECT c.entityType, n.t, c.i, CASE WHEN c.i = n.i THEN n.x ELSE c.name END, CASE WHEN c.i = n.i THEN n.k ELSE c.k END, CASE WHEN c.i = n.i THEN n.kw ELSE c.words END FROM changes c JOIN next n ON n.entityType = c.entityType
        UNION ALL SELECT entityType, t, i, x, k, kw FROM next WHERE fresh
    ) u
), held AS MATERIALIZED (SELECT * FROM changes),
joined AS MATERIALIZED (SELECT h.entityType, h.t, n.x, arg_max(h.i, (n.score, -h.i)) AS i FROM held h JOIN near n ON n.entityType = h.entityType AND n.k = h.k GROUP BY ALL),
spans AS (SELECT DISTINCT entityType, t AS since FROM held),
dealt AS (SELECT s.*, e.since FROM sights s ASOF JOIN spans e ON e.entityType = s.entityType AND s.t > e.since),
placed AS MATERIALIZED (SELECT d.*, coalesce(j.i, f.i) AS i FROM dealt d LEFT JOIN joined j ON j.entityType = d.entityType AND j.t = d.since AND j.x = d.x
    LEFT JOIN (SELECT entityType, t, max(i) AS i FROM held GROUP BY ALL) f ON f.entityType = d.entityType AND f.t = d.t),
spellings AS (SELECT entityType, i, array_to_string(list_sort(list(x || '*' || n::VARCHAR)), ';') AS variations FROM (SELECT entityType, i, x, count(*) AS n FROM placed GROUP BY ALL) v GROUP BY ALL),
led AS (SELECT p.entityType, p.i, arg_min(conf, p.t) AS conf, arg_min(seen_at, p.t) AS created_at, arg_max(seen_at, p.t) AS updated_at FROM placed p GROUP BY ALL),
named_last AS (SELECT entityType, i, arg_max(name, t) AS normalized FROM held WHERE i >= 0 GROUP BY ALL)"""

_LEDGER = """ledger AS (SELECT CAST(user_id AS VARCHAR) AS record_id, ts AS processed_at, CAST(event_id // 1000 + 1 AS INT) AS batch_number FROM events),
marks AS (SELECT record_id, min(processed_at) AS processed_at, arg_min(batch_number, (processed_at, batch_number)) AS batch_number FROM ledger GROUP BY record_id)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _led() -> str:
    """Runs that follow one another make the table of one run, so one text serves both."""
    canon = _CANON.replace("FROM normal)", "FROM named_last)")
    return _with(*_TO_NORMAL, _SCORED, _LEADER, canon).replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT canonicalName, entityType, conf AS classification_confidence, variations, created_at, updated_at FROM canon JOIN led USING (entityType, i) JOIN spellings USING (entityType, i)"


_TO_TEXTS = (_PICKED,)
_TO_CLASSES = (*_TO_TEXTS, _SANITIZED, _FLAGS)
_TO_NAMES = (*_TO_CLASSES, _ATOMS)
_TO_NORMAL = (*_TO_NAMES, _NORMAL)
_TO_CANON = (*_TO_NORMAL, _CANON)
_TO_ENTITIES = (*_TO_CANON, _ENTITIES)

ORACLE_SQL: dict[str, str] = {
    "resolve_counts": _with(*_TO_NORMAL) + "SELECT entityType, normalized, count(*) AS n FROM normal GROUP BY ALL",
    "source_filter_count": _with(*_TO_TEXTS) + "SELECT count(*) AS records FROM records WHERE kingdom = 'Plantae'",
    "collector_pick": _with(*_TO_TEXTS) + "SELECT record_id, collector_text FROM texts",
    "sanitize_codes": _with(*_TO_TEXTS, _SANITIZED) + "SELECT record_id, st AS sanitized_text FROM clean",
    "classify_rules": _with(*_TO_CLASSES) + "SELECT record_id, category, confidence, patterns, category = 'ConjuntoPessoas' AS should_atomize, confidence < 0.7 AS needs_review FROM classes",
    "classify_distribution": _with(*_TO_CLASSES) + "SELECT category, patterns, count(*) AS n, avg(confidence) AS confidence FROM classes GROUP BY ALL",
    "rejected_records": _with(*_TO_CLASSES) + "SELECT count(*) FILTER (st = '') AS rejected, count(*) FILTER (st <> '') AS processed FROM clean",
    "atomize_explode": _with(*_TO_NAMES) + "SELECT record_id, position, text, separator_used FROM atoms",
    "names_fallback": _with(*_TO_NAMES) + "SELECT record_id, position, name FROM named",
    "normalize_rules": _with(*_TO_NORMAL) + "SELECT record_id, position, normalized, rules FROM normal",
    "type_map_confidence": _with(*_TO_NORMAL) + "SELECT category, entityType, conf AS confidence, count(*) AS n FROM normal GROUP BY ALL",
    "canonical_format": _with(*_TO_CANON) + "SELECT DISTINCT entityType, normalized, canonicalName FROM canon",
    "lev_pairs": _with(*_TO_NORMAL, _PAIRS) + "SELECT a, b, round(1 - levenshtein(a, b) / greatest(len(a), len(b))::DOUBLE, 9) AS score FROM close",
    "jw_pairs": _with(*_TO_NORMAL, _PAIRS) + "SELECT a, b, round(jaro_winkler_similarity(a, b), 9) AS score FROM close",
    "prepared_names": _with(*_TO_NORMAL, _PAIRS) + r"SELECT normalized, trim(regexp_replace(regexp_replace(normalized, '\b([A-Z])\.\b', '\1', 'g'), '\s+', ' ', 'g')) AS prepared FROM people",
    "phonetic_codes": _with(*_TO_NORMAL, _PAIRS) + f"SELECT normalized, {_code_sql('normalized')} AS code FROM people",
    "similar_pairs": _with(*_TO_NORMAL, _PAIRS, _SCORED) + f"SELECT a, b, round({_SCORE}, 9) AS score FROM close JOIN forms x ON x.normalized = a AND x.entityType = 'Pessoa' JOIN forms y ON y.normalized = b AND y.entityType = 'Pessoa'",
    "matching_pairs": _with(*_TO_NORMAL, _SCORED, _MATCHES) + "SELECT entityType, a, b, round(score, 9) AS score FROM matched",
    "entities_leader": _led(),
    "entities_leader_resumed": _led(),
    "entities_graph": _with(*_TO_NORMAL, _SCORED, _MATCHES, _GRAPH, _CANON.replace("FROM normal)", "FROM (SELECT *, CASE WHEN entityType = 'Pessoa' THEN longest ELSE leader END AS normalized FROM grouped) g)")) + "SELECT canonicalName, entityType, conf AS classification_confidence, variations, created_at, updated_at FROM canon",
    "title_case_texts": r"""WITH words AS (SELECT unnest(regexp_split_to_array(text, '[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+')) AS w FROM documents)
        SELECT w, array_to_string(list_transform(string_split(w, ''), lambda c, i: CASE WHEN i > 1 AND regexp_matches(string_split(w, '')[i - 1], '^\p{L}$') THEN lower(c) WHEN c = 'ß' THEN 'SS' ELSE upper(c) END), '') AS titled, count(*) AS n FROM words WHERE w <> '' GROUP BY w""",
    "classify_conversations": _with("texts AS (SELECT text AS collector_text FROM conversations)", _SANITIZED, _FLAGS) + "SELECT CASE WHEN st = '' THEN NULL ELSE category END AS category, CASE WHEN st = '' THEN NULL ELSE patterns END AS patterns, count(*) AS n FROM (SELECT st, category, patterns FROM classes UNION ALL SELECT st, NULL, NULL FROM clean WHERE st = '') u GROUP BY ALL",
    "entities_exact": _with(*_TO_ENTITIES) + "SELECT canonicalName, entityType, classification_confidence, n_variations, occurrences, created_at, updated_at FROM entities",
    "entity_ids": _with(*_TO_ENTITIES) + "SELECT id, canonicalName, entityType FROM entities",
    "entities_of_type": _with(*_TO_ENTITIES) + "SELECT id, canonicalName FROM entities WHERE entityType = 'GrupoPessoas'",
    "entity_by_name": _with(*_TO_ENTITIES) + "SELECT id, canonicalName, classification_confidence FROM entities WHERE entityType = 'NaoDeterminado' AND upper(canonicalName) = 'SEM COLETOR' ORDER BY id LIMIT 1",
    "ledger_of_runs": _with(*_TO_TEXTS) + "SELECT CASE WHEN arrival % 5 = 0 THEN 1 ELSE 2 END::INT AS batch_number, count(DISTINCT record_id) AS records, 2::INT AS latest_batch, (SELECT count(DISTINCT record_id) FROM texts WHERE arrival % 5 IN (0, 1)) AS total FROM texts WHERE arrival % 5 IN (0, 1) GROUP BY 1",
    "entity_lookup": _with(*_TO_ENTITIES) + "SELECT upper(canonicalName) AS upper_name, entityType, min(id) AS id FROM entities GROUP BY ALL",
    "report_rows": _with(*_TO_ENTITIES) + "SELECT canonicalName, entityType, variations, counts AS occurrenceCounts FROM entities",
    "report_lines": _with(*_TO_ENTITIES) + "SELECT concat_ws(chr(9), canonicalName, entityType, variations, counts) AS value FROM entities",
    "variation_merge": _with(*_TO_CANON, _MONTHS) + "SELECT canonicalName, entityType, normalized AS variation_text, sum(n)::BIGINT AS occurrence_count, min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM months GROUP BY ALL",
    "consolidate_duplicates": _with(*_TO_CANON, _MONTHS) + "SELECT canonicalName, entityType, count(DISTINCT normalized)::INT AS n_variations, min(first_seen) AS created_at, max(last_seen) AS updated_at FROM months GROUP BY ALL",
    "duplicate_entities": _with(*_TO_CANON, _MONTHS) + "SELECT canonicalName, entityType, count(*) AS count FROM monthly GROUP BY ALL HAVING count(*) > 1",
    "upsert_merge": _with(*_TO_ENTITIES) + "SELECT canonicalName, entityType, n_variations, occurrences FROM entities",
    "json_round_trip": _with(*_TO_ENTITIES) + "SELECT canonicalName, entityType, normalized AS variation_text, n AS occurrence_count, first_seen, last_seen FROM firsts",
    "resume_anti_join": _with(*_TO_TEXTS) + "SELECT record_id FROM texts WHERE arrival % 3 <> 0",
    "ledger_first_marks": _with(_LEDGER) + "SELECT record_id, processed_at, batch_number FROM marks",
    "ledger_batches": _with(_LEDGER) + "SELECT batch_number, count(*) AS records FROM marks GROUP BY ALL",
    "ledger_latest": _with(_LEDGER) + "SELECT count(*) AS total, coalesce(max(batch_number), 0) AS latest_batch FROM marks",
    "metadata_latest": "WITH per AS (SELECT event_type AS key, ts, max(event_id) AS value FROM events GROUP BY ALL) SELECT key, CAST(arg_max(value, ts) AS VARCHAR) AS value FROM per GROUP BY ALL",
    "run_summary": _with(*_TO_CLASSES) + "SELECT (SELECT count(*) FROM records WHERE kingdom = 'Plantae') AS total, (SELECT count(*) FROM classes) AS processed, (SELECT count(*) FROM records WHERE kingdom = 'Plantae') - (SELECT count(*) FROM texts) AS without_text, (SELECT count(*) FROM classes WHERE patterns = 'default_fallback') AS ner_candidates",
    "ner_recategorise": _with(*_TO_CLASSES, """heard AS (SELECT *, CASE WHEN patterns = 'default_fallback' THEN list_filter(string_split(st, ' '), lambda w: len(w) >= 6) END AS people FROM classes),
        narrowed AS (SELECT *, CASE WHEN patterns = 'default_fallback' THEN CASE WHEN len(people) > 0 THEN list_filter(people, lambda w: len(w) = list_max(list_transform(people, lambda v: len(v))))[1] ELSE st END END AS name FROM heard),
        again AS (SELECT *, list_filter(string_split(name, ' '), lambda w: len(w) >= 4) AS found FROM narrowed),
        scored AS (SELECT *, list_max([(3 + len(w) % 8) / 10.0::DOUBLE for w in found if len(w) >= 6]) AS person, list_max([(3 + len(w) % 8) / 10.0::DOUBLE for w in found if len(w) < 6]) AS firm, len([w for w in found if len(w) >= 6]) AS n FROM again),
        gone AS (SELECT *, CASE WHEN len(found) = 0 THEN len(name) < 5 OR len(regexp_extract_all(name, '[A-Za-z]')) / len(name)::DOUBLE < 0.5 ELSE greatest(coalesce(person, 0), coalesce(firm, 0)) < 0.5 END AS discard FROM scored)
        SELECT record_id, CASE WHEN name IS NULL THEN category WHEN discard THEN 'NaoDeterminado' WHEN n > 1 THEN 'ConjuntoPessoas' WHEN n = 1 THEN 'Pessoa' WHEN firm IS NOT NULL THEN 'Empresa' ELSE category END AS category, coalesce(name, st) AS sanitized_text,
            round(CASE WHEN name IS NULL THEN confidence WHEN discard THEN 0 WHEN len(found) = 0 THEN greatest(confidence - 0.10, 0.65) WHEN person > 0.85 THEN 0.85 WHEN person > 0.70 THEN 0.75 WHEN person > 0.50 THEN 0.70 WHEN person IS NOT NULL THEN 0.65 WHEN firm > 0.85 THEN 0.85 WHEN firm > 0.70 THEN 0.75 ELSE 0.70 END::DOUBLE, 6) AS confidence,
            patterns || CASE WHEN name IS NULL THEN '' WHEN discard THEN ',ner_discard' ELSE ',ner_fallback' || CASE WHEN n > 1 THEN ',ner_multiple_persons_detected' WHEN n = 1 THEN ',ner_person_detected' WHEN firm IS NOT NULL THEN ',ner_org_detected' ELSE '' END END AS patterns,
            CASE WHEN name IS NULL THEN category = 'ConjuntoPessoas' ELSE NOT discard AND n > 1 END AS should_atomize FROM gone"""),
    "first_valid_records": _with(*_TO_CLASSES) + "SELECT record_id FROM classes ORDER BY arrival, record_id LIMIT 10000",
    "report_deduplicated": _with(*_TO_CANON) + "SELECT canonicalName, entityType, array_to_string(list_sort(list(normalized || '*' || n::VARCHAR)), ';') AS variations FROM (SELECT canonicalName, entityType, normalized, count(*) AS n FROM canon GROUP BY ALL) v GROUP BY ALL",
    "stream_entities": _with(*_TO_CANON) + "SELECT canonicalName, entityType, array_to_string(list_sort(list(normalized || '*' || n::VARCHAR)), ';') AS variations FROM (SELECT canonicalName, entityType, normalized, count(*) AS n FROM canon GROUP BY ALL) v GROUP BY ALL",
    "ner_postprocess": _with(*_TO_CLASSES) + """SELECT record_id, CASE WHEN arrival % 5 = 0 OR arrival % 2 = 1 THEN st WHEN len(split_part(st, ' ', 2)) > len(split_part(st, ' ', 1)) THEN split_part(st, ' ', 2) ELSE split_part(st, ' ', 1) END AS name,
        CASE WHEN arrival % 5 = 0 THEN len(st) < 5 OR len(regexp_extract_all(st, '[A-Za-z]')) / len(st)::DOUBLE < 0.5 ELSE 0.4 + (arrival % 6) / 10.0 < 0.5 END AS discard,
        CAST(CASE WHEN arrival % 5 = 0 THEN CASE WHEN len(st) < 5 OR len(regexp_extract_all(st, '[A-Za-z]')) / len(st)::DOUBLE < 0.5 THEN 0 ELSE 0.65 END WHEN 0.4 + (arrival % 6) / 10.0 < 0.5 THEN 0
            WHEN 0.4 + (arrival % 6) / 10.0 > 0.85 THEN 0.85 WHEN 0.4 + (arrival % 6) / 10.0 > 0.70 THEN 0.75 WHEN arrival % 2 = 0 AND 0.4 + (arrival % 6) / 10.0 <= 0.50 THEN 0.65 ELSE 0.70 END AS DOUBLE) AS confidence
        FROM classes WHERE patterns = 'default_fallback'""",
    "q1_entity_count": _with(*_TO_ENTITIES) + "SELECT count(*) AS entities FROM entities",
    "q2_count_by_type": _with(*_TO_ENTITIES) + "SELECT entityType, count(*) AS entities FROM entities GROUP BY ALL",
    "q3_most_varied_people": _with(*_TO_ENTITIES) + "SELECT canonicalName, n_variations AS variations FROM entities WHERE entityType = 'Pessoa' ORDER BY n_variations DESC, canonicalName LIMIT 5",
    "q4_names_with_digits": _with(*_TO_ENTITIES) + "SELECT id, canonicalName, entityType FROM entities WHERE regexp_matches(canonicalName, '[0-9]') ORDER BY id LIMIT 10",
    "q5_mean_confidences": _with(*_TO_ENTITIES) + "SELECT round(avg(classification_confidence), 9) AS classification, CAST(1.0 AS DOUBLE) AS grouping FROM entities",
    "q6_first_entities": _with(*_TO_ENTITIES) + "SELECT id, canonicalName, entityType FROM entities ORDER BY id LIMIT 5",
}
