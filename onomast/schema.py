"""Types of the data that flow through the stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERSON, PERSON_SET, PERSON_GROUP, COMPANY, UNDETERMINED = "Pessoa", "ConjuntoPessoas", "GrupoPessoas", "Empresa", "NaoDeterminado"
CATEGORIES = (PERSON, PERSON_SET, PERSON_GROUP, COMPANY, UNDETERMINED)
ENTITY_TYPES = (PERSON, PERSON_GROUP, COMPANY, UNDETERMINED)
SEPARATORS = (";", "&", "et al.", "none")

SOURCE = "record_id string, kingdom string, collector string, recordedBy string"
VARIATION = "struct<variation_text:string,occurrence_count:bigint,association_confidence:double,first_seen:timestamp,last_seen:timestamp>"
ENTITY = f"id bigint, canonicalName string, entityType string, classification_confidence double, grouping_confidence double, variations array<{VARIATION}>, created_at timestamp, updated_at timestamp"
LEDGER = "record_id string, processed_at timestamp, batch_number int"
METADATA = "key string, value string, updated_at timestamp"
NER_SPAN = "struct<text:string,label:string,score:double,start:int,end:int>"

#: Confidence below which a grouping is not trusted; classification confidences are raised to it for storage.
LEAST_CONFIDENCE = 0.70
REVIEW_BELOW = LEAST_CONFIDENCE


def stored_confidence(c: Column) -> Column:
    """0.70 for anything under 0.701, else rounded to two decimals."""
    return F.when(c < 0.701, F.lit(LEAST_CONFIDENCE)).otherwise(F.round(c, 2))


def entity_problems(confidence: Column, grouping: Column, entity_type: Column, variations: Column) -> Column:
    """Names of the constraints that an entity row breaks; empty for a sound one."""
    bad = [
        (confidence.isNull() | ~confidence.between(LEAST_CONFIDENCE, 1.0), "classification_confidence"),
        (grouping.isNull() | ~grouping.between(LEAST_CONFIDENCE, 1.0), "grouping_confidence"),
        (entity_type.isNull() | ~entity_type.isin(*ENTITY_TYPES), "entityType"),
        (variations.isNull() | (F.size(variations) < 1) | F.exists(variations, lambda v: (v["occurrence_count"] < 1) | ~v["association_confidence"].between(LEAST_CONFIDENCE, 1.0)), "variations"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in bad]))
