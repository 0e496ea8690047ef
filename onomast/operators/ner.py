"""Named-entity fallback for strings that only the default rule took. Off unless a recogniser is given.

A recogniser takes a list of texts and gives, for each, spans (text, label, score, start, end). It is made once in each
Python worker. What follows from the spans is worked out in column expressions. A recogniser that fails on a text, or gives spans
that cannot be, costs that text its classification and no other: the batch is halved until the text stands alone.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onomast.functions.text import stripped
from onomast.schema import COMPANY, NER_SPAN, PERSON, PERSON_SET, UNDETERMINED

Recogniser = Callable[[list[str]], list[list[dict[str, Any]]]]

# Labels of persons and organisations.
PERSON_LABELS = ("PESSOA", "PER", "PERSON")
ORGANISATION_LABELS = ("ORGANIZACAO", "ORG", "ORGANIZATION")

_MODELS: dict[str, Callable[[], Recogniser]] = {}


def register(key: str, make: Callable[[], Recogniser]) -> None:
    """Know a recogniser by a key; the first registered is the default."""
    _MODELS[key] = make


def perceptron() -> Callable[[], Recogniser]:
    """How workers make the library's own recogniser: it is trained here, and the weights go to them."""
    from onomast.operators.tagger import recognise_with, trained

    return functools.partial(recognise_with, trained())


def recogniser(key: str | None) -> Callable[[], Recogniser] | None:
    """How the recogniser of a key is made; the default one (the first registered, else the library's own) for a key that is not known. None for no key."""
    if key is None:
        return None
    return _MODELS.get(key) or next(iter(_MODELS.values()), None) or perceptron()


def _sound(text: str, found: list[dict[str, Any]]) -> list[dict[str, Any]]:
    out = [{k: s[k] for k in ("text", "label", "score", "start", "end")} for s in found]
    for s in out:
        if not (0 <= s["start"] < s["end"] <= len(text) and 0 <= s["score"] <= 1 and isinstance(s["label"], str)):
            raise ValueError(f"unsound span {s['start']}-{s['end']} {s['label']} {s['score']}")
    return out


def recognised(recognise: Recogniser, texts: list[str]) -> list[tuple[list[dict[str, Any]] | None, str | None]]:
    """For each text its spans, or what went wrong; a text that fails takes no other with it."""
    try:
        found = recognise(texts)
        if len(found) != len(texts):
            raise ValueError(f"{len(found)} results for {len(texts)} texts")
        return [(_sound(t, spans), None) for t, spans in zip(texts, found, strict=True)]
    except Exception as e:
        if len(texts) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        half = len(texts) // 2
        return recognised(recognise, texts[:half]) + recognised(recognise, texts[half:])


def spans_udf(make: Callable[[], Recogniser]) -> Callable[[Column], Column]:
    """A column function to a struct of spans and problem (null where all went well); the model is loaded at the first batch of a worker."""

    @F.pandas_udf(f"struct<spans:array<{NER_SPAN}>,problem:string>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        recognise = None
        for texts in batches:
            known = texts.notna().to_numpy()
            out: list[tuple] = [(None, None)] * len(texts)
            if known.any():
                recognise = recognise or make()
                for i, x in zip(known.nonzero()[0], recognised(recognise, texts[known].tolist()), strict=True):
                    out[i] = x
            yield pd.DataFrame({"spans": pd.Series([x for x, _ in out], dtype=object), "problem": pd.Series([x for _, x in out], dtype=object)})

    return spans


def persons(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["label"].isin(*PERSON_LABELS))


def organisations(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["label"].isin(*ORGANISATION_LABELS))


def _best(spans: Column) -> Column:
    return F.array_max(F.transform(spans, lambda s: s["score"]))


def person_name(text: Column, spans: Column) -> Column:
    """The longest person span (the first of equals), stripped; the text itself without one."""
    longest = F.array_max(F.transform(persons(spans), lambda s, i: F.struct((s["end"] - s["start"]).alias("n"), (-i).alias("at"), s["start"].alias("start"))))
    name = stripped(F.substring(text, longest["start"] + 1, longest["n"]))
    return F.when(F.length(name) > 0, name).otherwise(text)


def discards(text: Column, spans: Column) -> Column:
    """Whether a text is not worth keeping: no entity in a very short or mostly non-letter text, or only doubtful ones."""
    short = F.length(stripped(text))
    letters = F.regexp_count(text, F.lit(r"\p{L}")) / F.greatest(F.length(text), F.lit(1))
    return F.when(F.size(spans) == 0, (short < 5) | (letters < 0.5)).otherwise(_best(spans) < 0.50)


def improved(confidence: Column, spans: Column, discard: Column) -> Column:
    person, organisation = _best(persons(spans)), _best(organisations(spans))
    better = (
        F.when(F.size(spans) == 0, F.greatest(confidence - 0.10, F.lit(0.65)))
        .when(person > 0.85, 0.85).when(person > 0.70, 0.75).when(person > 0.50, 0.70).when(person.isNotNull(), 0.65)
        .when(organisation > 0.85, 0.85).when(organisation > 0.70, 0.75).when(organisation.isNotNull(), 0.70)
        .otherwise(confidence)
    )
    return F.when(discard, 0.0).when(F.size(spans) == 0, better).otherwise(F.least(better, F.lit(0.90)))


def refine(df: DataFrame, make: Callable[[], Recogniser], column: str = "classification") -> DataFrame:
    """Apply the fallback to the classifications of the default rule; others are left alone.

    A person's text is first narrowed to its longest person span, and the entities of what is left decide. Where the recogniser fails
    the classification becomes null and the new column ``problem`` says why; it is null elsewhere.
    """
    spans, c = spans_udf(make), F.col(column)
    # through an outer explosion, else the decision list would be worked out for each mention of its result
    df = df.select(*[x for x in df.columns if x != column], F.explode_outer(F.array(c)).alias(column))
    doubtful = F.array_contains(c["patterns_matched"], "default_fallback")
    out = df.withColumn("_text", F.when(doubtful, c["sanitized_text"])).withColumn("_first", spans(F.col("_text")))
    whole = F.col("_first.problem").isNull()
    out = out.withColumn("_name", F.when(whole, F.when(c["category"] == PERSON, person_name(F.col("_text"), F.col("_first.spans"))).otherwise(F.col("_text"))))
    out = out.withColumn("_second", spans(F.col("_name"))).withColumn("problem", F.coalesce("_first.problem", "_second.problem")).withColumn("_spans", F.col("_second.spans")).withColumn("_discard", discards(F.col("_name"), F.col("_spans")))
    out = out.withColumn("_better", improved(c["confidence"], F.col("_spans"), F.col("_discard")))
    people, firms = F.size(persons(F.col("_spans"))), F.size(organisations(F.col("_spans")))
    gone = F.col("_better") == 0.0
    category = F.when(gone, UNDETERMINED).when(people > 1, PERSON_SET).when(people == 1, PERSON).when(firms > 0, COMPANY).otherwise(c["category"])
    said = F.when(gone, F.array(F.lit("ner_discard"))).otherwise(
        F.concat(F.array(F.lit("ner_fallback")), F.when(people > 1, F.array(F.lit("ner_multiple_persons_detected"))).when(people == 1, F.array(F.lit("ner_person_detected"))).when(firms > 0, F.array(F.lit("ner_org_detected"))).otherwise(F.array().cast("array<string>")))
    )
    new = F.struct(
        c["original_text"].alias("original_text"), F.col("_name").alias("sanitized_text"), category.alias("category"), F.col("_better").alias("confidence"),
        F.concat(c["patterns_matched"], said).alias("patterns_matched"), (~gone & (category == PERSON_SET)).alias("should_atomize"),
    )
    told = F.when(F.col("problem").isNull(), F.when(F.col("_text").isNotNull(), new).otherwise(c))
    return out.withColumn(column, told).drop("_text", "_first", "_name", "_second", "_spans", "_discard", "_better")
