"""Classification of raw collector strings: an ordered decision list, compiled to one CASE expression.

The list is data: ``RULES`` can be read, extended or replaced. The first rule that holds decides.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onomast.functions.text import is_lower, is_upper, matches_of, stripped
from onomast.schema import COMPANY, PERSON, PERSON_GROUP, PERSON_SET, REVIEW_BELOW, UNDETERMINED

# The words and patterns that define the categories.
UNKNOWN_NAMES = ("?", "sem coletor", "não identificado", "s.c.", "s/c")
SEPARATORS = (";", "&", "et al.", " e ", " and ", "|")
GROUP_WORDS = ("pesquisas", "grupo", "equipe", "time", "laboratório", "lab", "turma", "bioveg")
ACRONYM = r"^[A-Z]{2,}$"
INITIALS = r"(?U)\b[A-Z]\.\s*[A-Z]\.?"
SURNAME_COMMA_INITIAL = r"(?U)[A-Z][a-z]+,\s*[A-Z]\."
INITIALS_CAPITAL_SURNAME = r"(?U)[A-Z]\.\s*[A-Z]\.\s*[A-Z][A-Z\-]+(?:,|$|\s*&)"
NUMBER_BETWEEN_NAMES = r"(?U)[A-Za-z]+\s+\d+[,;\s]+[A-Z]\.?"
GROUP_IN_LIST = r"(?iU),\s*(ALUNOS|EQUIPE|GRUPO)"
NAME_AMPERSAND = r"(?U)[A-Z][a-z]+,\s*[A-Z]\.\s*[A-Z]?\.*\s*&"
INITIAL_SURNAME = r"(?U)[A-Z]\.\s*[A-Z][a-z]+"
SURNAME_INITIALS = r"(?U)^[A-ZÀ-Ú][a-zà-ú]+(?:-[A-ZÀ-Ú][a-zà-ú]+)?,\s*[A-ZÀ-Ú]\.(?:[A-ZÀ-Ú]\.)*"

CLASSIFICATION = "struct<original_text:string,sanitized_text:string,category:string,confidence:double,patterns_matched:array<string>,should_atomize:boolean>"


@dataclass(frozen=True)
class Rule:
    """A condition on the sanitized text and what it means."""

    name: str
    holds: Callable[[Column], Column]
    category: str
    confidence: float
    patterns: tuple[str, ...]
    atomize: bool = False


def _any(*conditions: Column) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def has_separator(c: Column) -> Column:
    return _any(*[F.contains(c, F.lit(s)) for s in SEPARATORS])


def _several_people(c: Column) -> Column:
    return _any(
        has_separator(c) & c.rlike(INITIALS),
        matches_of(c, SURNAME_COMMA_INITIAL) >= 2,
        matches_of(c, INITIALS_CAPITAL_SURNAME) >= 2,
        matches_of(c, ",") >= 3,
        c.rlike(NUMBER_BETWEEN_NAMES),
        c.rlike(GROUP_IN_LIST),
        c.rlike(NAME_AMPERSAND),
        matches_of(c, INITIAL_SURNAME) >= 2,
    )


def _one_word(c: Column) -> Column:
    return ~c.rlike("[ ,.]")


RULES: tuple[Rule, ...] = (
    Rule("unknown", lambda c: F.lower(c).isin(*UNKNOWN_NAMES), UNDETERMINED, 1.0, ("exact_match",)),
    Rule("acronym", lambda c: c.rlike(ACRONYM), COMPANY, 0.85, ("all_caps_acronym",)),
    Rule("several", _several_people, PERSON_SET, 0.82, ("multiple_names", "separator_detected"), atomize=True),
    Rule("surname_initials", lambda c: c.rlike(SURNAME_INITIALS), PERSON, 0.80, ("surname_initials_format",)),
    Rule("initials", lambda c: c.rlike(INITIALS) & ~has_separator(c), PERSON, 0.65, ("single_name_with_initials",)),
    Rule("generic", lambda c: _one_word(c) & ((F.length(c) <= 3) | is_upper(c) | is_lower(c)), UNDETERMINED, 0.0, ("generic_single_name",)),
    Rule("surname", _one_word, PERSON, 0.55, ("single_surname_only",)),
    Rule("group", lambda c: _any(*[F.contains(F.lower(c), F.lit(w)) for w in GROUP_WORDS]), PERSON_GROUP, 0.75, ("group_keyword",)),
    Rule("default", lambda c: F.lit(True), PERSON, 0.60, ("default_fallback",)),
)


def sanitized(c: Column) -> Column:
    """A collection number at the end removed, in parentheses or bare, with a letter after it or without; then separators at both ends."""
    c = F.regexp_replace(stripped(c), r"(?U)\s*\(\d+[A-Za-z]?\)\s*$", "")
    c = F.regexp_replace(c, r"(?U)[\s,;-]*\b\d+[A-Za-z]?\b\s*$", "")
    return F.btrim(c, F.lit(" ,;-"))


def decided(c: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The number of the first rule that holds, from 0; null where none does."""
    out = F.when(rules[0].holds(c), F.lit(0))
    for i, r in enumerate(rules[1:], 1):
        out = out.when(r.holds(c), F.lit(i))
    return out


def classify(df: DataFrame, text_col: str = "collector_text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``classification`` (see ``CLASSIFICATION``), null where the text is null or nothing is left of it."""
    out = df.withColumn("_sanitized", sanitized(F.col(text_col))).withColumn("_decided", decided(F.col("_sanitized"), rules))
    # what a rule means is looked up by its number: the generated code holds the conditions alone
    of_rule = lambda values: F.get(F.array(*values), F.col("_decided"))
    whole = F.struct(
        stripped(F.col(text_col)).alias("original_text"), F.col("_sanitized").alias("sanitized_text"), of_rule(F.lit(r.category) for r in rules).alias("category"), of_rule(F.lit(r.confidence) for r in rules).alias("confidence"),
        of_rule(F.array(*map(F.lit, r.patterns)) for r in rules).alias("patterns_matched"), of_rule(F.lit(r.atomize) for r in rules).alias("should_atomize"),
    )
    return out.withColumn("classification", F.when(F.length("_sanitized") > 0, whole)).drop("_sanitized", "_decided")


def needs_review(confidence: Column) -> Column:
    return confidence < REVIEW_BELOW
