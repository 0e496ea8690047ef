"""Text helpers that keep the meaning of Unicode-aware string methods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(c: Column) -> Column:
    """White space of any kind removed from both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_upper(c: Column) -> Column:
    """At least one letter with a case, none of them lower."""
    return (c == F.upper(c)) & (c != F.lower(c))


def is_lower(c: Column) -> Column:
    return (c == F.lower(c)) & (c != F.upper(c))


def titled(c: Column) -> Column:
    """Each letter upper after a non-letter, lower after a letter: D'ÁVILA-COSTA becomes D'Ávila-Costa."""
    chars = F.split(c, "")
    letter = lambda x: x.rlike(r"^\p{L}$")
    cased = F.transform(chars, lambda x, i: F.when((i > 0) & letter(F.get(chars, i - 1)), F.lower(x)).otherwise(F.upper(x)))
    return F.array_join(cased, "")


def matches_of(c: Column, pattern: str) -> Column:
    """How often a pattern occurs, without overlaps."""
    return F.regexp_count(c, F.lit(pattern))


def non_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
