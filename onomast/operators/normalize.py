"""Normalisation of single names, with a record of the rules that changed something."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onomast.functions.text import stripped

#: Name of each rule and what it does, in order.
RULES: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("remove_leading_separators", lambda c: F.regexp_replace(c, r"(?U)^[;,&\s]+", "")),
    ("remove_trailing_separators", lambda c: F.regexp_replace(c, r"(?U)[;,&\s]+$", "")),
    ("remove_extra_spaces", lambda c: F.when(F.contains(c, F.lit("  ")) | (c != stripped(c)), stripped(F.regexp_replace(c, r"(?U)\s+", " "))).otherwise(c)),
    ("standardize_punctuation", lambda c: stripped(F.regexp_replace(c, r"(?U)\s*([,;.&])\s*", "$1 "))),
    ("uppercase", F.upper),
    ("strip_leading_separators_post", lambda c: F.regexp_replace(c, r"(?U)^[;\s]+", "")),
    ("remove_leading_conjunction_e", lambda c: F.when(F.startswith(c, F.lit("E ")), F.substring(c, 3, 1 << 30)).otherwise(c)),
)


def normalize(df: DataFrame, name_col: str = "name") -> DataFrame:
    """Add ``normalized`` and ``rules_applied``."""
    out = df.withColumn("_n0", F.col(name_col))
    for i, (_, rule) in enumerate(RULES):
        out = out.withColumn(f"_n{i + 1}", rule(F.col(f"_n{i}")))
    steps = [F.when(F.col(f"_n{i}") != F.col(f"_n{i + 1}"), F.lit(name)) for i, (name, _) in enumerate(RULES)]
    out = out.withColumn("normalized", F.col(f"_n{len(RULES)}")).withColumn("rules_applied", F.array_compact(F.array(*steps)))
    return out.drop(*[f"_n{i}" for i in range(len(RULES) + 1)])


def normalized(c: Column) -> Column:
    """The normal form alone."""
    for _, rule in RULES:
        c = rule(c)
    return c
