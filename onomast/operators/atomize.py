"""Splitting strings of several people into names: at one kind of separator, the first that applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onomast.functions.text import stripped
from onomast.schema import PERSON_SET

ATOM = "struct<text:string,original_formatting:string,position:int,separator_used:string>"

# What separates names.
ET_AL = r"(?iU)et\.?\s*al\.?"
ET_AL_AT_END = r"(?iU)\s*et\.?\s*al\.?\s*$"
ET_ALLI_AT_END = r"(?iU)\s*et\.?\s*alli\.?\s*$"
NUMBER_AFTER_SPACE = r"(?U)\s+\d+(?=[,;\s|]|$)"
NUMBER_AFTER_COMMA = r"(?U),\s*\d+(?=[,;\s|]|$)"
COMMA_LIST = r"(?U)[A-Z][a-z]+,\s*[A-Z]\..*,\s*[A-Z]"
COMMA_BEFORE_NAME = r"(?U),\s*(?=[A-Z][a-z]+)"


def cleared(c: Column) -> Column:
    """Without a closing et al. and without numbers of single names."""
    short = F.regexp_replace(F.regexp_replace(c, ET_AL_AT_END, ""), ET_ALLI_AT_END, "")
    c = F.when(c.rlike(ET_AL), short).otherwise(c)
    return F.regexp_replace(F.regexp_replace(c, NUMBER_AFTER_SPACE, ""), NUMBER_AFTER_COMMA, "")


def parted(c: Column) -> Column:
    """Parts of a cleared text and the separator between them: struct of parts, separator."""
    both = lambda parts, sep: F.struct(parts.alias("parts"), F.lit(sep).alias("separator"))
    has = lambda s: F.contains(c, F.lit(s))
    return (
        F.when(has("|"), both(F.split(c, r"\|"), ";"))
        .when(has(";"), both(F.split(c, ";"), ";"))
        .when(has("&"), both(F.split(c, "&"), "&"))
        .when(c.rlike(COMMA_LIST), both(F.split(c, COMMA_BEFORE_NAME), ";"))
        .when(F.contains(F.lower(c), F.lit(" e ")), both(F.split(c, r"(?iU)\s+e\s+"), "&"))
        .when(F.contains(F.lower(c), F.lit(" and ")), both(F.split(c, r"(?iU)\s+and\s+"), "&"))
        .otherwise(both(F.array(c), "none"))
    )


def atoms(parts: Column, separator: Column) -> Column:
    """Names with their place before empty parts were dropped; the first has no separator."""
    each = F.transform(parts, lambda x, i: F.struct(stripped(x).alias("text"), stripped(x).alias("original_formatting"), i.cast("int").alias("position"), F.when(i > 0, separator).otherwise(F.lit("none")).alias("separator_used")))
    return F.filter(each, lambda a: F.length(a["text"]) > 0)


def atomize(df: DataFrame, column: str = "classification") -> DataFrame:
    """Add ``atoms`` (array of ``ATOM``): empty for anything that is not a set of people."""
    c = F.col(column)
    out = df.withColumn("_cleared", F.when(c["category"] == PERSON_SET, cleared(c["sanitized_text"]))).withColumn("_parted", parted(F.col("_cleared")))
    none = F.array().cast(f"array<{ATOM}>")
    return out.withColumn("atoms", F.when(F.col("_cleared").isNull(), none).otherwise(atoms(F.col("_parted.parts"), F.col("_parted.separator")))).drop("_cleared", "_parted")


def names(df: DataFrame, column: str = "classification") -> DataFrame:
    """One row for each name: ``position`` among its record's and ``name``, the whole text where there are no atoms.

    Category and confidence pass through the explosion with the name: a later filter on them stops there, where pushed
    further it would work the decision list out twice. The array is never empty, so the explosion can be an outer one.
    """
    c = F.col(column)
    one = lambda position, name: F.struct(position.alias("position"), name.alias("name"), c["category"].alias("category"), c["confidence"].alias("confidence"))
    each = F.transform("atoms", lambda a: one(a["position"], a["text"]))
    out = df.withColumn("_each", F.explode_outer(F.when(F.size("atoms") > 0, each).otherwise(F.array(one(F.lit(0), c["sanitized_text"])))))
    return out.withColumns({x: F.col(f"_each.{x}") for x in ("position", "name", "category", "confidence")}).drop("_each")
