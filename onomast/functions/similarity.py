"""Name similarity: edit distance, Jaro-Winkler, phonetic agreement and their weighted sum."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from onomast.functions.text import non_empty


def levenshtein_score(a: Column, b: Column) -> Column:
    """1 less the edit distance over the longer length; 0 where either is empty."""
    both = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(both, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))).otherwise(F.lit(0.0))


def jaro_winkler_value(a: str | None, b: str | None, scale: float = 0.1, boost_over: float = 0.7) -> float:
    """Jaro (1989) with Winkler's bonus (1990) for up to four common first letters where the rest is alike; 0 where either is empty."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    if not mine:
        return 0.0
    theirs = [c for c, t in zip(b, taken, strict=True) if t]
    m, swaps = len(mine), sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= boost_over:
        return jaro
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * scale * (1 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler_value(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


_VOWELS = frozenset("AEIOU")


def metaphone_value(text: str | None) -> str:
    """Metaphone (Philips 1990) of each word, words kept apart by one space; marks and accents play no part."""
    import unicodedata

    plain = unicodedata.normalize("NFD", (text or "").upper())
    words = re.split(r"\s+", "".join(c for c in plain if "A" <= c <= "Z" or c.isspace()).strip())
    return " ".join(x for x in map(_word_code, words) if x)


def _word_code(w: str) -> str:
    w = re.sub(r"([A-BD-Z])\1", r"\1", w)  # doubled letters count once, but C
    if w[:2] in ("AE", "GN", "KN", "PN", "WR"):
        w = w[1:]
    elif w[:1] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out, n, i = [], len(w), 0
    at = lambda k: w[k] if 0 <= k < n else ""
    while i < n:
        c, before, after, step = w[i], at(i - 1), at(i + 1), 1
        if c in _VOWELS:
            if i == 0:
                out.append(c)
        elif c == "B":
            if not (before == "M" and i == n - 1):
                out.append("B")
        elif c == "C":
            if after and after in "EIY":
                if before == "S":
                    pass
                elif w[i + 1 : i + 3] == "IA":
                    out.append("X")
                else:
                    out.append("S")
            elif after == "H":
                out.append("K" if before == "S" or (i == 0 and at(i + 2) not in _VOWELS) else "X")
                step = 2
            else:
                out.append("K")
        elif c == "D":
            if after == "G" and at(i + 2) and at(i + 2) in "EIY":
                out.append("J")
                step = 2
            else:
                out.append("T")
        elif c == "G":
            if after == "H" and not (i + 2 >= n or at(i + 2) in _VOWELS):
                pass
            elif after == "N" and (i + 2 >= n or w[i + 1 :] == "NED"):
                pass
            elif after and after in "EIY" and before != "G":
                out.append("J")
            else:
                out.append("K")
        elif c == "H":
            if after in _VOWELS and not (before and before in "CSPTG"):
                out.append("H")
        elif c == "K":
            if before != "C":
                out.append("K")
        elif c == "P":
            out.append("F" if after == "H" else "P")
        elif c == "Q":
            out.append("K")
        elif c == "S":
            if after == "H":
                out.append("X")
                step = 2
            elif after == "I" and at(i + 2) and at(i + 2) in "OA":
                out.append("X")
            else:
                out.append("S")
        elif c == "T":
            if after == "I" and at(i + 2) and at(i + 2) in "OA":
                out.append("X")
            elif after == "H":
                out.append("0")
                step = 2
            elif w[i + 1 : i + 3] != "CH":
                out.append("T")
        elif c == "V":
            out.append("F")
        elif c in "WY":
            if after in _VOWELS and after:
                out.append(c)
        elif c == "X":
            out.append("KS")
        elif c == "Z":
            out.append("S")
        else:
            out.append(c)
        i += step
    return "".join(out)


@F.pandas_udf(StringType())
def metaphone(text: pd.Series) -> pd.Series:
    return text.map(metaphone_value)


def phonetic_match(a: Column, b: Column) -> Column:
    """Whether both are non-empty and sound alike."""
    return F.when(non_empty(a).isNotNull() & non_empty(b).isNotNull(), metaphone(a) == metaphone(b)).otherwise(F.lit(False))


def prepared(c: Column) -> Column:
    """Initials without their dot where a word follows at once, white space in single spaces, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?U)\b([A-Z])\.\b", "$1"), r"(?U)\s+", " "), r"(?U)^\s+|\s+$", "")


def weighted(levenshtein: Column, jaro_winkler: Column, same_sound: Column, weights: tuple[float, float, float] = (0.4, 0.4, 0.2)) -> Column:
    a, b, c = weights
    return levenshtein * a + jaro_winkler * b + F.when(same_sound, F.lit(c)).otherwise(F.lit(0.0))


def similarity_score(a: Column, b: Column, weights: tuple[float, float, float] = (0.4, 0.4, 0.2)) -> Column:
    """Weighted sum of the three scores of the prepared strings."""
    x, y = prepared(a), prepared(b)
    return weighted(levenshtein_score(x, y), jaro_winkler_score(x, y), phonetic_match(x, y), weights)


def similarity_value(a: str, b: str, weights: tuple[float, float, float] = (0.4, 0.4, 0.2), codes: tuple[str, str] | None = None) -> float:
    """The same of two Python strings; ``codes`` are their metaphone codes where known."""
    x, y = prepared_value(a), prepared_value(b)
    if not x or not y:
        return 0.0
    code_x, code_y = codes or (metaphone_value(x), metaphone_value(y))
    near = 1 - edit_distance(x, y) / max(len(x), len(y))
    return weights[0] * near + weights[1] * jaro_winkler_value(x, y) + (weights[2] if code_x == code_y else 0.0)


def prepared_value(s: str) -> str:
    return re.sub(r"\s+", " ", re.sub(r"\b([A-Z])\.\b", r"\1", s)).strip()


def edit_distance(a: str, b: str) -> int:
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
