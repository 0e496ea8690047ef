"""Benchmark decontamination by template canonicalisation. Only DataFrame operations are used.

Texts become templates: lower-case words without punctuation in which numbers, units and capitalised words are typed
placeholders. A question that was asked again with other numbers or names has the same template. Windows of template words are
hash-joined with those of the benchmark and compared word by word; then the slots are held against each other: along a
stretch of windows of a document that follow an item's, equal values of the item must have become equal values in the
document, else the likeness is chance, but for windows copied with all their values.

A template needs some words besides its slots to tell anything. Windows of an item's own words, whatever they are, are
looked for as well, case and punctuation aside: so copies are found of items that are short, made of numbers, or put in
other letters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onomast.llm.common import stored

WINDOW = 10
#: Words other than placeholders that a window must hold to be looked for as a template.
LITERALS = 5
#: Benchmark windows (some 200 bytes each) up to which they are broadcast; more are joined by shuffle.
BROADCAST_WINDOWS = 200_000
NAME, NUMBER, UNIT = "\uE000", "\uE001", "\uE002"  # private characters, so no text's own words
#: Words that are units of measure where they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l litre litres liter liters gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents degree degrees mph kmh watt watts volt volts"
)


def _prepared(text: Column) -> Column:
    """Numbers in one piece and apart from what follows: 1,250.5km becomes 12505 km."""
    one = F.regexp_replace(text, r"(?<=\p{N})[.,](?=\p{N})", "")
    return F.when(text.rlike("[0-9]"), F.regexp_replace(one, r"(?<=\p{N})(?=\p{L})", " ")).otherwise(text)


def _words(text: Column) -> Column:
    return F.split(F.lower(text), r"[^\p{L}\p{N}\x{E000}-\x{E002}]+")


def raw_words(text: Column) -> Column:
    return _words(_prepared(text))


def template_words(text: Column) -> Column:
    """As many words as :func:`raw_words`; capitalised words count as names, wherever they stand."""
    named = F.regexp_replace(_prepared(text), r"(?<![\p{L}\p{N}])\p{Lu}\p{Ll}+(?![\p{L}\p{N}])", NAME)
    numbered = F.regexp_replace(F.regexp_replace(F.lower(named), rf"\p{{N}}+(?![\p{{L}}\p{{N}}])(?<![\p{{L}}]\p{{N}}{{1,20}})", NUMBER), rf"(?<={NUMBER}[^\p{{L}}\p{{N}}]{{1,3}})(?:{'|'.join(sorted(UNITS.split(), key=len, reverse=True))})(?![\p{{L}}\p{{N}}])", UNIT)
    return F.split(F.when(named.rlike(r"\p{N}"), numbered).otherwise(F.lower(named)), r"[^\p{L}\p{N}\x{E000}-\x{E002}]+")


def is_slot(word: Column) -> Column:
    return word.isin(NAME, NUMBER, UNIT)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, at, n, template and values of each window, ``words`` to look for, whether they are the template (``slotted``), and their hash.

    Every window is looked for by its values; one with a slot and enough literal words by its template too. Items shorter
    than a window are one window.
    """
    items = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("t"))
    items = items.select("item_id", template_words(F.col("t")).alias("w"), raw_words(F.col("t")).alias("r"))
    pairs = F.filter(F.arrays_zip("w", "r"), lambda p: p["w"] != "")
    items = items.select("item_id", pairs["w"].alias("w"), pairs["r"].alias("r")).where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    each = items.select("item_id", "w", "r", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("at"))
    each = each.select("item_id", "at", "n", F.slice("w", F.col("at"), F.col("n")).alias("template"), F.slice("r", F.col("at"), F.col("n")).alias("values"))
    slots = F.size(F.filter("template", is_slot))
    whole = each.withColumn("words", F.col("values")).withColumn("slotted", F.lit(False))
    shaped = each.where((slots > 0) & (F.col("n") - slots >= LITERALS)).withColumn("words", F.col("template")).withColumn("slotted", F.lit(True))
    return whole.unionByName(shaped).withColumn("hash", F.xxhash64("words"))


def _windows(texts: DataFrame, n: int, slotted: bool) -> DataFrame:
    """doc_id, row (hash of the text), at, words, hash and the raw values of each window of n words, as template or as they are.

    With a broadcast join on top this is one stage of generated code: words and values are worked out in place, and of a
    document's columns nothing is copied for a window that does not match. Texts too short give a row that matches nothing.
    """
    cols = {"r": raw_words(F.col("t"))} | ({"w": template_words(F.col("t"))} if slotted else {})
    kind = "w" if slotted else "r"
    at = F.explode_outer(F.when(F.size(kind) >= n, F.sequence(F.lit(1), F.size(kind) - n + 1)))
    words, values = F.slice(kind, F.col("at"), F.lit(n)), F.slice("r", F.col("at"), F.lit(n))
    found = texts.select("doc_id", F.xxhash64("t").alias("row"), *[c.alias(x) for x, c in cols.items()]).select("doc_id", "row", *cols, at.alias("at"))
    return found.select("doc_id", "row", "at", words.alias("words"), F.when(F.col("at").isNotNull(), F.xxhash64(words)).alias("hash"), values.alias("values"))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row, item_id, shift, windows and exact of each alignment of a text with an item that agrees."""
    known = stored(benchmark_windows(benchmark, window), "benchmark-windows")
    sizes = [(r.n, r.slotted) for r in known.select("n", "slotted").distinct().collect()] or [(window, False)]  # at most two for each width
    small = known.count() <= BROADCAST_WINDOWS
    known = known.select("hash", "slotted", F.col("words").alias("known"), "template", "item_id", F.col("at").alias("item_at"), F.col("values").alias("item_values"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    hits = []
    for n, slotted in sorted(sizes):
        own = known.where(F.col("slotted") == slotted).drop("slotted")
        if small:
            hits.append(_windows(texts, n, slotted).join(F.broadcast(own), "hash"))
            continue
        hashes = F.broadcast(own.select("hash").distinct()) if own.count() <= BROADCAST_WINDOWS else own.select("hash").distinct()
        rows = _windows(texts, n, slotted).select("row", "hash").join(hashes, "hash", "left_semi").select("row").distinct()
        near = texts.withColumn("row", F.xxhash64("t")).join(rows, "row", "left_semi").drop("row")
        hits.append(_windows(near, n, slotted).join(own, "hash"))
    hit = reduce(DataFrame.unionByName, hits).where((F.col("words") <= F.col("known")) & (F.col("words") >= F.col("known")))  # equal, but no join key
    slots = F.filter(F.arrays_zip(F.col("template").alias("w"), F.col("item_values").alias("a"), F.col("values").alias("b")), lambda s: is_slot(s["w"]))
    aligned = hit.select("doc_id", "row", "item_id", (F.col("at") - F.col("item_at")).alias("shift"), "at", slots.alias("slots"))
    along = Window.partitionBy("doc_id", "row", "item_id", "shift").orderBy("at")
    equal = lambda s: s["a"] == s["b"]
    # a window may be found by template and by values: places are counted once
    stretches = aligned.withColumn("stretch", F.col("at") - F.dense_rank().over(along)).groupBy("doc_id", "row", "item_id", "shift", "stretch")
    grouped = stretches.agg(F.size(F.collect_set("at")).alias("all"), F.size(F.collect_set(F.when(F.forall("slots", equal), F.col("at")))).alias("copied"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    agrees = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["w"], s["a"]))))
    kept = grouped.select("doc_id", "row", "item_id", "shift", F.when(agrees, F.col("all")).otherwise(F.col("copied")).alias("windows"), (~agrees | F.forall("slots", equal)).alias("exact"))
    return kept.where("windows > 0").groupBy("doc_id", "row", "item_id", "shift").agg(F.sum("windows").alias("windows"), F.bool_and("exact").alias("exact"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document, item and alignment that agree: doc_id, item_id, shift, windows, exact (all slots equal).

    Slots are held against each other over each stretch of windows that follow one another in one text. A stretch in
    which they conflict keeps its windows whose slots all equal the item's, and no others; these count as exact.
    A null text or one shorter than a window matches nothing. Items shorter than a window are looked for whole; windows and
    items with fewer than ``LITERALS`` words besides slots by their very words only, however few. Rows with one id (or
    without) are judged text by text and reported together. Rows repeated whole count once. Other columns play no part.
    Empty tables match nothing.
    """
    return _judged(docs, benchmark, window, id_col, text_col).groupBy("doc_id", "item_id", "shift").agg(F.sum("windows").alias("windows"), F.bool_and("exact").alias("exact"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document with benchmark content: doc_id, item_ids (rising), windows, exact (of any item a true copy).

    Nulls, repeats and empty tables as of :func:`matches`.
    """
    return matches(docs, benchmark, window, id_col, text_col).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.sum("windows").alias("windows"), F.bool_or("exact").alias("exact"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark content.

    Rows are judged by their own text: of rows with one id, or without, only those with the content go. Null texts stay. An
    empty benchmark takes nothing, an empty table gives no rows.
    """
    bad = _judged(docs, benchmark, window, id_col, text_col).select(F.col("row").alias("_bad")).distinct()
    return docs.join(bad, F.xxhash64(text_col) == bad["_bad"], "left_anti")
