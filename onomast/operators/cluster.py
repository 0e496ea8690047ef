"""Grouping spellings of one name into entities.

``leader`` follows the order of arrival: each name joins the best entity known so far, or founds one; a longer spelling of a
person's name becomes the entity's own, which changes what later names find. Names are held against canonical names, both in
capitals. That is sequential by its meaning, but a name only ever meets spellings that it reaches the threshold with. So all
spellings that are names or can become canonical names are paired and scored first, by joins; those that hang together
form components, and names of different components never meet. Between two changes (an entity is made or renamed) a name goes on
joining what it joins, so only the sights that change something must be gone through in order. Each component gets the first few
sights of each of its names, and gives the steps of what each name joins from when on; where a name may change something after
its last sight at hand, the component goes on from there in another round, with more sights of each. All sights are then told their
entity by the steps and summed up, by joins and aggregations. ``graph`` does not depend on order: candidate pairs of distinct
names come from equi-joins that miss no pair over the threshold, are scored, and each name joins its best leader. The two are
different groupings.

Both go on from a stored table: entities that are known take part as if their names had come first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from onomast.functions.similarity import jaro_winkler_score, levenshtein_score, metaphone, prepared, weighted
from onomast.operators.canonical import canonical_form, numbered
from onomast.operators.links import components
from onomast.schema import ENTITY, PERSON, VARIATION, stored_confidence
from onomast.scratch import stored

THRESHOLD = 0.70
WEIGHTS = (0.4, 0.4, 0.2)
#: Names of one code that are all paired with each other.
CROWD = 64
#: Sights of each name that a component is given in the first round, and how many times more in each further one.
SIGHTS, MORE = 64, 8
_FOUND = "what string, component bigint, entityType string, i bigint, id bigint, name string, upper string, score double, open boolean, order string, position bigint, by string, after int"


def canonical_value(name: str, entity_type: str) -> str:
    parts = name.split(",")
    if entity_type == PERSON and len(parts) == 2:
        return f"{parts[0].title().strip()}, {parts[1].strip()}"
    return name.title()


@F.pandas_udf(StructType([StructField("upper", StringType()), StructField("own", StringType())]))
def _forms(name: pd.Series, entity_type: pd.Series) -> pd.DataFrame:
    """A name in capitals, and the canonical name in capitals of an entity that takes it as its own."""
    own = [None if n is None else canonical_value(n, t).upper() for n, t in zip(name, entity_type, strict=True)]
    return pd.DataFrame({"upper": name.str.upper(), "own": own})


@F.pandas_udf(StringType())
def _capitals(name: pd.Series) -> pd.Series:
    return name.str.upper()


class Leaders:
    """The entities of one component of one type while some sights of its names come in order, and the steps of what each name joins.

    ``near`` has for a name in capitals the canonical names in capitals that it reaches the threshold with, and the scores. Entities
    have numbers in the order of their making. A sight is known by its key: order, position and name.
    """

    def __init__(self, component: int, entity_type: str, near: dict[str, list[tuple[str, float]]]):
        self.component, self.entity_type, self.near = component, entity_type, near
        self.names: dict[int, str] = {}
        self.next = 0
        self.known: set[int] = set()
        self.by_upper: dict[str, set[int]] = defaultdict(set)
        self.joined: dict[str, tuple[float, int] | None] = {}  # score (2 for an equal name) and number, negative, so that the greatest is the best
        self.told: dict[str, tuple[int, float]] = {}
        self.behind: dict[str, list[str]] = defaultdict(list)  # names by their capitals that may have sights which are not at hand
        self.steps: list[tuple] = []
        self.stop: tuple | None = None

    def seed(self, i: int, known: bool, name: str) -> None:
        """Take an entity made before, in the order of numbers; that of one ``known`` from a stored table is its id."""
        self.names[i] = name
        self.by_upper[name.upper()].add(i)
        self.next = i + 1
        if known:
            self.known.add(i)

    def best(self, upper: str) -> tuple[float, int] | None:
        """What a name in capitals joins: the entity of an equal canonical name, else the best over the threshold, the oldest of equals."""
        if upper not in self.joined:
            same = [(2.0, -i) for i in self.by_upper.get(upper, ())]
            self.joined[upper] = max(same or ((score, -i) for other, score in self.near.get(upper, ()) for i in self.by_upper.get(other, ())), default=None)
        return self.joined[upper]

    def changes(self, name: str, found: tuple[float, int] | None) -> bool:
        """Whether a sight of the name would make or rename an entity."""
        if found is None:
            return True
        held = self.names[-found[1]]
        return self.entity_type == PERSON and len(name.split()) > len(held.split()) and canonical_value(name, self.entity_type) != held

    def tell(self, name: str, upper: str, i: int, score: float, key: tuple, after: int) -> None:
        """Note what a name joins from this key on; with ``after`` behind it only."""
        if self.told.get(name) != (i, score):
            self.told[name] = i, score
            self.steps.append(("step", self.component, self.entity_type, i, None, name, upper, score, None, *key, after))

    def look_behind(self, upper: str, key: tuple) -> None:
        """Names that may be seen again, nobody knows when: note what they join, and stop if they would change something."""
        for name in self.behind.get(upper, ()):
            found = self.best(upper)
            if found:
                self.tell(name, upper, -found[1], min(found[0], 1.0), key, 1)
            if self.changes(name, found):
                self.stop = key

    def rename(self, i: int, name: str, key: tuple) -> None:
        """Make an entity or rename it, and find anew what the names near it join."""
        touched = set()
        if i in self.names:
            old = self.names[i].upper()
            self.by_upper[old].discard(i)
            for u in (old, *(u for u, _ in self.near.get(old, ()))):
                if (found := self.joined.get(u)) and -found[1] == i:
                    del self.joined[u]
                    touched.add(u)
        self.names[i], self.next = name, max(self.next, i + 1)
        new = name.upper()
        self.by_upper[new].add(i)
        for u, score in ((new, 2.0), *self.near.get(new, ())):
            if u in self.joined and (self.joined[u] is None or (score, -i) > self.joined[u]):
                self.joined[u] = score, -i
                touched.add(u)
        for u in touched:
            self.look_behind(u, key)

    def take(self, name: str, key: tuple, last: bool) -> None:
        """A sight of a name; ``last`` if it is the last one at hand."""
        upper = name.upper()
        found = self.best(upper)
        i, score = (-found[1], min(found[0], 1.0)) if found else (self.next, 1.0)
        self.tell(name, upper, i, score, key, 0)
        if self.changes(name, found):
            self.rename(i, canonical_value(name, self.entity_type), key)
        if last:
            self.behind[upper].append(name)
            self.look_behind(upper, key)

    def rows(self) -> list[tuple]:
        """Steps, and all entities as they stand at the end or where a further round goes on."""
        at = self.stop or (None, None, None)
        return self.steps + [("entity", self.component, self.entity_type, i, i if i in self.known else None, n, None, None, self.stop is not None, *at, None) for i, n in self.names.items()]


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole components after each other: first what is near what, then entities made before, then sights."""
    columns = [x.split()[0] for x in _FOUND.split(", ")]
    held: dict[str, Leaders] = {}
    now, done = None, []

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns).astype({"i": "Int64", "id": "Int64", "position": "Int64", "after": "Int32", "open": "boolean"})

    for b in batches:
        for component, step, kind, name, other, score, order, position, last in zip(*(b[c] for c in ("component", "step", "entityType", "normalized", "other", "score", "order", "position", "last")), strict=True):
            if component != now:
                done += [r for x in held.values() for r in x.rows()]
                held, now = {}, component
            if kind not in held:
                held[kind] = Leaders(component, kind, defaultdict(list))
            if step == 0:
                held[kind].near[name].append((other, score))
            elif step == 1:
                held[kind].seed(position, last, name)
            elif held[kind].stop is None:
                held[kind].take(name, (order, position, name), last)
        if len(done) > 1000:
            yield frame(done)
            done = []
    yield frame(done + [r for x in held.values() for r in x.rows()])


def settled(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs with scores to nine places, of which those stay that reach the threshold: scores that differ by the order of additions only are equal, and the older entity wins."""
    return pairs.withColumn("score", F.round("score", 9)).where(F.col("score") >= threshold)


def first_sights(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` sights of each name, and whether a sight is the last of so many. Fewer are left before anything is shuffled."""
    rank = F.row_number().over(Window.partitionBy("entityType", "normalized").orderBy("order", "position"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= most).withColumn("last", F.col("rank") == most).drop("rank")


def _summed_up(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """Sights told their entity by the steps of their names: component, entityType, i, upper, n, first and last (structs of a sight's key and what it bears)."""
    at = F.struct("order", "position", "by", "after")
    of_names = steps.groupBy("entityType", F.col("name").alias("normalized")).agg(F.min("component").alias("component"), F.min("upper").alias("upper"), F.array_sort(F.collect_list(F.struct(at.alias("at"), "i", "score"))).alias("steps"))
    of_names = of_names.withColumn("final", F.element_at("steps", -1))
    key = F.struct("order", "position", F.col("normalized").alias("by"), F.lit(0).alias("after"))
    step = F.when(F.col("final.at") <= key, F.col("final")).otherwise(F.array_max(F.filter("steps", lambda s: s["at"] <= key)))
    told = rows.join(of_names, ["entityType", "normalized"]).withColumn("step", step)
    first, last = F.struct("order", "position", "normalized", "confidence", "seen_at", "step.score"), F.struct("order", "position", "normalized", "seen_at")
    per = told.groupBy("component", "entityType", "normalized", "upper", F.col("step.i").alias("i")).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"), F.max(last).alias("last"))
    return per.groupBy("component", "entityType", "i", "upper").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def _with_known(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` (of :func:`_summed_up`) as variations, with those that entities had before: a spelling that is known is counted on, at its place."""
    one = F.struct(F.col("first.normalized").alias("variation_text"), F.col("n").alias("occurrence_count"), F.col("first.score").alias("association_confidence"), F.col("first.seen_at").alias("first_seen"), F.col("last.seen_at").alias("last_seen")).cast(VARIATION)
    old = known.select("component", "entityType", F.col("id").alias("i"), F.posexplode("variations").alias("at", "v")).withColumn("upper", _capitals("v.variation_text"))
    had = old.groupBy("component", "entityType", "i", "upper").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("had"))
    both = found.join(had, ["component", "entityType", "i", "upper"], "full_outer")
    place = lambda new, at, first: F.struct(F.lit(new).alias("new"), at.alias("at"), first["order"].alias("order"), first["position"].alias("position"), first["normalized"].alias("by"))
    none = F.lit(None).cast(found.schema["first"].dataType)
    counted = lambda h, k: F.when((k == 0) & F.col("n").isNotNull(), h["v"].withField("occurrence_count", h["v"]["occurrence_count"] + F.col("n")).withField("last_seen", F.col("last.seen_at"))).otherwise(h["v"])
    olds = F.transform("had", lambda h, k: F.struct(place(0, h["at"], none).alias("place"), counted(h, k).alias("v")))
    return both.select("component", "entityType", "i", "first", "last", F.coalesce(olds, F.array(F.struct(place(1, F.lit(0), F.col("first")).alias("place"), one.alias("v")))).alias("vs"))


def leader_entities(names: DataFrame, threshold: float = THRESHOLD, weights: tuple[float, float, float] = WEIGHTS, known: DataFrame | None = None) -> DataFrame:
    """The entity table (as of ``schema.ENTITY``) after names in the order of (order, position).

    ``names`` has entityType, normalized, confidence (at least 0.70), order (a string that sorts), position and seen_at.
    ``known`` is the table before: its entities keep their ids and are joined by names as if made in this run, so runs that
    follow one another make the table of one run over all their names. New entities have the ids that follow.
    """
    rows = stored(names.where(F.length("normalized") > 0).select("entityType", "normalized", stored_confidence(F.col("confidence")).alias("confidence"), F.coalesce(F.col("order").cast("string"), F.lit("")).alias("order"), F.coalesce(F.col("position").cast("long"), F.lit(0)).alias("position"), "seen_at"), "names")
    table = known if known is not None else names.sparkSession.createDataFrame([], ENTITY)
    spelled = rows.select("entityType", "normalized").union(table.select("entityType", "canonicalName"))
    node = lambda c: F.xxhash64("entityType", c)  # noqa: E731  names of one node would only be gone through together
    spelled = stored(spelled.distinct().withColumn("form", _forms("normalized", "entityType")).select("entityType", "normalized", "form.*"), "spelled")
    strings = stored(with_codes(spelled.select("entityType", F.explode(F.array("upper", "own")).alias("normalized")).distinct()), "strings")
    pairs = stored(settled(similar_pairs(strings, threshold - 1e-9, weights), threshold), "pairs")
    edges = pairs.select(node("a").alias("x"), node("b").alias("y")).union(spelled.select(node("upper"), node("own")))
    found = components(edges, "x", "y")
    place = lambda df, c: df.withColumn("node", node(c)).join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node")
    placed = stored(place(spelled, "upper").select("entityType", "normalized", "component"), "placed")
    near = pairs.select("entityType", F.col("a").alias("normalized"), F.col("b").alias("other"), "score").union(pairs.select("entityType", "b", "a", "score"))
    near = stored(place(near, "normalized"), "near")
    table = table.join(placed.withColumnRenamed("normalized", "canonicalName"), ["entityType", "canonicalName"])
    fields = {"component": "bigint", "step": "int", "entityType": "string", "normalized": "string", "other": "string", "score": "double", "order": "string", "position": "bigint", "last": "boolean"}
    empty = {"position": 0, "last": False}  # not null: pandas would make floats of whole numbers
    line = lambda df, step: df.withColumn("step", F.lit(step)).select(*[(F.col(c) if c in df.columns or c == "step" else F.lit(empty.get(c))).cast(t).alias(c) for c, t in fields.items()])
    seeds = table.select("component", "entityType", F.col("canonicalName").alias("normalized"), F.col("id").alias("position"), F.lit(True).alias("last"))
    left, most, rounds = rows, SIGHTS, []
    while True:
        sights = first_sights(left, most).join(placed, ["entityType", "normalized"])
        whole = line(near, 0).unionByName(line(seeds, 1)).unionByName(line(sights, 2))
        rounds.append(stored(whole.repartition("component").sortWithinPartitions("component", "step", "order", "position", "normalized").mapInPandas(_in_order, _FOUND), "round"))
        more = rounds[-1].where("what = 'entity' and open")
        if more.isEmpty():
            break
        # what is left: components that stopped, and the sights behind the place where they did
        seeds = more.select("component", "entityType", F.col("name").alias("normalized"), F.col("i").alias("position"), F.col("id").isNotNull().alias("last"))
        stops = more.select("component", "entityType", F.struct("order", "position", "by").alias("stop")).distinct()
        near = near.join(stops.select("component", "entityType"), ["component", "entityType"], "left_semi")
        left = rows.join(placed.join(stops, ["component", "entityType"]).drop("component"), ["entityType", "normalized"]).where(F.struct("order", "position", F.col("normalized").alias("by")) > F.col("stop")).drop("stop")
        most *= MORE
    told = reduce(DataFrame.union, rounds)
    by = ["component", "entityType", "i"]
    grouped = _with_known(_summed_up(rows, told.where("what = 'step'")), table).groupBy(*by).agg(F.array_sort(F.flatten(F.collect_list("vs"))).alias("vs"), F.min("first").alias("first"), F.max("last").alias("last"))
    before = table.select("component", "entityType", F.col("id").alias("i"), "classification_confidence", "grouping_confidence", "created_at", "updated_at")
    made = told.where("what = 'entity' and not open").select(*by, "id", F.col("name").alias("canonicalName")).join(grouped, by, "left").join(before, by, "left")
    last = (known.agg(F.max("id")).first()[0] or 0) if known is not None else 0
    kept = lambda c, new: F.when(F.col("id").isNull(), new).otherwise(F.col(c)).alias(c)
    return numbered(made.select(
        "id", F.col("first.order").alias("first_order"), "canonicalName", "entityType", kept("classification_confidence", F.col("first.confidence")), kept("grouping_confidence", F.lit(1.0)),
        F.coalesce(F.transform("vs", lambda x: x["v"]), F.array()).cast(f"array<{VARIATION}>").alias("variations"), kept("created_at", F.col("first.seen_at")), F.when(F.col("last").isNull(), F.col("updated_at")).otherwise(F.col("last.seen_at")).alias("updated_at"),
    ), last)


# --- graph ----------------------------------------------------------------------------------------------------------


def distinct_names(names: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """entityType, normalized, p (prepared), code, n (occurrences), first and last sight, first (order and confidence), old (least id).

    Variations of entities in ``known`` count as names that came before all others, in the order of the table.
    """
    rows = names.where(F.length("normalized") > 0).select("entityType", "normalized", F.lit(1).cast("long").alias("n"), F.col("seen_at").alias("first_seen"), F.col("seen_at").alias("last_seen"), F.struct(F.concat(F.lit("1"), F.col("order").cast("string")).alias("order"), "confidence").alias("first"), F.lit(None).cast("long").alias("old"))
    if known is not None:
        place = F.concat(F.lit("0"), F.lpad(F.col("id").cast("string"), 20, "0"), F.lpad(F.col("at").cast("string"), 10, "0"))
        each = known.select("entityType", "id", "classification_confidence", F.posexplode("variations").alias("at", "v"))
        rows = rows.unionByName(each.select("entityType", F.col("v.variation_text").alias("normalized"), F.col("v.occurrence_count").alias("n"), "v.first_seen", "v.last_seen", F.struct(place.alias("order"), F.col("classification_confidence").alias("confidence")).alias("first"), F.col("id").alias("old")))
    per = rows.groupBy("entityType", "normalized").agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.min("first").alias("first"), F.min("old").alias("old"))
    return with_codes(per)


def with_codes(names: DataFrame) -> DataFrame:
    """With p, the prepared form of ``normalized``, and code, its sound."""
    return names.withColumn("p", prepared(F.col("normalized"))).withColumn("code", metaphone(F.col("p")))


def _segments(text: Column, length: Column, edits: Column) -> Column:
    """The text cut into edits + 1 segments: array of (segment number, start, width)."""
    pieces = edits + 1
    cut = lambda i: F.floor(length * i / pieces).cast("int")
    return F.transform(F.sequence(F.lit(0), edits), lambda i: F.struct(i.alias("no"), cut(i).alias("start"), (cut(i + 1) - cut(i)).alias("width")))


def least_overlap(threshold: float = THRESHOLD, weights: tuple[float, float, float] = WEIGHTS) -> float:
    """The share of the longer name's letters, repeats counted, that two names of one sound have in common at least if they reach the threshold.

    With m letters in common, n and s the longer and the shorter length, at least n - m edits are needed, so the first score is at
    most m / n. Jaro's is at most (m / s + m / n + 1) / 3, its first two terms at most 1 and m / n, and Winkler's bonus is at most 0.4 of what is missing
    to 1: together at most 0.8 + 0.2 * m / n.
    """
    a, b, c = weights
    return (threshold - c - 0.8 * b) / (a + 0.2 * b) if a + b else 0.0


def same_sound(distinct: DataFrame, overlap: float) -> DataFrame:
    """Pairs of names of one code that may have so large a share of letters in common.

    Codes of few names give all their pairs. Of a code of more than ``CROWD`` names (all that have no Latin letter, say) each name is
    looked up under some of its letters only, each with the number of its repeat: so many of the rarest that two names with enough in
    common have one of these in common too (prefix filter).
    """
    sizes = distinct.groupBy("entityType", "code").agg(F.count(F.lit(1)).alias("names"))
    told = distinct.where(F.length("p") > 0).select("entityType", "code", "normalized", "p", F.length("p").alias("l")).join(sizes, ["entityType", "code"])
    crowded = (F.col("names") > CROWD) & F.lit(overlap > 0)
    few, many = told.where(~crowded), told.where(crowded)
    letters = F.filter(F.split("p", ""), lambda c: c != "")
    repeats = F.transform("letters", lambda c, i: F.concat(c, F.size(F.filter(F.slice("letters", 1, i + 1), lambda d: d == c)).cast("string")))
    spelled = many.withColumn("letters", letters).select("entityType", "code", "normalized", "l", F.explode(repeats).alias("letter"))
    common = spelled.groupBy("letter").agg(F.count(F.lit(1)).alias("often"))
    wanted = (F.col("l") - F.ceil(F.col("l") * overlap - 1e-9) + 1).cast("int")
    ranked = spelled.join(common, "letter").groupBy("entityType", "code", "normalized", "l").agg(F.array_sort(F.collect_list(F.struct("often", "letter"))).alias("own"))  # a name's letters
    keyed = ranked.select("entityType", "code", "normalized", "l", F.explode(F.slice("own", F.lit(1), wanted)).alias("key")).select("entityType", "code", "key.letter", "normalized", "l")
    side = lambda df, n: df.withColumnsRenamed({"normalized": n, "l": f"l{n}"})
    long_enough = F.least("la", "lb") >= F.greatest("la", "lb") * max(overlap, 0.0) - 1e-9
    of_few = side(few.drop("p", "names"), "a").join(side(few.drop("p", "names"), "b"), ["entityType", "code"])
    of_many = side(keyed, "a").join(side(keyed, "b"), ["entityType", "code", "letter"])
    return reduce(DataFrame.union, [x.where("a < b").where(long_enough).select("entityType", "a", "b") for x in (of_few, of_many)]).distinct()


def candidates(distinct: DataFrame, least: float = 0.75, overlap: float = 0.375) -> DataFrame:
    """Pairs (entityType, a, b) with a < b that may reach the threshold, each once; none that does is missed.

    Either the codes are equal and a share of the letters is common, or the edit distance is at most a quarter of the longer length. In
    the second case one of the k + 1 segments of the longer string stands unchanged in the shorter, at most k places off.
    """
    by_sound = same_sound(distinct, overlap)
    edits = lambda n: F.floor(n * (1 - least) + 1e-9).cast("int")
    sized = distinct.where(F.length("p") > 0).select("entityType", "normalized", "p", F.length("p").alias("l"))
    longer = sized.withColumn("s", F.explode(_segments(F.col("p"), F.col("l"), edits(F.col("l"))))).select("entityType", F.col("normalized").alias("x"), F.col("l"), "s.no", F.substring("p", F.col("s.start") + 1, F.col("s.width")).alias("segment"))
    reach = sized.withColumn("big", F.explode(F.sequence(F.col("l"), F.floor(F.col("l") / least + 1e-9).cast("int")))).withColumn("k", edits(F.col("big")))
    reach = reach.withColumn("s", F.explode(_segments(F.col("p"), F.col("big"), F.col("k")))).withColumn("at", F.explode(F.sequence(F.greatest(F.lit(0), F.col("s.start") - F.col("k")), F.greatest(F.lit(0), F.col("s.start") + F.col("k")))))
    reach = reach.where(F.col("at") + F.col("s.width") <= F.col("l")).select("entityType", F.col("normalized").alias("y"), F.col("big").alias("l"), "s.no", F.substring("p", F.col("at") + 1, F.col("s.width")).alias("segment")).distinct()
    by_edit = longer.join(reach, ["entityType", "l", "no", "segment"]).where("x <> y").select("entityType", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return by_sound.unionByName(by_edit).distinct()


def similar_pairs(distinct: DataFrame, threshold: float = THRESHOLD, weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """entityType, a, b and score of all pairs that reach the threshold."""
    least = max(0.0, (threshold - weights[1]) / weights[0]) if weights[0] else 0.0
    side = lambda n: distinct.select("entityType", F.col("normalized").alias(n), F.col("p").alias(f"p{n}"), F.col("code").alias(f"code{n}"))
    pairs = candidates(distinct, least, least_overlap(threshold, weights)).join(side("a"), ["entityType", "a"]).join(side("b"), ["entityType", "b"]).withColumn("close", levenshtein_score(F.col("pa"), F.col("pb"))).withColumn("alike", (F.col("codea") == F.col("codeb")) & (F.length("pa") > 0) & (F.length("pb") > 0))
    # most candidates fall on the edit distance alone, before any Python
    hopeful = pairs.where(F.col("close") * weights[0] + weights[1] + F.when(F.col("alike"), weights[2]).otherwise(0.0) >= threshold - 1e-12)
    return hopeful.withColumn("score", weighted(F.col("close"), jaro_winkler_score(F.col("pa"), F.col("pb")), F.col("alike"), weights)).where(F.col("score") >= threshold).select("entityType", "a", "b", "score")


def graph_entities(names: DataFrame, threshold: float = THRESHOLD, weights: tuple[float, float, float] = WEIGHTS, known: DataFrame | None = None) -> DataFrame:
    """Entities that do not depend on the order of arrival: columns of ``schema.ENTITY``.

    With a stored table the names of its entities are grouped anew together with the others, so runs that follow one another
    make the groups of one run. A group keeps the id that its leader had; of groups that one entity has come apart into, the
    one with the most frequent leader.

    A name leads if no similar name is more frequent (of equals: smaller); every other joins its most similar leader, or
    leads itself where none of its similar names leads. The canonical form of a person is that of the leader's longest
    spelling in words.
    """
    distinct = stored(distinct_names(names, known), "names")
    last = (known.agg(F.max("id")).first()[0] or 0) if known is not None else 0
    pairs = stored(similar_pairs(distinct, threshold, weights), "pairs")
    both = pairs.select("entityType", F.col("a").alias("x"), F.col("b").alias("y"), "score").union(pairs.select("entityType", "b", "a", "score"))
    weight = distinct.select("entityType", F.col("normalized").alias("y"), F.col("n").alias("ny"))
    ranked = both.join(weight, ["entityType", "y"]).join(weight.select("entityType", F.col("y").alias("x"), F.col("ny").alias("nx")), ["entityType", "x"])
    beaten = ranked.where((F.col("ny") > F.col("nx")) | ((F.col("ny") == F.col("nx")) & (F.col("y") < F.col("x")))).select("entityType", "x").distinct()
    leads = distinct.select("entityType", F.col("normalized").alias("y")).join(beaten.withColumnRenamed("x", "y"), ["entityType", "y"], "left_anti")
    choice = ranked.join(leads, ["entityType", "y"]).groupBy("entityType", "x").agg(F.min_by(F.struct("y", "score"), F.struct(-F.round("score", 9), -F.col("ny"), "y")).alias("c"))
    choice = choice.join(leads.withColumnRenamed("y", "x"), ["entityType", "x"], "left_anti").select("entityType", F.col("x").alias("normalized"), F.col("c.y").alias("leader"), F.col("c.score").alias("score"))
    placed = distinct.join(choice, ["entityType", "normalized"], "left").withColumn("leader", F.coalesce("leader", "normalized")).withColumn("score", F.coalesce("score", F.lit(1.0)))
    variation = F.struct(F.col("normalized").alias("variation_text"), F.col("n").alias("occurrence_count"), F.col("score").alias("association_confidence"), "first_seen", "last_seen")
    spelling = F.struct(F.size(F.split("normalized", r"\s+")).alias("words"), (F.col("normalized") == F.col("leader")).alias("own"), F.col("n").alias("n"), F.col("normalized").alias("name"))
    grouped = placed.groupBy("entityType", "leader").agg(
        F.array_sort(F.collect_list(F.struct("first.order", "normalized", variation.alias("v")))).alias("found"), F.max(spelling).alias("longest"), F.min(F.struct("first.order", "first.confidence")).alias("first"), F.min("first_seen").alias("created_at"), F.max("last_seen").alias("updated_at"),
        F.max(F.when(F.col("normalized") == F.col("leader"), F.col("old"))).alias("old"), F.max(F.when(F.col("normalized") == F.col("leader"), F.col("n"))).alias("lead"),
    )
    heir = F.row_number().over(Window.partitionBy("old").orderBy(F.desc("lead"), "leader")) == 1
    grouped = grouped.where("old is not null").withColumn("old", F.when(heir, F.col("old"))).unionByName(grouped.where("old is null")) if known is not None else grouped
    name = F.when(F.col("entityType") == PERSON, F.col("longest.name")).otherwise(F.col("leader"))
    return numbered(grouped.select(
        F.col("old").alias("id"), F.col("first.order").alias("first_order"), canonical_form(name, F.col("entityType")).alias("canonicalName"), "entityType", stored_confidence(F.col("first.confidence")).alias("classification_confidence"), F.lit(1.0).alias("grouping_confidence"),
        F.transform("found", lambda x: x["v"]).cast(f"array<{VARIATION}>").alias("variations"), "created_at", "updated_at",
    ), last)

