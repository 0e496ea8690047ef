"""SimHash near-duplicates by multi-index hashing (Charikar 2002; Norouzi, Punjani and Fleet 2012).

Fingerprints that differ in at most ``radius`` of 64 bits are linked. The bits are cut into segments; where two
fingerprints differ in r = m * q + a bits over m segments, they differ by at most q bits in one of the first a + 1
segments or by at most q - 1 bits in one of the others. So each fingerprint looks up, segment by segment, the small
Hamming ball around its own segment, and every match is held against the whole distance.

Equal fingerprints are put together first, so groups of copies cost one row. Inside a bucket the matches are reduced to
a spanning forest before they leave the task: the links returned have the components of all links, and a group of k
fingerprints sends fewer than k rows for each bucket instead of k * k.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onomast.llm import similar
from onomast.llm.common import discard, join_by_hot_key, lean, release, stored
from onomast.llm.components import components, shortened

RADIUS = 4
#: Buckets with more home rows than this (chance gives a few) are linked by a search through unvisited members, others pair by pair.
LARGE_BUCKET = 16
_STEP = 1 << 13
#: Pairs looked at in one go.
_PAIRS = 1 << 17


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _STEP):
        part = hashes[at : at + _STEP]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles; A-Z lower-cased, words between ASCII white space, repeats counted."""
    return majority(similar.shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return ids.mapInArrow(lean(run), f"doc_id {dict(ids.dtypes)['doc_id']}, fp bigint")


def _segments(m: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of m segments."""
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def segment_count(n: int, radius: int) -> int:
    """Segments for n fingerprints: balls of one bit while the segments are long enough for n, else fewer, longer ones."""
    return -(-(radius + 1) // 2) if n < 1 << 23 else max(1, -(-(radius + 1) // 3))


def _flip(own: Column, key: Column) -> Callable[[Column], Column]:
    return lambda x: F.struct((own.bitwiseXOR(x) + key).alias("key"), F.lit(False).alias("home"))


def _probes(fps: DataFrame, m: int, radius: int) -> DataFrame:
    """Rows (key, home, fp, rep): home ones fill the table, all of them search it."""
    q, a = divmod(radius, m)
    rows = []
    for s, (at, width) in enumerate(_segments(m)):
        mask = (1 << width) - 1
        own = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit(mask).cast("long"))
        key = F.lit(s).cast("long") * (1 << 48)
        reach = q if s <= a else q - 1
        rows.append(F.array(F.struct((own + key).alias("key"), F.lit(True).alias("home"))))
        flips: list[int] = []
        for i in range(width):
            if reach >= 1:
                flips.append(1 << i)
            if reach >= 2:
                flips += [(1 << i) | (1 << j) for j in range(i)]
        if reach > 2:
            raise ValueError("balls of a radius over 2 are too large; use more segments")
        if flips:
            rows.append(F.transform(F.array(*[F.lit(x).cast("long") for x in flips]), _flip(own, key)))
    return fps.select("fp", "rep", F.explode(F.concat(*rows)).alias("p")).select("p.key", "p.home", "fp", "rep")


def _forest(fp: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Spanning forest of the links between the given distinct fingerprints; each is visited once."""
    left = np.arange(len(fp))
    a, b = [], []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[x]) <= radius
            found = left[near].tolist()
            left = left[~near]
            a += [x] * len(found)
            b += found
            queue += found
    return a, b


def _bucket_links(key: np.ndarray, home: np.ndarray, fp: np.ndarray, rep: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links in whole buckets; rows are sorted by key, home rows first."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((first, [len(key)])))
    homes = np.add.reduceat(home.astype(np.int64), first)
    for i in np.flatnonzero(homes > LARGE_BUCKET):
        part = slice(first[i], first[i] + size[i])
        _, at = np.unique(fp[part], return_index=True)
        r = rep[part][at]
        a, b = _forest(fp[part][at], radius)
        yield r[a], r[b]
    small = (homes > 0) & (size > 1) & (homes <= LARGE_BUCKET)
    first, size, homes = first[small], size[small], homes[small]
    pairs, at = np.cumsum(size * homes), 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + _PAIRS, "right")))
        f, s, h, at = first[at:to], size[at:to], homes[at:to], to
        bucket = np.repeat(np.arange(len(f)), s * h)
        within = np.arange(len(bucket)) - np.repeat(np.cumsum(s * h) - s * h, s * h)
        i = f[bucket] + within // s[bucket]
        j = f[bucket] + within % s[bucket]
        ok = (fp[i] != fp[j]) & (np.bitwise_count(fp[i] ^ fp[j]) <= radius)
        yield rep[i[ok]], rep[j[ok]]


def links(fps: DataFrame, radius: int = RADIUS, segments: int | None = None) -> DataFrame:
    """Links a, b between the representatives of distinct fingerprints (columns fp, rep) with the components of all links."""
    m = segments or segment_count(fps.count(), radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for b in batches:
            cols = [b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy().view(np.uint64), b.column(3).to_numpy()]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0  # the last bucket may go on
            held = [x[cut:] for x in cols]
            if cut:
                yield from out(*[x[:cut] for x in cols])
        if held is not None and len(held[0]):
            yield from out(*held)

    def out(key: np.ndarray, home: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a, b in _bucket_links(key, home, fp, rep, radius):
            if len(a):
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    rows = _probes(fps, m, radius)
    return rows.repartition("key").sortWithinPartitions("key", F.desc("home")).mapInArrow(lean(run), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row its fingerprint and component: columns doc_id, fp (long), component_id.

    ``component_id`` is the least doc_id that links reach, the row's own included. Texts that are null or have no word
    have fingerprint zero and link like any other. Repeated rows are kept. A row with a null doc_id links like any other too; its
    component is null if no row that links reach has an id. Other columns play no part. An empty table gives no rows.
    """
    each = stored(fingerprints(docs, shingle, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")), "fingerprints")
    distinct = stored(each.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "distinct")
    # a fingerprint stands for itself in links, so rows without an id link too
    found = components(links(distinct.select("fp", F.col("fp").alias("rep")), radius), "a", "b")
    placed = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    labels = placed.join(placed.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select("fp", "n", "component_id")
    return join_by_hot_key(each, labels, "fp", "n", each.count()).select("doc_id", "fp", "component_id")


def groups(texts: DataFrame, count: int, shingle: int = 5, radius: int = RADIUS) -> DataFrame:
    """node, component for the texts (node, text; ``count`` nodes) that links reach; others give no row. A stored table.

    Links are the pairs of shingle sets with a Jaccard similarity of 0.8 or more. Fingerprints within ``radius`` bits, and the
    nearest fingerprints under the least shingles, propose most of them; those that hold join texts to components, and the pairs
    that these miss are then looked for between components only.
    """
    found = stored(similar.prints(texts, similar.common_shingles(texts, count, shingle), majority, shingle), "prints")
    release(texts.sparkSession)
    each = found.select("fp", "node").distinct()
    reps = stored(each.groupBy("fp").agg(F.min("node").alias("rep")), "distinct")
    equal = each.join(reps, "fp").where("node <> rep").select(F.least("rep", "node").alias("a"), F.greatest("rep", "node").alias("b"))
    rounds = similar.rounds_for(count)
    # stored, so that the shuffle files they leave are gone when pairs are held against bitmaps and sets
    proposed = stored(links(reps, radius).unionByName(equal).unionByName(similar.neighbours(found)).distinct(), "proposed")
    release(texts.sparkSession)
    first = similar.verified(proposed, found, texts, shingle, rounds)
    discard(proposed)
    ways = shortened(first, "a", "b")
    labels = ways.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))  # nodes of one label are joined
    release(texts.sparkSession)
    between = similar.in_rounds(rounds, lambda r: similar.candidates(found, labels, rounds, r), "between")
    release(texts.sparkSession)
    more = similar.verified(between.distinct(), found, texts, shingle, rounds)
    release(texts.sparkSession)
    out = components(ways.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(more), "a", "b")
    for x in (found, reps, ways, *first._parts, *between._parts, *more._parts):
        discard(x)
    release(texts.sparkSession)
    return out


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """One row of ``docs``, all columns, of each group of near-duplicates: one with the least id.

    Texts whose word shingles have a similarity of 0.8 or more are linked; a group is what links reach. Null ids come last, so
    a row without an id stays if nothing in its group has one. Of rows with equal texts under one id (or without) one
    stays, by a hash of all columns. Texts that are null or have no word are one group. Two texts are taken for equal by a
    64-bit hash. An empty table gives no rows.
    """
    node = next(x for x in (f"_node{i or ''}" for i in range(len(docs.columns) + 1)) if x not in docs.columns)
    keyed = docs.withColumn(node, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    each = stored(keyed.groupBy(F.col(node).alias("_node"), F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n")), "ids")
    best = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_node").alias("node"), F.col("_n").alias("n"))).alias("best")
    texts = keyed.select(F.col(node).alias("node"), F.col(text_col).alias("text"))
    found = groups(texts, each.select("_node").distinct().count(), shingle)
    placed = each.join(found.withColumnRenamed("node", "_node").hint("merge"), "_node", "left").withColumn("component", F.coalesce("component", "_node"))
    winners = placed.groupBy("component").agg(best).select(F.col("best.id").alias("_id"), F.col("best.node").alias("_node"), F.col("best.n").alias("_n"))
    stay = stored(winners, "stay")
    discard(each)
    discard(found)
    same = lambda other: (keyed[node] == other["_node"]) & keyed[id_col].eqNullSafe(other["_id"])
    single, many = stay.where("_n = 1"), stay.where("_n > 1")
    kept = keyed.join(single, same(single), "left_semi").select(*docs.columns)
    rows = keyed.join(many, same(many), "left_semi")
    one = rows.groupBy(F.col(node).alias("_k"), F.col(id_col).alias("_i")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row"))
    return kept.unionByName(one.select("row.*"))
