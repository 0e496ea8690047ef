"""Links between texts whose sets of word shingles have a Jaccard similarity of 0.8 or more, none missed.

``simhash`` proposes links by fingerprints; this module holds any proposal against the sets themselves and finds the links
that fingerprints do not show (prefix filter, Chaudhuri et al. 2006). Two sets that are that similar share at least four
fifths of either one. So whatever order the shingles are put in, as long as it is one order for all sets, the first fifth
of the one and the first fifth of the other have a shingle in common. The order here is by hash, with shingles known to be
common last; what counts as common is drawn from a sample and changes the work, not the result.

Texts that are alike shall not give all their pairs. So some pairs are proposed first, a few for each text: by fingerprints,
and under a text's least shingles, with the nearest and with the text in the middle of all. What joins a group need not be looked for inside it again: of the buckets of
the prefix filter only rows between groups count, and there a pair leaves the task only if set sizes, places and a bitmap
that bounds the difference of two sets from below allow it. All proposals are held against the similarity itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onomast.llm.common import discard, lean, release, stored

SEED = 42
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: Texts from which common shingles are counted, how often one must occur there, and how many are taken at most.
SAMPLE, COMMON, MOST_COMMON = 10_000, 3, 200_000
#: 64-bit words of the bitmap.
BITMAP = 32
#: Of them those that go into a bucket, folded.
COARSE = 8
#: Least shingles of a text under which it is held against others at the start.
FIRST_KEYS = 8
#: Nodes up to which a list of them is broadcast.
BROADCAST_NODES = 500_000
#: Pairs looked at in one go, and pairs found that wait to be told apart.
_MOST, _WAIT = 1 << 15, 1 << 18
#: Nodes for which pairs are looked for in one round, and the most rounds; the share of all sets that moves with pairs in one round.
ROUND, MOST_ROUNDS, MOVED = 100_000, 8, 4
#: Rows of a bucket among which the nearest is looked for.
_NEAR = 2048
#: Of them those looked at in one go.
_ROWS_AT_ONCE = 128
PRINTS = "node bigint, fp bigint, n bigint, bits array<bigint>, keys array<bigint>, least array<bigint>"


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 of each word shingle in order, repeats included; A-Z lower-cased, words between ASCII white space.

    A shorter text is one shingle; one without a word has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    m = n - k + 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:m].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, m)


def shingles(text: str | None, k: int = 5) -> np.ndarray:
    """Rising distinct hashes of the word shingles."""
    return np.unique(shingle_hashes(text, k))


def prefix(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles of a set of which any set as similar has one in its own prefix."""
    if len(common):
        known = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
        s = np.concatenate((s[~known], s[known]))
    a, b = LEAST
    return s[: len(s) - -(-a * len(s) // b) + 1]


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of the shingles by their low bits: two bitmaps differ in no more bits than the sets in shingles."""
    bits = np.bincount((s & np.uint64(64 * BITMAP - 1)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches of node and text, without nodes that the task had of late."""
    seen: set[int] = set()
    for b in batches:
        nodes, own = b.column(0).to_pylist(), []
        for i, x in enumerate(nodes):
            if x not in seen:
                seen.add(x)
                own.append(i)
        if len(seen) > 100_000:
            seen.clear()
        for at in range(0, len(own), 256):
            yield b.take(pa.array(own[at : at + 256], pa.int64()))


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64)))


def prints(texts: DataFrame, common: np.ndarray, fingerprint, k: int = 5) -> DataFrame:
    """node, fp (by ``fingerprint`` of the shingles' hashes), n (size of the set), bits, keys (the prefix) and least (the least shingles) of each text.

    ``texts`` has node and text. A node comes once a task at least, not once in all.
    """
    shared = texts.sparkSession.sparkContext.broadcast(common)  # at most MOST_COMMON numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in _unseen(batches):
            fps, sets = [], []
            for t in part.column(1):
                hashes = shingle_hashes(t.as_py(), k)
                fps.append(fingerprint(hashes))
                sets.append(np.unique(hashes))
            keys = [prefix(s, known) if len(s) else s for s in sets]
            sizes = pa.array(np.array([len(s) for s in sets], np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), sizes, _lists([bitmap(s) for s in sets]), _lists(keys), _lists([s[:FIRST_KEYS] for s in sets])], [x.split()[0] for x in PRINTS.split(", ")])

    return texts.mapInArrow(lean(run), PRINTS)


def _sets(texts: DataFrame, k: int) -> DataFrame:
    """node, n and the set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _unseen(batches):
            found = [shingles(t.as_py(), k) for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array([len(s) for s in found], np.int64)), _lists(found)], ["node", "n", "shingles"])

    return texts.mapInArrow(lean(run), "node bigint, n bigint, shingles array<bigint>")


def common_shingles(texts: DataFrame, count: int, k: int = 5) -> np.ndarray:
    """Rising hashes of shingles that many of about ``SAMPLE`` texts have; ``count`` is that of the distinct nodes."""
    share = min(1.0, SAMPLE / max(1, count))
    drawn = texts.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20)))
    each = _sets(drawn, k).dropDuplicates(["node"]).select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON)
    return np.sort(each.orderBy(F.desc("n"), "s").limit(MOST_COMMON).select("s").toArrow()["s"].to_numpy().view(np.uint64))


def _columns(b: pa.RecordBatch) -> list[np.ndarray]:
    """Columns as arrays; lists are of one length and become rows."""
    return [np.asarray(c.flatten()).reshape(len(c), -1) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False) for c in b.columns]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of whole buckets; rows are sorted by key, the first column."""
    held: list[list[np.ndarray]] = []
    for b in batches:
        cols = _columns(b)
        if not len(cols[0]):
            continue
        cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last bucket may go on
        if cut or (held and held[-1][0][-1] != cols[0][0]):
            held.append([x[:cut] for x in cols])
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held = []
        held.append([x[cut:] for x in cols])
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _once(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of key, n and node, sorted so, each once."""
    key, n, node = cols[:3]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
    return [x[new] for x in cols]


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _nearest(n: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of one bucket, rising by fp: each row with the other whose fingerprint is nearest, among ``_NEAR`` around it, if sizes allow."""
    p, q = LEAST
    out = []
    for first in range(0, len(fp), _ROWS_AT_ONCE):
        at = first - first % (_NEAR // 2)
        own = np.arange(first, min(first + _ROWS_AT_ONCE, len(fp)))
        others = np.arange(max(0, at - _NEAR // 4), min(len(fp), at + 3 * _NEAR // 4))
        apart = np.bitwise_count(fp[own, None] ^ fp[None, others])
        apart[(own[:, None] == others) | (n[own, None] * p > n[None, others] * q) | (n[None, others] * p > n[own, None] * q)] = 255
        best = apart.argmin(axis=1)
        ok = apart[np.arange(len(own)), best] < 255
        out.append((own[ok], others[best[ok]]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a bucket with the nearest and with the bucket's hub, where sizes allow the similarity.

    The hub is the node whose fingerprint is nearest to the majority of all bits: where many texts were made from one, that one.
    Rows are key, n, node and fp, sorted by key, n and node.
    """
    p, q = LEAST
    for cols in _buckets(batches):
        key, n, node, fp = _once(cols)
        fp = fp.view(np.uint64)
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(first, len(key)))
        a, b = [], []
        for at, k in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            if k == 2:
                a.append([at])
                b.append([at + 1])
                continue
            rows = at + np.argsort(fp[at : at + k], kind="stable")
            x, y = _nearest(n[rows], fp[rows])
            bits = np.unpackbits(fp[rows].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            centre = np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > k, bitorder="little").view(np.uint64)[0]
            hub = rows[np.bitwise_count(fp[rows] ^ centre).argmin()]
            a += [rows[x], rows]
            b += [rows[y], np.full(k, hub)]
        if a:
            i, j = np.concatenate(a), np.concatenate(b)
            ok = (i != j) & (np.maximum(n[i], n[j]) * p <= np.minimum(n[i], n[j]) * q)
            if ok.any():
                yield _pairs(node[i[ok]], node[j[ok]])


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of buckets with more than one label; rows are sorted by key, n and node."""
    for cols in _buckets(batches):
        cols = _once(cols)
        key, label = cols[0], cols[3]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        apart = np.repeat(np.minimum.reduceat(label, first) != np.maximum.reduceat(label, first), np.diff(np.append(first, len(key))))
        yield pa.RecordBatch.from_arrays([pa.array(x[apart]) for x in cols], ["key", "n", "node", "label", "at"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one bucket that may be similar and whose labels differ.

    Rows are key, n, node, label, at (the key's place in the prefix) and coarse (the folded bitmap), sorted by key and n.
    """
    p, q = LEAST
    held, waiting = [], 0
    for key, n, node, label, at, coarse in _buckets(batches):
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        bucket = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
        wide = np.int64(1) << 40  # sizes are less
        own = np.arange(len(key))
        times = np.maximum(np.searchsorted(bucket * wide + n, bucket * wide + n * q // p, "right") - own - 1, 0)
        total, start = np.cumsum(times), 0
        while start < len(key):
            end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + _MOST, "right")))
            t = times[start:end]
            i = np.repeat(own[start:end], t)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(t) - t, t)
            # a pair is taken where its first common shingle stands; what comes before it is not common
            ok = np.flatnonzero((label[i] != label[j]) & (np.minimum(n[i] - at[i], n[j] - at[j]) * (p + q) >= (n[i] + n[j]) * p))
            i, j = i[ok], j[ok]
            apart = np.bitwise_count((coarse[i] ^ coarse[j]).view(np.uint64)).sum(axis=1, dtype=np.int64)
            ok = (n[i] + n[j] - apart) * (p + q) >= 2 * (n[i] + n[j]) * p
            held.append((node[i[ok]], node[j[ok]]))
            waiting += len(held[-1][0])
            if waiting > _WAIT:  # a pair may stand in many buckets
                yield _pairs(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, waiting = [], 0
            start = end
    if waiting:
        yield _pairs(*(np.concatenate(x) for x in zip(*held, strict=True)))


_ROWS = "key bigint, n bigint, node bigint, label bigint, at int"


def neighbours(found: DataFrame) -> DataFrame:
    """Pairs a < b that have one of their least shingles in common, two for each of these at most.

    Buckets are parted by size, in steps within which sizes allow the similarity.
    """
    p, q = LEAST
    step = F.floor(F.log(F.greatest("n", F.lit(1))) / F.log(F.lit(q / p))).cast("long")
    rows = found.select(F.explode("least").alias("key"), "n", "node", "fp", step.alias("step")).select(F.xxhash64("key", "step").alias("key"), "n", "node", "fp")
    return rows.repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(lean(_neighbours), "a bigint, b bigint")


def rounds_for(count: int) -> int:
    """In how many rounds pairs of so many nodes are looked for."""
    return max(1, min(MOST_ROUNDS, -(-count // ROUND)))


def in_rounds(rounds: int, work: Callable[[int], DataFrame], label: str) -> DataFrame:
    """What ``work`` gives for each round, stored: the shuffle files of a round are gone before the next one writes its own."""
    parts = []
    for r in range(rounds):
        parts.append(stored(work(r), label))
        if rounds > 1:
            release(parts[-1].sparkSession)
    out = reduce(DataFrame.unionByName, parts)
    out._parts = parts
    return out


def _drop(df: DataFrame) -> None:
    for x in df._parts:
        discard(x)


def _of_round(key: Column, rounds: int, r: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(rounds)) == r


def candidates(found: DataFrame, labels: DataFrame, rounds: int = 1, r: int = 0) -> DataFrame:
    """Pairs a < b of nodes with different labels that may be similar, among them all that are. ``labels`` has node and component.

    Of ``rounds`` this is the one with number ``r``: its pairs are those that stand under its share of the keys.
    """
    own = found.select("node", "n", F.filter(F.transform("keys", lambda k, i: F.struct(i.alias("at"), k.alias("key"))), lambda x: _of_round(x["key"], rounds, r)).alias("keys"))
    placed = own.join(labels.hint("merge"), "node", "left")
    rows = placed.select(F.explode("keys").alias("k"), "n", "node", F.coalesce("component", "node").alias("label")).select("k.key", "n", "node", "label", "k.at")
    shared = rows.repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(lean(_open), _ROWS)
    parts = [F.slice("bits", 1 + at, COARSE) for at in range(0, BITMAP, COARSE)]
    fold = reduce(lambda x, y: F.zip_with(x, y, lambda u, v: u.bitwiseXOR(v)), parts)
    coarse = found.select("node", fold.alias("coarse")).dropDuplicates(["node"])
    ready = shared.join(coarse.hint("merge"), "node").select("key", "n", "node", "label", "at", "coarse")
    return ready.repartition("key").sortWithinPartitions("key", "n").mapInArrow(lean(_candidates), "a bigint, b bigint").distinct()


def _only(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of the given nodes; a bounded number of nodes is broadcast, so that no text is shuffled."""
    return texts.join(F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes, "node", "left_semi")


def _enough(common: Column, n_a: Column, n_b: Column) -> Column:
    """Whether so many common shingles make the sets of these sizes similar; two empty sets are."""
    p, q = LEAST
    return common * (p + q) >= (n_a + n_b) * p


def verified(pairs: DataFrame, found: DataFrame, texts: DataFrame, k: int = 5, rounds: int = 1) -> DataFrame:
    """The pairs a, b that have the similarity, as a stored table: by the bitmaps of ``found`` (see ``prints``), then by the sets.

    A pair moves with the bitmap of its one end, then with its set, many times what it takes itself. How many pairs there are depends on
    how many shingles texts share by chance, so it is done in rounds: ``rounds`` for the bitmaps, and as many for the sets as keep
    what moves in one below a ``MOVED``-th of all sets.
    """
    side = lambda d, x: d.select(*[F.col(c).alias(x if c == "node" else f"{c}_{x}") for c in d.columns])
    bits = found.select("node", "n", "bits").dropDuplicates(["node"])
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)

    def may_be(r: int) -> DataFrame:
        own = pairs.where(_of_round(F.col("a"), rounds, r))
        near = own.join(side(bits.where(_of_round(F.col("node"), rounds, r)), "a").hint("merge"), "a").join(side(bits, "b").hint("merge"), "b")
        return near.where(_enough((F.col("n_a") + F.col("n_b") - apart) / 2, F.col("n_a"), F.col("n_b"))).select("a", "b", (F.col("n_a") + F.col("n_b")).alias("moved"))

    near = in_rounds(rounds, may_be, "candidates")
    every, moved = (x.first()[0] or 0 for x in (found.agg(F.sum("n")), near.agg(F.sum("moved"))))
    steps = max(1, -(-moved * MOVED // max(1, every))) if rounds > 1 else 1

    def are(r: int) -> DataFrame:
        own = near.where(_of_round(F.col("a"), steps, r)).select("a", "b")
        ends = stored(own.select(F.col("a").alias("node")).union(own.select("b")).distinct(), "ends")
        held.append(ends)
        sets = _sets(_only(texts, ends), k).dropDuplicates(["node"])
        whole = own.join(side(sets, "a").hint("merge"), "a").join(side(sets, "b").hint("merge"), "b")
        return whole.where(_enough(F.size(F.array_intersect("shingles_a", "shingles_b")), F.col("n_a"), F.col("n_b"))).select("a", "b")

    held: list[DataFrame] = []
    found_links = in_rounds(steps, are, "links")
    _drop(near)
    for x in held:
        discard(x)
    return found_links
