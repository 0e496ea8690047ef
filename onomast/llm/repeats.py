"""Finding every window of a fixed number of tokens that also starts earlier, for long repeats in a whole corpus.

A window is ``width`` consecutive tokens of one document. An operator gives each window an *anchor*: a place inside it that
the window's own content decides, so equal windows have equal anchors at equal places. Consecutive windows with one anchor
form a *piece*. Pieces are brought together by the hash of what surrounds the anchor:

* equal pieces (hash of all their tokens) have equal windows, so all but the earliest are repeats, whole;
* where one anchor has several different pieces, the earliest of each is a *variant*, and the variants' windows are compared
  one by one, by the operator's own method. An anchor with more than ``many`` variants is *hot*: its windows shall be dealt by
  their own content.

A task sends each piece once, however often it holds it: the earliest stands for the others, which are repeats for sure. So
no key has more rows than there are tasks and variants, and no pairs are made. Positions are ordered by document id, then
start; a null id comes last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens that a task works on at once; a longer document is a block of its own.
BLOCK = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
PIECES = "akey bigint, phash bigint, doc bigint, row bigint, start int, count int"
RUNS = "akey bigint, doc bigint, row bigint, start int, count int, hot boolean"
MANY = 4096
NO_ID = (1 << 63) - 1

#: docs' token values, first token of each document (and the end) -> start, count and key of each piece
Cutter = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of the base and its inverse, as far as asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            m = max(n, 2 * BLOCK)
            cls.up, cls.down = (np.cumprod(np.concatenate(([np.uint64(1)], np.full(m, x, np.uint64)))) for x in (BASE, _BASE_INVERSE))
        return cls.up, cls.down


class Hashes:
    """Hashes of any stretches of a sequence of token values."""

    def __init__(self, values: np.ndarray):
        up, self.down = Powers.to(len(values) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def runs_of(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each stretch of equal labels."""
    if not len(label):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
    return at, np.diff(np.concatenate((at, [len(label)])))


def window_starts(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows within documents, and the document of each."""
    n = np.maximum(0, np.diff(bounds) - width + 1)
    doc = np.repeat(np.arange(len(n)), n)
    return np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + bounds[:-1][doc], doc


def first_of_equals(key: np.ndarray, phash: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, hash, document and start; within it, whether each row leads its class, and whether it is later than its leader."""
    order = np.lexsort((start, doc, phash, key))
    k, p, d, s = key[order], phash[order], doc[order], start[order]
    lead = np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1]))) if len(k) else np.zeros(0, bool)
    leader = np.maximum.accumulate(np.where(lead, np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
    later = (d != d[leader]) | (s != s[leader])
    return order, lead, later


def _batch(names: str, *cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [x.split()[0] for x in names.split(", ")])


def earliest(key: np.ndarray, phash: np.ndarray, doc: np.ndarray, row: np.ndarray, at: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """``PIECES`` of which the earliest of equals stands for the others; those are repeats for sure and have a negative count."""
    o, lead, later = first_of_equals(key, phash, doc, at)
    keep = lead | later
    o, lead = o[keep], lead[keep]
    # a repeat needs no partner any more: its key only spreads it
    where = np.where(lead, key[o].view(np.int64), spread(doc[o], at[o]))
    return _batch(PIECES, where, phash[o].view(np.int64), doc[o], row[o], at[o].astype(np.int32), np.where(lead, count[o], -count[o]).astype(np.int32))


def _blocks(batches: Iterator[pa.RecordBatch], tokens: Callable[[bytes], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Document ids, row keys and token values, about a BLOCK of tokens at a time."""
    ids, rows, held, n = [], [], [], 0
    for b in batches:
        for i, r, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            values = tokens(t.as_py())
            if n and n + len(values) > BLOCK:
                yield np.array(ids, np.int64), np.array(rows, np.int64), held
                ids, rows, held, n = [], [], [], 0
            ids.append(i)
            rows.append(r)
            held.append(values)
            n += len(values)
    if ids:
        yield np.array(ids, np.int64), np.array(rows, np.int64), held


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (the id), row and text in UTF-8. Where ids repeat, row is a hash of the text, so that rows of one id stay apart."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    repeated = bool(own.groupBy("id").count().where("count > 1").limit(1).count())
    return own.select(F.coalesce("id", F.lit(NO_ID)).alias("doc"), (F.xxhash64("text") if repeated else F.lit(0).cast("long")).alias("row"), "text")


def pieces(docs: DataFrame, tokens: Callable[[bytes], np.ndarray], cut: Cutter) -> DataFrame:
    """One row for each different piece of each block, its earliest; those known to be repeats have a negative count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows, values in _blocks(batches, tokens):
            order = np.argsort(ids, kind="stable")
            ids, rows = ids[order], rows[order]
            bounds = np.concatenate(([0], np.cumsum([len(values[i]) for i in order])))
            flat = np.concatenate([values[i] for i in order])
            start, count, key, phash = cut(flat, bounds)
            owner = np.searchsorted(bounds, start, "right") - 1
            doc, row, at = ids[owner], rows[owner], start - bounds[owner]
            yield earliest(key, phash, doc, row, at, count)

    return docs.mapInArrow(run, PIECES)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut so that rows with one value of the first column are never parted."""
    held: list[np.ndarray] | None = None
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if not len(cols[0]):
            continue
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        held = [x[cut:] for x in cols]
        if cut:
            yield [x[:cut] for x in cols]
    if held is not None:
        yield held


def compared(found: DataFrame, many: int = MANY) -> DataFrame:
    """Runs of windows: repeats (akey null) and variants (with their anchor's key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, phash, doc, row, start, count in whole_groups(batches):
            known = count < 0
            i = np.flatnonzero(~known)
            order, lead, later = first_of_equals(key[i], phash[i], doc[i], start[i])
            o = i[order]
            at, n = runs_of(key[o])
            leads = np.add.reduceat(lead.astype(np.int64), at) if len(at) else at
            several, crowd = np.repeat(leads > 1, n), np.repeat(leads > many, n)
            dup = np.concatenate((np.flatnonzero(known), o[later & ~lead]))
            variant = o[lead & several]
            out = np.concatenate((dup, variant))
            if len(out):
                akey = pa.array(key[out], pa.int64(), mask=np.arange(len(out)) < len(dup))
                hot = np.concatenate((np.zeros(len(dup), bool), crowd[lead & several]))
                yield pa.RecordBatch.from_arrays([akey, *(pa.array(c) for c in (doc[out], row[out], start[out], np.abs(count[out]), hot))], ["akey", "doc", "row", "start", "count", "hot"])

    return found.repartition("akey").sortWithinPartitions("akey").mapInArrow(run, RUNS)


def spread(doc: np.ndarray | int, start: np.ndarray) -> np.ndarray:
    """Keys that only deal rows out evenly."""
    return mixed(np.asarray(doc).astype(np.uint64) * BASE + start.astype(np.uint64)).view(np.int64)


def packed(docs: DataFrame) -> DataFrame:
    """doc, row and the text compressed: what a join has to move.

    The filter lets nothing through that is null, and is there so that joins of either kind want the same exchange: a frame
    that is used in two joins is then shuffled once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([z.compress(t.as_py()) for t in b.column(2)], pa.binary())], ["doc", "row", "z"])

    return docs.mapInArrow(run, "doc bigint, row bigint, z binary").where("doc is not null and row is not null")


def unpacked(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def gathered(runs: DataFrame, *cols: str) -> DataFrame:
    """The runs of each document in one row; no more than the document has tokens."""
    return runs.groupBy("doc", "row").agg(F.collect_list(F.struct(*cols)).alias("runs"))


def covered(n: int, start: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """Which of n tokens lie in the windows of the runs."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + count - 1 + width, -1)
    return np.cumsum(marks[:-1]) > 0
