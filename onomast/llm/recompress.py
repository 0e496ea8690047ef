"""Removing long repeated passages of words by recompression (Jez 2016; after Sahinalp and Vishkin 1994).

Rounds name runs of equal symbols and pairs of unlike ones. Names are hashes of what they stand for, so every task gives
the same name to the same run or pair: the naming is global without a dictionary. In a pair round each symbol is left or
right by a bit of its name, and every left symbol followed by a right one becomes a new symbol; what happens between two
symbols depends on these two alone. So equal passages of words have the same symbols inside, away from their ends.

For every symbol the span of words that decides it is carried along. A window of words holds the symbols whose deciding
span lies in it, wherever it occurs; the one with the least name hash is its anchor. Shared symbols bring equal windows
together, and the pieces' hashes verify the repeat (see ``repeats``); windows of different pieces are held against each
other by two hashes of 64 bits. A window that holds no decided symbol is its own anchor,
so nothing depends on how far the rounds get.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onomast.llm import repeats as R

WIDTH = 20
ROUNDS = 3
_FAR = 1 << 40
_names: dict[bytes, int] = {}


def word_values(text: bytes) -> np.ndarray:
    """A 64-bit value for each word between ASCII white space."""
    words = text.split()
    if len(_names) > 200_000:
        _names.clear()
    for w in words:
        if w not in _names:
            _names[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_names.__getitem__, words), np.uint64, len(words))


class Symbols:
    """The symbols of one round: names, the words each stands for, and the span of words that decides it."""

    def __init__(self, name: np.ndarray, doc: np.ndarray):
        at = np.arange(len(name))
        self.name, self.doc, self.start, self.low, self.high = name, doc, at, at, at + 1

    def _rebuild(self, first: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.name, self.low, self.high = name, low, high
        self.doc, self.start = self.doc[first], self.start[first]

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether each symbol has a left and a right neighbour in its document."""
        same = self.doc[1:] == self.doc[:-1]
        return np.concatenate(([False], same)), np.concatenate((same, [False]))

    def name_runs(self) -> None:
        """Each run of equal symbols becomes one; what stands on either side decides where it ends."""
        left, right = self._neighbours()
        starts = np.flatnonzero(~left | np.concatenate(([True], self.name[1:] != self.name[:-1])))
        n = np.diff(np.concatenate((starts, [len(self.name)])))
        ends = starts + n - 1
        name = np.where(n > 1, R.mixed(self.name[starts] * np.uint64(3) + n.astype(np.uint64) * R.BASE), self.name[starts])
        low = np.where(left[starts], np.minimum(self.low[starts], self.low[starts - 1]), -_FAR)
        high = np.where(right[ends], np.maximum(self.high[ends], self.high[(ends + 1) % len(self.name)]), _FAR)
        low, high = np.minimum(low, np.minimum.reduceat(self.low, starts)), np.maximum(high, np.maximum.reduceat(self.high, starts))
        self._rebuild(starts, name, low, high)

    def name_pairs(self, level: int) -> None:
        """Each left symbol followed by a right one becomes one with it; others are decided by the neighbour they might have met."""
        left, right = self._neighbours()
        is_right = (R.mixed(self.name + np.uint64(level)) & np.uint64(1)).astype(bool)
        joins = ~is_right & right & np.concatenate((is_right[1:], [False]))
        second = np.concatenate(([False], joins[:-1]))
        i = np.flatnonzero(~second)
        j = np.minimum(i + 1, len(self.name) - 1)  # right neighbour
        h = np.maximum(i - 1, 0)
        met = np.where(is_right[i], h, j)
        has = np.where(is_right[i], left[i], right[i])
        low = np.where(has, np.minimum(self.low[i], self.low[met]), -_FAR)
        high = np.where(has, np.maximum(self.high[i], self.high[met]), _FAR)
        name = np.where(joins[i], R.mixed(self.name[i] * np.uint64(5) + R.mixed(self.name[j] + np.uint64(level))), self.name[i])
        self._rebuild(i, name, low, high)


def cut(values: np.ndarray, bounds: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Start, count, key and hash of the pieces of a block."""
    starts, doc = R.window_starts(bounds, width)
    if not len(starts):
        return starts, starts, starts.astype(np.uint64), starts.astype(np.uint64)
    s = Symbols(values, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)))
    s.name_runs()
    for level in range(rounds):
        s.name_pairs(level)
    ok = np.flatnonzero((s.low >= 0) & (s.high < _FAR) & (s.high - s.low <= width))
    low, high = s.low[ok], s.high[ok]
    rank = (R.mixed(s.name[ok]) & ~np.uint64((1 << 28) - 1)) | np.arange(len(ok), dtype=np.uint64)
    best = np.full(len(values) + 1, ~np.uint64(0))
    lo = np.maximum(high - width, 0)
    for k in range(width):
        more = lo + k <= low
        np.minimum.at(best, (lo + k)[more], rank[more])
    best = best[starts]
    hashes = R.Hashes(values)
    none = best == ~np.uint64(0)
    label = np.where(none, len(ok) + np.arange(len(best)), (best & np.uint64((1 << 28) - 1)).astype(np.int64))
    at, n = R.runs_of(label * len(bounds) + doc)
    a, start = label[at], starts[at]
    i = np.minimum(a, len(ok) - 1) if len(ok) else np.zeros(len(a), np.int64)
    own = none[at]
    if len(ok):
        key = np.where(own, hashes.of(start, start + width), R.mixed(hashes.of(low[i], high[i]) + s.name[ok][i]))
    else:
        key = hashes.of(start, start + width)
    return start, n, key, hashes.of(start, start + n - 1 + width)


def _compared_windows(texts: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """Runs of repeats: those known already, and each window of a variant that also starts earlier."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list[np.ndarray]] = [[] for _ in range(6)]
            for doc, row, z, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                start, count = (np.array([r[c] for r in own], np.int64) for c in ("start", "count"))
                known = np.array([r["akey"] is None for r in own])
                s, n = start[known], count[known]
                at = start[~known]
                i = np.repeat(np.arange(len(at)), count[~known])
                at = at[i] + np.arange(len(i)) - np.repeat(np.cumsum(count[~known]) - count[~known], count[~known])
                hashes = other = at
                if len(at):
                    values = word_values(R.unpacked(z))
                    hashes, other = (R.Hashes(v).of(at, at + width).view(np.int64) for v in (values, R.mixed(values + R.BASE)))
                both = np.concatenate((s, at))
                for held, x in zip(cols, (np.concatenate((R.spread(doc, s), hashes)), np.concatenate((s, other)), np.full(len(both), doc), np.full(len(both), row), both, np.concatenate((-n, np.ones(len(at), np.int64)))), strict=True):
                    held.append(x)
            key, phash, doc, row, start, count = (np.concatenate(c) for c in cols)
            # of equal windows in the batch the earliest stands for all; the others are repeats for sure
            new = np.flatnonzero(count > 0)
            order, lead, later = R.first_of_equals(key[new], phash[new], doc[new], start[new])
            o = new[order]
            gone = o[later]
            key[gone], count[gone] = R.spread(doc[gone], start[gone]), -1
            keep = np.concatenate((np.flatnonzero(count < 0), o[lead]))
            yield R._batch(R.PIECES, key[keep], phash[keep], doc[keep], row[keep], start[keep].astype(np.int32), count[keep].astype(np.int32))

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, phash, doc, row, start, count in R.whole_groups(batches):
            new = np.flatnonzero(count > 0)
            order, _, later = R.first_of_equals(key[new], phash[new], doc[new], start[new])
            out = np.concatenate((np.flatnonzero(count < 0), new[order][later]))
            if len(out):
                yield R._batch(_SETTLED, doc[out], row[out], start[out], np.abs(count[out]))

    joined = texts.join(R.gathered(runs, "akey", "start", "count"), ["doc", "row"]).select("doc", "row", "z", "runs")
    return joined.mapInArrow(hashed, R.PIECES).repartition("akey").sortWithinPartitions("akey").mapInArrow(settled, _SETTLED)


_SETTLED = "doc bigint, row bigint, start int, count int"


def repeated_windows(docs: DataFrame, texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """Runs (doc, row, start, count) of the windows that also start earlier; the documents as of ``keyed`` and ``packed``."""
    return _compared_windows(texts, R.compared(R.pieces(docs, word_values, partial(cut, width=width))), width)


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words left, joined by one space) of every row.

    Words are stretches without ASCII white space, unchanged. A word goes if a window of ``width`` words that covers it also
    starts earlier: in a smaller doc_id, or in the same document before. All windows are judged on the input. A null or
    empty text has no words; a null id counts as the greatest. Rows of one id count as one document, so rows repeated whole
    do not remove each other. Other columns play no part. An empty table gives no rows.
    """

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, z, runs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = R.unpacked(z).split()
                n = len(words)
                if runs:
                    gone = R.covered(n, *(np.array([r[c] for r in runs], np.int64) for c in ("start", "count")), width)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                kept = b" ".join(words)
                out.append((None if doc == R.NO_ID else doc, n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    own = R.keyed(docs, id_col, text_col)
    texts = R.packed(own)
    gone = R.gathered(repeated_windows(own, texts, width), "start", "count")
    return texts.join(gone, ["doc", "row"], "left").select("doc", "z", "runs").mapInArrow(finish, RESULT)
