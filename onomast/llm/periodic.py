"""Runs of periodic repetition in word sequences, by a suffix automaton with sets of end positions merged small to large.

The automaton of a text has a state for each class of word strings that end at the same places. Along suffix links the
states form a tree; a state's end positions are those of its children together. States are gone through from the longest to
the shortest, and the smaller set goes into the larger, so a position moves a logarithmic number of times. Where a position
gets a new neighbour in a state's set, at a distance that the state's length reaches, the string stands twice without a
gap: a square, the seed of a run with that distance as its period. Seeds are extended both ways to whole runs.

Every run is seeded: the string that a run of period q leaves when its last q words are cut off ends at two neighbouring places,
q apart, and has a state of its very length, which is at least q. It is half as long as the run or longer, so states under half
the least length of a run can seed nothing that counts and their sets are not merged.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least number of words of a run.
LEAST = 12
_BLOCK = 512
RUNS = "doc_id {id}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class Places:
    """An ordered set of numbers in blocks, so that an insertion moves few of them however many there are."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, first: int):
        self.blocks, self.firsts, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for b in self.blocks:
            yield from b

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Put in a number that is not there; gives its neighbours."""
        k = max(bisect_right(self.firsts, x) - 1, 0)
        block = self.blocks[k]
        at = bisect_left(block, x)
        before = block[at - 1] if at else self.blocks[k - 1][-1] if k else None
        after = block[at] if at < len(block) else self.blocks[k + 1][0] if k + 1 < len(self.blocks) else None
        block.insert(at, x)
        self.size += 1
        if not at:
            self.firsts[k] = x
        if len(block) > _BLOCK:
            half = len(block) // 2
            self.blocks[k : k + 1] = [block[:half], block[half:]]
            self.firsts.insert(k + 1, block[half])
        return before, after


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length and suffix link of each state, and for each prefix of the text the state that it leads to."""
    arcs: list[dict[int, int]] = [{}]
    link, length, prefixes = [-1], [0], []
    last = 0
    for i, w in enumerate(words):
        new, p = len(arcs), last
        arcs.append({})
        length.append(i + 1)
        a = arcs[p]
        while w not in a:
            a[w] = new
            p = link[p]
            if p < 0:
                break
            a = arcs[p]
        if p < 0:
            link.append(0)
        else:
            q = a[w]
            if length[q] == length[p] + 1:
                link.append(q)
            else:
                copy = new + 1
                link.append(copy)
                arcs.append(arcs[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = copy
                while p >= 0 and arcs[p].get(w) == q:
                    arcs[p][w] = copy
                    p = link[p]
        prefixes.append(new)
        last = new
    return length, link, prefixes


def _seeds(words: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Squares (first word, last word, period) that neighbouring end positions show, of ``least`` words or more."""
    length, link, prefixes = automaton(words)
    shortest = -(-least // 2)
    ends = dict(zip(prefixes, range(len(prefixes)), strict=True))
    up = np.array(link)
    known = np.array(length)
    # only states whose link is long enough hand their places on
    parents = np.where(up >= 0, known[up], 0)
    movers = np.flatnonzero(parents >= shortest)
    sets: dict[int, Places] = {}
    for s in movers[np.argsort(-known[movers], kind="stable")].tolist():
        own = sets.pop(s, None)
        if own is None:
            own = Places(ends[s])
        elif s in ends:
            yield from _joined(own, (ends[s],), length[s], least)
        to = link[s]
        other = sets.get(to)
        if other is None:
            sets[to] = own
            continue
        small, large = (own, other) if own.size < other.size else (other, own)
        sets[to] = large
        yield from _joined(large, small, length[to], least)
    for s, places in sets.items():
        if s in ends:
            yield from _joined(places, (ends[s],), length[s], least)


def _joined(places: Places, new: Iterator[int] | tuple[int, ...], length: int, least: int) -> Iterator[tuple[int, int, int]]:
    for x in new:
        before, after = places.add(x)
        for a, b in ((before, x), (x, after)):
            if a is not None and b is not None and b - a <= length and length + b - a >= least:
                yield a - length + 1, b, b - a


def _extended(w: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The longest stretch around start..end (last word included) that keeps the period."""
    n = len(w)
    k = end + 1
    while k < n:
        own = w[k : k + _BLOCK]
        apart = own != w[k - period : k - period + len(own)]
        if apart.any():
            k += int(apart.argmax())
            break
        k += len(own)
    i = start
    while i > 0:
        low = max(0, i - _BLOCK)
        apart = w[low:i] != w[low + period : i + period]
        if apart.any():
            i -= int(apart[::-1].argmax())
            break
        i = low
    return i, k - 1


def find_runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the sequence of numbers, by start, then period.

    A run is a stretch of ``least`` words or more and at least two of its least periods that cannot be made longer.
    """
    if len(words) < least:
        return []
    found: dict[int, tuple[list[int], list[int]]] = {}
    periods: dict[tuple[int, int], int] = {}
    for start, end, period in _seeds(words.tolist(), least):
        starts, ends = found.setdefault(period, ([], []))
        k = bisect_right(starts, start) - 1
        if k >= 0 and ends[k] >= end:
            continue  # two runs of one period share less than a period; a seed has two
        s, e = _extended(words, start, end, period)
        starts.insert(k + 1, s)
        ends.insert(k + 1, e)
        periods[s, e] = min(period, periods.get((s, e), period))  # a multiple of the period seeds the same stretch
    return sorted(((s, e - s + 1, q) for (s, e), q in periods.items() if e - s + 1 >= max(least, 2 * q)), key=lambda r: (r[0], r[2]))


def split(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period, joined by one space."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(words if keep.all() else [words[i] for i in np.flatnonzero(keep).tolist()])


def _numbers(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, runs (start, length, period, by start, then period) and collapsed.

    ``collapsed`` has the words, joined by one space, that no run contains after its first period. The work on a text takes memory
    in proportion to its length and time within a logarithm of that; nothing is shuffled. A text that is null or without a word has no
    runs and an empty ``collapsed``. Null ids and repeated rows stay as they are; other columns play no part. An empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                counts, runs, texts = [], [], []
                for t in part.column(1):
                    words = split(t.as_py())
                    own = find_runs(_numbers(words), least)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                    texts.append(collapse(words, own).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RUNS.format(id=dict(rows.dtypes)["doc_id"]))
