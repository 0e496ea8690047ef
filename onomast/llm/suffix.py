"""Removing long repeated byte strings with suffix arrays built by external induced sorting.

Bingmann, Fischer and Osipov (2013, "Inducing suffix and LCP arrays in external memory") after Nong, Zhang and Chan (2009).
Suffixes that start a rising stretch after a falling one (the sample) are sorted first: their stretches are put in order by
a first induction and named, and the string of names is sorted in turn. From the sorted sample two sweeps induce the order
of all other suffixes: when a suffix leaves the queue of its first symbol, the suffix one symbol longer enters that of its
own. A queue is first in, first out within a symbol, so it is a priority queue for the whole; its tuples (position and
length of the prefix shared with the tuple before) lie in blocks that go to disk beyond a bound of memory.
Shared prefixes are induced with the order: one symbol more than the least along the way.

Shards are made from the pieces of ``repeats``: windows are brought together by their least gram, equal pieces are settled by
their hash, and the different pieces of one anchor are brought together once more by their anchor and half of what surrounds it. What is still
different there goes, side by side, into the shard where the suffix array tells which windows are equal, which is then held
against the bytes. Of such a key with very many different pieces each window goes by itself, to where its own hash sends it, so no shard grows with the data. Equal windows always meet in one shard.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections import deque
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onomast.llm import repeats as R
from onomast.llm.common import stored

WIDTH = 100
GRAM = 32
#: Bytes of pieces that a task sorts at once, and bytes of queued tuples that it holds before they go to disk.
SHARD = 2 << 20
QUEUE_MEMORY = 48 << 20
_BLOCK = 1 << 18
#: Type of shared prefixes, which are cut at the width of a window.
SHARED, TOP = np.uint16, (1 << 16) - 1
_VALUES = R.mixed(np.arange(1, 257, dtype=np.uint64) * R.BASE)


# --- external induced sorting ---------------------------------------------------------------------------------------


class Queues:
    """First-in first-out blocks of (position, shared prefix) for each symbol; the newest blocks go to disk when memory is short.

    The file has no name, so nothing is left of it when the task ends, however it ends.
    """

    def __init__(self, symbols: int, memory: int = QUEUE_MEMORY):
        self.blocks: list[deque] = [deque() for _ in range(symbols)]
        self.memory, self.used, self.file, self.end = memory, 0, None, 0

    def push(self, symbol: int, at: np.ndarray, shared: np.ndarray) -> None:
        size = at.nbytes + shared.nbytes
        if self.used + size <= self.memory:
            self.used += size
            self.blocks[symbol].append((at, shared))
            return
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(self.end)
        self.file.write(at.tobytes() + shared.tobytes())
        self.blocks[symbol].append((self.end, len(at), at.dtype, shared.dtype))
        self.end += size

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        if not self.blocks[symbol]:
            return None
        block = self.blocks[symbol].popleft()
        if len(block) == 2:
            self.used -= block[0].nbytes + block[1].nbytes
            return block
        start, n, a, b = block
        self.file.seek(start)
        return np.frombuffer(self.file.read(n * a.itemsize), a), np.frombuffer(self.file.read(n * b.itemsize), b)

    def close(self) -> None:
        if self.file:
            self.file.close()


def suffix_types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the next (the empty one is the least), and how long each run of one symbol still is."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)  # last place of each run
    rising = np.append(text[ends[:-1]] < text[ends[:-1] + 1], False)
    runs = np.diff(np.concatenate(([-1], ends)))
    left = np.repeat(ends, runs) - np.arange(n) + 1
    return np.repeat(rising, runs), left


class _Sweep:
    """One induction: sources come in order, each sends the suffix one symbol longer to that suffix's queue."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, symbols: int, with_shared: bool, cap: int):
        self.text, self.wanted, self.queues, self.with_shared, self.cap = text, wanted, Queues(symbols), with_shared, cap
        self.since = np.zeros(symbols, SHARED)  # least shared prefix since the last tuple sent to each symbol

    def feed(self, at: np.ndarray, shared: np.ndarray) -> None:
        """Sources in sweep order with the prefix each shares with the source before."""
        ok = at > 0
        ok[ok] = self.wanted[at[ok] - 1]
        i = np.flatnonzero(ok)
        low = int(shared.min()) if len(shared) else TOP
        before = self.since.copy()
        np.minimum(self.since, low, out=self.since)
        if not len(i):
            return
        longer = at[i] - 1
        symbol = self.text[longer]
        order = np.argsort(symbol, kind="stable")
        i, longer, symbol = i[order], longer[order], symbol[order]
        firsts, sizes = R.runs_of(symbol)
        for f, n in zip(firsts.tolist(), sizes.tolist(), strict=True):
            c, own = int(symbol[f]), i[f : f + n]
            if self.with_shared:
                least = np.empty(n, SHARED)
                least[0] = min(before[c], shared[: own[0] + 1].min())
                if n > 1:
                    least[1:] = np.minimum.reduceat(shared[: own[-1] + 1], own[:-1] + 1)
                self.since[c] = shared[own[-1] + 1 :].min(initial=TOP)
                least = np.minimum(least, self.cap - 1) + SHARED(1)
            else:
                least = np.zeros(n, SHARED)
            self.queues.push(c, longer[f : f + n], least)

    def drain(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A symbol's tuples in order, small blocks put together; what is fed meanwhile comes after."""
        while True:
            held, n = [], 0
            while n < _BLOCK and (block := self.queues.pop(symbol)) is not None:
                held.append(block)
                n += len(block[0])
            if not held:
                return
            at, shared = held[0] if len(held) == 1 else (np.concatenate([x[i] for x in held]) for i in (0, 1))
            for k in range(0, len(at), _BLOCK):
                yield at[k : k + _BLOCK], shared[k : k + _BLOCK]


def _meet(left: np.ndarray, a: int | None, b: int | None, cap: int) -> int:
    """Prefix shared by a falling and a rising suffix of one symbol: the shorter of their runs of it."""
    return 0 if a is None or b is None else min(int(left[a]), int(left[b]), cap)


def induce(text: np.ndarray, rising: np.ndarray, left: np.ndarray, sample: np.ndarray, shared: np.ndarray, symbols: int, with_shared: bool = True, cap: int = TOP - 1) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes, and the prefix each shares with the one before, from the sorted sample (with its own)."""
    n = len(text)
    first = text[sample] if len(sample) else sample
    cuts = np.searchsorted(first, np.arange(symbols + 1))
    falling = _Sweep(text, ~rising, symbols, with_shared, cap)
    falling.feed(np.array([n]), np.zeros(1, SHARED))  # the empty suffix
    fell: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(symbols)]
    for c in range(symbols):
        last, start = None, True
        for at, pre in falling.drain(c):
            if start:
                pre = pre.copy()
                pre[0], start = 0, False
            fell[c].append((at, pre))
            falling.feed(at, pre)
            last = int(at[-1])
        a, b = int(cuts[c]), int(cuts[c + 1])
        if a < b:
            pre = shared[a:b].copy()
            pre[0] = _meet(left, last, int(sample[a]), cap)
            falling.feed(sample[a:b], pre)
    falling.queues.close()

    climbing = _Sweep(text, rising, symbols, with_shared, cap)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(symbols - 1, -1, -1):
        rose, last, start = [], None, True
        for at, pre in climbing.drain(c):
            if start:
                pre = pre.copy()
                pre[0], start = 0, False
            rose.append((at, pre))
            climbing.feed(at, pre)
            last = int(at[-1])
        down_at = np.concatenate([x for x, _ in reversed(fell[c])][::-1])[::-1] if fell[c] else np.zeros(0, np.int64)
        up_pre = np.concatenate([x for _, x in fell[c]]) if fell[c] else np.zeros(0, SHARED)
        fell[c] = []
        joint = _meet(left, int(down_at[0]) if len(down_at) else None, last, cap)
        if len(down_at):
            pre = np.concatenate(([SHARED(joint)], up_pre[1:][::-1]))  # with the source before, going down
            for k in range(0, len(down_at), _BLOCK):
                climbing.feed(down_at[k : k + _BLOCK], pre[k : k + _BLOCK])
        if rose:
            at = np.concatenate([x for x, _ in rose])[::-1]
            pre = np.concatenate(([SHARED(joint)], np.concatenate([x for _, x in rose])[1:][::-1]))
            out.append((at, pre))
        if len(down_at):
            out.append((down_at[::-1], up_pre))
    climbing.queues.close()
    out.reverse()
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _order_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names by their first ``depth`` names at least, by doubling."""
    rank, k, n = names.astype(np.int64), 1, len(names)
    while True:
        order = np.argsort(rank, kind="stable")
        ranked = rank[order]
        new = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1]))) if n else ranked
        if n == 0 or new[-1] == n - 1 or k >= depth:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new + 1
        rank = rank * (n + 2) + np.concatenate((rank[k:], np.zeros(min(k, n), np.int64)))[:n]
        k *= 2


def shared_prefixes(hashes: R.Hashes, n: int, at: np.ndarray, cap: int) -> np.ndarray:
    """Prefix that each suffix shares with the one before it in the list, up to ``cap``, by halving over hashes."""
    a, b = at[:-1], at[1:]
    most = np.minimum(cap, n - np.maximum(a, b))
    lo, hi = np.zeros(len(a), np.int64), most
    while (hi > lo).any():
        mid = (lo + hi + 1) // 2
        same = hashes.of(a, a + mid) == hashes.of(b, b + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return np.concatenate((np.zeros(min(1, len(at)), SHARED), lo.astype(SHARED)))


def suffix_array(text: np.ndarray, symbols: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` symbols at least, and the prefix shared with the one before, up to depth."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, SHARED)
    rising, left = suffix_types(text)
    sample = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if not len(sample):
        return induce(text, rising, left, sample, np.zeros(0, SHARED), symbols, cap=depth)
    by_symbol = sample[np.argsort(text[sample], kind="stable")]
    order, _ = induce(text, rising, left, by_symbol, np.zeros(len(sample), SHARED), symbols, with_shared=False)
    number = np.full(n, -1, np.int64)
    number[sample] = np.arange(len(sample))
    sorted_sample = order[number[order] >= 0]
    hashes = R.Hashes(R.mixed((text.astype(np.uint64) + np.uint64(1)) * R.BASE))
    stop = np.minimum(np.append(sample[1:], n - 1), n - 1) + 1  # a stretch ends with the first symbol of the next
    stretch = hashes.of(sorted_sample, stop[number[sorted_sample]])
    named = np.empty(len(sample), np.int64)
    named[number[sorted_sample]] = np.concatenate(([0], np.cumsum(stretch[1:] != stretch[:-1])))
    sample = sample[_order_names(named, depth)]
    return induce(text, rising, left, sample, shared_prefixes(hashes, n, sample, depth), symbols, cap=depth)


# --- repeats --------------------------------------------------------------------------------------------------------


def byte_values(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def cut(octets: np.ndarray, bounds: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Start, count, key and hash of the pieces of a block: a window's anchor is its least gram by hash, the first of equals."""
    gram = min(gram, width)
    starts, doc = R.window_starts(bounds, width)
    if not len(starts):
        return starts, starts, starts.astype(np.uint64), starts.astype(np.uint64)
    hashes = R.Hashes(_VALUES[octets])
    n = len(octets) - gram + 1
    grams = grams_of(hashes, n, gram)
    low = np.uint64((1 << 28) - 1)
    best = (R.mixed(grams) & ~low) | np.arange(n, dtype=np.uint64)
    reach, want = 1, width - gram + 1  # grams in a window
    while 2 * reach <= want:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if reach < want:
        best = np.minimum(best[: len(best) - (want - reach)], best[want - reach :])
    anchor = (best[starts] & low).astype(np.int64)
    at, count = R.runs_of(anchor * len(bounds) + doc)
    start = starts[at]
    return start, count, grams[anchor[at]], hashes.of(start, start + count - 1 + width)


def repeats_in_shard(pieces: list[bytes], doc: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece and offset of each window that also starts earlier; doc and start are those of the pieces."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 0  # between pieces
    order, shared = suffix_array(text, 257, width)
    at, n = R.runs_of(np.cumsum(shared < width))
    groups = np.flatnonzero(n > 1)
    take = np.repeat(at[groups], n[groups]) + np.arange(n[groups].sum()) - np.repeat(np.cumsum(n[groups]) - n[groups], n[groups])
    place = order[take]
    group = np.repeat(np.arange(len(groups)), n[groups])
    piece = np.searchsorted(ends, place)
    offset = place - (ends[piece] - sizes[piece])
    inside = offset + width <= sizes[piece]  # of equal prefixes none or all run over the end of their piece
    group, piece, offset = group[inside], piece[inside], offset[inside]
    d, s = doc[piece], start[piece] + offset
    o = np.lexsort((s, d, group))
    o = o[_same_bytes(text, (ends - sizes)[piece[o]] + offset[o], group[o], width)]
    lead = np.concatenate(([True], group[o][1:] != group[o][:-1])) if len(o) else np.zeros(0, bool)
    leader = np.maximum.accumulate(np.where(lead, np.arange(len(o)), 0)) if len(o) else np.zeros(0, np.int64)
    later = (d[o] != d[o][leader]) | (s[o] != s[o][leader])
    return piece[o][later], offset[o][later]


def _same_bytes(text: np.ndarray, at: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """Which of the windows have the bytes of the first of their group; names within a shard are hashes, so this is looked up."""
    lead = np.concatenate(([True], group[1:] != group[:-1])) if len(at) else np.zeros(0, bool)
    leader = np.maximum.accumulate(np.where(lead, np.arange(len(at)), 0)) if len(at) else np.zeros(0, np.int64)
    same, reach = np.ones(len(at), bool), np.arange(width)
    for k in range(0, len(at), 1 << 14):
        rows = slice(k, k + (1 << 14))
        same[rows] = (text[at[rows, None] + reach] == text[at[leader[rows], None] + reach]).all(axis=1)
    return same


_CONTENT = "akey bigint, doc bigint, row bigint, start int, piece binary"
_SETTLED = "doc bigint, row bigint, start int, count int"


def grams_of(hashes: R.Hashes, n: int, gram: int) -> np.ndarray:
    """A value for each of the n strings of ``gram`` bytes, wherever it stands."""
    return R.mixed((hashes.sums[gram:] - hashes.sums[:-gram]) * hashes.down[:n])


def narrowed(octets: np.ndarray, start: np.ndarray, count: np.ndarray, akey: np.ndarray, width: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Start, count, key and hash of the pieces that runs of windows with one anchor come apart into, and the run of each.

    A window holds ``width - gram`` bytes beside its anchor, so half of them stand before it or half behind it: the windows of a run
    part into two pieces, each of which goes under its anchor with the half that all its windows hold. Equal windows have their
    anchor at one place and go to the same side.
    """
    gram = min(gram, width)
    hashes = R.Hashes(_VALUES[octets])
    grams = grams_of(hashes, len(octets) - gram + 1, gram)
    reach = np.arange(width - gram + 1)
    anchor = np.empty(len(start), np.int64)
    for k in range(0, len(start), 1 << 13):
        rows = slice(k, k + (1 << 13))
        # the anchor of a run's first window is the first place with its gram
        anchor[rows] = start[rows] + (grams[start[rows, None] + reach] == akey[rows, None]).argmax(axis=1)
    half = (width - gram + 1) // 2
    before = np.clip(anchor - half - start + 1, 0, count)
    left = hashes.of(np.maximum(anchor - half, 0), anchor + gram)
    right = hashes.of(anchor, np.minimum(anchor + width - half + 1, len(octets)))
    at, n, key, run = np.concatenate((start, start + before)), np.concatenate((before, count - before)), np.concatenate((left, right)), np.tile(np.arange(len(start)), 2)
    at, n, key, run = (x[n > 0] for x in (at, n, key, run))
    return at, n, key, hashes.of(at, at + n - 1 + width), run


def narrower(texts: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """``R.PIECES`` of the runs (akey, doc, row, start, count), under more bytes than their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for doc, row, z, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = R.unpacked(z)
                if n and n + len(text) > R.BLOCK:
                    yield out(held)
                    held, n = [], 0
                held.append((doc, row, text, own))
                n += len(text)
        if held:
            yield out(held)

    def out(held: list[tuple]) -> pa.RecordBatch:
        doc, row = (np.array([x[k] for x in held], np.int64) for k in (0, 1))
        first = np.concatenate(([0], np.cumsum([len(x[2]) for x in held])))[:-1]
        owner = np.repeat(np.arange(len(held)), [len(x[3]) for x in held])
        start, count, akey = (np.array([r[c] for x in held for r in x[3]], np.int64) for c in ("start", "count", "akey"))
        at, n, key, phash, of = narrowed(np.frombuffer(b"".join(x[2] for x in held), np.uint8), first[owner] + start, count, akey.view(np.uint64), width)
        own = owner[of]
        return R.earliest(key, phash, doc[own], row[own], at - first[own], n)

    joined = texts.join(R.gathered(runs, "akey", "start", "count"), ["doc", "row"]).select("doc", "row", "z", "runs")
    return joined.mapInArrow(run, R.PIECES)


def _settled_in_shards(texts: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """Runs of the windows of variants that also start earlier."""

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, tuple[int, int]] = {}  # place of the earliest window sent with a hash
        for b in batches:
            for doc, row, z, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = R.unpacked(z)
                keys, starts, pieces = [], [], []
                known_at: list[int] = []
                for r in own:
                    a, n = r["start"], r["count"]
                    if not r["hot"]:
                        keys.append(r["akey"])
                        starts.append(a)
                        pieces.append(text[a : a + n - 1 + width])
                        continue
                    if len(first) > 200_000:
                        first.clear()
                    for at in range(a, a + n):
                        window = text[at : at + width]
                        key = xxhash.xxh3_64_intdigest(window) - (1 << 63)
                        place = first.get(key)
                        if place is not None and place < (doc, at):
                            known_at.append(at)  # the task has sent an equal one that starts earlier
                            continue
                        first[key] = (doc, at)
                        keys.append(key)
                        starts.append(at)
                        pieces.append(window)
                dealt = R.spread(doc, np.array(known_at, np.int64)).tolist() if known_at else []
                n = len(keys) + len(dealt)
                cols = [pa.array(keys + dealt, pa.int64()), pa.array([doc] * n, pa.int64()), pa.array([row] * n, pa.int64()), pa.array(starts + known_at, pa.int32()), pa.array(pieces + [None] * len(dealt), pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in _CONTENT.split(", ")])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(5)]
        size, last = 0, None
        for b in batches:
            known = pa.compute.is_null(b.column(4))
            if pa.compute.any(known).as_py():
                alone = b.select(["doc", "row", "start"]).filter(known)
                yield alone.append_column("count", pa.array(np.ones(len(alone), np.int32)))
            variants = b.filter(pa.compute.invert(known))
            for x in zip(*(c.to_pylist() for c in variants.columns), strict=True):
                if size >= SHARD and x[0] != last:  # a shard ends with a key
                    yield from _shard(held, width)
                    held, size = [[] for _ in range(5)], 0
                last = x[0]
                for h, v in zip(held, x, strict=True):
                    h.append(v)
                size += len(x[4])
        if held[0]:
            yield from _shard(held, width)

    joined = texts.join(R.gathered(runs, "akey", "start", "count", "hot"), ["doc", "row"]).select("doc", "row", "z", "runs")
    return joined.mapInArrow(contents, _CONTENT).repartition("akey").sortWithinPartitions("akey").mapInArrow(sort, _SETTLED)


def _shard(rows: list[list], width: int) -> Iterator[pa.RecordBatch]:
    _, doc, row, start, pieces = rows
    doc, row, start = (np.array(x, np.int64) for x in (doc, row, start))
    piece, offset = repeats_in_shard(pieces, doc, start, width)
    o = np.lexsort((offset, piece))
    piece, offset = piece[o], offset[o]
    at, n = R.runs_of(piece * (1 << 32) + offset - np.arange(len(o)))
    p = piece[at]
    yield R._batch(_SETTLED, doc[p], row[p], (start[p] + offset[at]).astype(np.int32), n.astype(np.int32))


def compared_twice(docs: DataFrame, texts: DataFrame, width: int = WIDTH, many: int = R.MANY) -> tuple[DataFrame, DataFrame]:
    """Runs of windows (as of ``R.compared``): repeats, and the variants that are left to compare byte by byte.

    An anchor is short, so in a large corpus nearly every one has variants, and common ones more and more of them. Those are held
    against each other once more under about twice as many bytes before any text is sent: where these occur once, no window repeats.
    """
    by_anchor = stored(R.compared(R.pieces(docs, byte_values, partial(cut, width=width)), many), "by_anchor")
    left = stored(R.compared(narrower(texts, by_anchor.where("akey is not null"), width), many), "narrowed")
    return by_anchor.where("akey is null").unionByName(left.where("akey is null")), left.where("akey is not null")


def repeated_windows(docs: DataFrame, texts: DataFrame, width: int = WIDTH, many: int = R.MANY) -> DataFrame:
    """Runs (doc, row, start, count) of the windows that also start earlier; the documents as of ``keyed`` and ``packed``."""
    known, variants = compared_twice(docs, texts, width, many)
    return _settled_in_shards(texts, variants, width).unionByName(known.select("doc", "row", "start", "count"))


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, many: int = R.MANY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (stretches removed), kept_sha256 and kept (the bytes left) of every row.

    A byte goes if a string of ``width`` bytes of one document that covers it also starts earlier: in a smaller doc_id, or in
    the same document before; overlaps count. All strings are judged on the input. A null text is empty; a null id counts as
    the greatest. Rows of one id count as one document, so rows repeated whole do not remove each other. Other columns play no
    part. An empty table gives no rows.
    """

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, z, runs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = R.unpacked(z)
                n, spans, kept = len(text), 0, text
                if runs:
                    gone = R.covered(n, *(np.array([r[c] for r in runs], np.int64) for c in ("start", "count")), width)
                    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].any())
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((None if doc == R.NO_ID else doc, n, n - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in RESULT.split(", ")])

    own = R.keyed(docs, id_col, text_col)
    texts = R.packed(own)
    gone = R.gathered(repeated_windows(own, texts, width, many), "start", "count")
    return texts.join(gone, ["doc", "row"], "left").select("doc", "z", "runs").mapInArrow(finish, RESULT)
