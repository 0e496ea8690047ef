"""Packing tokenised documents into training sequences: bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document's full windows are sequences by themselves; what is left
of it goes into the open window that it fills best. When none has room the fullest is emitted and a new one opened. The
windows still open at the end of each partition are merged: their pieces are packed again, best fit by falling length, in
rounds of many partitions to one until one group is left. Token ids never leave the task that made them.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onomast.llm.common import keep, lean, stored

CAPACITY = 2048
OPEN_WINDOWS = 64
#: Partitions whose open windows are merged into one group in a round.
MERGE_FAN_IN = 64
END_ID = 1
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, open_group bigint"
_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def word_pattern(spec: dict) -> str | None:
    """The pattern by which a tokenizer file cuts lower-cased plain Latin texts into words, or None if it works otherwise."""
    steps = [(x or {}).get("normalizers") or (x or {}).get("pretokenizers") or [] for x in (spec.get("normalizer"), spec.get("pre_tokenizer"))]
    if [x["type"] for x in steps[0]] != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps[1]] != ["Split", "ByteLevel"] or spec["model"].get("end_of_word_suffix") != "</w>":
        return None
    split = steps[1][0]
    pattern = split["pattern"].get("Regex", "") if split["invert"] and split["behavior"] == "Removed" else ""
    for kind in "LN":
        pattern = pattern.replace(rf"\p{{{kind}}}", "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind))
    return pattern if pattern and r"\p" not in pattern else None


class WordTokenizer:
    """Ids of whole texts by a file of the tokenizers library, remembered word by word where the file allows it.

    A word-level BPE file cuts a lower-cased text into words by a pattern and encodes them one by one, so a word's ids can be
    kept; the pattern is the file's own. Texts that are not plain Latin when lower-cased, or that may hold a
    special token, go to the library whole, and so do all texts where the file is of another kind.
    """

    plain = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*")
    most = 400_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            pattern = word_pattern(json.load(f))
        self.words = re.compile(pattern).findall if pattern else None
        self.model, self.known = Tokenizer.from_file(path), {}
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = list(words)
        ids = np.array(self.model.encode(" ".join(new), add_special_tokens=False).ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(new):
            raise ValueError("the tokenizer cuts words otherwise than expected")
        raw, at = ids.tobytes(), 0
        for w, end in zip(new, (4 * cuts).tolist(), strict=True):
            self.known[w] = raw[at:end]
            at = end

    def _cut(self, text: str) -> list[str] | None:
        if self.words is None or "<|" in text:
            return None
        low = text.lower()  # a capital's small letter may lie outside, as some signs' may lie inside
        return self.words(low) if self.plain.fullmatch(low) else None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out, get = [], self.known.__getitem__
        for t in texts:
            words = self._cut(t)
            if words is None:
                out.append(np.array(self.model.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
                continue
            try:
                out.append(b"".join(map(get, words)))
            except KeyError:
                self.learn(set(words))
                out.append(b"".join(map(get, words)))
        return out


@functools.lru_cache(maxsize=2)
def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer for all tasks of a worker: the file is read once and known words stay known, until another operator uses the worker."""
    keep("packing", tokenizer_at.cache_clear)
    return WordTokenizer(path)


class Windows:
    """The open windows of one partition."""

    def __init__(self, capacity: int, most: int | None):
        self.capacity, self.most = capacity, most
        self.rooms: list[tuple[int, int]] = []  # (room, number), rising
        self.held: dict[int, list[tuple]] = {}
        self.used = 0

    def place(self, piece: tuple, length: int) -> list[tuple] | None:
        """Put the piece into the window that it fills best; gives the pieces of a window that had to go, if one had."""
        gone = None
        at = bisect.bisect_left(self.rooms, (length, -1))
        if at == len(self.rooms):
            if self.most is not None and len(self.rooms) >= self.most:
                gone = self.held.pop(self.rooms.pop(0)[1])  # the fullest
            room, number = self.capacity, self.used
            self.used += 1
            self.held[number] = []
        else:
            room, number = self.rooms.pop(at)
        self.held[number].append(piece)
        if room == length:
            return (gone or []) + [("full", number)]
        bisect.insort(self.rooms, (room - length, number))
        return gone


def _rows(pieces: list[list]) -> pa.RecordBatch:
    cols = list(zip(*pieces, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], _NAMES)


class _Packer:
    """Numbers sequences and gives each piece its offset."""

    def __init__(self, capacity: int, most: int | None, first_id: int):
        self.windows, self.next_id, self.out = Windows(capacity, most), first_id, []

    def emit(self, pieces: list[tuple], open_group: int | None = None) -> None:
        at = 0
        for p in pieces:
            self.out.append([*p, self.next_id, at, open_group])
            at += p[2]
        self.next_id += 1

    def add(self, piece: tuple) -> None:
        gone = self.windows.place(piece, piece[2]) or []
        full = gone.pop()[1] if gone and gone[-1][0] == "full" else None
        if gone:
            self.emit(gone)
        if full is not None:
            self.emit(self.windows.held.pop(full))

    def finish(self, open_group: int | None) -> None:
        for _, number in self.windows.rooms:
            self.emit(self.windows.held[number], open_group)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids followed by id 1, so a null or empty text is one piece of one token. Repeated rows are packed
    each. Pieces of a sequence follow one another from offset 0, and no sequence exceeds ``capacity``. Other columns play
    no part. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, tokens = _Packer(capacity, open_windows, part << 32), tokenizer_at(tokenizer_path)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                texts = [t or "" for t in b.column(1)[at : at + 256].to_pylist()]
                for doc_id, ids in zip(b.column(0)[at : at + 256].to_pylist(), tokens.encode(texts), strict=True):
                    ids += END_ID.to_bytes(4, "little")
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        length = min(capacity, n - start)
                        piece = (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n)
                        if length == capacity:
                            packer.emit([piece])
                        else:
                            packer.add(piece)
                if packer.out:
                    yield _rows(packer.out)
                    packer.out = []
        packer.finish(part)
        yield _rows(packer.out)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first = stored(texts.mapInArrow(lean(run, "packing"), PIECES), "pieces")
    done, level = first.where("open_group is null"), 0
    left = first.where("open_group is not null")
    groups = (first.agg(F.max("open_group")).first()[0] or 0) + 1
    while True:
        level, groups = level + 1, -(-groups // MERGE_FAN_IN)
        merged = _merge(left, capacity, open_windows, level, last=groups == 1)
        if groups == 1:
            return done.unionByName(merged).drop("open_group")
        merged = stored(merged, "merged")
        done, left = done.unionByName(merged.where("open_group is null")), merged.where("open_group is not null")


def _merge(left: DataFrame, capacity: int, keep: int, level: int, last: bool) -> DataFrame:
    """Pack the pieces of open windows again; the ``keep`` emptiest windows of a group stay open for the next round, the others are closed.

    So a group takes at most ``MERGE_FAN_IN * keep`` windows, whatever the number of partitions.
    """

    def run(key: tuple, t: pa.Table) -> pa.Table:
        group = key[0].as_py()
        packer = _Packer(capacity, None, (level << 58) | (group << 32))
        for row in sorted(zip(*(t[c].to_pylist() for c in _NAMES[:5]), strict=True), key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1])):
            packer.add(row)
        rooms = packer.windows.rooms
        for i, (_, number) in enumerate(rooms):  # rising room
            packer.emit(packer.windows.held[number], None if last or i < len(rooms) - keep else group)
        return pa.Table.from_batches([_rows(packer.out)])

    grouped = left.withColumn("g", F.floor(F.col("open_group") / MERGE_FAN_IN).cast("long"))
    return grouped.groupBy("g").applyInArrow(run, PIECES)
