"""Byte-pair encoding by a tokenization automaton (Berglund, Martens and van der Merwe 2024).

The automaton reads tokens and accepts a row of them exactly if it is the encoding of some text. It starts as one state with an
arc to itself for each byte. A merge u v -> w puts in a gadget: arcs u go to a copy of the state they went to that has no arc v, so that
u is never followed by v again, and wherever u and then v led, an arc w leads there. Arcs of one token all go to one state, so
there are at most as many states as merges and one. A copy differs from its state by one arc; it is kept as that
difference, together with the merge that made it, and whether a state has an arc follows from the copies it descends from.

A pre-split word is encoded by the path of arcs that spells it. From a place the tokens that go on there are looked up in a table of
bytes, and the longest that the state has an arc for is taken. A place is reached by one path only, as the encoding of the word so far is
unique, so a place that does not lead to the end is left for good and the path to the end is the encoding. Arcs that were looked up
once stay in the table of transitions. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Iterator
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How the byte-level kind of tokenizer files cuts texts into words (a fixed value of that format).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in files of the byte-level kind: printable ones for themselves, others from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain_pattern(pattern: str, end: int) -> str:
    """The pattern for texts of characters below ``end``, with letters, numbers and white space spelled out."""
    own = {"s": r"\t-\r \x85\xa0"} | {kind: "".join(re.escape(chr(c)) for c in range(end) if category(chr(c))[0] == kind) for kind in "LN"}
    inner = re.sub(r"\[\^\\s\\p\{L\}\\p\{N\}\]", lambda _: f"[^{own['s']}{own['L']}{own['N']}]", pattern)
    inner = re.sub(r"\\p\{(L|N)\}", lambda m: f"[{own[m[1]]}]", inner)
    return inner.replace(r"\s", f"[{own['s']}]").replace(r"\S", f"[^{own['s']}]")


class Automaton:
    """The tokenization automaton of a list of merges, in order; tokens are bytes."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.labels: list[bytes] = [bytes([b]) for b in range(256)]
        number = {x: i for i, x in enumerate(self.labels)}
        #: of each token: the state its arcs go to, and the tokens (number, merge that ended it) it grew from on the left
        self.target = [0] * 256
        self.left: list[int] = [-1] * 256
        self.made: list[int] = [-1] * 256
        #: of each state: the state it was copied from, the merge that did so, and the arc that the copy lacks
        self.parent, self.born = [-1], [-1]
        self.lost: list[dict[int, int]] = [{}]
        users, self.dead = [257], set()  # the start and every byte
        for at, (a, b) in enumerate(merges):
            u, v, label = number[a], number[b], a + b
            meet = u not in self.dead and self.has_arc(self.target[u], v)
            if label in number:
                raise ValueError(f"two merges make {label!r}")
            w = number[label] = len(self.labels)
            self.labels.append(label)
            self.left.append(u)
            self.made.append(at)
            state = self.target[v]
            self.target.append(state)
            users[state] += 1
            if not meet:  # u is never followed by v: the merge changes nothing, and no state has an arc w
                self.dead.add(w)
                continue
            old = self.target[u]
            if users[old] > 1:  # other tokens keep the arc
                users[old] -= 1
                self.target[u] = len(self.parent)
                self.parent.append(old)
                self.born.append(at)
                self.lost.append({})
                users.append(1)
            self.lost[self.target[u]][v] = at
        self.sizes = [len(x) for x in self.labels]
        self.longest = max(self.sizes)
        self.trie: dict[int, dict | int] = {}  # byte to node; 256 leads to the token that ends there
        for i, label in enumerate(self.labels):
            node = self.trie
            for byte in label if i not in self.dead else b"":
                node = node.setdefault(byte, {})
            if i not in self.dead:
                node[256] = i
        self.table: dict[int, bool] = {}

    def lost_at(self, state: int, token: int) -> int | None:
        """The merge that took the token's arc from the state or from a state it descends from before the copy was made."""
        until = None
        while state >= 0:
            at = self.lost[state].get(token)
            if at is not None and (until is None or at < until):
                return at
            until = self.born[state] if until is None else min(until, self.born[state])
            state = self.parent[state]
        return None

    def has_arc(self, state: int, token: int) -> bool:
        """Whether a state has an arc of a token: its left part had one when the token was made, and it was not lost since."""
        if token in self.dead:
            return False
        if self.lost_at(state, token) is not None:
            return False
        while (u := self.left[token]) >= 0:
            at = self.lost_at(state, u)
            if at is not None and at <= self.made[token]:
                return False
            token = u
        return True

    def _ahead(self, word: bytes, i: int) -> list[int]:
        """The tokens that the word goes on with from a place, short ones first."""
        out, node = [], self.trie
        for byte in word[i : i + self.longest]:
            node = node.get(byte)
            if node is None:
                break
            token = node.get(256)
            if token is not None:
                out.append(token)
        return out

    def encode(self, word: bytes) -> list[int]:
        """Numbers of the tokens of a word. Long tokens are tried first; a place that does not lead to the end is never tried again."""
        n, table, target, sizes, many = len(word), self.table, self.target, self.sizes, len(self.labels)
        path: list[int] = []
        if not n:
            return path
        stack, dead = [(0, self._ahead(word, 0))], set()
        while stack:
            i, left = stack[-1]
            state = target[path[-1]] if i else 0
            while left:
                token = left.pop()
                j = i + sizes[token]
                if j in dead:
                    continue
                key = state * many + token
                go = table.get(key)
                if go is None:
                    if len(table) > 1_000_000:
                        table.clear()
                    go = table[key] = self.has_arc(state, token)
                if go:
                    path.append(token)
                    if j == n:
                        return path
                    stack.append((j, self._ahead(word, j)))
                    break
            else:
                dead.add(i)
                stack.pop()
                if path:
                    path.pop()
        raise ValueError(f"no way through {word[:80]!r}")


class ByteTokenizer:
    """Texts to ids and back by the content of a tokenizer file of the byte-level kind, words remembered."""

    most, longest = 450_000, 64
    plain = re.compile(r"[\x00-\u024f]*").fullmatch

    def __init__(self, content: str):
        spec = json.loads(content)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or (spec["decoder"] or {}).get("type") != "ByteLevel" or not plain:
            raise ValueError("not a byte-level BPE file of the plain kind")
        added = spec.get("added_tokens") or []
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
            raise ValueError("added tokens that take their surroundings along are not known")
        code = byte_letters()
        raw = lambda x: bytes(map(code.__getitem__, x))
        self.merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        self.vocabulary = {raw(k): v for k, v in model["vocab"].items() if k not in {x["content"] for x in added}}
        labels = {v: k for k, v in self.vocabulary.items()} | {x["id"]: x["content"].encode() for x in added}
        self.labels = pa.array([labels.get(i, b"") for i in range(max(labels) + 2)], pa.binary())  # the last for ids that are not known
        self.added = {x["content"]: x["id"] for x in added}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.cut, self.cut_plain = regex.compile(WORDS).findall, re.compile(plain_pattern(WORDS, 0x250)).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @functools.cached_property
    def automaton(self) -> Automaton:
        """Made when a word is encoded: workers that decode do without."""
        return Automaton(self.merges)

    @functools.cached_property
    def ids(self) -> list[int]:
        return [self.vocabulary[x] for x in self.automaton.labels]

    def words(self, text: str) -> list[str]:
        """The words of a text. Character tables of different age disagree on letters that were added of late; of these the library's count."""
        if self.plain(text):
            return self.cut_plain(text)
        if any(category(c) == "Cn" for c in set(text)):
            from tokenizers.pre_tokenizers import ByteLevel

            return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        return self.cut(text)

    def _coded(self, words: list[str]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            pass
        own = set(words)
        new = own.difference(self.known)
        if len(self.known) + len(new) > self.most:  # what is not met again while as many are learned is forgotten
            self.known, self.older, new = {}, self.known, own
        for w in new:
            got = self.older.get(w)
            self.known[w] = array("i", [self.ids[t] for t in self.automaton.encode(w.encode())]).tobytes() if got is None else got
        out = b"".join(map(self.known.__getitem__, words))
        for w in new:
            if len(w) > self.longest:
                del self.known[w]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers in the machine's order of bytes."""
        if not self.parts or not any(x in text for x in self.added):
            return self._coded(self.words(text))
        return b"".join(array("i", [self.added[x]]).tobytes() if x in self.added else self._coded(self.words(x)) for x in self.parts.split(text))

    def decode(self, ids: pa.ListArray) -> pa.StringArray:
        """For each list of ids their labels, joined; bytes that are not UTF-8 become U+FFFD, ids that are not known give nothing."""
        flat = ids.flatten().to_numpy()
        known = np.where((flat >= 0) & (flat < len(self.labels)), flat, len(self.labels) - 1)
        ends = np.concatenate(([0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy()))).astype(np.int32)
        raw = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), self.labels.take(pa.array(known))), b"")
        try:
            out = raw.cast(pa.string())
        except pa.ArrowInvalid:
            out = pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())
        return pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), out) if ids.null_count else out


@functools.lru_cache(maxsize=2)
def _tokenizer(content: str) -> ByteTokenizer:
    """One tokenizer for all tasks of a worker."""
    return ByteTokenizer(content)


def _shared(df: DataFrame, path: str):
    """The file's content for all tasks: read by the driver, so executors need no such file. Its size does not grow with data."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each row, by the tokenizer file at ``path``.

    A text that is null or empty has no ids (an empty array). A special token's string in a text is that token, as the library takes it.
    Null ids and repeated rows stay; other columns play no part. An empty table gives no rows. Nothing is shuffled.
    """
    content = _shared(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(content.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                coded = [t.encode(x or "") for x in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in coded)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decoded(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with their ids and ``decoded``, the text that the ids stand for.

    Null ids give a null text, an empty array the empty text. All other columns but one called ``decoded`` are kept.
    """
    content = _shared(rows, path)
    names = [c for c in rows.columns if c != "decoded"]
    at_ids = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(content.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, t.decode(part.column(at_ids))], [*names, "decoded"])

    kinds = dict(rows.dtypes)
    return rows.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "decoded string"]))
