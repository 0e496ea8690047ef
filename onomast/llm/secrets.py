"""Secret scanning: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field tags the tokens of a line as begin, inside or outside of a secret. Its features are the token's shape, the words
around it and facts about the whole text; the best tags are found by Viterbi's algorithm. It is trained here, on lines made
from a fixed seed: secrets of many makes in many settings, and ordinary tokens that look like them.

A secret may begin at any token but a punctuation mark, and every token of every line is scored. Where the most that one token
of a line gains as begin rather than outside, and all others as inside, moves included, is less than nothing, no tagging can beat
all outside, and the line needs no more.
"""

from __future__ import annotations

import functools
import hashlib
import math
import operator
import pickle
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onomast.llm.common import settle

KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the same spans as runs of any length of which the short ones are dropped

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start, then kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


# --- the field ---------------------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[\w+/-]+|[^\w\s]")
_DIGIT = re.compile(r"[0-9]")
_WORDS = ("password", "passwd", "passphrase", "pwd", "secret", "token", "key", "apikey", "api_key", "auth", "authorization", "bearer", "credential", "private", "access", "login", "jwt", "session")
_HINT = re.compile("|".join(_WORDS))
_SIGNS = "\"'=:.,;@/()<>|"
B, I, O = 0, 1, 2  # noqa: E741


def may_begin(token: str) -> bool:
    return len(token) > 1 or token.isalnum()


_RUNS = re.compile(r"[b-df-hj-np-tv-xz]+")  # consonants in a row
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_PREFIX = re.compile(r"(gh[opsu]|sk|pk|rk|xox[abp]|glpat|AIza|eyJ|npm|hf)[_A-Za-z0-9-]")


def shape(token: str) -> list[str]:
    n = len(token)
    plain = token.isascii() and token.isalpha()
    if n == 1 and not plain and not token.isalnum():
        return [f"sign{token}" if token in _SIGNS else "sign"]
    if plain and token.islower():
        digits, upper, lower = 0, 0, n
    else:
        digits, upper, lower = (sum(a <= c <= b for c in token) for a, b in ("09", "AZ", "az"))
    out = [f"len{min(7, n // 6)}", f"mix{'d' * bool(digits)}{'u' * bool(upper)}{'l' * bool(lower)}{'o' * (digits + upper + lower < n)}"]
    if digits == n or (digits + upper + lower < n and re.fullmatch(r"[0-9+/-]+", token)):
        out.append("number")
    elif digits:
        turns = sum((a.isdigit() != b.isdigit()) for a, b in zip(token, token[1:], strict=False))
        out.append(f"turns{min(6, turns)}")
        seen = len(set(token))
        out.append(f"kinds{min(5, seen // 4)}")
    else:
        out.append(f"humps{min(4, len(re.findall('[a-z][A-Z]', token))) if upper > 1 or (upper and not "A" <= token[0] <= "Z") else 0}")
        out.append(f"joins{0 if plain else min(3, sum(map(token.count, '_+/-')))}")
        out.append(f"hard{min(7, max(map(len, _RUNS.findall(token.lower())), default=0))}" if n >= 8 else "short")
    if n == 36 and _UUID.fullmatch(token):
        out.append("uuid")
    if _PREFIX.match(token):
        out.append("known_prefix")
    return out


def _word(token: str) -> str:
    """The first hint of the list in a token; none in long ones with digits."""
    low = token.lower()
    if not _HINT.search(low) or (len(token) >= 40 and _DIGIT.search(token)):
        return "other"
    return next(w for w in _WORDS if w in low)


def _sign(token: str) -> str:
    return token if len(token) == 1 and not token.isalnum() else "w"


def _features(own: tuple[str, ...], near: str, before: str, after: str, facts: tuple[str, ...]) -> list[str]:
    told = near != "none"
    return ["bias", *own, f"near_{near}", f"before{before}", f"after{after}", f"{told}:{before}", f"{told}:{before}:{own[0]}", *(f"{f}:{own[-1]}" for f in facts), *(f"{told}:{x}" for x in own)]


def line_keys(tokens: list[str], facts: tuple[str, ...]) -> Iterator[tuple]:
    """What the features of each token of a line depend on: its shape, the hint among the six tokens before, the signs beside it, the facts."""
    near, since, before = "none", 0, "^"
    for i, t in enumerate(tokens):
        after = _sign(tokens[i + 1]) if i + 1 < len(tokens) else "$"
        yield tuple(shape(t)), near if since <= 6 else "none", before, after, facts
        hint = _word(t)
        near, since = (hint, 1) if hint != "other" else (near, since + 1)
        before = _sign(t)


def line_features(tokens: list[str], facts: list[str]) -> list[list[str]]:
    """Names of the features of each token of a line."""
    return [_features(*k) for k in line_keys(tokens, tuple(facts))]


def file_facts(text: str) -> list[str]:
    """Facts about a whole text: how much of it is digits, whether it looks like settings or code."""
    digits = sum(map(text.count, "0123456789"))
    assigned = text.count("=") + text.count(": ")
    return [f"digits{min(3, int(20 * digits / max(1, len(text))))}", f"settings{min(3, assigned * 40 // max(40, len(text)))}"]


_FIRST = operator.itemgetter(0)


class Field:
    """Weights of a linear chain over the tags B, I and O."""

    def __init__(self) -> None:
        self.names: dict[str, int] = {}
        self.weights = np.zeros((0, 3))
        self.moves = np.zeros((3, 3))
        self._forget()

    def _forget(self) -> None:
        """Nothing remembered: kinds of tokens by token, scores by kind and surroundings for each set of facts."""
        self._infos: dict[str, tuple[int, int, int, bool]] = {}
        self._owns: list[tuple[str, ...]] = []
        self._own_ids: dict[tuple[str, ...], int] = {}
        self._known: dict[tuple[str, ...], dict[int, tuple]] = {}
        self._signs = ["none", "^", "$", "w", *sorted({c for c in (f.removeprefix("before").removeprefix("after") for f in self.names) if len(c) == 1} - set("^$w"))]
        self._sign_ids = {c: i for i, c in enumerate(self._signs)}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _info(self, token: str) -> tuple[int, int, int, bool]:
        """Numbers of a token's shape, hint (0: none) and sign (0: one without weights), and whether a secret may begin there."""
        own = tuple(shape(token))
        if own not in self._own_ids:
            self._own_ids[own] = len(self._owns)
            self._owns.append(own)
        hint = _word(token)
        info = (self._own_ids[own], 1 + _WORDS.index(hint) if hint != "other" else 0, self._sign_ids.get(_sign(token), 0), may_begin(token))
        if len(token) < 64:
            if len(self._infos) > 60_000:
                self._infos.clear()
            self._infos[token] = info
        return info

    def _scored(self, own: int, near: int, before: int, after: int, begins: bool, facts: tuple[str, ...]) -> tuple[float, float, float, float, float]:
        """Scores of a kind of token in its surroundings, and what it can gain over outside at most as begin and as inside, moves included."""
        key = (self._owns[own], _WORDS[near - 1] if near else "none", self._signs[before], self._signs[after], facts)
        ids = [k for f in _features(*key) if (k := self.names.get(f)) is not None]
        b, i, o = self.weights[ids].sum(axis=0).tolist()
        b = b if begins else -math.inf
        m = self.moves
        leave = max(0.0, max(m[B, O], m[I, O]) - m[O, O], -m[O, O])  # at the end of a secret, or of the line
        enter = max(0.0, m[O, B] - m[O, O], m[B, B] - m[O, O], m[I, B] - m[O, O])
        stay = max(m[B, I], m[I, I]) - m[O, O]
        return b, i, o, float(b - o + enter + leave), float(max(0.0, i - o + stay))

    def tags(self, tokens: list[str], facts: tuple[str, ...]) -> list[int] | None:
        """The likeliest tags of a line, None where all are outside; a few numbers a token are held."""
        infos = self._infos
        found = [infos.get(t) or self._info(t) for t in tokens]
        known = self._known.setdefault(facts, {})
        signs, hints = len(self._signs), len(_WORDS) + 1
        near, since, before, scores, begin, inside = 0, 0, 1, [], -math.inf, 0.0
        for (own, hint, sign, begins), after in zip(found, [*[f[2] for f in found[1:]], 2], strict=True):
            key = ((own * hints + (near if since <= 6 else 0)) * signs + before) * signs + after
            s = known.get(key)
            if s is None:
                s = known[key] = self._scored(own, near if since <= 6 else 0, before, after, begins, facts)
            scores.append(s)
            if s[3] > begin:
                begin = s[3]
            inside += s[4]
            if hint:
                near, since = hint, 1
            else:
                since += 1
            before = sign
        return self._best(scores) if begin + inside >= 0 else None

    def _best(self, scores: list[tuple]) -> list[int]:
        """Viterbi's algorithm over plain numbers, as :meth:`viterbi`."""
        ((bb, bi, bo), (ib, ii, io), (ob, _, oo)) = self.moves.tolist()
        x, _, z = scores[0][:3]
        y, back = -math.inf, bytearray()
        for sb, si, so, _, _ in scores[1:]:
            b, pb = max((x + bb, B), (y + ib, I), (z + ob, O), key=_FIRST)
            n, pn = max((x + bi, B), (y + ii, I), key=_FIRST)
            o, po = max((x + bo, B), (y + io, I), (z + oo, O), key=_FIRST)
            x, y, z = b + sb, n + si, o + so
            back.append(pb | pn << 2 | po << 4)
        at = max((x, B), (y, I), (z, O), key=_FIRST)[1]
        out = [at]
        for p in reversed(back):
            at = p >> 2 * at & 3
            out.append(at)
        return out[::-1]

    def scores(self, features: list[list[str]], begins: list[bool]) -> np.ndarray:
        get = self.names.get
        out = np.array([self.weights[[k for f in fs if (k := get(f)) is not None]].sum(axis=0) for fs in features])
        out[~np.array(begins), B] = -np.inf
        return out

    def viterbi(self, scores: np.ndarray) -> list[int]:
        """The likeliest tags; a secret's inside follows a begin or an inside."""
        moves = self.moves.copy()
        moves[O, I] = -np.inf
        best, back = scores[0].copy(), []
        best[I] = -np.inf
        for row in scores[1:]:
            through = best[:, None] + moves
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        tags = [int(best.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]

    def fit(self, lines: list[tuple[list[list[str]], list[bool], list[int]]], epochs: int = 6, rate: float = 0.3, l2: float = 1e-4) -> Field:
        """Maximise the likelihood by stochastic gradients with per-weight rates; forward and backward sums give the gradient."""
        for features, _, _ in lines:
            for fs in features:
                for f in fs:
                    self.names.setdefault(f, len(self.names))
        self.weights = np.zeros((len(self.names), 3))
        seen_w, seen_m = np.full_like(self.weights, 1e-8), np.full_like(self.moves, 1e-8)
        coded = [([np.array([self.names[f] for f in fs]) for fs in features], begins, tags) for features, begins, tags in lines]
        banned = np.zeros((3, 3))
        banned[O, I] = -np.inf
        order = np.random.default_rng(1)
        lse = np.logaddexp.reduce
        with np.errstate(invalid="ignore"):
            for _ in range(epochs):
                for at in order.permutation(len(coded)):
                    ids, begins, tags = coded[at]
                    s = np.array([self.weights[k].sum(axis=0) for k in ids])
                    s[~np.array(begins), B] = -np.inf
                    s[0, I] = -np.inf
                    m, n = self.moves + banned, len(ids)
                    fw, bw = np.zeros((n, 3)), np.zeros((n, 3))
                    fw[0] = s[0]
                    for i in range(1, n):
                        fw[i] = lse(fw[i - 1][:, None] + m, axis=0) + s[i]
                    for i in range(n - 2, -1, -1):
                        bw[i] = lse(m + (s[i + 1] + bw[i + 1])[None, :], axis=1)
                    z = lse(fw[-1])
                    p = np.exp(fw + bw - z)
                    gm = np.zeros((3, 3))
                    for i in range(1, n):
                        gm -= np.exp(fw[i - 1][:, None] + m + (s[i] + bw[i])[None, :] - z)
                        gm[tags[i - 1], tags[i]] += 1
                    for i, k in enumerate(ids):
                        g = -p[i]
                        g[tags[i]] += 1
                        g = g[None, :] - l2 * self.weights[k]
                        seen_w[k] += g * g
                        self.weights[k] += rate * g / np.sqrt(seen_w[k])
                    gm -= l2 * self.moves
                    seen_m += gm * gm
                    self.moves += rate * gm / np.sqrt(seen_m)
        self._forget()
        return self


def _sample_lines(n: int, seed: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Made lines with the spans of their secrets."""
    r = random.Random(seed)
    small = "abcdefghijklmnopqrstuvwxyz"
    letters, alnum = small + small.upper(), small + small.upper() + "0123456789"
    pick = lambda chars, a, b: "".join(r.choice(chars) for _ in range(r.randint(a, b)))

    def word(least: int = 1, most: int = 4) -> str:
        return "".join(r.choice(("the", "an", "er", "ion", "re", "la", "ment", "sch", "ung", "que", "os", "ado", "ti", "on", "st")) for _ in range(r.randint(least, most)))

    def words(a: int, b: int) -> str:
        return " ".join(w.capitalize() if r.random() < 0.1 else w for w in (word() for _ in range(r.randint(a, b))))

    def strong() -> str:
        """A secret that can be known without any hint."""
        return r.choice((
            lambda: r.choice(("ghp_", "gho_", "ghs_", "glpat-", "npm_", "hf_")) + pick(alnum, 24, 40),
            lambda: r.choice(("sk_live_", "pk_test_", "sk-", "rk_live_")) + pick(alnum, 20, 48),
            lambda: "xoxb-" + pick("0123456789", 10, 13) + "-" + pick(alnum, 20, 28),
            lambda: "AIza" + pick(alnum + "_-", 33, 35),
            lambda: ".".join(["eyJ" + pick(alnum, 16, 30), "eyJ" + pick(alnum, 20, 60), pick(alnum + "_-", 30, 43)]),
            lambda: "SG." + pick(alnum, 20, 22) + "." + pick(alnum, 40, 43),
            lambda: pick(alnum, 24, 48), lambda: pick(alnum + "+/", 32, 44), lambda: pick("0123456789ABCDEF", 32, 64), lambda: pick(letters, 24, 40),
        ))()

    def weak() -> str:
        """A secret that takes a hint and a sign to be one."""
        return r.choice((lambda: pick(alnum, 6, 14), lambda: pick(letters, 6, 16), lambda: pick(small, 14, 30), lambda: word(1, 2) + str(r.randint(1, 9999)), lambda: "-".join(word(1, 2) for _ in range(r.randint(3, 5)))))()

    def harmless() -> str:
        return r.choice((
            lambda: str(r.randint(1, 10**r.randint(8, 16))), lambda: f"{pick('0123456789abcdef', 8, 8)}-{pick('0123456789abcdef', 4, 4)}-{pick('0123456789abcdef', 4, 4)}-{pick('0123456789abcdef', 4, 4)}-{pick('0123456789abcdef', 12, 12)}",
            lambda: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: f"+{r.randint(10**9, 10**12)}", lambda: f"{word()}{r.randint(1, 9999)}@{word()}.com", lambda: f"{word()}{word()}{r.randint(1, 99)}",
            lambda: f"{r.randint(1, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}", lambda: f"https://{word()}.com/{word()}/{r.randint(1, 10**8)}.html", lambda: f"{word()}-{word()}-{r.randint(1, 10**5)}", lambda: f"{r.randint(100, 999)}-{r.randint(1000, 9999)}-{r.randint(1000, 9999)}",
            lambda: word(5, 9), lambda: word(5, 8).capitalize(), lambda: "".join(word(1, 2).capitalize() for _ in range(r.randint(2, 5))), lambda: "_".join(word(1, 2) for _ in range(r.randint(2, 5))), lambda: f"/{word()}/{word()}/{word()}-{word()}/{word()}",
            lambda: "".join(r.choice(("dampf", "schiff", "fahrts", "kraft", "werks", "gesell", "schafts", "recht", "strength", "rhythm", "length", "wachs", "ein", "ver", "ungs", "licht", "mach")) for _ in range(r.randint(2, 7))).capitalize(), lambda: f"{word()}.{word()}@{word()}.org", lambda: f"{word()}({word()}, {word()})", lambda: f"{word()}: {word()}", lambda: f"v{r.randint(1, 20)}.{r.randint(0, 99)}", lambda: word(2, 5).upper(), lambda: f"#{pick('0123456789abcdef', 6, 6)}", lambda: f'"{word()} {word()}"',
        ))()

    told = ('{w}key = "{s}"', "{w}auth: {s}", "Authorization: Bearer {s}", '"{w}_key": "{s}",', "export {w}_PWD={s}", 'credential "{s}" {b}', "passphrase: {s}", 'pwd="{s}"', "{w}://{w}:{s}@{w}.com/{w}")
    free = ("{a} key is {s} {b}", "login with {s}", "private key {s}", "{a} {s} {b}")
    for _ in range(n):
        x = r.random()
        if x < 0.5:
            frame = r.choice(told + free)
            y = weak() if frame in told and r.random() < 0.45 else strong()
            line = frame.format(w=word(), a=words(1, 8), b=words(0, 6), s="\0")
            at = line.index("\0")
            yield line.replace("\0", y), [(at, at + len(y))]
        elif x < 0.7:  # words that speak of secrets where there is none
            yield r.choice(("{a} {k} {b}", "the {k} {b}", "{k}: the {b}", "{a}, {k} {b}", "{k} of {a} is {b}", "{k}s and {k}s {b}", "{k} = {w}({w})", "{w}.{k}({w})", "https://{w}.com/{k}/{w}", "{w}://{w}.com:8080/{w}")).format(k=r.choice(_WORDS), a=words(1, 6), b=words(1, 8), w=word()), []
        else:
            yield f"{words(1, 8)} {r.choice(('', '', 'id: ', 'nr = ', 'call '))}{harmless()} {words(0, 5)}", []


@functools.cache
def trained(lines: int = 2500, seed: int = 7) -> Field:
    """The field, trained once in a process; the same everywhere for a seed. Operators have a task train it, see ``field_of``."""
    rows = []
    for line, spans in _sample_lines(lines, seed):
        tokens = list(_TOKEN.finditer(line))
        tags = [next((B if t.start() == a else I for a, b in spans if a <= t.start() < b), O) for t in tokens]
        rows.append((line_features([t[0] for t in tokens], file_facts(line)), [may_begin(t[0]) for t in tokens], tags))
    return Field().fit(rows)


_FIELDS: dict[str, Field] = {}


def field_of(spark: SparkSession) -> Field:
    """The trained field: a task trains it once in an application, so the driver holds the weights only."""
    application = spark.sparkContext.applicationId
    if application not in _FIELDS:

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _ in batches:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trained())])], ["field"])

        _FIELDS.clear()
        _FIELDS[application] = pickle.loads(spark.range(1, numPartitions=1).mapInArrow(train, "field binary").first().field)
    return _FIELDS[application]


def field_spans(text: str, field: Field) -> list[tuple[int, int]]:
    """Start and end of the secrets that the field finds; every line is decoded."""
    out, facts, at = [], tuple(file_facts(text)), 0
    for line in text.split("\n"):
        if (tokens := _TOKEN.findall(line)) and (tags := field.tags(tokens, facts)):
            places = [m.span() for m in _TOKEN.finditer(line)]
            for i, tag in enumerate(tags):
                if tag == B:
                    end = i
                    while end + 1 < len(tags) and tags[end + 1] == I:
                        end += 1
                    out.append((at + places[i][0], at + places[end][1]))
        at += len(line) + 1
    return out


def scan(text: str | None, field: Field) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans: the field's are added where they touch no base span."""
    text = text or ""
    base, more, k, reach = base_spans(text), [], 0, 0
    for a, b in field_spans(text, field):  # by start; of the base spans that start before b, reach is the furthest end
        while k < len(base) and base[k][0] < b:
            reach = max(reach, base[k][2])
            k += 1
        if reach <= a:
            more.append((a, 3, b))
    return base, sorted(base + more)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row.

    Positions are code points of the whole text, the end exclusive. A null or empty text has no spans. Repeated rows give
    equal results; rows with a null id are scanned too; other columns play no part. An empty table gives no rows.
    """

    field = field_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = defaultdict(list)
            for t in b.column(1):
                base, spans = scan(t.as_py(), field)
                for k, kind in enumerate(KINDS[:3]):
                    cols[f"n_{kind}"].append(sum(s[1] == k for s in base))
                cols["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                cols["spans"].append(joined(spans))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(cols[c], pa.int64()) for c in ("n_assign", "n_access", "n_hex")), *(pa.array(cols[c], pa.string()) for c in ("base_sha256", "spans"))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return ids.mapInArrow(run, f"doc_id {dict(ids.dtypes)['doc_id']}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redacted(text: str, field: Field, mark: str = "[SECRET]") -> str:
    """The text with every secret replaced; touching and overlapping spans become one mark."""
    spans, out, at = scan(text, field)[1], [], 0
    for a, _, b in spans:
        if a > at or not out:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the secrets of each text replaced and the length put right.

    Null texts stay null, with their length as it was; every row stays, repeated ones too. Other columns play no part. An
    empty table gives no rows.
    """

    field = field_of(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts):
        settle()
        return texts.map(lambda t: None if t is None else redacted(t, field))

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    return out.withColumn(chars_col, F.when(F.col(text_col).isNull(), F.col(chars_col)).otherwise(F.length(text_col))).select(docs.columns)
