"""A recogniser of persons and organisations: an averaged structured perceptron (Collins 2002) over the tokens of a text.

Tags are outside, and begin and inside of either kind; the best row of tags is found by Viterbi's algorithm. Features are the
token, its ends, its shape and those of its neighbours. It is trained here on lines made from a fixed seed: invented names in the
forms that people are written in, organisations by their head words, places, plants and remarks. A span's score is the
probability that it is right, fitted on lines kept back, from the margin by which its tags beat all others.
"""

from __future__ import annotations

import functools
import math
import random
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import Any

Span = tuple[int, int, str]  # start, end, label
TAGS = ("O", "B-PER", "I-PER", "B-ORG", "I-ORG")
_TOKEN = re.compile(r"[^\W\d_](?:\.[^\W\d_])*\.(?=\s|[^\W\d_]|[,;&)]|$)|[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+|[^\w\s]")
#: Tag after tag: an inside follows its own begin or inside.
_MAY = [[not (b.startswith("I-") and a[2:] != b[2:]) for b in TAGS] for a in TAGS]
_START = [not b.startswith("I-") for b in TAGS]


def shape(token: str) -> str:
    """Kind of a token by its letters: initials, capitals, capitalised, small, mixed, digits or the sign itself."""
    if not token[0].isalpha():
        return "9" if token[0].isdigit() else token
    if len(token) == 1 or token.endswith("."):
        return "X." if token[0].isupper() else "x."
    if token.isupper():
        return "XX" if len(token) > 5 else "XXX"
    return "Xx" if token[0].isupper() and token[1:].islower() else "xx" if token.islower() else "xX"


def features(tokens: list[str]) -> list[list[str]]:
    low = ["<s>", *(t.lower() for t in tokens), "</s>"]
    kinds = ["<s>", *(shape(t) for t in tokens), "</s>"]
    out = []
    for i in range(1, len(tokens) + 1):
        w, k, before, after = low[i], kinds[i], kinds[i - 1], kinds[i + 1]
        own = ["bias", f"s={k}", f"w={w}", f"-1s={before}", f"+1s={after}", f"s3={before}|{k}|{after}", f"-1w={low[i - 1]}", f"+1w={low[i + 1]}", f"-1w,s={low[i - 1]}|{k}"]
        if len(w) > 3:
            own += [f"e2={w[-2:]}", f"e3={w[-3:]}", f"b3={w[:3]}"]
        if i > 1:
            own += [f"-2w={low[i - 2]}", f"-2s={kinds[i - 2]}|{before}|{k}"]
        if i < len(tokens):
            own += [f"+2s={k}|{after}|{kinds[i + 2]}"]
        out.append(own)
    return out


class Tagger:
    """Weights by feature, one for each tag, and those of moves between tags."""

    def __init__(self) -> None:
        self.weights: dict[str, list[float]] = {}
        self.moves = [[0.0] * len(TAGS) for _ in TAGS]
        self.slope, self.shift = 1.0, 0.0

    def _scores(self, found: list[list[str]]) -> list[list[float]]:
        get, out = self.weights.get, []
        for fs in found:
            row = [0.0] * len(TAGS)
            for f in fs:
                w = get(f)
                if w is not None:
                    for k, x in enumerate(w):
                        row[k] += x
            out.append(row)
        return out

    def _best(self, scores: list[list[float]]) -> tuple[list[int], list[list[float]]]:
        """The best tags, and for each token and tag the score of the best row of tags through it."""
        n, all_tags = len(scores), range(len(TAGS))
        forward = [[s if _START[k] else -math.inf for k, s in enumerate(scores[0])]]
        for row in scores[1:]:
            last = forward[-1]
            forward.append([row[b] + max(last[a] + self.moves[a][b] for a in all_tags if _MAY[a][b]) for b in all_tags])
        backward = [[0.0] * len(TAGS)]
        for row in scores[:0:-1]:
            after = backward[-1]
            backward.append([max(self.moves[a][b] + row[b] + after[b] for b in all_tags if _MAY[a][b]) for a in all_tags])
        through = [[f + b for f, b in zip(forward[i], backward[n - 1 - i], strict=True)] for i in range(n)]
        tags = [max(all_tags, key=lambda k: through[0][k])]
        for i in range(1, n):
            a = tags[-1]
            tags.append(max((b for b in all_tags if _MAY[a][b]), key=lambda b: self.moves[a][b] + scores[i][b] + backward[n - 1 - i][b]))
        return tags, through

    def fit(self, lines: list[tuple[list[list[str]], list[int]]], rounds: int = 6, seed: int = 3, leave_out: float = 0.3) -> Tagger:
        """Perceptron updates where the best tags are not the right ones; the weights are the mean of all states gone through.

        ``leave_out`` is the chance of a feature of words (not of shapes) to be left out of a visit.
        """
        order, sums, since = random.Random(seed), defaultdict(lambda: [0.0] * len(TAGS)), 0
        move_sums = [[0.0] * len(TAGS) for _ in TAGS]
        for _ in range(rounds):
            for at in order.sample(range(len(lines)), len(lines)):
                found, right = lines[at]
                since += 1
                # words are left out now and then, so shapes and neighbours have to do without
                found = [[f for f in fs if f[0] == "s" or "s" in f[:3] or order.random() > leave_out] for fs in found]
                tags, _ = self._best(self._scores(found))
                for step, row in ((1.0, right), (-1.0, tags)):
                    if tags == right:
                        break
                    for i, t in enumerate(row):
                        if tags[i] != right[i]:
                            for f in found[i]:
                                self.weights.setdefault(f, [0.0] * len(TAGS))[t] += step
                                sums[f][t] += step * since
                        if i:
                            self.moves[row[i - 1]][t] += step
                            move_sums[row[i - 1]][t] += step * since
        total = since + 1
        self.weights = {f: [w - s / total for w, s in zip(ws, sums[f], strict=True)] for f, ws in self.weights.items()}
        self.moves = [[w - s / total for w, s in zip(a, b, strict=True)] for a, b in zip(self.moves, move_sums, strict=True)]
        return self

    def spans(self, text: str) -> list[tuple[int, int, str, float]]:
        """start, end, label and margin of the spans of a text."""
        places = [m.span() for m in _TOKEN.finditer(text)]
        if not places:
            return []
        tags, through = self._best(self._scores(features([text[a:b] for a, b in places])))
        out, i = [], 0
        while i < len(tags):
            if not TAGS[tags[i]].startswith("B-"):
                i += 1
                continue
            end = i + 1
            while end < len(tags) and TAGS[tags[end]].startswith("I-"):
                end += 1
            margin = min(through[k][tags[k]] - max(x for t, x in enumerate(through[k]) if t != tags[k]) for k in range(i, end))
            out.append((places[i][0], places[end - 1][1], TAGS[tags[i]][2:], margin))
            i = end
        return out

    def calibrate(self, lines: list[tuple[str, list[Span]]]) -> Tagger:
        """Fit the probability of a span to be right to its margin, by Newton's steps of a logistic regression."""
        points = [(m, float((a, b, k) in set(right))) for text, right in lines for a, b, k, m in self.spans(text)]
        self.slope, self.shift = 0.0, 0.0
        for _ in range(25):
            g0 = g1 = 0.0
            h00, h01, h11 = 1e-3, 0.0, 1e-3
            for x, y in points:
                p = 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * x + self.shift))))
                q = p * (1 - p)
                g0, g1, h00, h01, h11 = g0 + y - p, g1 + (y - p) * x, h00 + q, h01 + q * x, h11 + q * x * x
            det = h00 * h11 - h01 * h01
            self.shift += (h11 * g0 - h01 * g1) / det
            self.slope += (h00 * g1 - h01 * g0) / det
        return self

    def entities(self, text: str) -> list[dict[str, Any]]:
        chance = lambda m: 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * m + self.shift))))
        return [{"text": text[a:b], "label": k, "score": chance(m), "start": a, "end": b} for a, b, k, m in self.spans(text)]


# --- lines to learn from -------------------------------------------------------------------------------------------------

_SYLLABLES = "ba be bo ca ce co da de do fa fe ga go ja je jo la le lo ma me mo na ne no pa pe po ra re ri ro sa se si so ta te ti to va vi vo xa za zi lha nho bre tri gue gui mar ber fer son dor lin ner hof man ber ski ley ton".split()
_HEADS = ("Universidade Federal de {p}", "Universidade Estadual de {p}", "Universidade de {p}", "Instituto de {t}", "Instituto {n}", "Instituto Nacional de {t}", "Museu de {t}", "Museu {n}", "Museu Nacional", "Jardim Botânico de {p}", "Jardim Botânico do {p}", "Herbário {n}", "Herbário da Universidade de {p}", "Fundação {n}", "Empresa {n} Ltda", "Companhia {n}", "{n} Ltda", "{n} S.A.", "Laboratório de {t}", "Departamento de {t}", "Faculdade de {t}", "Centro de {t}", "Escola de {t}", "Secretaria de {t}", "Projeto {n}", "University of {p}", "{p} University", "Museum of {t}", "{n} Institute", "Department of {t}", "{n} Foundation", "Royal Botanic Garden of {p}", "National Herbarium of {p}", "{n} Company", "Sociedade de {t}", "Sociedade Brasileira de {t}", "Associação {n}", "Comissão {n}", "{a}", "{a} {p}", "{a}/{a}")
_TOPICS = ("Botânica", "Zoologia", "Pesquisas", "Biologia", "Pesquisas Florestais", "Ciências", "Ecologia", "História Natural", "Agricultura", "Meio Ambiente", "Botany", "Natural History", "Plant Sciences", "Geografia", "Taxonomia Vegetal")
_SMALL = "planta seca margem do rio perto da estrada no campo mata fechada flores brancas frutos maduros solo arenoso árvore pequena sem dados de coleta material estéril duplicata enviada ao acervo folha solta caule ramo coletor ignorado desconhecido não informado amostra muito antiga do lado norte near the river white flowers dry forest small tree along road collector unknown no date".split()
_BY = ("coletado por", "col.", "leg.", "det.", "coletor", "coleção de", "collected by", "com", "por", "determinado por", "o senhor", "a senhora", "dona", "professor", "leg. et det.", "comm.", "coll.")
_PLACES = ("Serra do {p}", "Rio {p}", "Fazenda {p}", "Estrada para {p}", "Município de {p}", "Parque {p}", "Morro do {p}", "Lagoa {p}", "Estação {p}", "Mata de {p}", "perto de {p}", "near {p}", "{p}, {p}", "estado de {p}")
_TITLES = ("Dr.", "Dra.", "Prof.", "Pe.", "Padre", "Irmão", "Frei", "Sr.", "Dom", "Mrs.")


def made_lines(n: int, seed: int) -> Iterator[tuple[str, list[Span]]]:
    """Lines with the spans of their persons and organisations."""
    r = random.Random(seed)
    pick = r.choice
    word = lambda a=2, b=4: "".join(pick(_SYLLABLES) for _ in range(r.randint(a, b))).capitalize()
    initial = lambda: pick("ABCDEFGHIJLMNOPRSTVWZ") + "."
    initials = lambda: pick(("", " ")).join(initial() for _ in range(r.randint(1, 3)))
    small = lambda a, b: " ".join(pick(_SMALL) for _ in range(r.randint(a, b)))

    place = lambda: pick((word(), word(), f"{word()} {word()}", f"{pick(('Rio', 'São', 'Porto', word()))} {pick(('de', 'do', 'da'))} {word()}"))

    def person() -> str:
        particle = pick(("", "", "", "de ", "da ", "dos ", "von ", "van ", "d'"))
        surname = particle + word() + pick(("", "", "", f" {word()}", f"-{word()}", " Filho", " Júnior"))
        given = word(2, 3)
        x = pick((f"{given} {surname}", f"{given} {surname}", f"{initials()} {surname}", f"{initials()} {surname}", f"{surname}, {initials()}", f"{surname}, {initials()}", f"{given} {initial()} {surname}", f"{surname}, {given}", f"{given} {word(2, 3)} {surname}", f"{given} {word(2, 3)} {surname}", f"{given} {word()} {word()} {surname}", f"{pick(_TITLES)} {word()}", word(), word()))
        return x.upper() if r.random() < 0.12 and len(x) > 6 else x

    def organisation() -> str:
        name = pick((word(), f"{word()} {word()}"))
        acronym = "".join(pick("ABCDEFGIMNOPRSTU") for _ in range(r.randint(3, 7)))
        return pick(_HEADS).format(p=place(), t=pick(_TOPICS), n=name, a=acronym)

    def remark() -> str:
        x = pick((small(1, 5), small(1, 5), pick(_PLACES).format(p=place()), str(r.randint(1, 2020)), f"n. {r.randint(1, 9999)}", f"{r.randint(1, 30)}/{r.randint(1, 12)}/{r.randint(1900, 2020)}"))
        return x[0].upper() + x[1:] if r.random() < 0.4 else x

    for _ in range(n):
        line, spans, x = "", [], r.random()
        if x < 0.22:
            parts = [("", remark())] + ([("", remark())] if r.random() < 0.4 else [])
        elif x < 0.42:
            parts = [("ORG", organisation())] + ([("", remark())] if r.random() < 0.3 else [])
        else:
            by = pick(_BY)
            parts = [("", pick((remark(), by, by[0].upper() + by[1:])))] if r.random() < 0.55 else []
            parts.append(("PER", person()))
            while r.random() < 0.3:
                parts += [("", pick(("&", "e", "and", ";", "com", "with"))), ("PER", person())]
            if r.random() < 0.35:
                parts.append(("", remark()))
            elif r.random() < 0.15:
                parts += [("", pick(("da", "do", ",", "-", "/"))), ("ORG", organisation())]
        for label, part in parts:
            line += " " if line and part[0] not in ",;" else ""
            if label:
                spans.append((len(line), len(line) + len(part), label))
            line += part
        yield line, spans


def _tagged(line: str, spans: list[Span]) -> tuple[list[list[str]], list[int]]:
    places = [m.span() for m in _TOKEN.finditer(line)]
    tags = [next((TAGS.index(("B-" if a == s else "I-") + k) for s, e, k in spans if s <= a < e), 0) for a, _ in places]
    return features([line[a:b] for a, b in places]), tags


@functools.cache
def trained(lines: int = 2500, seed: int = 5) -> Tagger:
    """The tagger, trained once in a process; the same everywhere for a seed."""
    return Tagger().fit([_tagged(*x) for x in made_lines(lines, seed)]).calibrate(list(made_lines(lines // 3, seed + 1)))


def recognise_with(tagger: Tagger) -> Callable[[list[str]], list[list[dict[str, Any]]]]:
    return lambda texts: [tagger.entities(t) for t in texts]
