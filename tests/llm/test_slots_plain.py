"""Decontamination against a plain version that slides over words in Python."""

import random
import re
from itertools import groupby

from onomast.llm import decontaminate as D

L, N = r"[^\W\d_]", r"[0-9]"
WORD = re.compile(rf"(?:{L}|{N}|[-])+")


def forms(text):
    """Raw words and template words of an ASCII text."""
    t = re.sub(r"(?<=[0-9])(?=[A-Za-z])", " ", re.sub(r"(?<=[0-9])[.,](?=[0-9])", "", text))
    raw = WORD.findall(t.lower())
    words, shaped = WORD.findall(t), []
    for i, w in enumerate(words):
        if re.fullmatch("[A-Z][a-z]+", w):
            shaped.append(D.NAME)
        elif re.fullmatch("[0-9]+", w):
            shaped.append(D.NUMBER)
        elif i and shaped[-1] == D.NUMBER and w.lower() in D.UNITS.split():
            shaped.append(D.UNIT)
        else:
            shaped.append(w.lower())
    return raw, shaped


def plain(docs, items, width=D.WINDOW):
    """(doc_id, item_id) of contaminated documents."""
    slot = {D.NAME, D.NUMBER, D.UNIT}
    found = set()
    for d, text in docs:
        raw, shaped = forms(text or "")
        for i, item in items:
            r, w = forms(item)
            n = min(width, len(r))
            hits = {}
            for p in range(len(raw) - n + 1):
                for q in range(len(r) - n + 1):
                    a, b = slice(p, p + n), slice(q, q + n)
                    own = [x not in slot for x in w[b]]
                    if n and (raw[a] == r[b] or (shaped[a] == w[b] and sum(own) >= D.LITERALS and not all(own))):
                        hits.setdefault(p - q, []).append((p, {(t, x, y) for t, x, y in zip(w[b], r[b], raw[a], strict=True) if t in slot}))
            for places in hits.values():
                for _, run in groupby(enumerate(sorted(places)), key=lambda x: x[1][0] - x[0]):
                    slots = [s for _, (_, s) in run]
                    every = set().union(*slots)
                    if len(every) == len({(t, x) for t, x, _ in every}) or any(all(x == y for _, x, y in s) for s in slots):
                        found.add((d, i))
    return found


def _item(r, names):
    words = "the a farmer sells buys apples pears at market for each day in town and then has left after week more than".split()
    out = []
    for _ in range(r.randint(6, 40)):
        x = r.random()
        out.append(r.choice(names) if x < 0.15 else f"{r.randint(1, 99)}{r.choice(('', '', 'km', ' miles', ',000'))}" if x < 0.35 else r.choice(words))
    return " ".join(out) + "."


def test_against_a_plain_version(spark):
    r = random.Random(3)
    names = ["Tom", "Ann", "Robert", "Lucy"]
    items = [(i, _item(r, names)) for i in range(12)] + [(20, "What is two plus"), (21, "12 + 7 * 3 - 5"), (22, "Tom")]
    docs = []
    for k in range(120):
        t = r.choice(items)[1]
        if r.random() < 0.6:  # the same question with another value, or with values that conflict
            t = re.sub(r"\b(Tom|12|3)\b", lambda m: r.choice(("Tom", "Ann", "7")) if r.random() < 0.5 else m[0], t)
        if r.random() < 0.2:
            t = t.lower()
        if r.random() < 0.3:
            w = t.split()
            w[r.randrange(len(w))] = "x"
            t = " ".join(w)
        docs.append((k, f"{_item(r, names)} {t} {_item(r, names)}" if r.random() < 0.7 else t))
    docs += [(500, None), (501, ""), (502, "nothing of it here")]
    got = D.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == plain(docs, items)


def test_names_at_the_start_of_sentences_and_joined_units(spark):
    tom = "Tom has 3 apples. Tom buys 4 more pears at the shop. Tom eats 2 of them."
    run = "she ran 5km along the river before the sun came up and slept"
    items = spark.createDataFrame([(1, tom), (2, run), (3, "what is two plus")], "item_id long, text string")
    docs = [(1, tom.replace("Tom", "Ann")), (2, run.replace("5km", "7km")), (3, "so what is two plus, he asked"), (4, tom.upper()), (5, "Tom has apples.")]
    found = {x.doc_id: list(x.item_ids) for x in D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert found == {1: [1], 2: [2], 3: [3], 4: [1]}


def test_clean_judges_rows(spark):
    item = "the quick brown fox jumps over the lazy dog and then sleeps all day"
    rows = [(None, item, 1), (None, "an innocent text", 2), (7, item, 3), (7, "another text", 4), (8, None, 5), (9, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = D.clean(docs, bench)
    assert out.columns == docs.columns and sorted(x.item_id for x in out.collect()) == [2, 4, 5, 6]
    assert D.clean(docs, bench.limit(0)).count() == 6 and D.clean(docs.limit(0), bench).count() == 0
