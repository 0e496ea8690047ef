"""Language identification against a plain version with dictionaries, and its probabilities against how often it is right."""

import math
import random
import zlib

import numpy as np
import pytest

from onomast.llm import langid as G

M = 0xFFFFFFFF


def plain_counts(text):
    """Buckets of the one- to three-grams of letters, stretches of anything else as one mark."""
    marks = [0]
    for c in (text or "").lower():
        x = ord(c) if c.isalpha() else 0
        if x or marks[-1]:
            marks.append(x)
    if len(marks) == 1:
        return {}
    if marks[-1]:
        marks.append(0)
    h = [(x * 0x9E3779B1 + 0x85EBCA6B) & M for x in marks]
    out = {}
    for n in (1, 2, 3):
        for i in range(len(h) - n + 1):
            g = h[i]
            for k in range(1, n):
                g = ((g ^ (g >> 15)) * 0x2C1B3C6D + h[i + k]) & M
            b = ((g ^ (g >> 13)) * 0x297A2D39 & M) >> 17
            out[b] = out.get(b, 0) + 1
    return out


def plain_weights(counts, idf):
    v = {b: (1 + math.log(n)) * idf[b] for b, n in counts.items()}
    size = math.sqrt(sum(x * x for x in v.values())) or 1.0
    return {b: x / size for b, x in v.items()}


def plain_ftrl(rows, labels, k, alpha=0.5, beta=1.0, l1=0.02, l2=0.01, epochs=3):
    z, n = {}, {}

    def weight(b, j):
        a, c = z.get((b, j), 0.0), n.get((b, j), 0.0)
        return 0.0 if abs(a) <= l1 else -(a - math.copysign(l1, a)) / ((beta + math.sqrt(c)) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x = {**rows[i], "bias": 1.0}
            w = {(b, j): weight(b, j) for b in x for j in range(k)}
            s = [sum(v * w[b, j] for b, v in x.items()) for j in range(k)]
            e = [math.exp(y - max(s)) for y in s]
            for j in range(k):
                error = e[j] / sum(e) - (j == labels[i])
                for b, v in x.items():
                    g, c = v * error, n.get((b, j), 0.0)
                    z[b, j] = z.get((b, j), 0.0) + g - (math.sqrt(c + g * g) - math.sqrt(c)) / alpha * w[b, j]
                    n[b, j] = c + g * g
    return weight


def _text(r, lang, words):
    own = {"xa": ["ba", "do", "ki", "ru", "la"], "xb": ["sch", "do", "ein", "ver", "la"], "xc": ["ción", "que", "lla", "ru", "ba"]}[lang]
    return " ".join("".join(r.choice(own) for _ in range(r.randint(1, 3))) for _ in range(words))


def test_counts_as_the_plain_version():
    r = random.Random(4)
    texts = ["", None, "12 34", "a", "Ab c", "É!é", "漢字 かな 12x", "𐐀𐐁 b", "a" * 5, "İstanbul ß"] + [_text(r, "xc", 20) for _ in range(20)]
    for t in texts:
        nz, n = G.counts(t)
        assert dict(zip(nz.tolist(), n.tolist(), strict=True)) == plain_counts(t), t


def test_weights_and_predictions_as_the_plain_version(spark):
    r = random.Random(5)
    rows = [(i, _text(r, lang, r.randint(2, 12)), lang) for i in range(90) for lang in [("xa", "xb", "xc")[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = G.fit(docs)
    learned = [x for x in rows if zlib.crc32(str(x[0]).encode()) % 4 != 2]
    df = {}
    for _, t, _ in learned:
        for b in plain_counts(t):
            df[b] = df.get(b, 0) + 1
    idf = [math.log((1 + len(learned)) / (1 + df.get(b, 0))) + 1 for b in range(G.BUCKETS)]
    assert np.allclose(model.idf, idf, atol=1e-6) and model.languages == ["xa", "xb", "xc"]
    from pyspark.sql import functions as F

    places = {x.doc_id: x.p for x in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 62)).alias("p")).collect()}
    kept = sorted((places[i], lang, t) for i, t, lang in learned if places[i] % 5 != 4)
    weight = plain_ftrl([plain_weights(plain_counts(t), idf) for _, _, t in kept], [model.languages.index(lang) for _, lang, _ in kept], 3)
    assert np.allclose(model.bias, [weight("bias", j) for j in range(3)], atol=1e-9)
    plain = np.array([[weight(b, j) for j in range(3)] for b in sorted(df)])
    assert np.allclose(model.weights[sorted(df)], plain, atol=1e-6)
    for i, t, _ in rows:
        x = plain_weights(plain_counts(t), idf)
        s = [(sum(v * weight(b, j) for b, v in x.items()) + weight("bias", j)) / model.temperature for j in range(3)]
        p = [math.exp(y - max(s)) for y in s]
        lang, score = model.predict(t)
        assert lang == model.languages[int(np.argmax(p))] and score == pytest.approx(max(p) / sum(p), abs=1e-4)


def test_probabilities_are_honest_on_short_texts(spark):
    r = random.Random(6)
    rows = [(i, _text(r, lang, 40), lang) for i in range(1500) for lang in [("xa", "xb", "xc")[i % 3]]]
    model = G.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    right, said = [], []
    for lang in ("xa", "xb", "xc"):
        for _ in range(500):
            found, score = model.predict(_text(r, lang, r.randint(1, 3)))
            right.append(found == lang)
            said.append(score)
    assert 0.06 < model.temperature < 19 and 0.6 < np.mean(right) < 0.999
    assert abs(np.mean(right) - np.mean(said)) < 0.05


def test_rare_languages_are_learned(spark):
    r = random.Random(7)
    rows = [(i, _text(r, "xa", 10), "xa") for i in range(3000)] + [(3000 + i, _text(r, "xc", 10), "xc") for i in range(8)]
    assert G.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_rows=200).languages == ["xa", "xc"]


def test_rare_languages_are_predicted(spark):
    """A language of one row is learned from it, wherever its hash puts it, and known again."""
    r = random.Random(8)
    rare = {f"r{k}": " ".join("".join(chr(0x3B1 + 40 * k + r.randrange(20)) for _ in range(6)) for _ in range(12)) for k in range(6)}
    ids = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, _text(r, "xa", 10), "xa") for i in range(300)] + [(ids[k], t, lang) for k, (lang, t) in enumerate(rare.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = G.fit(docs)
    assert model.languages == [*sorted(rare), "xa"]
    assert {lang: model.predict(t)[0] for lang, t in rare.items()} == {lang: lang for lang in rare}
    assert model.predict(rows[0][1])[0] == "xa"
