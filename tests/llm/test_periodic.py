"""Periodic runs against a search of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from onomast.llm import periodic, queries


def plain_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [2, 5, 12])
def test_all_runs_are_found(least):
    rng = random.Random(least)
    for _ in range(1500):
        w = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(70))]
        if w and rng.random() < 0.6:
            a = rng.randrange(len(w))
            p = 1 + rng.randrange(max(1, (len(w) - a) // 3 + 1))
            w = [w[i] if i < a else w[min(a + (i - a) % p, len(w) - 1)] for i in range(len(w))]
        assert periodic.find_runs(np.array(w, np.int32), least) == plain_runs(w, least), w


def test_fibonacci_words_have_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert periodic.find_runs(np.array(b, np.int32)) == plain_runs(b)


def test_long_texts():
    for w, run in (([7] * 200_000, (0, 200_000, 1)), (list(range(1000)) * 60, (0, 60_000, 1000))):
        assert periodic.find_runs(np.array(w, np.int32)) == [run]


def test_places_keep_order():
    rng = random.Random(1)
    numbers = rng.sample(range(10**6), 5000)
    places, known = periodic.Places(numbers[0]), [numbers[0]]
    for x in numbers[1:]:
        before, after = places.add(x)
        below, above = [y for y in known[-50:] if y < x], [y for y in known[-50:] if y > x]
        assert (before is None or before < x) and (after is None or after > x)
        assert not below or before >= max(below)
        assert not above or after <= min(above)
        known.append(x)
    assert list(places) == sorted(numbers) and places.size == len(numbers)


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    top = min(((-k, s, q) for s, k, q in runs), default=None)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    return (doc_id, len(runs), *((top[1], -top[0], top[2], -1000 * top[0] // top[2]) if top else (None,) * 4), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(None, "a b " * 9), (1, None), (2, ""), (3, " \t\n"), (3, " \t\n"), (4, "x " * 30), (5, "l'été là " * 7), (6, "one two three " * 4 + "end")]
    rows += [(i, " ".join(rng.choice(["a", "b", "c", "Ä"]) for _ in range(rng.randrange(60)))) for i in range(10, 300)]
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, runs string, n bigint").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in found.collect()) > 10


def test_operator_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "go " * 15 + "on", "z")], "doc_id bigint, text string, collapsed string")
    row = periodic.periodic_runs(docs).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (16, [(0, 15, 1)], "go on")
    assert periodic.periodic_runs(docs.where("false")).count() == 0
