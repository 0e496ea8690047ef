"""The pipeline's near-duplicates against Jaccard similarities by brute force."""

import random

from onomast.llm import similar, simhash


def _set(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def _kept(rows):
    """Least id of each group linked by a similarity of 0.8, by all pairs."""
    sets, group = [_set(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    return sorted(min(r[0] for r, h in zip(rows, group, strict=True) if h == g) for g in set(group))


def _texts(r):
    words = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    texts, foot = [], words(30)
    for _ in range(40):
        t = words(r.randint(20, 150))
        texts.append(t + foot * (r.random() < 0.5))
        for _ in range(3):
            u = list(texts[-1])
            for _ in range(r.randint(1, 1 + len(u) // 35)):  # similarities on both sides of 0.8
                u[r.randrange(len(u))] = "x"
            texts.append(u)
    return [" ".join(t) for t in texts] + ["one two", "ONE  two", "", None]


def test_keep_one_each_is_exact(spark):
    rows = list(enumerate(_texts(random.Random(5))))
    got = simhash.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(x.doc_id for x in got.collect()) == _kept(rows)


def test_common_shingles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(similar, "COMMON", 2)
    rows = list(enumerate(_texts(random.Random(6))))
    got = simhash.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(x.doc_id for x in got.collect()) == _kept(rows)


def test_rows_without_an_id(spark):
    a, b, c = "a b c d e f g h", "q r s t u v w x y z", "k l m n o p"
    rows = [(None, a, 1), (5, a, 2), (None, b, 3), (None, b, 3), (7, c, 4), (7, c, 4), (None, "alone it stands here today", 5)]
    got = simhash.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string, n int"))
    assert sorted((x.n, x.doc_id, x.text) for x in got.collect()) == [(2, 5, a), (3, None, b), (4, 7, c), (5, None, "alone it stands here today")]


def test_rounds_find_the_same(spark, monkeypatch):
    """Pairs are looked for and held against sets in rounds: each moves its share, together they give what one gives."""
    r = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(60):
        base = [r.choice(words) for _ in range(r.randint(20, 120))]
        texts += [" ".join(base), " ".join(base + [r.choice(words)]), " ".join(base[: len(base) // 2] + [r.choice(words) for _ in base])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(x.doc_id for x in simhash.keep_one_each(docs).collect())
    asked = []
    plain = similar.candidates
    monkeypatch.setattr(similar, "candidates", lambda found, labels, rounds=1, n=0: asked.append((rounds, n)) or plain(found, labels, rounds, n))
    monkeypatch.setattr(similar, "ROUND", 60)
    assert sorted(x.doc_id for x in simhash.keep_one_each(docs).collect()) == whole
    assert asked == [(3, 0), (3, 1), (3, 2)] and len(whole) < len(texts)
    assert similar.rounds_for(10**9) == similar.MOST_ROUNDS
