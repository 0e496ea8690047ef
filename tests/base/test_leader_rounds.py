"""The leader grouping goes through few sights of each name, and gives what going through all of them gives."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from onomast.operators import cluster
from onomast.operators.cluster import Leaders, canonical_value, leader_entities

T0 = dt.datetime(2020, 1, 1)
KIND = "Pessoa"


def names_of(spark, rows, first=0):
    return spark.createDataFrame([(kind, name, 0.8, f"{first + i:06}", 0, T0 + dt.timedelta(days=first + i)) for i, (kind, name) in enumerate(rows)], "entityType string, normalized string, confidence double, order string, position int, seen_at timestamp")


def table(df):
    return sorted((e.id, e.canonicalName, e.entityType, tuple(map(tuple, e.variations)), e.created_at, e.updated_at) for e in df.collect())


def test_few_sights_go_through_python(spark, monkeypatch):
    seen, real = spark.sparkContext.accumulator(0), cluster._in_order

    def counting(batches):
        def each():
            for b in batches:
                seen.add(len(b))
                yield b

        yield from real(each())

    monkeypatch.setattr(cluster, "_in_order", counting)
    found = leader_entities(names_of(spark, [(KIND, ("SILVA, J.", "COSTA, A. B.", "ZANONI, T.")[i % 3]) for i in range(1500)])).collect()
    assert [(e.id, e.canonicalName, e.variations[0].occurrence_count) for e in sorted(found)] == [(1, "Silva, J.", 500), (2, "Costa, A. B.", 500), (3, "Zanoni, T.", 500)]
    assert found and seen.value < 300


def test_many_rounds_equal_one(spark, monkeypatch):
    r = random.Random(5)
    pool = ["SILVA, J.", "SILVA, J. C.", "SILVA, J. C. DE", "Silva, J.", "SYLVA, J.", "FORZZA, R.", "FORZZA, R. C.", "FORZA, R.", "J. SILVA", "J. C. SILVA"]
    rows = [(r.choice([KIND, "Empresa"]), r.choice(pool[: 2 + i // 8])) for i in range(120)]
    monkeypatch.setattr(cluster, "SIGHTS", 1000)
    whole = table(leader_entities(names_of(spark, rows)))
    monkeypatch.setattr(cluster, "SIGHTS", 1)
    monkeypatch.setattr(cluster, "MORE", 2)
    part = leader_entities(names_of(spark, rows[:50]))
    assert table(leader_entities(names_of(spark, rows[50:], 50), known=part)) == whole


def plainly(sights, near):
    """For each sight the entity and the score by the definition, and the names at the end."""
    names, out = [], []
    for name in sights:
        up = name.upper()
        found = max(((2.0 if n.upper() == up else near.get((up, n.upper()), 0.0), -i) for i, n in enumerate(names)), default=(0.0, 0))
        if found[0] == 0.0:
            out.append((len(names), 1.0))
            names.append(canonical_value(name, KIND))
            continue
        out.append((-found[1], min(found[0], 1.0)))
        if len(name.split()) > len(names[-found[1]].split()):
            names[-found[1]] = canonical_value(name, KIND)
    return out, names


def in_rounds(sights, near, most, more):
    """The same by rounds of the first ``most`` sights of each name, then ``more`` times as many."""
    lists = defaultdict(list)
    for (a, b), score in near.items():
        lists[a].append((b, score))
    steps, at, names, rounds = defaultdict(list), -1, {}, 0
    while True:
        one, count = Leaders(0, KIND, lists), defaultdict(int)
        for i, n in names.items():
            one.seed(i, False, n)
        for t, name in enumerate(sights):
            count[name] += t > at
            if t > at and count[name] <= most and one.stop is None:
                one.take(name, ("", t, name), count[name] == most)
        rounds += 1
        for _, _, _, i, _, name, _, score, _, _, t, _, after in one.steps:
            steps[name].append(((t, after), i, score))
        names = one.names
        if one.stop is None:
            break
        at, most = one.stop[1], most * more
    told = [max(s for s in steps[name] if s[0] <= (t, 0)) for t, name in enumerate(sights)]
    return [s[1:] for s in told], [names[i] for i in sorted(names)], rounds


@pytest.mark.parametrize("most", [1, 2, 5])
def test_steps_equal_the_definition(most):
    rounds = 0
    for seed in range(300):
        r = random.Random(seed)
        pool = [" ".join(r.choice("ABCDEF") for _ in range(r.randint(1, 4))) for _ in range(8)] + ["X , Y", "X, Y", "x, y"]
        strings = sorted({s for n in pool for s in (n.upper(), canonical_value(n, KIND).upper())})
        near = {}
        for i, a in enumerate(strings):
            for b in strings[i + 1 :]:
                if r.random() < 0.4:
                    near[a, b] = near[b, a] = r.choice([0.7, 0.8, 0.9, 1.0])
        sights = [r.choice(pool[: 2 + t // 6]) for t in range(80)]
        got, names, n = in_rounds(sights, near, most, 2)
        assert (got, names) == plainly(sights, near), seed
        rounds = max(rounds, n)
    assert rounds > 1
