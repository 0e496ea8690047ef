"""Pairs of names against all pairs."""

import random

from onomast.functions.similarity import similarity_value
from onomast.operators.cluster import candidates, least_overlap, similar_pairs, with_codes


def _names(seed):
    r = random.Random(seed)
    han = [chr(0x4E00 + k) for k in range(60)]
    out = {"".join(r.choice(han) for _ in range(r.randint(1, 4))) for _ in range(250)}  # no Latin letter: one code for all
    out |= {"".join(r.choice("AEIOU") for _ in range(r.randint(1, 3))) + "BRT" + "".join(r.choice("AEIOU ") for _ in range(r.randint(0, 6))) + "." * r.randint(0, 1) for _ in range(250)}
    return sorted({x.strip() for x in out} - {""})


def test_no_pair_is_missed(spark):
    names = _names(1)
    df = with_codes(spark.createDataFrame([("Pessoa", n) for n in names], "entityType string, normalized string"))
    for threshold, weights in ((0.70, (0.4, 0.4, 0.2)), (0.80, (0.3, 0.5, 0.2)), (0.5, (0.5, 0.2, 0.3))):
        found = {(p.a, p.b) for p in similar_pairs(df, threshold, weights).collect()}
        assert found == {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if similarity_value(a, b, weights) >= threshold}
    assert abs(least_overlap() - 0.375) < 1e-12


def test_many_names_of_one_code_are_not_all_paired(spark):
    r = random.Random(2)
    names = sorted({"".join(chr(0x4E00 + r.randrange(3000)) for _ in range(3)) for _ in range(5000)})
    df = with_codes(spark.createDataFrame([("Pessoa", n) for n in names], "entityType string, normalized string"))
    assert df.select("code").distinct().count() == 1
    assert candidates(df).count() < 60_000  # of 12 million
