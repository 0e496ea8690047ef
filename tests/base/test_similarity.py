import random

import pytest
from pyspark.sql import functions as F

from onomast.functions.similarity import edit_distance, jaro_winkler_value, levenshtein_score, metaphone_value, phonetic_match, similarity_score, similarity_value
from onomast.operators.cluster import candidates, distinct_names, similar_pairs


def test_published_jaro_winkler_values():
    for a, b, want in (("MARTHA", "MARHTA", 0.961), ("DIXON", "DICKSONX", 0.813), ("DWAYNE", "DUANE", 0.84), ("", "X", 0.0), ("A", "A", 1.0), ("AB", "CD", 0.0)):
        assert jaro_winkler_value(a, b) == pytest.approx(want, abs=5e-4)


def test_metaphone():
    assert metaphone_value("Silva") == metaphone_value("Sylva")
    assert metaphone_value("Silva") != metaphone_value("Costa")
    assert metaphone_value("FORZZA, R.") != metaphone_value("FORZZA, R. C.")
    for word, code in (("KNIGHT", "NFT".replace("F", "")), ("PHILIPS", "FLPS"), ("THOMAS", "0MS"), ("SCHOOL", "SKL"), ("XAVIER", "SFR"), ("WRIGHT", "RT")):
        assert metaphone_value(word) == code, word
    assert metaphone_value(None) == metaphone_value("") == ""


def test_scores_in_columns_equal_those_in_python(spark):
    rows = [("SILVA, J.", "SILVA, M."), ("SILVA, J.", "SILVA, J. C."), ("FORZZA", "FORZA"), ("", "X"), ("Á B", "A B"), ("FORZZA, R.", "FORZZA, R. C.")]
    df = spark.createDataFrame(rows, "a string, b string")
    for (a, b), r in zip(rows, df.select(similarity_score(F.col("a"), F.col("b")).alias("s"), levenshtein_score(F.col("a"), F.col("b")).alias("l"), phonetic_match(F.col("a"), F.col("b")).alias("p")).collect(), strict=True):
        assert r.s == pytest.approx(similarity_value(a, b))
        assert r.l == pytest.approx(1 - edit_distance(a, b) / max(len(a), len(b)) if a and b else 0)
        assert r.p == bool(a and b and metaphone_value(a) == metaphone_value(b))
    assert similarity_value("SILVA, J.", "SILVA, M.") >= 0.70
    assert similarity_value("FORZZA, R.", "FORZZA, R. C.") < 0.70  # the headline example does not group


def test_candidates_miss_no_pair(spark):
    r = random.Random(5)
    base = ["".join(r.choice("ABCDE ") for _ in range(r.randint(1, 14))).strip() or "A" for _ in range(60)]
    near = ["".join(c for c in b if r.random() > 0.1) + r.choice(["", "A", "X"]) for b in base]
    names = sorted({x for x in base + near if x})
    df = spark.createDataFrame([("Pessoa", n, str(i), 0.7) for i, n in enumerate(names)], "entityType string, normalized string, order string, confidence double").withColumn("seen_at", F.lit("2020-01-01").cast("timestamp"))
    distinct = distinct_names(df)
    found = {(p.a, p.b): p.score for p in similar_pairs(distinct).collect()}
    want = {(a, b): s for i, a in enumerate(names) for b in names[i + 1 :] if (s := similarity_value(a, b)) >= 0.70}
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k]) for k in want)
    assert candidates(distinct).groupBy("a", "b").count().where("count > 1").count() == 0
