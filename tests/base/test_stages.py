"""Golden vectors of the string stages, and traps of Unicode and of order."""

import pytest
from pyspark.sql import functions as F

from onomast.functions.text import titled
from onomast.operators.atomize import atomize, names
from onomast.operators.canonical import canonical_form, entity_type
from onomast.operators.classify import RULES, Rule, classify
from onomast.operators.normalize import normalize, normalized
from onomast.plans.resolve import resolved_names
from onomast.schema import stored_confidence

# text, sanitized, category, confidence, normalized names, canonical names
# Inputs where what is claimed of this grammar and what it does differ.
DIVERGENT = [
    ("Silva, J. & R.C. Forzza; Santos, M. et al.", "Silva, J. & R.C. Forzza; Santos, M. et al.", "ConjuntoPessoas", 0.82, ["SILVA, J. & R. C. FORZZA", "SANTOS, M."], ["Silva, J. & R. C. FORZZA", "Santos, M."]),
    ("Forzza, R.C.", "Forzza, R.C.", "Pessoa", 0.80, ["FORZZA, R. C."], ["Forzza, R. C."]),
    ("R.C. Forzza", "R.C. Forzza", "Pessoa", 0.65, ["R. C. FORZZA"], ["R. C. Forzza"]),
    ("EMBRAPA", "EMBRAPA", "Empresa", 0.85, ["EMBRAPA"], ["Embrapa"]),
]
GOLDEN = DIVERGENT + [
    ("T.W. Keller (31)", "T.W. Keller", "Pessoa", 0.65, ["T. W. KELLER"], ["T. W. Keller"]),
    ("H. Lindgren 2204", "H. Lindgren", "Pessoa", 0.65, ["H. LINDGREN"], ["H. Lindgren"]),
    ("B. Okafor 518C", "B. Okafor", "Pessoa", 0.65, ["B. OKAFOR"], ["B. Okafor"]),
    ("A. B. Moreau 12, C. D. TANAKA 9", "A. B. Moreau 12, C. D. TANAKA", "ConjuntoPessoas", 0.82, ["A. B. MOREAU, C. D. TANAKA"], ["A. B. Moreau, C. D. TANAKA"]),
    ("Grupo do Rio Verde", "Grupo do Rio Verde", "GrupoPessoas", 0.75, ["GRUPO DO RIO VERDE"], ["Grupo Do Rio Verde"]),
    ("NASA", "NASA", "Empresa", 0.85, ["NASA"], ["Nasa"]),
    ("s/c", "s/c", "NaoDeterminado", 1.0, ["S/C"], ["S/C"]),
    ("Sem Coletor", "Sem Coletor", "NaoDeterminado", 1.0, ["SEM COLETOR"], ["Sem Coletor"]),
    ("Yu", "Yu", "NaoDeterminado", 0.0, ["YU"], ["Yu"]),
    ("Keller & Moreau", "Keller & Moreau", "Pessoa", 0.60, ["KELLER& MOREAU"], ["Keller& Moreau"]),
    ("Turma", "Turma", "Pessoa", 0.55, ["TURMA"], ["Turma"]),
    ("Lindgren, H. W. ET AL", "Lindgren, H. W. ET AL", "Pessoa", 0.80, None, None),
    ("Okafor, B, Tanaka, C", "Okafor, B, Tanaka, C", "ConjuntoPessoas", 0.82, None, None),
    ("Moreau, A. ; Von Keller, T. W. Da S.", "Moreau, A. ; Von Keller, T. W. Da S.", "ConjuntoPessoas", 0.82, ["MOREAU, A.", "VON KELLER, T. W. DA S."], ["Moreau, A.", "Von Keller, T. W. DA S."]),
    ("B. O. Keller, H. W. Moreau, C. D. Tanaka", "B. O. Keller, H. W. Moreau, C. D. Tanaka", "ConjuntoPessoas", 0.82, None, None),
    ("Maria Labelle", "Maria Labelle", "GrupoPessoas", 0.75, None, None),  # a keyword inside a name
    ("Éva Dvořák, Á.", "Éva Dvořák, Á.", "Pessoa", 0.60, None, None),
]


@pytest.fixture(scope="module")
def resolved(spark):
    rows = [(str(i), g[0]) for i, g in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "record_id string, collector_text string")
    classes = {int(r.record_id): r.classification for r in classify(df).collect()}
    found = resolved_names(df).withColumn("canonical", canonical_form(F.col("normalized"), F.col("entityType"))).orderBy("record_id", "position").collect()
    per = {}
    for r in found:
        per.setdefault(int(r.record_id), []).append(r)
    return classes, per


@pytest.mark.parametrize("i", range(len(GOLDEN)), ids=[g[0] for g in GOLDEN])
def test_golden(resolved, i):
    text, sanitized, category, confidence, norm, canonical = GOLDEN[i]
    c = resolved[0][i]
    assert (c.sanitized_text, c.category, c.confidence, c.should_atomize) == (sanitized, category, confidence, category == "ConjuntoPessoas")
    if norm:
        assert [r.normalized for r in resolved[1][i]] == norm
    if canonical:
        assert [r.canonical for r in resolved[1][i]] == canonical


def test_rejected_and_null_texts(spark):
    df = spark.createDataFrame([("1234",), ("   ",), (None,), ("",), (" ,;- ",)], "collector_text string")
    assert all(r.classification is None for r in classify(df).collect())
    assert resolved_names(df).count() == 0


def test_rules_are_data(spark):
    own = (Rule("numbers", lambda c: c.rlike("[0-9]"), "Empresa", 0.9, ("digits",)), *RULES)
    df = spark.createDataFrame([("Lote 12 Sul",)], "collector_text string")
    assert classify(df, rules=own).first().classification.patterns_matched == ["digits"]


def _atoms(spark, text):
    df = spark.createDataFrame([(text,)], "collector_text string")
    return [(a.text, a.position, a.separator_used) for a in atomize(classify(df)).first().atoms]


def test_atoms(spark):
    assert _atoms(spark, "Silva, J. & R.C. Forzza; Santos, M. et al.") == [("Silva, J. & R.C. Forzza", 0, "none"), ("Santos, M.", 1, ";")]
    assert _atoms(spark, "Keller, J. | Tanaka, M.") == [("Keller, J.", 0, "none"), ("Tanaka, M.", 1, ";")]
    assert _atoms(spark, "Keller, J. & & Tanaka, M.") == [("Keller, J.", 0, "none"), ("Tanaka, M.", 2, "&")]  # places count before empty parts go
    assert _atoms(spark, "J. B. Keller e M. Tanaka") == [("J. B. Keller", 0, "none"), ("M. Tanaka", 1, "&")]
    assert _atoms(spark, "Keller, J., Tanaka, M.") == [("Keller, J.", 0, "none"), ("Tanaka, M.", 1, ";")]


def test_names_fall_back_to_the_whole_text(spark):
    df = spark.createDataFrame([("Forzza, R.C.",)], "collector_text string")
    assert [(r.position, r["name"]) for r in names(atomize(classify(df))).collect()] == [(0, "Forzza, R.C.")]


def test_normalization_says_what_it_did(spark):
    df = spark.createDataFrame([("  ;Silva,J.C. ; ",), ("e  Costa",), ("A\tB",)], "name string")
    rows = [(r.normalized, r.rules_applied) for r in normalize(df).collect()]
    assert rows[0] == ("SILVA, J. C.", ["remove_leading_separators", "remove_trailing_separators", "standardize_punctuation", "uppercase"])
    assert rows[1] == ("COSTA", ["remove_extra_spaces", "uppercase", "remove_leading_conjunction_e"])
    assert rows[2] == ("A\tB", [])  # a lone tab stays
    assert [r[0] for r in df.select(normalized(F.col("name"))).collect()] == [r[0] for r in rows]


def test_title_case_is_that_of_python(spark):
    words = ["D'ÁVILA-COSTA, J.C.", "o'neil 3rd", "ÉMILE ZOLA", "straße", "x", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(titled(F.col("w"))).collect()] == [w.title() for w in words]


def test_types_and_confidences(spark):
    df = spark.createDataFrame([("ConjuntoPessoas", 0.0), ("Empresa", 0.7005), ("Pessoa", 0.854)], "c string, x double")
    assert [tuple(r) for r in df.select(entity_type(F.col("c")), stored_confidence(F.col("x"))).collect()] == [("Pessoa", 0.7), ("Empresa", 0.7), ("Pessoa", 0.85)]
