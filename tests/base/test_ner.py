import datetime as dt
import re

from onomast.config import Settings
from onomast.operators import tagger
from onomast.operators.classify import classify
from onomast.operators.ner import recognised, recogniser, refine
from onomast.plans.resolve import run
from onomast.schema import ENTITY
from onomast.sources.entities import EntityStore, sound_entities
from onomast.sources.records import first_rows


def test_refine(spark):
    def recogniser():
        """Marks words: Xavier and Yara are people (scores by word), Vale is a firm."""
        known = {"Xavier": ("PER", 0.9), "Yara": ("PESSOA", 0.6), "Vale": ("ORG", 0.8), "Duvida": ("PER", 0.3)}

        def one(text):
            out, at = [], 0
            for w in text.split(" "):
                if w in known:
                    out.append({"text": w, "label": known[w][0], "score": known[w][1], "start": at, "end": at + len(w)})
                at += len(w) + 1
            return out

        return lambda texts: [one(t) for t in texts]

    texts = ["o senhor Xavier coletou", "casa Vale norte", "nada de nada", "talvez Duvida sim", "Forzza, R.C.", None]
    df = spark.createDataFrame([(t,) for t in texts], "collector_text string")
    rows = [r.classification for r in refine(classify(df), recogniser).collect()]
    assert (rows[0].category, rows[0].sanitized_text, rows[0].confidence, rows[0].patterns_matched[1:]) == ("Pessoa", "Xavier", 0.85, ["ner_fallback", "ner_person_detected"])
    assert (rows[1].category, rows[1].confidence, rows[1].patterns_matched[1:]) == ("Empresa", 0.75, ["ner_fallback", "ner_org_detected"])
    assert (rows[2].category, round(rows[2].confidence, 2)) == ("Pessoa", 0.65)
    assert (rows[3].category, rows[3].confidence, rows[3].patterns_matched[-1]) == ("NaoDeterminado", 0.0, "ner_discard")
    assert rows[4].patterns_matched == ["surname_initials_format"] and rows[5] is None


def fussy_one():
    """Knows every text but those that speak of fire, and gives a span out of bounds for those of water."""

    def make():
        def work(texts):
            if any("fogo" in t for t in texts):
                raise RuntimeError("too hot")
            return [[{"text": t, "label": "PER", "score": 0.9, "start": 0, "end": 999 if "agua" in t else len(t)}] for t in texts]

        return work

    return make


def test_a_text_that_fails_fails_alone():
    texts = [f"nome {i}" for i in range(50)] + ["o fogo", "a agua"] + [f"nome {i}" for i in range(50)]
    found = recognised(fussy_one()(), texts)
    assert [i for i, (spans, _) in enumerate(found) if spans is None] == [50, 51]
    assert found[50][1] == "RuntimeError: too hot" and found[51][1].startswith("ValueError: unsound span 0-999")
    assert all(s[0]["end"] == len(t) for (s, _), t in zip(found, texts, strict=True) if s)


def test_failing_records_are_rejected_and_others_stored(spark, tmp_path):
    rows = [("1", "Plantae", "algum nome qualquer"), ("2", "Plantae", "perto do fogo alto"), ("3", "Plantae", "dentro da agua fria"), ("4", "Plantae", "Silva, J."), ("5", "Plantae", "1234")]
    spark.createDataFrame(rows, "record_id string, kingdom string, collector string").write.parquet(f"file://{tmp_path}/in")
    settings = Settings.from_dict({"source": {"path": f"file://{tmp_path}/in"}, "store": {"path": f"file://{tmp_path}/out"}, "output": {"report_path": ""}, "algorithms": {"clustering": "exact"}})
    done = run(spark, settings, fussy_one())
    assert (done.processed, done.rejected, done.recognised) == (2, 3, 3)
    why = {r.record_id: r.reason for r in spark.read.parquet(f"file://{tmp_path}/out/entities-rejects/b1").collect()}
    assert why["5"] == "nothing is left of the text" and why["2"] == "RuntimeError: too hot" and why["3"].startswith("ValueError")
    store = EntityStore(spark, f"file://{tmp_path}/out/entities")
    assert {e.canonicalName for e in store.all().collect()} == {"Algum Nome Qualquer", "Silva, J."}
    settings.processing.resume = True
    assert run(spark, settings, fussy_one()).processed == 0  # what was stored is marked, what failed is tried again
    again = run(spark, settings)
    assert (again.processed, again.rejected) == (2, 1)


def test_unsound_entities_go_alone(spark):
    at = dt.datetime(2020, 1, 1)
    v = lambda text, n, c: (text, n, c, at, at)
    rows = [(1, "Good", "Pessoa", 0.8, 1.0, [v("GOOD", 1, 1.0)], at, at), (2, "Half", "Pessoa", 0.8, 1.0, [v("HALF", 1, 1.0), v("HALV", 1, 0.5)], at, at), (3, "Bad", "Pessoa", 0.2, 1.0, [v("BAD", 1, 1.0)], at, at), (4, "None", "Nothing", 0.8, 1.0, [v("NONE", 0, 1.0)], at, at)]
    good, gone = sound_entities(spark.createDataFrame(rows, ENTITY))
    assert {(e.canonicalName, len(e.variations)) for e in good.collect()} == {("Good", 1), ("Half", 1)}
    assert {r.canonicalName: r.reason for r in gone.collect()} == {"Half": "without unsound variations", "Bad": "unsound classification_confidence", "None": "unsound entityType, variations"}


def test_first_rows(spark):
    df = spark.range(1000).selectExpr("cast(id * 7919 % 1000 AS string) AS order", "id").repartition(7)
    for n in (0, 1, 137, 1000, 5000):
        assert sorted(r.order for r in first_rows(df, n, "order", "id").collect()) == sorted(str(i) for i in range(1000))[:n]


#: Written by hand and not looked at while the maker of lines was written.
LINES = """
[Warming|PER]|[Museu Nacional|ORG]|[Ule, E.|PER]|coll. [Regnell|PER] 1234|[Universidade de São Paulo|ORG]|beira de riacho|[Loefgren, A.|PER] & [Edwall, G.|PER]|[Instituto Agronômico de Campinas|ORG]
[Maria Lúcia Kawasaki|PER]|planta sem flores|[CEPEC|ORG]|[H. S. Irwin|PER]|Parque Nacional do Itatiaia|[Jardim Botânico de Porto Alegre|ORG]|det. [Sandra Knapp|PER]|[Field Museum of Natural History|ORG]
[A. Ducke|PER] e [J. M. Pires|PER]|solo pedregoso e seco|coletado por [Antônio Carlos Brade|PER]|[Royal Botanic Gardens|ORG]|[Spruce|PER]|[Fundação Zoobotânica|ORG]|[Guilherme Gazzola|PER]|estrada de terra|[Gardner, G.|PER]|[Secretaria do Meio Ambiente|ORG]
"""


def held_out_lines():
    for part in LINES.strip().replace("\n", "|").replace("|PER]", "#PER]").replace("|ORG]", "#ORG]").split("|"):
        text, spans, at = "", [], 0
        for m in re.finditer(r"\[(.*?)#(\w+)\]", part):
            text += part[at : m.start()]
            spans.append((len(text), len(text) + len(m[1]), m[2]))
            text, at = text + m[1], m.end()
        yield text + part[at:], spans


def span_f1(tagger, lines):
    right = wrong = missed = 0
    for text, spans in lines:
        found = {s[:3] for s in tagger.spans(text)}
        right, wrong, missed = right + len(found & set(spans)), wrong + len(found - set(spans)), missed + len(set(spans) - found)
    return 2 * right / (2 * right + wrong + missed)


def test_the_own_recogniser_finds_spans():
    t = tagger.trained()
    assert len(list(held_out_lines())) == 26
    assert span_f1(t, tagger.made_lines(500, 1000)) > 0.95
    assert span_f1(t, held_out_lines()) > 0.85
    for e in t.entities("coletado por João Batista da Silva e R. M. Harley"):
        assert e["label"] == "PER" and 0.5 < e["score"] <= 1
    assert t.entities("") == [] and t.entities(" 12 ") == []
    assert t.spans("x" * 5000) is not None


def test_the_own_recogniser_is_the_default(spark):
    make = recogniser("any key")
    df = spark.createDataFrame([("coletado por João Batista da Silva",), ("Universidade Federal de Viçosa",)], "collector_text string")
    found = refine(classify(df), make).collect()
    assert recogniser(None) is None and all(r.problem is None for r in found)
    assert found[0].classification.sanitized_text == "João Batista da Silva" or "ner_fallback" not in found[0].classification.patterns_matched
