"""The stages one after the other, held against plain decisions."""

import os

import pytest

import corpus_pipeline
from onomast.llm import secrets

SF = "/root/testdata/sf0.001"


def word_sets(text, k=5):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [{r.doc_id: r for r in docs.collect()}]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "decontamination", "secret_scan", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        kept.append({r.doc_id: r for r in docs.collect()})
    start, known, single, clean, plain = kept
    assert set(known) >= {i for i, r in start.items() if r.text and len(r.text) > 200}  # nothing but odd texts goes
    sets = {i: word_sets(r.text) for i, r in known.items()}
    near = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    assert all(not near(a, b) for a in single for b in single if a < b)
    assert all(any(near(i, j) for j in known if j != i) for i in known if i not in single)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {i for i, r in single.items() if any(t in r.text for t in items)}
    assert held and held == set(single) - set(clean)
    assert set(plain) == set(clean)
    assert all(not secrets.base_spans(r.text) for r in plain.values())
    last = corpus_pipeline.packed(spark, docs, SF).collect()
    assert {r.doc_id for r in last} == set(plain)
    assert sum(r.length for r in last if r.doc_id is not None) == sum({r.doc_id: r.doc_tokens for r in last}.values())


LINE = "the quick brown fox jumps over a lazy dog and then goes home to sleep for the night under old trees "
ROW = "doc_id long, text string, lang string, source string, n_chars long, _node string, node int, row int, label string, words int, hash long"


def _odd_docs(spark):
    """Nulls in any column, rows and ids that repeat, empty and long texts, and columns with names that operators use."""
    import random

    r = random.Random(1)
    one = {"en": "the of and to in is that for it was on as with by".split(), "de": "der die und in den von zu das mit sich des auf".split()}
    text = lambda lang, n=40: " ".join(r.choice(one[lang]) + r.choice(one[lang]) for _ in range(n))
    rows = [(i, text(lang), lang, "s", 0) for i in range(60) for lang in [("en", "de")[i % 2]]]
    rows += [(None, text("en"), "en", None, None), (None, text("de"), None, "s", 1), (None, None, None, None, None), (100, None, "en", "s", 0), (101, "", "de", "s", 0), (102, "12 ...", "en", "s", 0)]
    rows += [rows[4], rows[4], (4, text("en"), "en", "s", 3), (103, rows[6][1], "en", "s", 0), (104, rows[8][1].upper(), "en", "s", 0)]
    rows += [(105, text("de") + " " + LINE + text("de"), "de", "s", 0), (None, LINE * 2, "en", "s", 0), (106, text("en", 60_000), "en", "s", 0), (107, text("en") + " token = abcdef123456 end", "en", "s", 0)]
    return spark.createDataFrame([(*x, "n", 1, 2, "l", 3, 4) for x in rows], ROW)


@pytest.fixture
def sf_dir(spark, tmp_path):
    spark.createDataFrame([(1, LINE), (2, None), (3, "")], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    return f"file://{tmp_path}"


def test_stages_on_odd_rows(spark, sf_dir):
    docs = corpus_pipeline.stored(_odd_docs(spark), "odd")
    columns, held = docs.columns, [sorted(map(tuple, docs.collect()), key=repr)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns
        held.append(sorted(map(tuple, docs.collect()), key=repr))
    start, known, single, clean, plain = held
    assert [x for x in start if x not in known] == [x for x in start if x[0] in (100, 101, 102) or (x[0] is None and not x[1])]
    gone = list(known)
    for x in single:
        gone.remove(x)
    assert sorted((x[0], x[1]) for x in gone) == sorted([(4, next(x[1] for x in known if x[0] == 4 and known.count(x) == 3))] * 2 + [(103, next(x[1] for x in known if x[0] == 6)), (104, next(x[1] for x in known if x[0] == 104))])
    assert [x for x in single if x not in clean] == [x for x in single if LINE.strip() in x[1]] and sum(x[0] is None for x in clean) == 2
    assert [x[0] for x in clean] == [x[0] for x in plain]
    masked = next(x for x in plain if x[0] == 107)
    assert "[SECRET]" in masked[1] and "abcdef123456" not in masked[1] and masked[4] == len(masked[1])
    last = corpus_pipeline.packed(spark, docs, sf_dir).collect()
    assert {x.doc_id for x in last} == {x[0] for x in plain}


def test_stages_on_empty_tables(spark, sf_dir):
    docs = _odd_docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
