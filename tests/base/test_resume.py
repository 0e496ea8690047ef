"""Runs that follow one another, and runs that break off."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from onomast.__main__ import main
from onomast.config import Settings
from onomast.operators import ner
from onomast.operators.cluster import graph_entities, leader_entities
from onomast.plans.resolve import run
from onomast.sources.entities import EntityStore
from onomast.sources.progress import Progress
from onomast.sources.records import stream_records
from onomast.streaming.incremental import start

RECORD = "record_id string, kingdom string, collector string, recordedBy string, order string, seen_at timestamp"
T0 = dt.datetime(2020, 1, 1)


def names_of(spark, names, first=0):
    return spark.createDataFrame([("Pessoa", n, 0.8, f"{first + i:06}", 0, T0 + dt.timedelta(days=first + i)) for i, n in enumerate(names)], "entityType string, normalized string, confidence double, order string, position int, seen_at timestamp")


def table(df):
    return sorted((e.id, e.canonicalName, e.classification_confidence, tuple(map(tuple, e.variations)), e.created_at, e.updated_at) for e in df.collect())


def groups(df):
    return sorted((e.canonicalName, tuple(sorted((v.variation_text, v.occurrence_count) for v in e.variations))) for e in df.collect())


NAMES = ["SILVA, J.", "SILVA, M.", "COSTA, A. B. C. D.", "A. B. C. D. SILVA", "SYLVA, J.", "ZANONI, T.", "A. B. C. D. SYLVA", "SILVA, J. P.", "ZANONY, T.", "SILVA, J.", "KOSTA, A. B. C. D."]


def test_initials_apart_are_one_entity(spark):
    found = leader_entities(names_of(spark, ["SILVA, J.", "SILVA, M."])).collect()
    assert [[v.variation_text for v in e.variations] for e in found] == [["SILVA, J.", "SILVA, M."]]
    assert found[0].variations[1].association_confidence == pytest.approx(0.7378, abs=1e-3)


@pytest.mark.parametrize("cut", [1, 4, 9])
def test_leaders_go_on_from_a_table(spark, cut):
    whole = leader_entities(names_of(spark, NAMES))
    part = leader_entities(names_of(spark, NAMES[:cut]))
    assert table(leader_entities(names_of(spark, NAMES[cut:], cut), known=part)) == table(whole)


@pytest.mark.parametrize("cut", [1, 4, 9])
def test_graph_goes_on_from_a_table(spark, cut):
    whole = graph_entities(names_of(spark, NAMES))
    part = graph_entities(names_of(spark, NAMES[:cut]))
    again = graph_entities(names_of(spark, NAMES[cut:], cut), known=part)
    assert groups(again) == groups(whole)
    ids = [e.id for e in again.collect()]
    assert len(set(ids)) == len(ids) and {e.id for e in part.collect()} & set(ids)


def _write(spark, path, texts, first=0):
    rows = [(f"{first + i:04}", "Plantae", t, None, f"{first + i:04}", T0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(path)


TEXTS = ["A. B. C. D. Silva", "Silva, J.", "1234", "A. B. C. D. Sylva", "Silva, M.", "EMBRAPA"]


def settings_for(path, clustering):
    return Settings.from_dict({"source": {"path": f"file://{path}/in"}, "store": {"path": f"file://{path}/out"}, "output": {"report_path": ""}, "algorithms": {"clustering": clustering}, "processing": {"resume": True}})


@pytest.mark.parametrize("clustering", ["leader", "graph"])
def test_two_runs_equal_one(spark, tmp_path, clustering):
    one, two = tmp_path / "one", tmp_path / "two"
    _write(spark, f"file://{one}/in", TEXTS)
    run(spark, settings_for(one, clustering))
    _write(spark, f"file://{two}/in", TEXTS[:3])
    first = run(spark, settings_for(two, clustering))
    assert (first.processed, first.rejected, first.skipped, first.total) == (2, 1, 0, 3) and first.seconds > 0
    _write(spark, f"file://{two}/in", TEXTS[3:], 3)
    second = run(spark, settings_for(two, clustering))
    assert (second.processed, second.rejected, second.skipped) == (3, 1, 2)
    stores = [EntityStore(spark, f"file://{p}/out/entities") for p in (one, two)]
    assert groups(stores[0].all()) == groups(stores[1].all()) and stores[1].batch() == 2
    assert [r.collector for r in spark.read.parquet(f"file://{two}/out/entities-rejects/b1").collect()] == ["1234"]


def test_a_run_that_breaks_off_adds_nothing(spark, tmp_path, monkeypatch):
    _write(spark, f"file://{tmp_path}/in", TEXTS)
    settings = settings_for(tmp_path, "exact")

    def fails(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(EntityStore, "replace", fails)  # after the ledger, before the table
        with pytest.raises(RuntimeError, match="gone"):
            run(spark, settings)
    store = EntityStore(spark, f"file://{tmp_path}/out/entities")
    ledger = Progress(spark, f"file://{tmp_path}/out/progress", store.batch)
    assert (store.batch(), ledger.total()) == (0, 0)
    assert run(spark, settings).processed == 5 and ledger.total() == 5
    assert run(spark, settings).processed == 0
    assert all(v.occurrence_count == 1 for e in store.all().collect() for v in e.variations)


def test_streams_group_with_what_is_stored(spark, tmp_path):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for i, t in enumerate(TEXTS):
        _write(spark, source, [t], i)  # a file, so a batch, for each
    settings = Settings.from_dict({"algorithms": {"clustering": "leader"}})
    start(spark, stream_records(spark, source, RECORD), out, settings).awaitTermination()
    whole = tmp_path / "whole"
    _write(spark, f"file://{whole}/in", TEXTS)
    run(spark, settings_for(whole, "leader"))
    assert groups(EntityStore(spark, f"{out}/entities").all()) == groups(EntityStore(spark, f"file://{whole}/out/entities").all())


def test_command_line_and_recognisers(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(ner, "_MODELS", {})
    assert ner.recogniser("any") is not None and ner.recogniser(None) is None  # the own one, where none is registered
    made = lambda: lambda texts: [[{"text": t, "label": "PER", "score": 0.9, "start": 0, "end": len(t)}] for t in texts]
    ner.register("first", made)
    ner.register("second", lambda: made())
    assert ner.recogniser("unknown") is made and ner.recogniser("second") is not made
    _write(spark, f"file://{tmp_path}/in", ["Silva", "Maria Costa", "1234", "USP", "Silva, J."])
    config = tmp_path / "settings.json"
    config.write_text(json.dumps({"source": {"path": f"file://{tmp_path}/in"}, "store": {"path": f"file://{tmp_path}/out"}, "output": {"report_path": f"file://{tmp_path}/report"}, "processing": {"recogniser": "first"}}))
    monkeypatch.setattr(spark, "stop", lambda: None)
    summary = main(["--config", str(config), "--max-records", "3"])
    assert (summary.processed, summary.rejected, summary.recognised) == (3, 1, 1)
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["total"] == 4
    again = main(["--config", str(config), "--continue"])
    assert (again.processed, again.skipped) == (1, 3)
    assert spark.read.text(f"file://{tmp_path}/report").where(F.col("value").startswith("canonicalName")).count() == 1
