import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from onomast.config import Settings
from onomast.functions.similarity import similarity_value
from onomast.operators.canonical import exact_entities
from onomast.operators.cluster import canonical_value, graph_entities, leader_entities
from onomast.plans.resolve import run
from onomast.scratch import stored
from onomast.sources.entities import EntityStore, merged, variations_from_json, variations_json
from onomast.sources.progress import Progress
from onomast.sources.report import report_lines, write_report

T0 = dt.datetime(2020, 1, 1)


def names_of(spark, rows):
    return spark.createDataFrame([(kind, name, 0.8, f"{i:06}", 0, T0 + dt.timedelta(days=i)) for i, (kind, name) in enumerate(rows)], "entityType string, normalized string, confidence double, order string, position int, seen_at timestamp")


def plain_leader(rows, threshold=0.70):
    """The grouping by its definition: every name against every entity."""
    entities = []
    for kind, name in rows:
        best = None
        same = [e for e in entities if e["kind"] == kind and e["name"].upper() == name.upper()]
        if same:
            best = (1.0, same[0])
        else:
            for e in entities:
                if e["kind"] == kind and (s := similarity_value(name.upper(), e["name"].upper())) >= threshold and (best is None or s > best[0]):
                    best = (s, e)
        if best is None:
            entities.append({"kind": kind, "name": canonical_value(name, kind), "v": {name.upper(): [name, 1]}})
            continue
        e = best[1]
        e["v"].setdefault(name.upper(), [name, 0])[1] += 1
        if kind == "Pessoa" and len(name.split()) > len(e["name"].split()):
            e["name"] = canonical_value(name, kind)
    return sorted((e["kind"], e["name"], tuple(map(tuple, e["v"].values()))) for e in entities)


def test_leader_equals_its_definition(spark):
    import random

    r = random.Random(3)
    pool = ["SILVA, J.", "SILVA, J. C.", "SILVA, M.", "SYLVA, J.", "FORZZA, R.", "FORZZA, R. C.", "FORZA, R.", "COSTA", "COSTA, A. B.", "J. SILVA", "J. C. SILVA", "EMBRAPA", "EMBRAPAS"]
    rows = [(r.choice(["Pessoa", "Empresa"]), r.choice(pool)) for _ in range(200)]
    found = leader_entities(names_of(spark, rows)).collect()
    got = sorted((e.entityType, e.canonicalName, tuple((v.variation_text, v.occurrence_count) for v in e.variations)) for e in found)
    assert got == plain_leader(rows)
    assert sorted(e.id for e in found) == list(range(1, len(found) + 1))


def test_graph_does_not_depend_on_order(spark):
    rows = [("Pessoa", n) for n in ["SILVA, J.", "SILVA, M.", "SILVA, J.", "COSTA", "SYLVA, J.", "ZANONI, T."]]
    groups = lambda rows: {frozenset(v.variation_text for v in e.variations) for e in graph_entities(names_of(spark, rows)).collect()}
    assert groups(rows) == groups(rows[::-1])
    assert any({"SILVA, J.", "SILVA, M."} <= g for g in groups(rows))


def test_store_upsert_and_consolidate(spark, tmp_path):
    store = EntityStore(spark, f"file://{tmp_path}/entities")
    assert store.all().count() == 0
    first = names_of(spark, [("Pessoa", "SILVA, J."), ("Pessoa", "SILVA, J."), ("Empresa", "USP")])
    store.upsert(exact_entities(first))
    store.upsert(exact_entities(names_of(spark, [("Pessoa", "SILVA, J."), ("Pessoa", "COSTA")])))
    rows = {(e.canonicalName, e.entityType): e for e in store.all().collect()}
    assert rows["Silva, J.", "Pessoa"].variations[0].occurrence_count == 3
    assert sorted(e.id for e in rows.values()) == [1, 2, 3] and rows["Costa", "Pessoa"].id == 3
    assert store.of_type("Empresa").count() == 1 and store.by_name("SILVA, J.", "Pessoa").first().id == rows["Silva, J.", "Pessoa"].id
    twice = store.all().unionByName(store.all().withColumn("id", F.col("id") + 10))
    store.replace(twice)
    assert store.consolidate() == 3 and store.consolidate() == 0
    assert {e.canonicalName: e.variations[0].occurrence_count for e in store.all().collect()} == {"Silva, J.": 6, "Usp": 2, "Costa": 2}
    with pytest.raises(Exception, match="unsound entity"):
        store.replace(store.all().withColumn("classification_confidence", F.lit(0.2)))
    assert store.all().count() == 3  # the old table stands


def test_json_and_report(spark, tmp_path):
    e = exact_entities(names_of(spark, [("Pessoa", "SILVA, J."), ("Pessoa", "ÁVILA"), ("Pessoa", "SILVA, J.")]))
    back = e.withColumn("v", variations_from_json(variations_json(F.col("variations")))).select("variations", "v").collect()
    assert all(r.variations == r.v for r in back)
    assert [r.value for r in report_lines(e).collect()] == ["Silva, J.\tPessoa\tSILVA, J.\t2", "Ávila\tPessoa\tÁVILA\t1"]
    write_report(e, f"file://{tmp_path}/report", deduplicated=True)
    assert spark.read.text(f"file://{tmp_path}/report").first().value == "canonicalName\tentityType\tvariations\toccurrenceCounts"
    with pytest.raises(Exception, match="no tab"):
        report_lines(e.withColumn("canonicalName", F.lit("a\tb"))).collect()


def test_ledger(spark, tmp_path):
    p = Progress(spark, f"file://{tmp_path}/progress")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "record_id string")
    assert (p.total(), p.latest_batch(), p.value("run")) == (0, 0, None)
    p.mark(ids("a", "b", "b"), 1)
    p.mark(ids("b", "c"), 2)
    p.mark(ids(), 3)
    assert (p.total(), p.latest_batch(), p.count_of_batch(1), p.count_of_batch(2)) == (3, 2, 2, 1)
    assert p.is_processed("a") and not p.is_processed("z")
    p.set_value("run", "x")
    p.set_value("run", "y")
    assert p.value("run") == "y"
    p.reset()
    assert (p.total(), p.value("run")) == (0, None)


@pytest.mark.parametrize("clustering", ["exact", "leader", "graph"])
def test_whole_run_and_resume(spark, tmp_path, clustering):
    rows = [("1", "Plantae", "Forzza, R.C.", None), ("2", "Plantae", "", "Silva, J. & Costa, M."), ("3", "Fungi", "USP", None), ("4", "Plantae", "1234", None), ("5", "Plantae", None, None), ("6", "Plantae", "EMBRAPA", None)]
    spark.createDataFrame(rows, "record_id string, kingdom string, collector string, recordedBy string").write.parquet(f"file://{tmp_path}/in")
    settings = Settings.from_dict({"source": {"path": f"file://{tmp_path}/in"}, "store": {"path": f"file://{tmp_path}/out"}, "output": {"report_path": f"file://{tmp_path}/report"}, "algorithms": {"clustering": clustering}})
    first = run(spark, settings)
    assert (first.processed, first.rejected, first.skipped, first.entities) == (3, 1, 0, 4)
    settings.processing.resume = True
    again = run(spark, settings)
    assert (again.processed, again.skipped, again.entities) == (0, 3, 4)


def test_settings_are_checked():
    assert Settings.from_dict(None).algorithms.similarity_threshold == 0.70
    with pytest.raises(ValueError, match="unknown settings"):
        Settings.from_dict({"algorithms": {"typo": 1}})


def _files(path):
    return {f"{d}/{n}": os.path.getsize(f"{d}/{n}") for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_changes_are_written_without_the_table(spark, tmp_path):
    store = EntityStore(spark, f"file://{tmp_path}/entities", changes=3)
    table = stored(exact_entities(names_of(spark, [("Pessoa", f"SILVA{i % 2000:05}, J.") for i in range(2000)])), "table")
    store.change_to(table, 1)
    whole = sum(_files(f"{tmp_path}/entities").values())
    for k in range(2, 5):
        before = _files(f"{tmp_path}/entities")
        table = stored(merged(store.all(), exact_entities(names_of(spark, [("Pessoa", "SILVA00007, J."), ("Empresa", f"FIRM {k}")]))), "table")
        store.change_to(table, k)
        new = sum(n for f, n in _files(f"{tmp_path}/entities").items() if f not in before)
        assert new < whole / 5  # two entities, not two thousand
        assert sorted(map(repr, store.all().collect())) == sorted(map(repr, table.collect())) and store.batch() == k
    assert store.versions() == [1, 2, 3, 4]
    found = {e.canonicalName: e for e in store.all().collect()}
    assert len(found) == 2003 and found["Silva00007, J."].variations[0].occurrence_count == 4
    assert store.of_type("Empresa").count() == 3 and store.by_name("SILVA00007, J.", "Pessoa").first().id == found["Silva00007, J."].id
    # a change that was not written whole is not there
    os.makedirs(f"{tmp_path}/entities/v5-b5-changes")
    assert store.batch() == 4 and store.all().count() == 2003
    # an entity that goes, and many changes, make a whole table; what no table needs is deleted
    store.change_to(stored(table.where("entityType = 'Pessoa'"), "table"), 6)
    assert store.all().count() == 2000 and store._current() == ["v5-b6"]
    store.replace(table, 7)
    assert store.versions() == [5, 6] and store.all().count() == 2003
