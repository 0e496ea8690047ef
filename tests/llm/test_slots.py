"""Slots are judged by stretch and text; windows copied with their values count whatever stands elsewhere."""

from onomast.llm import decontaminate

PLAIN = "so that nobody in the old village would ever have to walk down to the river again before winter comes"
ITEM = f"one day the farmer Robert went to market and {PLAIN} while the good farmer Robert sold his apples there"


def _found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r for r in decontaminate.contaminated(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string")).collect()}


def test_copied_windows_outlive_a_conflict(spark):
    found = _found(spark, [(1, ITEM.replace("Robert sold", "Alice sold")), (2, ITEM)])
    assert set(found) == {1, 2} and 0 < found[1].windows < found[2].windows


def test_texts_do_not_veto_each_other(spark):
    words = "the farmer Robert sold his apples at the market there"
    docs = spark.createDataFrame([(None, words.replace("Robert", n)) for n in ("Alice", "Susan")], "doc_id long, text string")
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    assert [(r.doc_id, r.item_ids) for r in decontaminate.contaminated(docs, items).collect()] == [(None, [1])]
