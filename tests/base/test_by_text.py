"""What is long to work out follows the different texts, and the first rows are found among few."""

from pyspark.sql import functions as F

from onomast.operators.canonical import by_name, exact_entities
from onomast.plans import fixture
from onomast.plans.resolve import arrival_order, by_text, resolved_names, summed
from onomast.sources import records
from onomast.sources.records import first_rows

TEXTS = ["Silva, J. & Costa, M.", "Silva, J.", "?", "410", "Silva, J."]


def test_each_text_is_gone_through_once(spark):
    df = spark.createDataFrame([(str(i), TEXTS[i % 5]) for i in range(50)], "record_id string, collector_text string")
    given = []

    def work(texts):
        given.extend(r.collector_text for r in texts.collect())
        return resolved_names(texts)

    columns = ["record_id", "collector_text", "position", "name", "normalized", "entityType", "confidence", "rules_applied"]
    found = by_text(df, work, "names").select(*columns).collect()
    assert sorted(given) == sorted(set(TEXTS))
    assert sorted(map(tuple, found)) == sorted(map(tuple, resolved_names(df).select(*columns).collect()))


def test_canonical_forms_follow_names(spark):
    """The canonical form, worked out letter by letter, stands behind the grouping of equal names."""
    rows = spark.range(100).select(F.lit("Pessoa").alias("entityType"), F.concat(F.lit("SILVA"), F.col("id") % 3).alias("normalized"), F.lit(0.8).alias("confidence"), F.current_timestamp().alias("seen_at"), F.col("id").cast("string").alias("order"))
    names = by_name(rows)
    assert names.count() == 3 and "canonicalName" in names.columns
    assert "canonicalName" not in names._jdf.queryExecution().analyzed().toString().split("Aggregate", 1)[1]
    assert exact_entities(rows).count() == 3


def test_rows_far_behind_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(records, "_DRAWN", 200)
    df = spark.range(20_000).select(F.lpad(((F.col("id") * 7919) % 20_000).cast("string"), 6, "0").alias("order"), "id")
    for n in (1, 50, 400):
        near = records._beginning(df, n, "order", "id")
        assert n <= near.count() < 10_000
        assert sorted(int(r.order) for r in first_rows(df, n, "order", "id").collect()) == list(range(n))


def test_records_are_gone_through_once(spark):
    """Records summed up by their text give the entities of all records, and of each half; parts give their words once."""
    df = spark.range(60).select(F.col("id").cast("string").alias("record_id"), F.element_at(F.array(*map(F.lit, TEXTS)), (F.col("id") % 5 + 1).cast("int")).alias("collector_text"), F.col("id").alias("arrival"), F.timestamp_seconds(F.col("id") * 7919 % 60).alias("seen_at"))
    df = df.withColumn("half", F.col("arrival") % 2).withColumn("order", arrival_order(F.col("arrival")))
    few = summed(df, "half")
    assert few.count() == 8 and few.agg(F.sum("n")).first()[0] == 60  # four different texts of either half
    for rows in ((df, few), (df.where("half = 1"), few.where("half = 1"))):
        made = [sorted(map(str, exact_entities(by_text(x, resolved_names, "names")).collect())) for x in rows]
        assert made[0] == made[1] and made[0]


def test_words_follow_parts(spark):
    plan = fixture.records(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    for join in plan.split("Join Inner")[:2]:
        assert "split_part" not in join
    got = fixture.records(spark, "/root/testdata/sf0.001").select("record_id", "collector", "recordedBy")
    path = "parquet.`/root/testdata/sf0.001/{}.parquet`"
    want = spark.sql(fixture.records_sql(path.format("lineitem"), path.format("part"))).select("record_id", "collector", "recordedBy")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
