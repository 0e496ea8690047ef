import time

from pyspark.sql import functions as F

from onomast.plans.resolve import resolved_names
from onomast.sources.entities import EntityStore
from onomast.sources.progress import Progress
from onomast.sources.records import stream_records, with_text
from onomast.streaming.incremental import running_counts, start
from onomast.streaming.metrics import Metrics, Watch

SCHEMA = "record_id string, kingdom string, collector string, recordedBy string, order string, seen_at timestamp"


def _write(spark, path, rows):
    df = spark.createDataFrame([(i, "Plantae", c, None, i) for i, c in rows], "record_id string, kingdom string, collector string, recordedBy string, order string")
    df.withColumn("seen_at", F.lit("2020-01-01").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def test_incremental_runs(spark, tmp_path):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    _write(spark, source, [("1", "Forzza, R.C."), ("2", "USP")])
    stream = lambda: stream_records(spark, source, SCHEMA, equals={"kingdom": "Plantae"})
    start(spark, stream(), out).awaitTermination()
    _write(spark, source, [("2", "USP"), ("3", "Forzza, R.C.")])
    start(spark, stream(), out).awaitTermination()
    counts = {e.canonicalName: e.variations[0].occurrence_count for e in EntityStore(spark, f"{out}/entities").all().collect()}
    assert counts == {"Forzza, R. C.": 2, "Usp": 1}  # record 2 came twice and counts once
    assert Progress(spark, f"{out}/progress").latest_batch() == 2


def test_running_counts(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    _write(spark, source, [("1", "USP"), ("2", "USP")])
    _write(spark, source, [("3", "USP"), ("4", "EMBRAPA")])
    counted = running_counts(resolved_names(with_text(stream_records(spark, source, SCHEMA))))
    q = counted.writeStream.format("memory").queryName("counted").outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    best = {r.normalized: r.n for r in spark.sql("select normalized, max(n) n from counted group by 1").collect()}
    assert best == {"USP": 3, "EMBRAPA": 1}


def test_metrics_of_a_stream(spark, tmp_path):
    source, out, watch = f"file://{tmp_path}/in", f"file://{tmp_path}/out", Watch(total=10)
    _write(spark, source, [("1", "Forzza, R.C."), ("2", "USP")])
    _write(spark, source, [("3", "EMBRAPA")])
    spark.streams.addListener(watch)
    try:
        start(spark, stream_records(spark, source, SCHEMA), out).awaitTermination()
        until = time.time() + 20
        while watch.metrics().processed < 3 and time.time() < until:  # reports come a little later
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(watch)
    found = watch.metrics()
    assert (found.total, found.processed, watch.failed) == (10, 3, None) and found.seconds > 0
    assert abs(found.remaining_seconds - 7 / found.per_second) < 1e-9 and not found.on_track


def test_rates():
    assert (Metrics(100, 50, 0.1).per_second, Metrics(100, 50, 0.1).remaining_seconds, Metrics(100, 50, 0.1).on_track) == (500.0, 0.1, True)
    assert Metrics(None, 5, 1.0).remaining_seconds is None and Metrics(9, 0, 0.0).remaining_seconds is None and Metrics(3, 5, 1.0).remaining_seconds == 0
