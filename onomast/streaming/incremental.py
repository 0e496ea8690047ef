"""Incremental runs: files arrive, each micro-batch is resolved once and grouped with what is stored; running counts keep keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from onomast.config import Settings
from onomast.operators.ner import Recogniser
from onomast.plans.resolve import take_batch
from onomast.sources.entities import EntityStore
from onomast.sources.progress import Progress, unprocessed
from onomast.sources.records import with_text


def start(spark: SparkSession, records: DataFrame, folder: str, settings: Settings | None = None, recogniser: Callable[[], Recogniser] | None = None) -> StreamingQuery:
    """Resolve every batch of a stream of records into the store in ``folder``; stops when all that is there is done.

    Grouping follows the settings (``exact``, if none are given) and goes on from the stored table, which is the state between
    batches. A record is taken once, and a batch as a whole or not at all (see ``take_batch``): one that is tried again after
    it was stored finds its records done. Batch numbers go on where the last run ended.
    """
    settings = settings or Settings.from_dict({"algorithms": {"clustering": "exact"}})
    store = EntityStore(spark, f"{folder}/entities")
    progress = Progress(spark, f"{folder}/progress", store.batch)

    def one(batch: DataFrame, batch_id: int) -> None:
        todo = unprocessed(with_text(batch), progress.marks()).persist()
        try:
            if todo.limit(1).count():
                take_batch(todo, store, progress, settings, recogniser)
        finally:
            todo.unpersist()

    return records.writeStream.foreachBatch(one).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


class _Counts(StatefulProcessor):
    """How often each normal form was seen, by entity type and name; the state is one number for each."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "name string", "n bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        changed: dict[str, int] = {}
        for b in rows:
            for name, n in b["normalized"].value_counts().items():
                changed[name] = changed.get(name, 0) + int(n)
        for name, n in changed.items():
            before = self.seen.getValue((name,))
            changed[name] = n + (before[0] if before is not None else 0)
            self.seen.updateValue((name,), (changed[name],))
        yield pd.DataFrame({"entityType": key[0], "normalized": list(changed), "n": list(changed.values())})

    def close(self) -> None:
        pass


def running_counts(names: DataFrame) -> DataFrame:
    """For each batch of names the new count of every name in it; needs the RocksDB state store. Hot types are dealt over 64 keys."""
    dealt = names.withColumn("_slot", F.pmod(F.xxhash64("normalized"), F.lit(64)).cast("int"))
    return dealt.groupBy("entityType", "_slot").transformWithStateInPandas(_Counts(), "entityType string, normalized string, n bigint", "Update", "none")
