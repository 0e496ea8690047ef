"""How a run is getting on, while it runs: Spark's own progress of a stream's batches, added up."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQueryListener

#: Records a second by which all of a large herbarium is done in six hours (a fixed value).
TARGET = 213.0


@dataclass(frozen=True)
class Metrics:
    """Records in all (None where unknown), records done, and the seconds that took."""

    total: int | None
    processed: int
    seconds: float

    @property
    def per_second(self) -> float:
        return self.processed / self.seconds if self.seconds > 0 else 0.0

    @property
    def remaining_seconds(self) -> float | None:
        """At the rate so far; None where the total is not known or nothing is done yet."""
        if self.total is None or not self.per_second:
            return None
        return max(0, self.total - self.processed) / self.per_second

    @property
    def on_track(self) -> bool:
        return self.per_second >= TARGET


class Watch(StreamingQueryListener):
    """Adds up the batches of the streams of a session: ``spark.streams.addListener(Watch(total))``.

    Nothing is counted anew for it: rows and durations are those that Spark reports at the end of each batch. With ``name`` only the
    queries of that name count. A batch that is run again after a failure counts once, with its last report.
    """

    def __init__(self, total: int | None = None, name: str | None = None):
        self.total, self.name = total, name
        self._batches: dict[tuple[str, int], tuple[int, float]] = {}
        self._lock = threading.Lock()
        self.failed: str | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.name in (None, p.name):
            with self._lock:
                self._batches[str(p.id), p.batchId] = (p.numInputRows, p.batchDuration / 1000)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed = event.exception

    def metrics(self) -> Metrics:
        with self._lock:
            done = list(self._batches.values())
        return Metrics(self.total, sum(n for n, _ in done), sum(s for _, s in done))
