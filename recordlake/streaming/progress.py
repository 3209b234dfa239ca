"""Progress of unique records while they arrive, right also when batches are repeated."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

METRICS = "unique_progress"
STEP = 200


def observed(rows: DataFrame, is_new: Column) -> DataFrame:
    """``rows`` with a count of the new keys among them, as a metric of every batch."""
    return rows.observe(METRICS, F.count_if(is_new).alias("n_new"), F.count(F.lit(1)).alias("n_rows"))


class UniqueProgress(StreamingQueryListener):
    """Reports at every ``step`` unique rows of an observed stream that starts after this was added.

    Counts are kept per batch: a batch that is repeated after a failure or a restart replaces
    its own count. ``before`` is what earlier runs of the stream have counted. ``report`` gets
    the round number that was passed; every one is reported once.
    """

    def __init__(self, step: int = STEP, report: Callable[[int], None] | None = None, before: int = 0):
        self.step, self.before = step, before
        self.report = report or (lambda n: log.info("unique rows: %d", n))
        self.by_batch: dict[int, int] = {}
        self.reported = before // step
        self.runs: set = set()
        self.ended = threading.Event()
        self._lock = threading.Lock()

    @property
    def total(self) -> int:
        return self.before + sum(self.by_batch.values())

    def count(self, batch: int, n_new: int) -> None:
        with self._lock:
            self.by_batch[batch] = n_new
            passed = self.total // self.step
            while self.reported < passed:
                self.reported += 1
                self.report(self.reported * self.step)

    def onQueryStarted(self, event) -> None:
        # Late events of queries that ran before are not counted.
        self.runs.add(event.runId)
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        metrics = event.progress.observedMetrics.get(METRICS)
        if metrics is not None and event.progress.runId in self.runs:
            self.count(event.progress.batchId, metrics["n_new"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId in self.runs:
            self.ended.set()
