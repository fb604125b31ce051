"""A ledger of rows that streams dropped as late.

A query's own progress reports reach back a hundred batches. The ledger listens to all
queries of a session and keeps one number per batch that dropped anything.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_LEDGERS: dict[str, LateRows] = {}


class LateRows(StreamingQueryListener):
    """Dropped rows by query, run and batch."""

    def __init__(self) -> None:
        self._news = threading.Condition()
        self._dropped: dict[tuple[str, str, int], int] = {}
        self._batches: dict[str, int] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        with self._news:
            self._batches[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        with self._news:
            self._batches[str(progress.runId)] = self._batches.get(str(progress.runId), 0) + 1
            if rows:
                self._dropped[str(progress.id), str(progress.runId), progress.batchId] = rows
            self._news.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def _settle(self, query: StreamingQuery, timeout_s: float) -> None:
        """Events come after the fact: wait for the last one of a query that has ended."""
        if query.isActive:
            return
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, timeout_s):
                raise RuntimeError("the end of the query was not reported; its late rows are unknown")

    def total(self, query: StreamingQuery, timeout_s: float = 60) -> int:
        """Rows dropped by this run of the query, of however many batches."""
        self._settle(query, timeout_s)
        with self._news:
            return sum(n for (_, run, _), n in self._dropped.items() if run == str(query.runId))

    def batches(self, query: StreamingQuery, timeout_s: float = 60) -> int:
        """Batches this run has reported."""
        self._settle(query, timeout_s)
        with self._news:
            return self._batches.get(str(query.runId), 0)

    def table(self, spark: SparkSession) -> DataFrame:
        """(query_id, run_id, batch, rows) of every batch that dropped rows."""
        with self._news:
            rows = [(*key, n) for key, n in sorted(self._dropped.items())]
        return spark.createDataFrame(rows, "query_id string, run_id string, batch bigint, rows bigint")


def late_rows(spark: SparkSession) -> LateRows:
    """The ledger of the session's application; made, and listening, from the first call."""
    app = spark.sparkContext.applicationId
    if app not in _LEDGERS:
        ledger = LateRows()
        spark.streams.addListener(ledger)
        _LEDGERS[app] = ledger
    return _LEDGERS[app]
