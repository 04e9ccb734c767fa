"""The progress of streams as a table: every micro-batch, not only the last hundred."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

SCHEMA = "query string, run string, batch bigint, rows bigint, duration_ms bigint, state_rows bigint"
FLUSH_ROWS = 100
FLUSH_SECONDS = 10.0


class ProgressRecorder(StreamingQueryListener):
    """Appends a row per micro-batch to the table at ``path``.

    Rows are written when there are ``flush_rows`` of them, when the first has waited for
    ``flush_seconds``, and when a query ends. A run that is watched by ``path`` alone
    can thus be read while it goes on, at most that far behind.
    """

    def __init__(
        self, spark: SparkSession, path: str, flush_rows: int = FLUSH_ROWS, flush_seconds: float = FLUSH_SECONDS
    ) -> None:
        self.spark, self.path = spark, path
        self.flush_rows, self.flush_seconds = flush_rows, flush_seconds
        self._rows: list[tuple] = []
        self._since = 0.0
        self._lock = threading.RLock()
        self._ended = threading.Condition()
        self._runs: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        took = int((progress.durationMs or {}).get("triggerExecution", 0))
        state = sum(operator.numRowsTotal for operator in progress.stateOperators)
        row = (str(progress.id), str(progress.runId), int(progress.batchId), int(progress.numInputRows), took, state)
        with self._lock:
            if not self._rows:
                self._since = time.monotonic()
            self._rows.append(row)
            if len(self._rows) >= self.flush_rows or time.monotonic() - self._since >= self.flush_seconds:
                self.flush()

    def onQueryIdle(self, event) -> None:
        self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._ended:
            self._runs.add(str(event.runId))
            self._ended.notify_all()

    def flush(self) -> None:
        """Write what has been gathered."""
        with self._lock:
            rows, self._rows = self._rows, []
            if rows:
                self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Wait until all that a query which has ended reported is in the table."""
        with self._ended:
            return self._ended.wait_for(lambda: str(query.runId) in self._runs, seconds)


@contextmanager
def recorded(spark: SparkSession, path: str, **settings) -> Iterator[ProgressRecorder]:
    """Record the progress of all queries that run inside."""
    recorder = ProgressRecorder(spark, path, **settings)
    spark.streams.addListener(recorder)
    try:
        yield recorder
    finally:
        spark.streams.removeListener(recorder)
        recorder.flush()


def recorded_progress(spark: SparkSession, path: str, trigger_ms: int = 1000) -> DataFrame:
    """(query, run, batch, rows, duration_ms, state_rows, overrun): one row per micro-batch.

    A batch without rows may be reported once more when a stream falls idle; the last report counts.
    ``overrun`` marks batches that took longer than the trigger interval.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    values = F.struct("duration_ms", "rows", "state_rows")
    once = rows.groupBy("query", "run", "batch").agg(F.max(values).alias("v"))
    return once.select(
        "query", "run", "batch", "v.rows", "v.duration_ms", "v.state_rows", (F.col("v.duration_ms") > trigger_ms).alias("overrun")
    )
