"""Starting, watching and stopping stream queries."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sparkloom.scratch import path_exists, write_text


def stop_gracefully(query: StreamingQuery, timeout: float = 60.0, marker: str | None = None,
                    poll: float = 0.05) -> bool:
    """Stop between two micro-batches, and only once the marker file exists if one is named (a path or URI
    of any file system that Spark can read).

    False when the timeout passed first; the query then still runs.
    """
    deadline = time.monotonic() + timeout
    while time.monotonic() < deadline:
        if not query.isActive:
            return True
        if (marker is None or path_exists(SparkSession.active(), marker)) and not query.status["isTriggerActive"]:
            query.stop()
            return True
        time.sleep(poll)
    return False


def stop_all(spark: SparkSession) -> int:
    active = list(spark.streams.active)
    for query in active:
        query.stop()
    return len(active)


def run_with_restarts(start: Callable[[], StreamingQuery], restarts: int = 3) -> int:
    """Run a query to its end, starting it again after a failure; gives the number of restarts used."""
    for attempt in range(restarts + 1):
        try:
            start().awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt == restarts:
                raise
    return restarts


def progress_rows(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch id, input rows) of the recent micro-batches."""
    return [(p["batchId"], p["numInputRows"]) for p in query.recentProgress]


class ProgressLog(StreamingQueryListener):
    """Keeps the events of all queries: started, progress (batch, rows), ended with its error if any."""

    def __init__(self):
        self.events: list[tuple] = []

    def onQueryStarted(self, event):
        self.events.append(("started", str(event.id)))

    def onQueryProgress(self, event):
        self.events.append(("progress", event.progress.batchId, event.progress.numInputRows))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.events.append(("ended", event.exception))


PROGRESS = ("query string, run string, name string, batch_id bigint, at timestamp, input_rows bigint, rows_per_second double, "
            "state_rows bigint, state_bytes bigint, late_rows bigint, watermark timestamp, trigger_ms bigint")


class ProgressTable(StreamingQueryListener):
    """Keeps the progress of all queries of a session as a table: one small JSON file per micro-batch in a folder of
    shared storage, so the record outlives the application and can be read while queries run.

    Events come after the fact and in a thread of their own: `wait` returns once a query's end has come through.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._ended: dict[str, str | None] = {}
        self._change = threading.Condition()
        self._failure: Exception | None = None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        state = p.stateOperators
        row = {"query": str(p.id), "run": str(p.runId), "name": p.name, "batch_id": p.batchId, "at": p.timestamp,
               "input_rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond,
               "state_rows": sum(s.numRowsTotal for s in state), "state_bytes": sum(s.memoryUsedBytes for s in state),
               "late_rows": sum(s.numRowsDroppedByWatermark for s in state),
               "watermark": dict(p.eventTime).get("watermark"), "trigger_ms": dict(p.durationMs).get("triggerExecution")}
        try:
            # A batch may report twice (with and without data): time and run tell the files apart.
            name = f"{p.runId}-{p.batchId:010d}-{time.time_ns()}.json"
            write_text(self._spark, f"{self._path}/{name}", json.dumps(row) + "\n")
        except Exception as error:  # raised in `wait`: an error here would only be logged
            self._failure = error

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._change:
            self._ended[str(event.runId)] = event.exception
            self._change.notify_all()

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Until all events of a query that has ended are written."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError("the query's end was not reported in time")
        if self._failure:
            raise self._failure

    def table(self) -> DataFrame:
        """(query, run, name, batch_id, at, input_rows, ..., state_rows, watermark): a row per reported micro-batch."""
        return self._spark.read.schema(PROGRESS).json(self._path)
