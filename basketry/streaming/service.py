"""Running a streaming query as a service (T1): progress, stop, restart.

``supervise`` watches one query until it ends, is told to stop, or fails.
``keep_running`` starts it again after a failure; the checkpoint makes the new
query go on where the failed one ended.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.finished import exists

Progress = Callable[[dict], None]


def stop_file(spark: SparkSession, path: str) -> Callable[[], bool]:
    """Tells to stop once ``path`` exists, on any file system Spark reaches."""
    return lambda: exists(spark, path)


def _report(query: StreamingQuery, last: int, on_progress: Progress | None) -> int:
    """Hand on the progress of micro-batches after ``last``; the newest one."""
    for p in query.recentProgress:
        if p["batchId"] > last and p["numInputRows"]:
            last = p["batchId"]
            if on_progress:
                on_progress({"batch": last, "rows": p["numInputRows"], "rows_per_second": p["processedRowsPerSecond"],
                             "duration_ms": dict(p["durationMs"]).get("triggerExecution"),
                             "late_rows": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])})
    return last


def supervise(query: StreamingQuery, on_progress: Progress | None = None,
              should_stop: Callable[[], bool] | None = None, every: float = 1.0) -> int:
    """Watch a query; returns its last micro-batch with rows (-1 if none). A
    stop lets the running micro-batch finish, so that it isn't run again; what
    a query fails with is raised."""
    last = -1
    while not query.awaitTermination(every):
        last = _report(query, last, on_progress)
        if should_stop is not None and should_stop():
            running = query.lastProgress and query.lastProgress["batchId"]
            while (query.isActive and query.status["isTriggerActive"] and query.status["isDataAvailable"]
                   and (query.lastProgress and query.lastProgress["batchId"]) == running):
                time.sleep(min(every, 0.1))
            query.stop()
            query.awaitTermination()
            break
    return _report(query, last, on_progress)


def keep_running(start: Callable[[], StreamingQuery], on_progress: Progress | None = None,
                 should_stop: Callable[[], bool] | None = None, restarts: int = 3, wait: float = 1.0,
                 every: float = 1.0) -> int:
    """Supervise what ``start`` starts, and start it again after a failure, at
    most ``restarts`` times in a row without a finished micro-batch between,
    waiting twice as long each time. Returns the last micro-batch."""
    failed, last = 0, -1
    while True:
        done = []
        try:
            return max(last, supervise(start(), lambda p: (done.append(p["batch"]), on_progress and on_progress(p)),
                                       should_stop, every))
        except StreamingQueryException:
            failed = 1 if done else failed + 1
            last = max([last, *done])
            if failed > restarts or should_stop is not None and should_stop():
                raise
            time.sleep(wait * 2 ** (failed - 1))
