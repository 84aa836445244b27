"""Queries that run for long: counts of what they do, a stop between batches, restarts after failures."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

#: Seconds between two looks at a query.
LOOK = 0.2


@dataclass
class Counts:
    """Of one query name, over all its runs. ``dropped`` are rows beyond the watermark of a state operator."""

    batches: int = 0
    samples: int = 0
    published: int = 0
    dropped: int = 0
    starts: int = 0
    failures: int = 0


class RunCounts(StreamingQueryListener):
    """Adds up the progress of all named queries; add it with ``spark.streams.addListener``.

    ``published`` holds for queries that write their rows themselves; those fed by a table of panes
    count in ``query.publisher.totals``. Spark tells its listeners some moments after a batch.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._counts: dict[str, Counts] = {}
        self._names: dict[str, str] = {}

    def of(self, name: str) -> Counts:
        with self._lock:
            return replace(self._counts.get(name, Counts()))

    def _add(self, run: str, name: str | None, **more: int) -> None:
        with self._lock:
            name = self._names.setdefault(run, name or run)
            counts = self._counts.setdefault(name, Counts())
            for field, number in more.items():
                setattr(counts, field, getattr(counts, field) + number)

    def onQueryStarted(self, event) -> None:
        self._add(str(event.runId), event.name, starts=1)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = progress.observedMetrics.get("published")
        dropped = sum(max(0, s.numRowsDroppedByWatermark) for s in progress.stateOperators)
        self._add(
            str(progress.runId),
            progress.name,
            batches=int("addBatch" in progress.durationMs),
            samples=max(0, progress.numInputRows),
            published=0 if metrics is None else metrics["rows"],
            dropped=dropped,
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add(str(event.runId), None, failures=int(event.exception is not None))


def stop_between_batches(query: StreamingQuery, timeout: float = 600) -> None:
    """Stop a query when it has no batch at work, or after ``timeout`` seconds.

    A batch that starts at the same moment is broken off; started again, the query repeats it.
    """
    end = time.monotonic() + timeout
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(LOOK / 4)
    query.stop()


def run_supervised(
    start: Callable[[], StreamingQuery],
    restarts: int = 3,
    pause: float = 10,
    stop: threading.Event | None = None,
) -> StreamingQuery:
    """Run a query until it ends or ``stop`` is set, and start it again after failures; returns its last run.

    ``start`` starts the query on its checkpoint, each time the same. After ``restarts`` failures in a row
    without a batch done between them the last failure is raised; what is no failure of a query, such as a wrong
    argument, is raised at once. Waits ``pause`` seconds before a restart, twice as long after each further failure.
    """
    stop = stop or threading.Event()
    failed, done = 0, -1
    while True:
        query = None
        try:
            query = start()
            while not query.awaitTermination(LOOK):
                if stop.is_set():
                    stop_between_batches(query)
            return query
        except StreamingQueryException:
            reached = max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=-1) if query else -1
            failed, done = (1, reached) if reached > done else (failed + 1, done)
            if failed > restarts or stop.wait(pause * 2 ** (failed - 1)):
                raise
