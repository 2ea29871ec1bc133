"""Watching streaming queries, and starting them again."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)


@dataclass
class Progress:
    """What one query has done so far, over all its runs.

    ``late_rows``: rows that the watermark dropped, which are in no result (as
    they reach the state: a count's map-side combine comes first);
    ``state_rows``: entries held after the last batch; ``rows_per_second``: of
    the last batch, to compare with the topic's own rate."""

    batches: int = 0
    input_rows: int = 0
    late_rows: int = 0
    state_rows: int = 0
    state_bytes: int = 0
    watermark: str | None = None
    newest_event: str | None = None
    rows_per_second: float = 0.0
    last_batch: int = -1
    failures: list[str] = field(default_factory=list)


class ProgressListener(StreamingQueryListener):
    """Adds up the progress of every query of a session, by query id (which
    stays the same when a query restarts from its checkpoint).

    Spark calls listeners from a thread of its own, after the batch;
    :meth:`settled` waits until a run's end has arrived.  ``report`` is called
    with the id and the progress after each batch, to log or export it.
    """

    def __init__(self, report: Callable[[str, Progress], None] | None = None) -> None:
        super().__init__()
        self.report = report
        self.progress: dict[str, Progress] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.progress.setdefault(str(event.id), Progress())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.changed:
            mine = self.progress.setdefault(str(p.id), Progress())
            mine.batches += 1
            mine.input_rows += max(int(p.numInputRows), 0)
            mine.late_rows += sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators)
            mine.state_rows = sum(int(s.numRowsTotal) for s in p.stateOperators)
            mine.state_bytes = sum(int(s.memoryUsedBytes) for s in p.stateOperators)
            mine.watermark = p.eventTime.get("watermark", mine.watermark)
            mine.newest_event = p.eventTime.get("max", mine.newest_event)
            mine.rows_per_second = float(p.processedRowsPerSecond or 0.0)
            mine.last_batch = int(p.batchId)
        if mine.late_rows:
            log.warning("query %s: %s rows came too late so far and are in no result", p.id, mine.late_rows)
        if self.report is not None:
            self.report(str(p.id), mine)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            if event.exception:
                self.progress.setdefault(str(event.id), Progress()).failures.append(event.exception)
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def settled(self, query: StreamingQuery, timeout: float = 30.0) -> Progress:
        """The progress of a query whose run has ended, complete."""
        with self.changed:
            self.changed.wait_for(lambda: str(query.runId) in self.ended, timeout)
            return self.progress.setdefault(str(query.id), Progress())


class GaveUp(RuntimeError):
    """A query failed more often than its policy allows."""


@dataclass(frozen=True)
class Restarts:
    """At most ``most`` restarts in any span of ``within_s`` seconds, the first
    after ``wait_s`` seconds, each further one after twice as long, up to
    ``longest_s``."""

    most: int = 3
    within_s: float = 3600.0
    wait_s: float = 1.0
    longest_s: float = 300.0

    def wait(self, recent: int) -> float:
        return min(self.wait_s * 2 ** max(recent - 1, 0), self.longest_s)


def supervise(
    spark: SparkSession,
    begin: Callable[[], StreamingQuery],
    restarts: Restarts = Restarts(),
    listener: ProgressListener | None = None,
    stop: threading.Event | None = None,
) -> Progress:
    """Run the query that ``begin`` starts until it ends, and start it again
    from its checkpoint when it fails.

    ``begin`` must use the same checkpoint each time, so that no message is
    lost and a replayed batch is known to its sink (:func:`append_batches`).
    When the policy allows no further restart :class:`GaveUp` is raised from
    the last failure.  ``stop`` ends the query from another thread, at the
    end of what it is doing.  Returns the progress over all runs.
    """
    own = listener is None
    listener = listener or ProgressListener()
    if own:
        spark.streams.addListener(listener)
    failed: list[float] = []
    try:
        while True:
            query = begin()
            try:
                while not query.awaitTermination(1):
                    if stop is not None and stop.is_set():
                        query.stop()
                return listener.settled(query)
            except Exception as e:  # the query's failure, as Spark raises it
                if query.isActive:
                    raise
                listener.settled(query)
                now = time.monotonic()
                failed = [t for t in failed if now - t < restarts.within_s] + [now]
                if len(failed) > restarts.most:
                    raise GaveUp(f"query {query.id} failed {len(failed)} times in {restarts.within_s:g} s") from e
                wait = restarts.wait(len(failed))
                log.warning("query %s failed (%s); restart %s of %s in %s s", query.id, type(e).__name__, len(failed), restarts.most, wait)
                time.sleep(wait)
    finally:
        if own:
            spark.streams.removeListener(listener)
