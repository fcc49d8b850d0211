"""Keep independent streams running: restart a failed one from its checkpoint, leave the others alone.

``Supervisor`` holds a start function per feed. A ``StreamingQueryListener`` tells it which
query ended; one that ended with an exception is started again after a pause that doubles
with every failure in a row (progress resets it), at most ``max_restarts`` times in a row.
A feed that is given up, or that ended by itself (``availableNow``), does not stop the rest.
Restarts are safe because a query resumes from its checkpoint and the sinks are idempotent.
"""

from __future__ import annotations

import queue
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class Feed:
    name: str
    start: Callable[[], StreamingQuery]
    query: StreamingQuery | None = None
    failures: int = 0                 # in a row
    restarts: int = 0                 # altogether
    due: float | None = None          # when to start it again
    state: str = "new"                # running, waiting, done, failed
    errors: list[str] = field(default_factory=list)


class _Listener(StreamingQueryListener):
    """Puts (kind, run id, error) on the supervisor's queue."""

    def __init__(self, events: queue.Queue):
        self.events = events

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.events.put(("progress", str(event.progress.runId), None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.events.put(("ended", str(event.runId), event.exception))


class Supervisor:
    """``Supervisor(spark, {"posts": lambda: start_feed(...), ...}).run()``."""

    def __init__(self, spark: SparkSession, starts: dict[str, Callable[[], StreamingQuery]],
                 max_restarts: int = 5, first_pause: float = 1.0, longest_pause: float = 60.0):
        self.spark = spark
        self.feeds = {name: Feed(name, start) for name, start in starts.items()}
        self.max_restarts, self.first_pause, self.longest_pause = max_restarts, first_pause, longest_pause
        self.events: queue.Queue = queue.Queue()

    def pause(self, failures: int) -> float:
        """Seconds before the restart after so many failures in a row."""
        return min(self.longest_pause, self.first_pause * 2 ** (failures - 1))

    def _start(self, feed: Feed) -> None:
        feed.due = None
        try:
            feed.query = feed.start()
            feed.state = "running"
        except Exception as e:              # a start that fails counts like a query that fails
            self._failed(feed, str(e))

    def _failed(self, feed: Feed, error: str) -> None:
        feed.errors.append(error)
        feed.failures += 1
        feed.query = None
        if feed.failures > self.max_restarts:
            feed.state = "failed"
            return
        feed.state, feed.due = "waiting", time.monotonic() + self.pause(feed.failures)

    def _handle(self, kind: str, run_id: str, error: str | None) -> None:
        feed = next((f for f in self.feeds.values() if f.query is not None and str(f.query.runId) == run_id), None)
        if feed is None:
            return
        if kind == "progress":
            feed.failures = 0
        elif error:
            self._failed(feed, error)
        else:
            feed.state, feed.query = "done", None

    def _poll(self) -> None:
        """Ended queries, should their event have been lost (the listener's queue is bounded in Spark)."""
        for feed in self.feeds.values():
            if feed.query is not None and not feed.query.isActive:
                error = feed.query.exception()
                self._handle("ended", str(feed.query.runId), str(error) if error else None)

    def active(self) -> bool:
        return any(f.state in ("running", "waiting") for f in self.feeds.values())

    def run(self, timeout: float | None = None, tick: float = 0.5) -> dict[str, str]:
        """Start all feeds and look after them until none is left or ``timeout`` seconds have passed; {feed: state}."""
        listener = _Listener(self.events)
        self.spark.streams.addListener(listener)
        until = None if timeout is None else time.monotonic() + timeout
        try:
            for feed in self.feeds.values():
                if feed.state == "new":
                    self._start(feed)
            while self.active() and (until is None or time.monotonic() < until):
                try:
                    self._handle(*self.events.get(timeout=tick))
                except queue.Empty:
                    self._poll()
                for feed in self.feeds.values():
                    if feed.due is not None and time.monotonic() >= feed.due:
                        feed.restarts += 1
                        self._start(feed)
        finally:
            self.spark.streams.removeListener(listener)
        return {f.name: f.state for f in self.feeds.values()}

    def stop(self) -> None:
        """Stop every running feed; it resumes from its checkpoint when started again."""
        for feed in self.feeds.values():
            feed.due = None
            if feed.query is not None:
                feed.query.stop()
                feed.query, feed.state = None, "done"
