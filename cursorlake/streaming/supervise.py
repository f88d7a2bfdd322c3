"""Independent topics. A failed query is started again from its checkpoint, the
others run on.

``await_all`` ends a set of queries at the first error, which suits a batch-like run.
A service wants each topic by itself: here every topic has a function that starts its
query. When the query fails, or cannot be started, the function is called again after
a pause that doubles with each failure in a row; a query that has made progress since
its start begins with the shortest pause anew. The checkpoint and the sink's log make
the restarted query go on after the last committed batch, so no row is lost or written
twice. A topic that fails too often in a row is given up and named in the error that
is raised once the other topics have ended.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

SHORTEST, LONGEST = 1.0, 60.0
MAX_FAILURES = 5


class TopicsFailed(RuntimeError):
    """The topics that were given up, each with its last error."""

    def __init__(self, errors: dict[str, Exception]):
        super().__init__("; ".join(f"{name}: {str(e).splitlines()[0]}" for name, e in errors.items()))
        self.errors = errors


@dataclass
class Topic:
    start: Callable[[], StreamingQuery]
    query: StreamingQuery | None = None
    due: float = 0.0
    in_a_row: int = 0
    failures: list[Exception] = field(default_factory=list)

    def pause(self, shortest: float, longest: float) -> float:
        return min(longest, shortest * 2 ** (self.in_a_row - 1))


def _progressed(query: StreamingQuery) -> bool:
    return any(p["numInputRows"] > 0 for p in query.recentProgress)


def supervise(starters: dict[str, Callable[[], StreamingQuery]], max_failures: int = MAX_FAILURES,
              shortest: float = SHORTEST, longest: float = LONGEST, poll: float = 0.2,
              stop: Callable[[], bool] = lambda: False) -> dict[str, list[Exception]]:
    """Run every topic until its query ends by itself or ``stop()`` holds; the errors
    that each topic has come over. Raises TopicsFailed if any was given up."""
    topics, given_up = {name: Topic(start) for name, start in starters.items()}, {}
    running = dict(topics)
    while running and not stop():
        for name, topic in list(running.items()):
            try:
                if topic.query is None:
                    if time.monotonic() >= topic.due:
                        topic.query = topic.start()
                elif not topic.query.isActive:
                    if error := topic.query.exception():
                        raise error
                    del running[name]
            except Exception as error:  # of the start or of the query
                if topic.query is not None and _progressed(topic.query):
                    topic.in_a_row = 0
                topic.query, topic.in_a_row = None, topic.in_a_row + 1
                topic.failures.append(error)
                topic.due = time.monotonic() + topic.pause(shortest, longest)
                log.warning("topic %s failed (%d in a row): %s", name, topic.in_a_row, str(error).splitlines()[0])
                if topic.in_a_row >= max_failures:
                    given_up[name] = error
                    del running[name]
        if running:
            time.sleep(poll)
    for topic in running.values():  # stop() was asked for
        if topic.query is not None:
            topic.query.stop()
    if given_up:
        raise TopicsFailed(given_up)
    return {name: topic.failures for name, topic in topics.items()}
