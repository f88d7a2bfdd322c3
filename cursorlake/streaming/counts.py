"""Counts per micro-batch of what a stream received, wrote and left out.

The reference's loader logs each batch it writes; its streaming job skips what it cannot
parse without a trace. Here a query carries two observations, which Spark computes in
the tasks that do the work anyway: ``received`` (messages) and ``written`` (rows, their
earliest and latest time, further counts by condition). A listener collects them.

* Unparsable messages are those received less the rows written: a message gives one
  row or none.
* ``behind`` is the number of rows that stateful operators dropped behind the watermark.
  A query without state, as the ingest, drops none; whether it had late rows shows in
  ``earliest`` against ``watermark``.
* A batch that is replayed after a failure takes the place of its first report, as the
  query's id stays the same, so totals count it once. A stage that Spark computes again
  after losing an executor may count its rows twice: the counts are for monitoring.

The observations must lie above any range partitioning, whose sampling reads its input
a second time.
"""

from __future__ import annotations

import logging
import threading
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)

KEPT_BATCHES = 10_000  # reports kept per query; older ones are only in its totals


def received(messages: DataFrame) -> DataFrame:
    return messages.observe("received", F.count(F.lit(1)).alias("messages"))


def written(rows: DataFrame, time: str, **conditions: Column) -> DataFrame:
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    return rows.observe("written", F.count(F.lit(1)).alias("rows"), F.min(time).alias("earliest"),
                        F.max(time).alias("latest"), *counts)


@dataclass(frozen=True)
class Batch:
    """One micro-batch. ``counts`` holds messages, rows, unparsable, behind and the
    conditions' counts."""

    batch_id: int
    counts: dict[str, int]
    earliest: datetime | None
    latest: datetime | None
    watermark: str | None


@dataclass
class _Query:
    batches: dict[int, Batch] = field(default_factory=dict)
    older: dict[str, int] = field(default_factory=dict)


def _add(into: dict[str, int], counts: dict[str, int]) -> None:
    for name, n in counts.items():
        into[name] = into.get(name, 0) + n


class BatchCounts(StreamingQueryListener):
    """``spark.streams.addListener(counts)`` before the queries start."""

    def __init__(self) -> None:
        self._queries: dict[str, _Query] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        metrics = {name: row.asDict() for name, row in p.observedMetrics.items()}
        if "written" not in metrics:
            return
        counts = dict(metrics.get("received", {}))
        times = metrics["written"]
        counts.update((k, v) for k, v in times.items() if k not in ("earliest", "latest"))
        counts["unparsable"] = max(0, counts.get("messages", counts["rows"]) - counts["rows"])
        counts["behind"] = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        batch = Batch(p.batchId, counts, times["earliest"], times["latest"], p.eventTime.get("watermark"))
        log.info("query %s batch %d: %s", p.name or p.id, p.batchId, counts)
        with self._changed:
            q = self._queries.setdefault(str(p.id), _Query())
            q.batches[p.batchId] = batch
            while len(q.batches) > KEPT_BATCHES:
                _add(q.older, q.batches.pop(min(q.batches)).counts)

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def ended(self, query: StreamingQuery, timeout: float = 30.0) -> bool:
        """Wait until all reports of an ended run are in."""
        with self._changed:
            return self._changed.wait_for(lambda: str(query.runId) in self._ended, timeout)

    def batches(self, query: StreamingQuery) -> list[Batch]:
        with self._changed:
            q = self._queries.get(str(query.id), _Query())
            return [q.batches[i] for i in sorted(q.batches)]

    def totals(self, query: StreamingQuery) -> dict[str, int]:
        """Sums over all batches, of all runs from this checkpoint that were heard."""
        with self._changed:
            q = self._queries.get(str(query.id), _Query())
            out = dict(q.older)
            for b in q.batches.values():
                _add(out, b.counts)
            return out
