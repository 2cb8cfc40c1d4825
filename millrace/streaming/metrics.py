"""Counts that a stream takes of its own rows, batch by batch, as it runs."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class BatchMetrics:
    """One micro-batch: rows read, observed values by name, and groups of rows that came too late.

    Late rows are counted after those of one task and one group were folded into one.
    """

    query: str | None
    batch: int
    rows: int
    observed: dict[str, dict] = field(default_factory=dict)
    late_groups: int = 0
    watermark: str | None = None


class Metrics(StreamingQueryListener):
    """Keeps the metrics of all batches that end while it listens.

    Spark tells of a batch some time after it has ended, so ``wait`` for a query to be told of as
    ended before reading ``batches``. A batch that runs again counts once, as it was last.
    """

    def __init__(self) -> None:
        self._told = threading.Condition()
        self._batches: dict[tuple[str, int], BatchMetrics] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = BatchMetrics(
            progress.name,
            progress.batchId,
            progress.numInputRows,
            {name: row.asDict() for name, row in progress.observedMetrics.items()},
            sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
            progress.eventTime.get("watermark"),
        )
        with self._told:
            self._batches[str(progress.id), progress.batchId] = found

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._told:
            self._ended.add(str(event.runId))
            self._told.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all batches of a query that has ended have been told of."""
        with self._told:
            if not self._told.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no word of the end of query {query.runId}")

    @property
    def batches(self) -> list[BatchMetrics]:
        with self._told:
            return [self._batches[key] for key in sorted(self._batches)]

    def total(self, name: str, value: str) -> int:
        """Sum over all batches of an observed count."""
        seen = [b.observed[name][value] for b in self.batches if name in b.observed]
        return sum(n for n in seen if n is not None)


@contextmanager
def listening(spark: SparkSession) -> Iterator[Metrics]:
    """Metrics of the session's streaming queries that run inside the block."""
    metrics = Metrics()
    spark.streams.addListener(metrics)
    try:
        yield metrics
    finally:
        spark.streams.removeListener(metrics)


def observed(df: DataFrame, name: str, **counts) -> DataFrame:
    """The same rows, with aggregates taken of them on the way, at no extra pass."""
    return df.observe(name, *[value.alias(key) for key, value in counts.items()])
