"""Watching streams: how long messages take to reach their table, and what happens to the other queries when one fails."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

ARRIVALS, VERDICTS = "arrivals", "verdicts"
BATCH_DDL = (
    "query_id STRING, batch BIGINT, n_messages BIGINT, n_anomalies BIGINT, first_arrival TIMESTAMP, committed_at TIMESTAMP, "
    "batch_seconds DOUBLE, latency_seconds DOUBLE"
)
# Batches that a listener remembers.
REMEMBERED = 10_000


def observe_arrivals(messages: DataFrame, arrived: Column | str) -> DataFrame:
    """Count the messages of each micro-batch and note the earliest arrival (the broker's or the file's time)."""
    at = F.col(arrived) if isinstance(arrived, str) else arrived
    return messages.observe(ARRIVALS, F.count(F.lit(1)).alias("n"), F.min(at.cast("timestamp")).alias("first"))


def observe_verdicts(flagged: DataFrame) -> DataFrame:
    return flagged.observe(VERDICTS, F.count_if("is_anomaly").alias("n"))


class BatchTimes(StreamingQueryListener):
    """Remembers for each micro-batch with messages when it was committed and how long its oldest message had waited by then.

    The counts are observed while the batch is written, so nothing is read again.
    """

    def __init__(self) -> None:
        self.batches: deque[tuple] = deque(maxlen=REMEMBERED)
        self.failures: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        arrivals, verdicts = (progress.observedMetrics.get(name) for name in (ARRIVALS, VERDICTS))
        if arrivals is None or not arrivals["n"]:
            return
        started = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        seconds = progress.batchDuration / 1000
        committed = started + timedelta(seconds=seconds)
        first = arrivals["first"].astimezone(committed.tzinfo) if arrivals["first"] else None
        waited = (committed - first).total_seconds() if first else None
        self.batches.append(
            (str(progress.id), progress.batchId, arrivals["n"], verdicts["n"] if verdicts else None, first, committed, seconds, waited),
        )

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self.failures[str(event.id)] = event.exception

    def settle(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Wait for the reports of a query that has ended: they arrive a little after its end."""
        until = time.monotonic() + seconds
        last = query.lastProgress
        while last and last.batchId not in {row[1] for row in self.batches if row[0] == str(query.id)} and time.monotonic() < until:
            time.sleep(0.05)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.batches), BATCH_DDL)


def wait_for_all(queries: Sequence[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until all queries have ended. If one fails the others are stopped and its error is raised."""
    running = list(queries)
    try:
        while running:
            for query in running:
                query.awaitTermination(poll_seconds)  # raises the query's error
            running = [query for query in running if query.isActive]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
