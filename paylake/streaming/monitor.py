"""Reports of running streams, gathered by a listener."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = "query string, batch_id bigint, num_input_rows bigint, state_rows bigint, late_rows bigint, duration_ms bigint"


class ProgressListener(StreamingQueryListener):
    """Keeps the last ``most`` progress reports of all queries, and the errors that ended one."""

    def __init__(self, most: int = 10_000):
        self.reports: deque[tuple] = deque(maxlen=most)
        self.errors: deque[tuple[str, str]] = deque(maxlen=most)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.reports.append((p.name or str(p.id), p.batchId, p.numInputRows, sum(s.numRowsTotal for s in p.stateOperators),
                             sum(s.numRowsDroppedByWatermark for s in p.stateOperators), int(p.batchDuration)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.errors.append((str(event.id), event.exception))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.reports), PROGRESS)


def watch(spark: SparkSession) -> ProgressListener:
    listener = ProgressListener()
    spark.streams.addListener(listener)
    return listener
