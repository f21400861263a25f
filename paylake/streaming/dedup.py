"""Repeats taken out of a message stream, with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(source: DataFrame, keys: list[str], delay: str = "1 hour", event_time: str = "event_ts") -> DataFrame:
    """The first of the messages that share their ``keys`` and come within ``delay`` of event time.

    The state holds the keys of about ``delay`` before the newest event time seen, not all of
    them.  A message older than that when it arrives is late and left out, a repeat or not.
    """
    timed = source.withColumn("_event_time", F.col(event_time).cast("timestamp"))  # watermarks take no other type
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(keys).drop("_event_time")
