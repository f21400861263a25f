"""Replay of a table as a message stream: slices of files that a file stream reads back.

The registered stream queries and the tests run on it; the library's own source is
``consumer.kafka_source`` or any frame with the message columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.session import children
from paylake.streaming import consumer


def write_slices(msgs: DataFrame, path: str, batches: int = 3, partitions: int = 8) -> int:
    """Write the messages in ``batches`` slices of their arrival order (``event_seq``).

    A slice has at most ``partitions`` files, written where its messages lie (no result depends on
    which file holds a message); the return value is the most files a slice has, to be read per
    trigger (a micro-batch may reach into the next slice where slices have fewer).  Messages without
    a place in the order (NULL) come with the first slice.
    """
    msgs = msgs.select(*[c.split()[0] for c in consumer.MESSAGE_SCHEMA.split(", ")])  # made anew for each slice, kept nowhere
    cuts = msgs.select(F.percentile_approx("event_seq", [i / batches for i in range(1, batches)], 10000)).first()[0] \
        if batches > 1 else []
    bounds = [None, *(cuts or []), None]
    spark, files, most = msgs.sparkSession, set(), 1
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        part = msgs
        if lo is not None:
            part = part.filter(F.col("event_seq") >= lo)
        if hi is not None:
            part = part.filter((F.col("event_seq") < hi) | (F.col("event_seq").isNull() & F.lit(lo is None)))
        part.coalesce(partitions).write.mode("append").option("compression", "zstd").parquet(path)
        found = {n for n in children(spark, path) if n.endswith(".parquet")}
        files, most = found, max(most, len(found - files))
    return most
