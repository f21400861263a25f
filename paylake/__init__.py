"""paylake: payments analytics on Spark.

Batch lake + star schema, operational and revenue reports, a change stream
with validation, quarantine and an idempotent field-level upsert, data-quality
checks, and fraud features / scoring with ``pyspark.ml``.  Everything is
expressed with DataFrame, Structured Streaming and ``pyspark.ml`` operations.
"""

__version__ = "0.1.0"
