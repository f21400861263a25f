"""Consume the change stream: validate, quarantine, dispatch, upsert, alert log.

The micro-batch sink (``ConsumerSink``) is meant for ``foreachBatch``.  Every
write it does is keyed by ``batch_id`` and overwrites that batch's folder, so a
replayed batch (after a failure before the checkpoint commit) changes nothing:
at-least-once delivery plus idempotent writes gives effectively-once results.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylake.functions import domains as D
from paylake.operators.upsert import UpsertTable
from paylake.session import path_exists, remove, write_text

# Typed fields of a transaction event (all optional in the JSON).
EVENT_SCHEMA = ("id string, customer_id string, merchant_id string, amount double, currency_code string, "
                "status string, fraud_score double, device_type string, ip_country string, created_at string")
EVENT_FIELDS = [c.strip().split()[0] for c in EVENT_SCHEMA.split(",")]
STATE_SCHEMA = ("id string, customer_id string, merchant_id string, amount double, currency_code string, "
                "status string, fraud_score double, device_type string, ip_country string, "
                "created_at timestamp_ntz")
ALERT_SCHEMA = STATE_SCHEMA + ", flagged_at timestamp"
MESSAGE_SCHEMA = "topic string, key string, value string, event_ts timestamp_ntz, event_seq long"


def validate(messages: DataFrame, required=D.REQUIRED_EVENT_KEYS) -> DataFrame:
    """Add ``_ev`` (the message as VARIANT), ``is_valid`` and ``reason``.

    A message is valid when its value is a JSON object holding every required
    key (a NULL value counts as present).  Malformed text and non-objects get
    reason ``malformed``; the rest of the invalid ones ``missing_keys``.  The text is parsed
    once, here; all else takes fields out of the VARIANT.
    """
    # through a generator, below which no filter on its result is pushed (that would parse again)
    keyed = messages.select("*", F.explode(F.array(F.try_parse_json("value"))).alias("_ev"))
    is_object = F.coalesce(F.schema_of_variant("_ev").startswith("OBJECT"), F.lit(False))
    complete = is_object
    for k in required:
        complete = complete & present(k)
    return keyed.withColumns({
        "is_valid": complete,
        "reason": F.when(~is_object, "malformed").when(~complete, "missing_keys"),
    })


def present(field: str, event: str = "_ev") -> Column:
    """Whether a VARIANT object has the key (its value may be NULL)."""
    return F.try_variant_get(F.col(event), f"$.{field}", "variant").isNotNull()


def parse(valid: DataFrame) -> DataFrame:
    """Typed event columns plus ``<field>__present`` flags (key present in the JSON)."""
    cols = {f.name: F.try_variant_get("_ev", f"$.{f.name}", f.dataType.simpleString())
            for f in StructType.fromDDL(EVENT_SCHEMA).fields}
    # a malformed timestamp becomes NULL instead of failing the micro-batch
    # and an offset is honoured: the state holds UTC (the session's zone)
    cols["created_at"] = cols["created_at"].try_cast("timestamp").cast("timestamp_ntz")
    flags = {f"{f}__present": present(f) for f in EVENT_FIELDS if f != "id"}
    return valid.select(*[c for c in valid.columns if c != "_ev"], *[c.alias(n) for n, c in cols.items()],
                        *[c.alias(n) for n, c in flags.items()])


# The one order of changes, inside a batch and across batches: the place in the topic (for Kafka
# partition and offset; a key lives in one partition).  It is kept with every field's state, so the
# order in which files or batches arrive decides nothing, nor do event times of producers.
ORDER = "event_seq bigint"
PRESENCE = {f: f"{f}__present" for f in EVENT_FIELDS if f != "id"}


def log_rows(alerts: DataFrame) -> DataFrame:
    """One log row per delivered alert; its place in the topic tells deliveries apart."""
    return alerts.select(
        F.lit("fraud_alert").alias("type"), F.coalesce("id", F.lit("unknown")).alias("transaction_id"),
        "fraud_score", "amount", F.col("currency_code").alias("currency"), F.current_timestamp().alias("logged_at"),
        "topic", "event_seq")


BATCH_METRICS = ("n_messages bigint, n_valid bigint, n_invalid bigint, n_transactions bigint, n_alerts bigint, "
                 "first_seq bigint, last_seq bigint")


def batch_metrics(tx_topic: str, alerts_topic: str) -> list[Column]:
    """What a delivery report tells of a micro-batch."""
    valid = F.col("is_valid")
    return [F.count(F.lit(1)).alias("n_messages"), F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("n_invalid"),
            F.count_if(valid & (F.col("topic") == tx_topic)).alias("n_transactions"),
            F.count_if(valid & (F.col("topic") == alerts_topic)).alias("n_alerts"),
            F.min("event_seq").alias("first_seq"), F.max("event_seq").alias("last_seq")]


class ConsumerSink:
    """``foreachBatch`` target writing quarantine, current state, alerts, logs and delivery reports."""

    def __init__(self, spark: SparkSession, root: str, tx_topic: str = "transactions", alerts_topic: str = "fraud_alerts"):
        self.spark, self.root = spark, root.rstrip("/")
        self.tx_topic, self.alerts_topic = tx_topic, alerts_topic
        self.transactions = UpsertTable(spark, f"{self.root}/transactions", "id", STATE_SCHEMA, ORDER, PRESENCE)
        self.alerts = UpsertTable(spark, f"{self.root}/fraud_alerts", "id", ALERT_SCHEMA, ORDER, PRESENCE)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # read, validated and parsed once, into files that all else reads: a batch of any size needs no
        # executor memory to be kept in, and files hold columns of one kind packed (a message's text only
        # where it is quarantined)
        aside = f"{self.root}/parsed/batch={batch_id}"
        bad = {c: F.when(~F.col("is_valid"), F.col(c)) for c in ("key", "value")}
        rows = parse(validate(batch).withColumns(bad)).drop("event_ts")
        try:
            rows.write.mode("overwrite").option("compression", "zstd").parquet(aside)
            parsed = batch.sparkSession.read.schema(rows.schema).parquet(aside)
            (parsed.filter(~F.col("is_valid"))
             .select("topic", "key", "value", "reason", F.lit(batch_id).cast("bigint").alias("batch_id"))
             .write.mode("overwrite").parquet(f"{self.root}/quarantine/batch={batch_id}"))
            events = parsed.filter(F.col("is_valid"))
            tx = events.filter(F.col("topic") == self.tx_topic)
            self.transactions.apply(self.transactions.fold(tx), batch_id)
            alerts = events.filter(F.col("topic") == self.alerts_topic).withColumn("flagged_at", F.current_timestamp())
            self.alerts.apply(self.alerts.fold(alerts), batch_id)
            (log_rows(alerts).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
             .write.mode("overwrite").parquet(f"{self.root}/logs/batch={batch_id}"))
            # counted on the parsed batch; not by an Observation, with which a session can no longer
            # ship fitted models to its executors
            report = parsed.agg(*batch_metrics(self.tx_topic, self.alerts_topic)).first().asDict()
            # the report comes last: a batch that has one is done
            write_text(self.spark, f"{self.root}/metrics/batch={batch_id}.json", json.dumps({"batch_id": batch_id, **report}))
        finally:
            remove(self.spark, aside)

    # -- readers -----------------------------------------------------------
    def _read_batches(self, name: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/{name}"):  # nothing written yet
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/{name}")

    def quarantine(self) -> DataFrame:
        return self._read_batches("quarantine", "topic string, key string, value string, reason string, "
                                  "batch_id bigint, batch int")

    def logs(self) -> DataFrame:
        return self._read_batches("logs", "type string, transaction_id string, fraud_score double, "
                                  "amount double, currency string, logged_at timestamp, topic string, event_seq bigint, "
                                  "batch_id bigint, batch int")


    def metrics(self) -> DataFrame:
        """One delivery report a finished micro-batch."""
        schema = f"batch_id bigint, {BATCH_METRICS}"
        if not path_exists(self.spark, f"{self.root}/metrics"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{self.root}/metrics/batch=*.json")


def start(spark: SparkSession, source: DataFrame, sink: ConsumerSink, checkpoint: str,
          trigger: dict | None = None):
    """Start the consumer query (default trigger: every 10 seconds)."""
    trigger = trigger or {"processingTime": "10 seconds"}
    return (source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Message stream from Parquet files (a stand-in for the Kafka source in tests)."""
    return (spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def kafka_source(spark: SparkSession, servers: str, topics: list[str], options: dict | None = None) -> DataFrame:
    """Message stream from Kafka: ``topic, key, value`` as text plus arrival order."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
           .options(**(options or {})).load())
    return raw.select("topic", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      F.col("timestamp").cast("timestamp_ntz").alias("event_ts"),
                      (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("event_seq"))


def progress(query) -> dict:
    """Rows read and batch id of the last trigger (``query.lastProgress``), for logs and alerts."""
    p = query.lastProgress or {}
    return {"batch_id": p.get("batchId"), "num_input_rows": p.get("numInputRows"),
            "sources": [s.get("description") for s in p.get("sources", [])]}
