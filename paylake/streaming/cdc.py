"""Change-data capture: table rows -> keyed JSON messages, routed by score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions import rules as R

EVENT_FIELDS = ["id", "customer_id", "merchant_id", "amount", "currency_code", "status",
                "fraud_score", "device_type", "ip_country", "created_at"]


def iso_utc(col: str) -> Column:
    """Full ISO text of a UTC timestamp (NULL stays NULL)."""
    return F.concat(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def to_messages(transactions: DataFrame, alerts_topic: str = "fraud_alerts",
                tx_topic: str = "transactions", mirror_alerts: bool = False) -> DataFrame:
    """``topic, key, value`` rows ready for a Kafka sink.

    Ids are text, amounts and scores doubles, ``created_at`` ISO text with microseconds and the UTC offset; NULL
    fields are written as ``null`` (not dropped).  Routing is exclusive: a
    suspected transaction goes to the alert topic only, unless
    ``mirror_alerts`` also sends it to the transaction topic.
    """
    body = F.struct(
        F.col("id").cast("string").alias("id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("merchant_id").cast("string").alias("merchant_id"),
        F.col("amount").cast("double").alias("amount"),
        "currency_code", "status",
        F.col("fraud_score").cast("double").alias("fraud_score"),
        "device_type", "ip_country",
        iso_utc("created_at").alias("created_at"))
    out = transactions.select(
        R.route_topic("fraud_score", alerts_topic, tx_topic).alias("topic"),
        F.col("id").cast("string").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))
    if mirror_alerts:
        out = out.unionByName(out.filter(F.col("topic") == alerts_topic)
                              .withColumn("topic", F.lit(tx_topic)))
    return out


def write_kafka(messages: DataFrame, servers: str, options: dict | None = None) -> None:
    """Publish ``topic, key, value`` rows (needs the Kafka connector on the classpath)."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .options(**(options or {})).save())
