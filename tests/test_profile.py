"""The payments tables mapped from the test data have the documented profile."""

from pyspark.sql import functions as F

from paylake.functions import rules as R
from paylake.sources import fixtures as fx
from tests.conftest import SF_ORACLE, SF_SMALL


def test_transaction_profile_sf001(spark):
    tx = fx.transactions(spark, SF_ORACLE)
    by = {r.status: (r.n, r.k, r.s) for r in tx.groupBy("status").agg(
        F.count("*").alias("n"), F.count_if(R.is_suspected()).alias("k"),
        F.sum(F.col("amount").cast("decimal(12,2)")).alias("s")).collect()}
    assert {k: v[0] for k, v in by.items()} == {"failed": 2958, "pending": 2014, "refunded": 1975, "success": 8053}
    assert {k: v[1] for k, v in by.items()} == {"failed": 326, "pending": 36, "refunded": 30, "success": 144}
    assert str(by["success"][2]) == "20132964.64"
    assert tx.filter(F.col("ip_country").isNull()).count() == 1194
    assert abs(tx.select(F.percentile("amount", 0.95)).first()[0] - 4750.9625) < 1e-9


def test_change_log_and_events_profile(spark):
    ch = fx.tx_changes(spark, SF_SMALL)
    assert ch.count() == 6000 and ch.select("id").distinct().count() == 4599
    assert ch.filter(F.col("fraud_score") > 0.7).count() == 1482
    from paylake.streaming import consumer
    ev = consumer.validate(fx.tx_events(spark, SF_SMALL))
    assert ev.filter(~F.col("is_valid")).count() == 201
    assert ev.filter(F.col("topic") == "fraud_alerts").count() == 272
    assert ev.filter(F.col("is_valid") & (F.col("topic") == "fraud_alerts")).count() == 205
    assert ev.filter(F.col("is_valid") & (F.col("topic") == "transactions")).count() == 594
