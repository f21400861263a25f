"""Boundary values of the column rules (literal frames)."""

import datetime as dt

from pyspark.sql import functions as F

from paylake.functions import aggregates as A
from paylake.functions import rules as R


def test_rule_score_tiers_and_flags(spark):
    rows = [
        (1000.0, "desktop", "FR", 12, "success"),    # not > 1000
        (1000.01, "desktop", "FR", 12, "success"),   # > 1000
        (2000.0, "desktop", "FR", 12, "success"),
        (4000.0, "desktop", "FR", 12, "success"),    # not > 4000 -> 0.20
        (4000.01, "mobile", "NG", 22, "failed"),     # .35+.20+.15+.10+.15 = .95
        (50.0, None, None, 6, "success"),            # hour 6 is night
        (50.0, "tablet", "US", 7, "success"),        # hour 7 is day, US is high risk
        (50.0, "desktop", "DE", 21, "refunded"),
    ]
    df = spark.createDataFrame(rows, "amount double, device string, ip string, hour int, status string")
    got = [r[0] for r in df.select(R.fraud_score("amount", "device", "ip", "hour", "status")).collect()]
    assert got == [0.0, 0.1, 0.1, 0.2, 0.95, 0.15, 0.2, 0.0]


def test_rule_score_clips_with_noise(spark):
    df = spark.createDataFrame([(5000.0, "mobile", "NG", 23, "failed", 500), (10.0, "desktop", "FR", 12, "success", -500)],
                               "amount double, device string, ip string, hour int, status string, noise int")
    got = [r[0] for r in df.select(R.fraud_score("amount", "device", "ip", "hour", "status", "noise")).collect()]
    assert got == [1.0, 0.0]


def test_threshold_strict_and_null(spark):
    df = spark.createDataFrame([(0.7,), (0.7001,), (None,)], "s double")
    r = df.select(R.is_suspected("s").alias("a"), R.suspected_or_null("s").alias("b"),
                  R.route_topic("s").alias("t")).collect()
    assert [x.a for x in r] == [False, True, False]
    assert [x.b for x in r] == [False, True, None]
    assert [x.t for x in r] == ["transactions", "fraud_alerts", "transactions"]


def test_risk_bands_edges(spark):
    df = spark.createDataFrame([(0.4,), (0.40001,), (0.7,), (0.70001,), (None,)], "p double")
    assert [r[0] for r in df.select(R.risk_level("p")).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", None]


def test_day_of_week_conventions(spark):
    sunday = dt.datetime(2024, 1, 7, 10, 0)   # a Sunday
    monday = dt.datetime(2024, 1, 8, 10, 0)
    df = spark.createDataFrame([(sunday,), (monday,)], "ts timestamp_ntz")
    r = df.select(R.day_of_week_sun0("ts"), R.day_of_week_mon0("ts")).collect()
    assert [tuple(x) for x in r] == [(0, 6), (1, 0)]


def test_iso_week_53(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 31),), (dt.date(2021, 1, 3),)], "d date")
    assert [r[0] for r in df.select(F.weekofyear("d")).collect()] == [53, 53]


def test_cond_count_is_null_when_nothing_matches(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", 0.9)], "k string, s double")
    r = {x.k: x.n for x in df.groupBy("k").agg(A.cond_count(F.col("s") > 0.7).alias("n")).collect()}
    assert r == {"a": None, "b": 1}


def test_rate_rounds_half_up(spark):
    df = spark.createDataFrame([(3, 7), (1, 8), (None, 5)], "k bigint, n bigint")
    assert [r[0] for r in df.select(A.rate_pct("k", "n")).collect()] == [42.86, 12.5, None]


def test_one_hot_and_membership_null_is_zero(spark):
    df = spark.createDataFrame([("mobile", "NG"), (None, None), ("desktop", "FR")], "d string, c string")
    r = df.select(R.one_hot("d", "mobile"), R.in_set("c", ["US", "NG"])).collect()
    assert [tuple(x) for x in r] == [(1, 1), (0, 0), (0, 0)]


def test_pick_out_of_range_is_null(spark):
    df = spark.range(0, 4)
    assert [r[0] for r in df.select(R.pick(["a", "b", "c"], F.col("id"))).collect()] == ["a", "b", "c", None]


def test_with_hour_keeps_date_minutes_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 17, 42, 9),)], "ts timestamp_ntz")
    assert df.select(R.with_hour("ts", 3)).first()[0] == dt.datetime(2024, 3, 5, 3, 42, 9)
