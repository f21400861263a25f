"""Report operators on literal frames: bounded top-k join equals join-then-top-k."""

import datetime as dt

from pyspark.sql import functions as F

from paylake.operators import reports


def _tables(spark, n=300, missing_top=100):
    ts = dt.datetime(2024, 1, 1)
    tx = [(i, 0.71 + (n - i) / (10 * n), "EUR", 10.0, "success", ts, (i if i >= missing_top else 10_000 + i))
          for i in range(n)]
    tx_df = spark.createDataFrame(tx, "id bigint, fraud_score double, currency_code string, amount double, "
                                      "status string, created_at timestamp_ntz, merchant_id bigint")
    m_df = spark.createDataFrame([(i, f"m{i}", "retail") for i in range(n)], "id bigint, name string, category string")
    return tx_df, m_df


def _brute(tx, m, k):
    j = tx.join(m.select(F.col("id").alias("merchant_id"), F.col("name").alias("merchant"), "category"), "merchant_id")
    return [r.id for r in j.orderBy(F.col("fraud_score").desc(), F.col("id")).limit(k).collect()]


def test_topk_join_expands_candidates(spark):
    tx, m = _tables(spark)
    got = [r.id for r in reports.suspicious_transactions(tx, m, k=5).collect()]
    assert got == _brute(tx, m, 5) == [100, 101, 102, 103, 104]


def test_topk_plan_is_lazy_and_has_no_global_sort(spark):
    tx, m = _tables(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("topk", "plan only")
    df = reports.suspicious_transactions(tx, m, k=5)
    assert not tracker.getJobIdsForGroup("topk")
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    spark.sparkContext._jsc.clearJobGroup()


def test_reports_are_ordered(spark):
    ts = dt.datetime(2024, 1, 3)
    tx = spark.createDataFrame(
        [(i, i % 4, i % 3, 10.0 * (i % 5 + 1), ["EUR", "USD", "GBP"][i % 3], ["success", "failed"][i % 2],
          [0.9, 0.1, None, float("nan")][i % 4], "mobile", [None, "FR", "NG"][i % 3], ts - dt.timedelta(hours=9 * i)) for i in range(40)],
        "id long, customer_id long, merchant_id long, amount double, currency_code string, status string, fraud_score double, "
        "device_type string, ip_country string, created_at timestamp_ntz")
    customers = spark.createDataFrame([(0, "FR"), (1, None), (2, "DE"), (3, "FR")], "id long, country_code string")
    days = [(r.day, r.status) for r in reports.daily_volume_by_status(tx).collect()]
    assert days == sorted(days, key=lambda x: (-x[0].toordinal(), x[1])) and len(days) > 4
    rates = [r.fraud_rate_pct for r in reports.fraud_rate_by_customer_country(tx, customers).collect()]
    assert [r for r in rates if r is not None] == sorted((r for r in rates if r is not None), reverse=True)
    assert all(r is None for r in rates[len([r for r in rates if r is not None]):])
    revenue = [r.total_revenue for r in reports.revenue_by_currency(tx).collect()]
    assert revenue == sorted(revenue, reverse=True)
    assert tx.filter(reports.R.is_suspected("fraud_score")).count() == 10  # NaN is no score


def test_topk_when_fewer_rows_than_k(spark):
    tx, m = _tables(spark, n=20, missing_top=17)
    got = [r.id for r in reports.suspicious_transactions(tx, m, k=50).collect()]
    assert got == [17, 18, 19]
