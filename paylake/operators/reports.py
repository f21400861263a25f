"""Operational and revenue reports (the five key queries and the report pages)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions import aggregates as A
from paylake.functions import rules as R
from paylake.sources import reference


def suspicious_transactions(transactions: DataFrame, merchants: DataFrame, k: int = 50) -> DataFrame:
    """Top-k suspected transactions by score, with merchant name and category.

    Filter, join, then a top-k per partition (``TakeOrderedAndProject``, no global sort): one lazy
    plan for every size.  Only suspected rows and the needed columns reach the join; ``id`` breaks ties.
    """
    order = [F.col("fraud_score").desc(), F.col("id").asc()]
    t = transactions.filter(R.suspected_or_null("fraud_score"))
    m_cols = merchants.select(F.col("id").alias("merchant_id"), F.col("name").alias("merchant"), "category")
    return t.join(m_cols, "merchant_id", "inner").orderBy(*order).limit(k).select(
        "id", "amount", "currency_code", "fraud_score", "status", "created_at", "merchant", "category")


def as_of_max(transactions: DataFrame) -> "F.Column":
    """The newest ``created_at`` as a scalar subquery (a data-derived "now")."""
    return transactions.select(F.max("created_at")).scalar()


def daily_volume_by_status(transactions: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Volume per day and status over the ``days`` days before ``as_of``.

    ``as_of`` replaces ``NOW()`` so the report is repeatable; default is the
    newest transaction.  The predicate is a plain range on ``created_at``.
    """
    now = as_of_max(transactions) if as_of is None else (
        F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of)
    t = transactions.filter(F.col("created_at") >= now - F.make_dt_interval(F.lit(days)))
    return (t.groupBy(F.to_date("created_at").alias("day"), "status")
            .agg(F.count(F.lit(1)).alias("nb_transactions"),
                 A.money_sum("amount").alias("total_amount"))
            .orderBy(F.col("day").desc(), F.col("status").asc()))


def daily_volume_pruned(fact: DataFrame, dim_time: DataFrame, newest, days: int = 7) -> DataFrame:
    """``daily_volume_by_status`` over a stored fact with a folder a day.

    The days come from the filtered ``dim_time``; the join prunes the fact's folders while the
    query runs.  ``newest``: the newest day there is (from the folder names); the exact end of the
    window is read from that day alone.
    """
    last = F.lit(newest).cast("date")
    now = fact.filter(F.col("date_key") == last).select(F.max("created_at")).scalar()
    wanted = dim_time.filter(F.col("date_key") >= F.date_sub(last, days)).select(F.col("date_key").alias("day"))
    t = fact.join(wanted, fact["date_key"] == wanted["day"]).filter(F.col("created_at") >= now - F.make_dt_interval(F.lit(days)))
    return (t.groupBy("day", "status")
            .agg(F.count(F.lit(1)).alias("nb_transactions"), A.money_sum("amount").alias("total_amount"))
            .orderBy(F.col("day").desc(), F.col("status").asc()))


def _merchant_volume(transactions: DataFrame) -> DataFrame:
    """Successful volume per merchant id: aggregate before any join."""
    return (transactions.filter(F.col("status") == "success")
            .groupBy("merchant_id")
            .agg(F.count("id").alias("nb_transactions"),
                 F.sum(F.col("amount").cast("decimal(12,2)")).alias("_vol")))


def top_merchants(transactions: DataFrame, merchants: DataFrame, k: int = 10) -> DataFrame:
    """Top-k merchants (grouped by merchant id, name, category) by successful volume."""
    per = _merchant_volume(transactions)
    m = merchants.select(F.col("id").alias("merchant_id"), "name", "category")
    return (per.join(m, "merchant_id", "inner")
            .orderBy(F.col("_vol").desc(), F.col("merchant_id").asc())
            .limit(k)
            .select("name", "category", "nb_transactions",
                    F.col("_vol").cast("double").alias("total_volume")))


def top_merchants_by_name(transactions: DataFrame, merchants: DataFrame, k: int = 10) -> DataFrame:
    """Top-k by (name, category): same-named merchants are fused.

    Per-merchant partial sums are re-aggregated by name after the join.
    """
    per = transactions.filter(F.col("status") == "success").groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("amount").cast("decimal(12,2)")).alias("_vol"))
    m = merchants.select(F.col("id").alias("merchant_id"), "name", "category")
    return (per.join(m, "merchant_id", "inner")
            .groupBy("name", "category")
            .agg(F.sum("_n").alias("nb_transactions"), F.sum("_vol").alias("_vol"))
            .orderBy(F.col("_vol").desc(), F.col("name").asc(), F.col("category").asc())
            .limit(k)
            .select(F.col("name").alias("merchant"), "category", "nb_transactions",
                    F.col("_vol").cast("double").alias("total_volume")))


def fraud_rate_by_customer_country(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Fraud rate per customer country; customers without a country form a NULL group.

    Transactions are first reduced to one row per customer (count and
    suspected count), so the join with customers moves per-customer partials.
    """
    per_cust = transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"),
        A.cond_count(R.suspected_or_null("fraud_score")).alias("_k"))
    c = customers.select(F.col("id").alias("customer_id"), "country_code")
    return (per_cust.join(c, "customer_id", "inner")
            .groupBy("country_code")
            .agg(F.sum("_n").alias("total"), F.sum("_k").alias("suspected_fraud"))
            .select("country_code", "total", "suspected_fraud",
                    A.rate_pct("suspected_fraud", "total").alias("fraud_rate_pct"))
            .orderBy(F.col("fraud_rate_pct").desc_nulls_last(), F.col("country_code").asc_nulls_last()))


def refunds_to_reconcile(refunds: DataFrame, transactions: DataFrame) -> DataFrame:
    """Refunds whose transaction is not marked refunded, newest refund first."""
    t = transactions.filter(F.col("status") != "refunded").select(
        F.col("id").alias("transaction_id"), F.col("amount").alias("original_amount"), "status",
        F.col("created_at").alias("transaction_date"))
    return (refunds.join(t, "transaction_id", "inner")
            .select(F.col("id").alias("refund_id"), F.col("amount").alias("refund_amount"),
                    "original_amount", "status", "transaction_date",
                    F.col("created_at").alias("refund_date"), "reason")
            .orderBy(F.col("refund_date").desc(), F.col("refund_id").asc()))


def kpi_overview(transactions: DataFrame) -> DataFrame:
    """Global KPIs; one row even on empty input."""
    return transactions.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        A.money_sum("amount").alias("total_revenue"),
        A.money_avg("amount").alias("avg_amount"),
        A.cond_count(R.suspected_or_null("fraud_score")).alias("fraud_count"))


def revenue_by_currency(transactions: DataFrame) -> DataFrame:
    return (transactions.filter(F.col("status") == "success")
            .groupBy("currency_code")
            .agg(F.count(F.lit(1)).alias("nb_transactions"),
                 A.money_sum("amount").alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("currency_code").asc()))


def fraud_by_country(transactions: DataFrame) -> DataFrame:
    """The report-page form of the country aggregate (reads raw transactions)."""
    from paylake.operators import star
    return star.agg_fraud_by_country(star.fact_transactions(transactions)).orderBy(
        F.col("fraud_rate_pct").desc_nulls_last(), F.col("ip_country").asc())


def fraud_by_country_iso3(fraud_by_ip_country: DataFrame) -> DataFrame:
    """Add the ISO alpha-3 code; codes outside the 12-entry map give NULL.

    The map is a fixed 12-row table, so broadcasting it is bounded.
    """
    iso = F.broadcast(reference.iso_alpha3(fraud_by_ip_country.sparkSession))
    return fraud_by_ip_country.join(iso, "ip_country", "left")
