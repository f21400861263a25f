"""Star schema: dimensions, fact table, pre-aggregates, row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions import aggregates as A
from paylake.functions import rules as R


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("id").alias("customer_key"), "email_hash", "country_code",
        F.col("created_at").alias("customer_since"))


def dim_merchant(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        F.col("id").alias("merchant_key"), F.col("name").alias("merchant_name"),
        F.col("country_code").alias("merchant_country"),
        F.col("category").alias("merchant_category"))


def dim_time(transactions: DataFrame) -> DataFrame:
    """Distinct dates with their parts.

    The date is projected and de-duplicated first (partial aggregation keeps
    the shuffle to one row per date and partition); the parts are derived from
    the distinct dates only.
    """
    d = transactions.select(F.to_date("created_at").alias("date_key")).distinct()
    return d.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
        R.day_of_week_sun0("date_key").alias("day_of_week"),
        F.weekofyear("date_key").alias("week_of_year"),
        F.quarter("date_key").alias("quarter"),
    )


def dim_payment_method(transactions: DataFrame, payment_methods: DataFrame | None = None) -> DataFrame:
    """Distinct payment method ids.

    As in the original, ``method_name`` repeats the id; pass the
    ``payment_methods`` reference table to get the real name instead.
    """
    d = transactions.select(F.col("payment_method_id").alias("payment_method_key")).distinct()
    if payment_methods is None:
        return d.select("payment_method_key", F.col("payment_method_key").alias("method_name"))
    pm = F.broadcast(payment_methods.select(F.col("id").alias("payment_method_key"),
                                            F.col("name").alias("method_name")))
    return d.join(pm, "payment_method_key", "left")


def fact_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        F.col("id").alias("transaction_key"),
        F.col("customer_id").alias("customer_key"),
        F.col("merchant_id").alias("merchant_key"),
        F.to_date("created_at").alias("date_key"),
        F.col("payment_method_id").alias("payment_method_key"),
        "currency_code", "amount", "status", "device_type", "ip_country", "fraud_score",
        R.is_suspected("fraud_score").alias("is_fraud_suspected"),
        "created_at",
    )


def agg_daily_revenue(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("date_key", "currency_code").agg(
        F.count(F.lit(1)).alias("nb_transactions"),
        A.money_sum("amount").alias("total_revenue"),
        A.money_avg("amount").alias("avg_amount"),
        A.cond_count(F.col("status") == "success").alias("nb_success"),
        A.cond_count(F.col("status") == "failed").alias("nb_failed"),
        A.cond_count("is_fraud_suspected").alias("nb_fraud_suspected"),
    ))


def agg_merchant_performance(fact: DataFrame, dim_merch: DataFrame) -> DataFrame:
    """Per merchant volume.

    The fact is aggregated by ``merchant_key`` first (map-side partial
    aggregation), then the small per-merchant result is joined to the
    dimension: the join moves one row per merchant, not one per transaction.
    Sums and counts compose, so this equals join-then-aggregate.
    """
    per_key = fact.groupBy("merchant_key").agg(
        F.count(F.lit(1)).alias("nb_transactions"),
        F.sum(F.col("amount").cast("decimal(12,2)")).alias("_vol"),
        F.count("amount").alias("_n_amount"),
        A.cond_count("is_fraud_suspected").alias("nb_fraud"),
    )
    return per_key.join(dim_merch.select("merchant_key", "merchant_name", "merchant_category"),
                        "merchant_key", "inner").select(
        "merchant_key", "merchant_name", "merchant_category", "nb_transactions",
        F.col("_vol").cast("double").alias("total_volume"),
        (F.col("_vol").cast("double") / F.col("_n_amount")).alias("avg_transaction"),
        "nb_fraud",
    )


def agg_fraud_by_country(fact: DataFrame) -> DataFrame:
    return (fact.filter(F.col("ip_country").isNotNull())
            .groupBy("ip_country").agg(
                F.count(F.lit(1)).alias("total"),
                A.cond_count("is_fraud_suspected").alias("nb_fraud"),
                A.money_avg("fraud_score", "decimal(5,4)").alias("avg_fraud_score"))
            .select("ip_country", "total", "nb_fraud",
                    A.rate_pct("nb_fraud", "total").alias("fraud_rate_pct"),
                    "avg_fraud_score"))


def build(transactions: DataFrame, customers: DataFrame, merchants: DataFrame) -> dict[str, DataFrame]:
    """All star tables by name (lazy; materialise them with ``lake.write_star``)."""
    fact = fact_transactions(transactions)
    dm = dim_merchant(merchants)
    return {
        "dim_customer": dim_customer(customers),
        "dim_merchant": dm,
        "dim_time": dim_time(transactions),
        "dim_payment_method": dim_payment_method(transactions),
        "fact_transactions": fact,
        "agg_daily_revenue": agg_daily_revenue(fact),
        "agg_merchant_performance": agg_merchant_performance(fact, dm),
        "agg_fraud_by_country": agg_fraud_by_country(fact),
    }


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` for each table, as one union of global counts."""
    parts = [df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
