"""Reference rows (currencies, countries, payment methods, ISO map).

These are fixed, tiny tables; they are the only ones broadcast without a
size check because their size does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.functions import domains as D


def currencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(D.CURRENCY_ROWS, "code string, name string")


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(D.COUNTRY_ROWS, "code string, name string, region string")


def payment_methods(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(D.PAYMENT_METHOD_ROWS, "id smallint, name string")


def iso_alpha3(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(D.ISO_ALPHA3.items()), "ip_country string, iso_alpha3 string")
