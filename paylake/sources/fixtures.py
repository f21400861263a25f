"""Map the driver's test tables onto the payments data model.

The test tables are TPC-H-like (orders, lineitem, customer, supplier) plus an
``events`` table.  Each payments table is a narrow projection of one of them,
so every query's work grows with the test data.  The same mapping is written
in SQL in ``paylake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.functions import domains as D
from paylake.functions import rules as R
from paylake.streaming.cdc import iso_utc

IP12 = D.COUNTRIES + ["RU", "CN", "BR", "NG"]
CUSTOMER_EPOCH = "2023-01-01 00:00:00"
MERCHANT_EPOCH = "2022-01-01 00:00:00"
SECONDS_PER_YEAR = 31536000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions`` from ``orders`` (one scalar, the supplier count)."""
    o = table(spark, sf_dir, "orders")
    n_merchants = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    cents = F.floor("o_totalprice").cast("bigint")
    sec = (k * 7919) % 86400
    prio = F.substring("o_orderpriority", 1, 1)
    st = F.col("o_orderstatus")
    status = (F.when(st == "O", "success")
              .when(st == "P", F.when(prio.isin("1", "2"), "pending").otherwise("success"))
              .when(st == "F", F.when(prio.isin("4", "5"), "refunded").otherwise("failed")))
    device = F.when(k % 50 == 49, F.lit(None).cast("string")).otherwise(R.pick(D.DEVICES, (k + c) % 3))
    ip = R.pick(IP12, (k * 7 + c) % 13)
    base = o.select(
        k.alias("id"),
        c.alias("customer_id"),
        ((k * 13) % n_merchants).alias("merchant_id"),
        (k % 3 + 1).cast("smallint").alias("payment_method_id"),
        R.pick(D.CURRENCIES, k % 5).alias("currency_code"),
        (cents / F.lit(100.0)).alias("amount"),
        status.alias("status"),
        device.alias("device_type"),
        ip.alias("ip_country"),
        (F.floor(sec / 3600)).alias("_hour"),
        (((k * 104729) % 1001) - 500).alias("_noise"),
        F.timestamp_add("SECOND", sec, F.col("o_orderdate")).alias("created_at"),
    )
    score = R.fraud_score("amount", "device_type", "ip_country", "_hour", "status", "_noise")
    return base.select(
        "id", "customer_id", "merchant_id", "payment_method_id", "currency_code", "amount",
        "status", "device_type", "ip_country",
        F.when(F.col("id") % 97 == 96, F.lit(None).cast("double")).otherwise(score).alias("fraud_score"),
        "created_at",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customers`` from ``customer``; the e-mail is hashed, never kept."""
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    created = F.timestamp_add("SECOND", (k * 7919) % SECONDS_PER_YEAR,
                              F.lit(CUSTOMER_EPOCH).cast("timestamp_ntz"))
    return cu.select(
        k.alias("id"),
        F.sha2(F.concat(F.col("c_name"), F.lit("@example.com")), 256).alias("email_hash"),
        F.when(k % 40 == 39, F.lit(None).cast("string"))
         .otherwise(R.pick(D.COUNTRIES, F.col("c_nationkey") % 8)).alias("country_code"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def customer_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw e-mail addresses (input of the pseudonymisation step)."""
    cu = table(spark, sf_dir, "customer")
    return cu.select(F.col("c_custkey").alias("id"),
                     F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"))


def merchants(spark: SparkSession, sf_dir: str, colliding_names: bool = False) -> DataFrame:
    """``merchants`` from ``supplier``.

    ``colliding_names`` gives 60 distinct names so that same-named merchants
    exist (the by-name report fuses them).
    """
    s = table(spark, sf_dir, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    name = (F.concat(F.lit("Merchant-"), (k % 60).cast("string")) if colliding_names
            else F.col("s_name"))
    created = F.timestamp_add("SECOND", (k * 7919) % SECONDS_PER_YEAR,
                              F.lit(MERCHANT_EPOCH).cast("timestamp_ntz"))
    return s.select(
        k.alias("id"),
        name.alias("name"),
        R.pick(D.COUNTRIES, (n * 3 + k) % 8).alias("country_code"),
        R.pick(D.CATEGORIES, n % 5).alias("category"),
        created.alias("created_at"),
    )


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``refunds``: one per order with returned line items."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return (li.filter(F.col("l_returnflag") == "R")
            .groupBy(k.alias("transaction_id"))
            .agg(F.max("l_shipdate").alias("created_at"))
            .select(
                F.col("transaction_id").alias("id"),
                "transaction_id",
                (F.col("transaction_id") % 50 + 1).cast("double").alias("amount"),
                R.pick(["duplicate", "fraudulent", "requested"], F.col("transaction_id") % 4).alias("reason"),
                "created_at",
            ))


def tx_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log with repeated keys, as parsed change rows.

    One row per change: ``id``, ordering ``(_ts, _seq)`` which has no ties
    within an id, the field values, and ``device_type`` only present when the
    line is open (``device_type__present``).
    """
    li = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").alias("_ts"),
        F.struct(F.floor("l_extendedprice").cast("bigint").alias("p"),
                 F.col("l_partkey").alias("k")).alias("_seq"),
        F.col("l_partkey").alias("customer_id"),
        F.col("l_suppkey").alias("merchant_id"),
        R.pick(D.CURRENCIES, F.col("l_orderkey") % 5).alias("currency_code"),
        (F.floor("l_extendedprice") / F.lit(100.0)).alias("amount"),
        F.when(flag == "A", "failed").when(flag == "R", "refunded").otherwise("success").alias("status"),
        F.when(F.col("l_linestatus") == "O", F.lit("mobile")).alias("device_type"),
        (F.col("l_linestatus") == "O").alias("device_type__present"),
        F.round(F.col("l_discount") * 10, 1).alias("fraud_score"),
    )


def tx_change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as keyed JSON messages (absent keys really absent).

    ``event_seq`` is the arrival order: day, then ``(floor(price), partkey)``, packed into one long.
    """
    ch = tx_changes(spark, sf_dir)
    body = F.struct(
        F.col("id").cast("string").alias("id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("merchant_id").cast("string").alias("merchant_id"),
        F.col("amount"), F.col("currency_code"), F.col("status"), F.col("device_type"),
        F.col("fraud_score"),
        iso_utc("_ts").alias("created_at"))
    return ch.select(
        F.lit("transactions").alias("topic"),
        F.col("id").cast("string").alias("key"),
        # to_json drops NULL fields: device_type is absent for closed lines
        F.to_json(body).alias("value"),
        F.col("_ts").alias("event_ts"),
        (F.datediff("_ts", F.lit("1970-01-01").cast("date")).cast("long") * F.lit(200000000000000)
         + F.col("_seq.p") * F.lit(1000000000) + F.col("_seq.k")).alias("event_seq"),
    )


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as broker messages ``topic, key, value, event_ts``.

    ``merchant_id`` is absent for error events, which makes them invalid.
    """
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    score = F.when(eid % 20 == 0, F.lit(None).cast("double")).otherwise(k / F.lit(100.0))
    fields = F.struct(
        eid.cast("string").alias("id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(F.col("event_type") != "error", (eid % 10).cast("string")).alias("merchant_id"),
        F.col("value").alias("amount"),
        R.pick(D.CURRENCIES, eid % 5).alias("currency_code"),
        score.alias("fraud_score"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
    )
    return ev.select(
        R.route_topic(score).alias("topic"),
        eid.cast("string").alias("key"),
        # fraud_score is written as null when unknown; merchant_id is left out
        F.to_json(fields, {"ignoreNullFields": "false"}).alias("_with_nulls"),
        F.to_json(fields).alias("_no_nulls"),
        F.col("ts").alias("event_ts"),
        eid.alias("event_seq"),
        F.col("event_type"),
    ).select(
        "topic", "key",
        F.when(F.col("event_type") == "error", F.col("_no_nulls")).otherwise(F.col("_with_nulls")).alias("value"),
        "event_ts", "event_seq",
    )


def reference_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Reference tables as the data would fill them: every code that transactions use, named where it is known."""
    from paylake.sources import reference
    tx = transactions(spark, sf_dir)

    def seen(column: str, key: str, known: DataFrame) -> DataFrame:
        used = tx.select(F.col(column).alias(key)).filter(F.col(key).isNotNull()).distinct()
        return used.join(F.broadcast(known), key, "left").select(*known.columns)

    return {"currencies": seen("currency_code", "code", reference.currencies(spark)),
            "countries": seen("ip_country", "code", reference.countries(spark)),
            "payment_methods": seen("payment_method_id", "id", reference.payment_methods(spark))}
