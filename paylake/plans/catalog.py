"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query maps the test tables to the payments model
(``paylake.sources.fixtures``) and runs one operator over the whole tables.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paylake import session
from paylake.functions import rules as R
from paylake.operators import reports, star
from paylake.sources import fixtures as fx
from paylake.sources import commits, lake, reference, schemas

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


def _tx(spark, d):
    return fx.transactions(spark, d)


# --- sources -----------------------------------------------------------------

@register("scan_transactions")
def q_scan_transactions(spark, d):
    return _tx(spark, d)


@register("scan_projected")
def q_scan_projected(spark, d):
    return _tx(spark, d).select("id", "customer_id", "merchant_id", "amount", "currency_code", "status",
                                "payment_method_id", "device_type", "ip_country", "fraud_score", "created_at")


@register("export_day_slice")
def q_export_day_slice(spark, d):
    """The newest day's slice, as the daily export reads it."""
    tx = _tx(spark, d)
    day = tx.select(F.to_date(F.max("created_at"))).scalar()
    return lake.read_day_slice(tx, day)


@register("ref_countries")
def q_ref_countries(spark, d):
    """Customers per country with the reference country name and region."""
    c = fx.customers(spark, d)
    ref = F.broadcast(reference.countries(spark).select(
        F.col("code").alias("country_code"), F.col("name").alias("country_name"), "region"))
    per = c.groupBy("country_code").agg(F.count(F.lit(1)).alias("n_customers"))
    return per.join(ref, "country_code", "left").select("country_code", "country_name", "region", "n_customers")


# --- star schema -----------------------------------------------------------------

def _star(spark, d) -> dict[str, DataFrame]:
    return star.build(_tx(spark, d), fx.customers(spark, d), fx.merchants(spark, d))


for _name in ["dim_customer", "dim_merchant", "dim_time", "dim_payment_method", "fact_transactions",
              "agg_daily_revenue", "agg_merchant_performance", "agg_fraud_by_country"]:
    register(_name)(lambda spark, d, _n=_name: _star(spark, d)[_n])


@register("table_row_counts")
def q_table_row_counts(spark, d):
    return star.row_counts(_star(spark, d))


# --- reports -----------------------------------------------------------------------

@register("suspicious_transactions")
def q_suspicious(spark, d):
    return reports.suspicious_transactions(_tx(spark, d), fx.merchants(spark, d))


@register("daily_volume_by_status")
def q_daily_volume(spark, d):
    return reports.daily_volume_by_status(_tx(spark, d))


@register("top_merchants")
def q_top_merchants(spark, d):
    return reports.top_merchants(_tx(spark, d), fx.merchants(spark, d))


@register("top_merchants_by_name")
def q_top_merchants_by_name(spark, d):
    return reports.top_merchants_by_name(_tx(spark, d), fx.merchants(spark, d, colliding_names=True))


@register("fraud_rate_by_customer_country")
def q_fraud_rate_customer_country(spark, d):
    return reports.fraud_rate_by_customer_country(_tx(spark, d), fx.customers(spark, d))


@register("refunds_to_reconcile")
def q_refunds(spark, d):
    return reports.refunds_to_reconcile(fx.refunds(spark, d), _tx(spark, d))


@register("kpi_overview")
def q_kpi(spark, d):
    return reports.kpi_overview(_tx(spark, d))


@register("revenue_by_currency")
def q_revenue_by_currency(spark, d):
    return reports.revenue_by_currency(_tx(spark, d))


@register("fraud_by_country_iso3")
def q_fraud_iso3(spark, d):
    return reports.fraud_by_country_iso3(reports.fraud_by_country(_tx(spark, d)))


@register("pseudonymise")
def q_pseudonymise(spark, d):
    """SHA-256 hex of the raw e-mail bytes; the address itself is dropped."""
    e = fx.customer_emails(spark, d)
    return e.select("id", F.sha2(F.col("email"), 256).alias("email_hash"))


@register("cdc_route_counts")
def q_cdc_route_counts(spark, d):
    return (_tx(spark, d).select(R.route_topic("fraud_score").alias("topic"))
            .groupBy("topic").agg(F.count(F.lit(1)).alias("n_messages")))


@register("amount_p95")
def q_amount_p95(spark, d):
    """Exact 95th percentile of amount, linear interpolation."""
    tx = _tx(spark, d)
    return tx.agg(FE.amount_threshold(tx).alias("amount_p95"), F.count(F.lit(1)).alias("n_rows"))


@register("amount_quantile_sketch")
def q_amount_quantile_sketch(spark, d):
    """95th percentile per merchant from sketches a day and merchant in two batches; is its true rank within the bound?"""
    tx = _tx(spark, d).select("id", "merchant_id", "amount", F.to_date("created_at").alias("day"))
    table = QS.SketchTable(spark, session.work_path(spark, "sketches"), "day date, merchant_id bigint")
    for b in range(2):
        table.apply(tx.filter(F.col("id") % 2 == b), b)
    found = QS.quantile(QS.merged(table.read(), ["merchant_id"]), 0.95)
    x = tx.join(found, "merchant_id")
    ranks = x.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("n_values").alias("n_values"),
                                         (F.count_if(F.col("amount") < F.col("estimate")) / F.count(F.lit(1))).alias("below"),
                                         (F.count_if(F.col("amount") <= F.col("estimate")) / F.count(F.lit(1))).alias("upto"))
    return ranks.select("merchant_id", "n_rows", "n_values",
                        ((F.col("below") <= 0.95 + QS.RANK_ERROR) & (F.col("upto") >= 0.95 - QS.RANK_ERROR)).alias("within_bound"))


@register("rule_fraud_score")
def q_rule_fraud_score(spark, d):
    """Rule score without noise next to the stored score."""
    tx = _tx(spark, d)
    rule = R.fraud_score("amount", "device_type", "ip_country", F.hour("created_at"), "status")
    return tx.select("id", rule.alias("rule_score"), "fraud_score").select(
        "id", "rule_score", "fraud_score",
        (F.abs(F.col("fraud_score") - F.col("rule_score")) <= F.lit(0.05)).alias("within_noise"))


# --- data quality -------------------------------------------------------------------

from paylake.operators import audit  # noqa: E402
from paylake.operators import features as FE  # noqa: E402
from paylake.operators import incremental as IN  # noqa: E402
from paylake.operators import metrics as M  # noqa: E402
from paylake.operators import model as ML  # noqa: E402
from paylake.operators import quality as Q  # noqa: E402
from paylake.operators import quantiles as QS  # noqa: E402
from paylake.operators import upsert as U  # noqa: E402
from paylake.plans import replay  # noqa: E402
from paylake.streaming import cdc, consumer, dedup  # noqa: E402


def _tables(spark, d) -> dict[str, DataFrame]:
    return {"transactions": _tx(spark, d), "customers": fx.customers(spark, d),
            "merchants": fx.merchants(spark, d), "refunds": fx.refunds(spark, d)}


def _refs(spark) -> dict[str, DataFrame]:
    return {"currencies": reference.currencies(spark), "countries": reference.countries(spark),
            "payment_methods": reference.payment_methods(spark)}


@register("dq_not_null")
def q_dq_not_null(spark, d):
    return Q.not_null(_tables(spark, d))


@register("dq_checks")
def q_dq_checks(spark, d):
    return Q.value_checks(_tables(spark, d))


@register("dq_unique_keys")
def q_dq_unique_keys(spark, d):
    return Q.unique_keys(_tables(spark, d))


@register("dq_foreign_keys")
def q_dq_foreign_keys(spark, d):
    return Q.foreign_keys(_tables(spark, d), _refs(spark))


@register("dq_reference_tables")
def q_dq_reference_tables(spark, d):
    """All rules of the reference tables, as the data fills them, and of an audit log of the change log."""
    log = audit_rows(spark, d).select(F.monotonically_increasing_id().alias("id"), "*", F.lit(AUDIT_RUN[0]).alias("changed_by"),
                                      F.lit(AUDIT_RUN[1]).cast("timestamp_ntz").alias("changed_at"))
    return Q.reference_checks({**fx.reference_tables(spark, d), "audit_logs": log})


@register("raw_table_counts")
def q_raw_table_counts(spark, d):
    """Rows of the raw tables, stored with their declared types and read with them."""
    tables = _stored(spark, d)
    return star.row_counts(tables)


@register("typed_transactions")
def q_typed_transactions(spark, d):
    return _stored(spark, d, ("transactions",))["transactions"]


def _stored(spark, d, names=("transactions", "customers", "merchants")) -> dict[str, DataFrame]:
    root = session.work_path(spark, "raw")
    out = {}
    for n in names:
        kind = schemas.schema(n, "bigint")
        lake.write_table(lake.conform(_tables(spark, d)[n], kind), f"{root}/{n}")
        out[n] = lake.read_table(spark, f"{root}/{n}", kind)
    return out


CHANGE_FIELDS = ["customer_id", "merchant_id", "currency_code", "amount", "status", "device_type",
                 "fraud_score", "created_at"]
CHANGE_STATE = ("id bigint, customer_id bigint, merchant_id bigint, currency_code string, amount double, "
                "status string, device_type string, fraud_score double, created_at timestamp_ntz")
CHANGE_ORDER = "_ts timestamp_ntz, _seq struct<p: bigint, k: bigint>"
CHANGE_PRESENCE = {"device_type": "device_type__present"}
CHANGE_CUTOFF = "1998-06-01 00:00:00"


def _changes(spark, d) -> DataFrame:
    return fx.tx_changes(spark, d).withColumn("created_at", F.col("_ts"))


def _fold_changes(ch: DataFrame) -> DataFrame:
    return U.fold(ch, "id", CHANGE_FIELDS, ["_ts", "_seq"], CHANGE_PRESENCE)


@register("audit_snapshot_diff")
def audit_rows(spark, d):
    """Audit rows between the change-log state at the cutoff and now."""
    ch = _changes(spark, d)
    before = F.col("_ts") < F.lit(CHANGE_CUTOFF).cast("timestamp_ntz")
    return U.diff_as_of(ch, "id", CHANGE_FIELDS, ["_ts", "_seq"], CHANGE_PRESENCE,
                        before, "transactions")


# --- lake writers -------------------------------------------------------------------

@register("export_partition_counts")
def q_export_partition_counts(spark, d):
    """Export by day, re-export the newest day (idempotent), count per partition."""
    tx = _tx(spark, d)
    path = session.work_path(spark, "export/transactions")
    lake.export_partition(tx, path)
    newest = tx.select(F.to_date(F.max("created_at"))).first()[0]
    lake.export_partition(tx, path, start=str(newest), end=str(newest + datetime.timedelta(days=1)))
    schema = StructType(tx.schema.fields + [StructField(c, StringType()) for c in ("year", "month", "day")])
    back = spark.read.schema(schema).parquet(path)
    return back.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("amount").cast("decimal(12,2)")).cast("double").alias("total_amount"))


@register("snapshot_roundtrip")
def q_snapshot_roundtrip(spark, d):
    root = session.work_path(spark, "snapshot/transactions")
    lake.export_snapshot(_tx(spark, d), root, "1")
    return lake.read_snapshot(spark, root)


RUN_DATE = "2024-01-01"


@register("export_other_tables")
def q_export_other_tables(spark, d):
    """Customers and merchants whole under the run's date (twice: the second run replaces), refunds by their day."""
    root = session.work_path(spark, "export/others")
    whole = {"customers": fx.customers(spark, d), "merchants": fx.merchants(spark, d)}
    for name, df in whole.items():
        for _ in range(2):
            lake.export_run(df, f"{root}/{name}", RUN_DATE)
    lake.export_partition(fx.refunds(spark, d), f"{root}/refunds")
    back = [lake.read_partitions(spark, f"{root}/{n}").select(F.lit(n).alias("table_name"), "year", "month", "day")
            for n in (*whole, "refunds")]
    return back[0].unionByName(back[1]).unionByName(back[2]).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("year", "month", "day").alias("n_days"))


POLL_UNTIL = ("1996-06-30 12:00:00", "1997-06-30 12:00:00")


@register("cdc_poll")
def q_cdc_poll(spark, d):
    """Two polls with a stored mark; every fiftieth row commits late, after the first poll."""
    tx = _tx(spark, d).select(*cdc.EVENT_FIELDS)
    poller = lake.Poller(spark, session.work_path(spark, "poll"), lookback_seconds=86400)
    poller.poll(tx.filter(F.col("id") % 50 != 0), POLL_UNTIL[0])
    poller.poll(tx, POLL_UNTIL[1])
    return poller.delivered().drop("seq")


INSERT_CUTOFF = "2023-07-01 00:00:00"


@register("insert_if_absent")
def q_insert_if_absent(spark, d):
    """A later customer load (updated_at + 1 day, repeated rows) inserted without touching existing ids."""
    c = fx.customers(spark, d)
    existing = c.filter(F.col("created_at") < F.lit(INSERT_CUTOFF).cast("timestamp_ntz"))
    incoming = c.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
    return lake.insert_if_absent(existing, incoming.unionByName(incoming), "id")


@register("insert_if_absent_email")
def q_insert_if_absent_email(spark, d):
    """A later load with new ids, each customer twice: the e-mail hash decides, the smaller id comes in."""
    c = fx.customers(spark, d)
    existing = c.filter(F.col("created_at") < F.lit(INSERT_CUTOFF).cast("timestamp_ntz"))
    later = [c.withColumn("id", F.col("id") + F.lit(n)) for n in (2_000_000_000, 1_000_000_000)]
    return lake.insert_if_absent(existing, later[0].unionByName(later[1]), "email_hash", ["id"])


@register("seed_reference_tables")
def q_seed_reference_tables(spark, d):
    """The fixed rows inserted where the data has not brought in their key; keys the data uses keep their rows."""
    kept = fx.reference_tables(spark, d)
    out = []
    for name, key in (("currencies", "code"), ("countries", "code"), ("payment_methods", "id")):
        full = lake.insert_if_absent(kept[name].filter(F.col(key).cast("string") != F.lit("EUR")), _refs(spark)[name], key)
        out.append(full.select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("code"), "name"))
    return out[0].unionByName(out[1]).unionByName(out[2])


CDC_MARK = ("2000-01-01 00:00:00", 0)


@register("cdc_incremental_read")
def q_cdc_incremental_read(spark, d):
    """Rows after a stored (created_at, id) mark, routed to their topic."""
    tx = _tx(spark, d)
    inc = lake.read_since(tx, CDC_MARK[0], CDC_MARK[1])
    return inc.select("id", "created_at", "fraud_score", R.route_topic("fraud_score").alias("topic"))


@register("cdc_messages")
def q_cdc_messages(spark, d):
    """Keyed JSON messages, decoded again to check every field survives."""
    # parsed once, in a projection of its own
    msgs = cdc.to_messages(_tx(spark, d)).withColumn("_ev", F.from_json("value", consumer.EVENT_SCHEMA))
    return msgs.select("topic", "key", *[F.col("_ev")[f].alias(f) for f in consumer.EVENT_FIELDS])


# --- lake reads ---------------------------------------------------------------------

@register("daily_volume_pruned")
def q_daily_volume_pruned(spark, d):
    """The 7-day report over the stored star schema: only the days' folders are read."""
    tables = _star(spark, d)
    paths = lake.write_star({n: tables[n] for n in ("fact_transactions", "dim_time")}, session.work_path(spark, "star"))
    fact, dim = (spark.read.schema(tables[n].schema).parquet(paths[n]) for n in ("fact_transactions", "dim_time"))
    return reports.daily_volume_pruned(fact, dim, lake.newest_day(spark, paths["fact_transactions"]))


@register("star_replaced")
def q_star_replaced(spark, d):
    """A stored star schema replaced by one of the newest year alone: rows and days of each table that has days."""
    tx = _tx(spark, d)
    root = session.work_path(spark, "star")
    names = ("fact_transactions", "dim_time", "agg_daily_revenue")
    for part in (tx, tx.filter(F.col("created_at") >= F.lit(STAR_SINCE).cast("timestamp_ntz"))):
        tables = star.build(part, fx.customers(spark, d), fx.merchants(spark, d))
        paths = lake.write_star({n: tables[n] for n in names}, root)
    back = [spark.read.schema(tables[n].schema).parquet(paths[n]).agg(
        F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct("date_key").alias("n_days")) for n in names]
    return back[0].unionByName(back[1]).unionByName(back[2])


STAR_SINCE = "1998-01-01 00:00:00"
#: Buckets of the stored tables that join by transaction id; alike on both sides.
ID_BUCKETS = 16


@register("refunds_to_reconcile_bucketed")
def q_refunds_bucketed(spark, d):
    """Refunds against transactions, both stored in buckets of the transaction id: the join shuffles nothing."""
    root = session.work_path(spark, "bucketed")
    names = [f"{n}_{root.rsplit('/', 1)[1]}" for n in ("refunds", "transactions")]
    refunds = lake.write_bucketed(fx.refunds(spark, d), f"{root}/refunds", names[0], "transaction_id", ID_BUCKETS)
    tx = lake.write_bucketed(_tx(spark, d), f"{root}/transactions", names[1], "id", ID_BUCKETS)
    return reports.refunds_to_reconcile(refunds.hint("merge"), tx)  # sorted buckets against sorted buckets


@register("snapshot_set")
def q_snapshot_set(spark, d):
    """Two exports of three tables under one pointer; rows and sums of the newest, read back together."""
    found = commits.SnapshotSet(spark, session.work_path(spark, "snapshots"))
    tx, cu, me = _tx(spark, d), fx.customers(spark, d), fx.merchants(spark, d)
    found.export({"transactions": tx.filter("id % 2 = 0"), "customers": cu.filter("id % 2 = 0"), "merchants": me.filter("id % 2 = 0")})
    found.export({"transactions": tx, "customers": cu, "merchants": me})
    return star.row_counts(found.read())


AUDIT_RUN = ("nightly_export", "2024-01-01 03:00:00")


@register("audit_two_snapshots")
def q_audit_two_snapshots(spark, d):
    """Audit rows between two stored snapshots of the change log's state; the later one also lacks some ids."""
    ch = _changes(spark, d)
    before = F.col("_ts") < F.lit(CHANGE_CUTOFF).cast("timestamp_ntz")
    root = session.work_path(spark, "audit")
    for name, part in (("old", ch.filter(before)), ("new", ch.filter("id % 101 <> 0"))):
        audit.write_fingerprinted(U.flatten(_fold_changes(part), "id", CHANGE_FIELDS), f"{root}/{name}", "id")
    return audit.diff_snapshots(spark, f"{root}/old", f"{root}/new", "id", "transactions", *AUDIT_RUN)


def _maintained(spark, d, batches: int = 3):
    """The change log in batches, dealt without regard to time, kept as state and as aggregates of it."""
    root = session.work_path(spark, "incremental")
    state = U.UpsertTable(spark, f"{root}/state", "id", CHANGE_STATE, CHANGE_ORDER, CHANGE_PRESENCE)
    aggs = {"daily": IN.daily_revenue(spark, f"{root}/daily"), "merchants": IN.merchant_performance(spark, f"{root}/merchants")}
    ch = _changes(spark, d)
    for b in range(batches):
        # the batch is folded once, beside what the state has of its keys
        both = state.beside(state.register_rows(ch.filter(F.pmod(F.col("_seq.p"), F.lit(batches)) == b)), b).persist()
        rows = IN.signed(state.old_and_new(both))
        for agg in aggs.values():
            agg.apply(rows, b)
        state.apply(both, b)
        both.unpersist()
    return aggs


@register("agg_incremental")
def q_agg_incremental(spark, d):
    """Daily revenue kept up to date from three batches of changes."""
    return IN.daily_revenue_view(_maintained(spark, d)["daily"])


@register("agg_incremental_merchants")
def q_agg_incremental_merchants(spark, d):
    """Merchant performance kept up to date from three batches of changes."""
    return IN.merchant_performance_view(_maintained(spark, d)["merchants"], star.dim_merchant(fx.merchants(spark, d)))


# --- upsert -------------------------------------------------------------------------

@register("upsert_current")
def q_upsert_current(spark, d):
    """Change log applied in three time-ordered batches to the bucketed state table."""
    ch = _changes(spark, d)
    table = U.UpsertTable(spark, session.work_path(spark, "upsert/current"), "id", CHANGE_STATE, CHANGE_ORDER, CHANGE_PRESENCE)
    cuts = ["1997-01-01 00:00:00", CHANGE_CUTOFF]
    bounds = [None] + cuts + [None]
    for i in range(len(bounds) - 1):
        part = ch
        if bounds[i]:
            part = part.filter(F.col("_ts") >= F.lit(bounds[i]).cast("timestamp_ntz"))
        if bounds[i + 1]:
            part = part.filter(F.col("_ts") < F.lit(bounds[i + 1]).cast("timestamp_ntz"))
        table.apply(table.fold(part), batch_id=i)
    return table.read()


@register("upsert_patch")
def q_upsert_patch(spark, d):
    """One merge: state before the cutoff patched with the later changes, with the operation per id."""
    ch = _changes(spark, d)
    cut = F.lit(CHANGE_CUTOFF).cast("timestamp_ntz")
    state = _fold_changes(ch.filter(F.col("_ts") < cut))
    patch = _fold_changes(ch.filter(F.col("_ts") >= cut))
    patched = U.merge(state, patch, "id", with_op=True)
    return U.flatten(patched, "id", CHANGE_FIELDS + ["op"])


# --- streams ------------------------------------------------------------------------

def run_consumer(spark, msgs: DataFrame, name: str, batches: int = 3) -> consumer.ConsumerSink:
    """Drive the consumer stream over ``msgs`` to completion (availableNow), in ``batches`` micro-batches."""
    root = session.work_path(spark, f"stream/{name}")
    per_slice = replay.write_slices(msgs, f"{root}/source", batches)
    sink = consumer.ConsumerSink(spark, f"{root}/sink")
    q = consumer.start(spark, consumer.file_source(spark, f"{root}/source", per_slice), sink,
                       f"{root}/checkpoint", {"availableNow": True})
    q.awaitTermination()
    return sink


def _event_stream(spark, d) -> consumer.ConsumerSink:
    return run_consumer(spark, fx.tx_events(spark, d), "events")


@register("stream_validate")
def q_stream_validate(spark, d):
    v = consumer.validate(fx.tx_events(spark, d))
    return v.select(F.col("key").alias("id"), "topic", "is_valid")


@register("stream_quarantine")
def q_stream_quarantine(spark, d):
    return _event_stream(spark, d).quarantine().select("key", "topic", "reason")


@register("stream_dispatch")
def q_stream_dispatch(spark, d):
    sink = _event_stream(spark, d)
    parts = [(name, df) for name, df in [("transactions", sink.transactions.read()),
                                         ("fraud_alerts", sink.alerts.read()),
                                         ("logs", sink.logs()), ("quarantine", sink.quarantine())]]
    from functools import reduce
    return reduce(DataFrame.unionByName, [df.agg(F.lit(n).alias("collection"), F.count(F.lit(1)).alias("n_docs"))
                                          for n, df in parts])


@register("alert_log")
def q_alert_log(spark, d):
    return _event_stream(spark, d).logs().select("type", "transaction_id", "fraud_score", "amount", "currency")


@register("batch_metrics")
def q_batch_metrics(spark, d):
    """The delivery reports of a stream's micro-batches, added up."""
    m = _event_stream(spark, d).metrics()
    return m.agg(*[F.sum(c).alias(c) for c in ("n_messages", "n_valid", "n_invalid", "n_transactions", "n_alerts")])


@register("stream_dedup")
def q_stream_dedup(spark, d):
    """The event stream with every tenth message sent again in the next slice: each comes out once.

    Slices follow event time, one run of the stream each; state holds ten days of keys.
    """
    msgs = fx.tx_events(spark, d).persist()
    root = session.work_path(spark, "stream/dedup")
    cuts = [None, *msgs.select(F.percentile_approx(F.col("event_ts").cast("timestamp"), [0.33, 0.67], 10000)).first()[0], None]
    for b in range(3):
        at, part = F.col("event_ts").cast("timestamp"), msgs
        again = msgs.filter("event_seq % 10 = 0")
        if cuts[b] is not None:
            part, again = part.filter(at >= F.lit(cuts[b])), again.filter(at < F.lit(cuts[b]))
        else:
            again = again.limit(0)
        if cuts[b + 1] is not None:
            part = part.filter(at < F.lit(cuts[b + 1]))
        part.unionByName(again).repartition(8, "key").write.mode("append").parquet(f"{root}/source")
        source = consumer.file_source(spark, f"{root}/source", 64)
        q = (dedup.deduplicated(source, ["key"], "10 days").writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    msgs.unpersist()
    return spark.read.schema(source.schema).parquet(f"{root}/out").select("key", "topic")


@register("stream_upsert")
def q_stream_upsert(spark, d):
    """The change log streamed in three micro-batches into the current-state table."""
    sink = run_consumer(spark, fx.tx_change_messages(spark, d), "changes")
    return sink.transactions.read()


# --- features and metrics on fixed scores ----------------------------------------------

@register("features")
def q_features(spark, d):
    f = FE.build(_tx(spark, d))
    return f.withColumn("amount_log", F.col("amount_log").cast("decimal(18,9)").cast("double"))


@register("label_balance")
def q_label_balance(spark, d):
    return FE.label_balance(FE.build(_tx(spark, d), 0.0))  # the amount threshold plays no part


@register("class_weights")
def q_class_weights(spark, d):
    return FE.class_weights(FE.build(_tx(spark, d), 0.0))


@register("score_defaults")
def q_score_defaults(spark, d):
    rec = _tx(spark, d).select("id", "amount", "currency_code", "device_type", "ip_country", "status")
    return FE.score_defaults(rec, as_of="2024-01-01 00:00:00")


def _rule_scored(spark, d) -> DataFrame:
    """Noise-free rule score as the prediction, suspected flag as the label."""
    tx = _tx(spark, d)
    return tx.select(R.fraud_score("amount", "device_type", "ip_country", F.hour("created_at"), "status")
                     .alias("score"),
                     R.is_suspected("fraud_score").cast("int").alias("label"))


@register("eval_auc")
def q_eval_auc(spark, d):
    # the sum's order is free: nine decimals are compared
    return M.roc_pr(_rule_scored(spark, d), "score", "label").withColumn(
        "average_precision", F.col("average_precision").cast("decimal(18,9)").cast("double"))


@register("confusion_matrix")
def q_confusion_matrix(spark, d):
    s = _rule_scored(spark, d).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    return M.confusion_matrix(s)


@register("classification_report")
def q_classification_report(spark, d):
    s = _rule_scored(spark, d).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    return M.classification_report(s)


@register("risk_bands")
def q_risk_bands(spark, d):
    return M.risk_band_counts(_rule_scored(spark, d).withColumnRenamed("score", "fraud_proba"))


@register("score_records_json")
def q_score_records_json(spark, d):
    """Records in from JSON lines, scored by the rule, records out as JSON lines, read back."""
    root = session.work_path(spark, "records")
    tx = _tx(spark, d).withColumn("id", F.col("id").cast("string"))
    tx.drop("merchant_id", "customer_id", "payment_method_id").write.json(f"{root}/in")
    rule = R.fraud_score("amount", "device_type", "ip_country", F.hour("created_at"), "status")
    ML.write_score_records(FE.read_records(spark, f"{root}/in").withColumn("fraud_proba", rule), f"{root}/out")
    return spark.read.schema("transaction_id string, amount double, currency string, fraud_proba double, is_fraud boolean, "
                             "risk_level string").json(f"{root}/out")


# --- trained model (rows-only checks) -----------------------------------------------

def _trained(spark, d):
    """Model, threshold and test predictions, trained on the given tables with the full settings."""
    model, test_pred, thr = ML.train(_tx(spark, d))
    return model, thr, test_pred


@register("stratified_split")
def q_stratified_split(spark, d):
    f = ML.with_split(FE.build(_tx(spark, d), 0.0))  # the amount threshold plays no part
    return f.groupBy("split", FE.D.LABEL_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))


@register("cv_fold_counts")
def q_cv_fold_counts(spark, d):
    """Rows and positives per CV fold (the fold assignment of the cross-validation)."""
    f = ML.with_folds(FE.build(_tx(spark, d), 0.0))
    return f.groupBy("fold", FE.D.LABEL_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))


@register("train_model")
def q_train_model(spark, d):
    _, _, test_pred = _trained(spark, d)
    return ML.evaluate(test_pred)


@register("cv_folds")
def q_cv_folds(spark, d):
    return ML.cross_validate(_tx(spark, d))


@register("feature_importance")
def q_feature_importance(spark, d):
    model, _, _ = _trained(spark, d)
    return ML.feature_importance(model, spark)


@register("score_batch")
def q_score_batch(spark, d):
    """A model trained on the transactions scores every one of them, with all columns they have."""
    model, thr, _ = _trained(spark, d)
    return ML.score(model, _tx(spark, d), thr)


@register("risk_band_counts")
def q_risk_band_counts(spark, d):
    return M.risk_band_counts(q_score_batch(spark, d))


@register("model_roundtrip")
def q_model_roundtrip(spark, d):
    """Save a fitted model with its record, load "latest", and count the scores that differ (none)."""
    tx = _tx(spark, d)
    model, thr, test_pred = _trained(spark, d)
    reg = ML.Registry(spark, session.work_path(spark, "models"))
    ev = {r["metric"]: r["value"] for r in ML.evaluate(test_pred).collect()}   # 5 rows
    reg.save("fraud-detector", model, thr, ML.run_parameters(), ev)
    loaded, thr2 = reg.load("fraud-detector", "latest")
    old = ML.score(model, tx, thr).select("id", F.struct("fraud_proba", "is_fraud", "risk_level").alias("a"))
    new = ML.score(loaded, tx, thr2).select("id", F.struct("fraud_proba", "is_fraud", "risk_level").alias("b"))
    return old.join(new, "id").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_differ"))


@register("stream_score")
def q_stream_score(spark, d):
    """Score the event stream in motion, with every field an event has; defaults where it lacks one."""
    model, thr, _ = _trained(spark, d)
    root = session.work_path(spark, "stream/score")
    per_slice = replay.write_slices(fx.tx_events(spark, d), f"{root}/source")
    src = consumer.file_source(spark, f"{root}/source", per_slice)
    valid = consumer.parse(consumer.validate(src).filter(F.col("is_valid")))
    rec = valid.select("id", "amount", "currency_code", "created_at", *[
        F.when(F.col(f"{c}__present"), F.col(c)).otherwise(F.lit(v)).alias(c) for c, v in FE.D.SCORING_DEFAULTS.items()])
    scored = ML.score(model, rec, thr)
    q = (scored.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")
