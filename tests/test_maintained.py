"""State kept up to date: aggregates from changes, sketches, snapshots under one pointer, audits, deduplicated streams."""

import datetime as dt
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from paylake import session
from paylake.functions import rules as R
from paylake.operators import audit, incremental, quality, quantiles, star, upsert
from paylake.sources import commits, lake, schemas
from paylake.streaming import consumer, dedup, monitor

SCHEMA = ("id bigint, merchant_id bigint, currency_code string, amount double, status string, ip_country string, "
          "fraud_score double, created_at timestamp_ntz")
FIELDS = [c.split()[0] for c in SCHEMA.split(", ")][1:]


def _rows(seed, n):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    return [(rng.randrange(40), rng.randrange(4), pick("EUR", "USD"), pick(None, 1.25, 10.5, 99.99), pick("success", "failed", None),
             pick("FR", "US", None), pick(None, 0.2, 0.7, 0.91, float("nan")), dt.datetime(2024, 1, 1 + rng.randrange(5), 3), seq)
            for seq in range(n)]


def _plain(df):
    return sorted((tuple(None if isinstance(v, float) and v != v else v for v in r) for r in df.collect()), key=str)


def test_aggregates_from_changes_equal_full_ones(spark):
    changes = spark.createDataFrame(_rows(3, 150), SCHEMA + ", seq int").cache()
    root = session.work_path(spark, "test-incremental")
    state = upsert.UpsertTable(spark, f"{root}/state", "id", SCHEMA, "seq int")
    aggs = [incremental.daily_revenue(spark, f"{root}/d"), incremental.merchant_performance(spark, f"{root}/m"),
            incremental.fraud_by_country(spark, f"{root}/c")]
    for b in (0, 1, 1, 2):  # the second batch is replayed; batches are no slices of time
        folded = state.fold(changes.filter(F.col("seq") % 3 == b))
        rows = incremental.signed(state.changed(folded, b)).cache()
        for a in aggs:
            a.apply(rows, b)
        state.apply(folded, b)
    now = state.read().select(*[F.col(c) for c in ("id", *FIELDS)], F.lit(1).alias("customer_id"), F.lit(1).alias("payment_method_id"),
                              F.lit("mobile").alias("device_type"))
    fact = star.fact_transactions(now.withColumn("fraud_score", R.known_score("fraud_score")))
    dim = spark.createDataFrame([(i, f"m{i}", "c") for i in range(4)], "merchant_key bigint, merchant_name string, merchant_category string")
    for got, want in ((incremental.daily_revenue_view(aggs[0]), star.agg_daily_revenue(fact)),
                      (incremental.merchant_performance_view(aggs[1], dim), star.agg_merchant_performance(fact, dim)),
                      (incremental.fraud_by_country_view(aggs[2]), star.agg_fraud_by_country(fact))):
        assert got.columns == want.columns
        assert _plain(got) == _plain(want)
    assert now.count() == len({r[0] for r in _rows(3, 150)})


def test_groups_that_empty_out_are_gone(spark):
    agg = incremental.daily_revenue(spark, session.work_path(spark, "test-empty-group"))
    row = "sign int, amount double, status string, fraud_score double, created_at timestamp_ntz, currency_code string"
    day = dt.datetime(2024, 1, 1)
    agg.apply(spark.createDataFrame([(1, 5.0, "success", 0.9, day, "EUR"), (1, 7.0, None, None, day, "USD")], row), 0)
    agg.apply(spark.createDataFrame([(-1, 5.0, "success", 0.9, day, "EUR")], row), 1)
    assert [tuple(r)[1:5] for r in incremental.daily_revenue_view(agg).collect()] == [("USD", 1, 7.0, 7.0)]
    agg.apply(spark.createDataFrame([], row), 2)
    assert agg.read().count() == 1


def test_quantile_sketches_merge(spark):
    df = spark.range(20000).selectExpr("id % 7 as day", "id % 3 as m", "cast(id as double) as amount").unionByName(
        spark.createDataFrame([(0, 0, None), (0, 0, float("nan"))], "day bigint, m bigint, amount double"))
    table = quantiles.SketchTable(spark, session.work_path(spark, "test-kll"), "day bigint, m bigint")
    for b in range(3):
        table.apply(df.filter(F.coalesce(F.col("amount"), F.lit(0)) % 3 == b), b)
        table.apply(df.filter(F.coalesce(F.col("amount"), F.lit(0)) % 3 == b), b)
    for groups, n in ((["m"], 20000 / 3), (["day"], 20000 / 7), ([], 20000)):
        for r in quantiles.quantile(quantiles.merged(table.read(), groups), 0.95).collect():
            assert abs(r["n_values"] - n) < 2 and abs(r["estimate"] / 20000 - 0.95) <= quantiles.RANK_ERROR


def test_snapshots_switch_together_and_writers_get_different_numbers(spark):
    root = session.work_path(spark, "test-set")
    one = spark.range(5).selectExpr("id")
    with ThreadPoolExecutor(4) as pool:
        exports = [commits.SnapshotSet(spark, root) for _ in range(4)]
        numbers = list(pool.map(lambda x: x[1].export({"a": one.filter(f"id < {x[0]}"), "b": one.filter(f"id < {x[0]}")}), enumerate(exports)))
    assert sorted(numbers) == [1, 2, 3, 4]
    for n in numbers:
        t = exports[0].read(n)
        assert t["a"].count() == t["b"].count()  # never a mix
    assert {t.count() for t in exports[0].read().values()} == {exports[0].read(4)["a"].count()}
    log = commits.CommitLog(spark, f"{root}/log")
    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(lambda i: log.commit({"writer": i}), range(16))) == list(range(1, 17))
    assert sorted(log.get(n)["writer"] for n in log.numbers()) == list(range(16))
    assert not session.publish(spark, f"{root}/log/3.json", "other") and "other" not in session.read_text(spark, f"{root}/log/3.json")


def test_audit_reads_only_what_differs(spark):
    root = session.work_path(spark, "test-audit")
    old = spark.range(3000).selectExpr("id", "cast(id % 5 as string) as a", "if(id % 3 = 0, null, id) as b")
    new = old.filter("id not in (7, 8)").withColumn("a", F.when(F.col("id") == 11, None).otherwise(F.col("a"))).unionByName(
        spark.createDataFrame([(9001, "x", None), (None, "y", 1)], "id bigint, a string, b bigint"))
    for name, df in (("old", old), ("new", new), ("same", old.repartition(5))):
        audit.write_fingerprinted(df, f"{root}/{name}", "id", 16, 16)
    assert audit.diff_snapshots(spark, f"{root}/old", f"{root}/same", "id", "t", "me", "2024-01-01 00:00:00").count() == 0
    places = audit.differing(spark, f"{root}/old", f"{root}/new").collect()
    assert 1 <= len(places) <= 5
    got = audit.diff_snapshots(spark, f"{root}/old", f"{root}/new", "id", "t", "me", "2024-01-01 00:00:00")
    assert {(r.operation, r.record_id) for r in got.collect()} == {("DELETE", 7), ("DELETE", 8), ("UPDATE", 11), ("INSERT", 9001), ("INSERT", None)}
    assert {(r.changed_by, r.changed_at) for r in got.collect()} == {("me", dt.datetime(2024, 1, 1))}
    assert {(r.operation, r.record_id) for r in quality.snapshot_diff(old, new.filter("id is not null"), "id", "t").collect()} == \
        {("DELETE", 7), ("DELETE", 8), ("UPDATE", 11), ("INSERT", 9001)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    touched = {p["_bucket"] for p in places}
    assert plan.count("PartitionFilters: [") >= 2 and len(touched) < 16
    assert all("_bucket#" in side and any(str(b) in side for b in touched) for side in plan.split("PartitionFilters: [")[1:])


@pytest.mark.parametrize("ids", [["a", "b", "c", "d"], [1, 2, 3, 4]])
def test_polls_with_any_id_type_and_null_ids(spark, ids):
    t = dt.datetime(2024, 1, 1, 12)
    kind = "string" if isinstance(ids[0], str) else "bigint"
    rows = [(None, t), (ids[0], t), (ids[1], t), (ids[2], t + dt.timedelta(seconds=5)), (ids[3], t - dt.timedelta(seconds=5))]
    frame = lambda x: spark.createDataFrame(x, f"id {kind}, created_at timestamp_ntz")
    poller = lake.Poller(spark, session.work_path(spark, "test-poll"), lookback_seconds=60)
    sizes = [poller.poll(frame(x)).count() for x in (rows[:1], rows[:2], rows[:2], rows, rows, [])]
    assert sizes == [1, 1, 0, 3, 0, 0]
    assert poller.delivered().count() == 5 and poller.mark()["id"] == ids[2]


def test_insert_if_absent_null_keys_and_order(spark):
    kind = "k string, v int, at int"
    old = spark.createDataFrame([(None, 1, 0), ("a", 1, 0)], kind)
    new = spark.createDataFrame([(None, 9, 0), ("b", 5, 2), ("b", 7, 1), ("a", 9, 9)], kind)
    got = lake.insert_if_absent(old, new, "k", ["at"])
    assert sorted(((r.k, r.v) for r in got.collect()), key=str) == [("a", 1), ("b", 7), (None, 1)]
    again = lake.insert_if_absent(got, new, "k", ["at"])
    assert again.count() == 3


def test_star_is_replaced_under_any_overwrite_mode(spark):
    root = session.work_path(spark, "test-replace")
    fact = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i)) for i in range(3)], "transaction_key int, date_key date")
    agg = spark.createDataFrame([(dt.date(2024, 1, 1 + i), float(i)) for i in range(3)], "date_key date, total_revenue double")
    for mode in ("dynamic", "static"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        lake.write_star({"fact_transactions": fact, "agg_daily_revenue": agg}, root)
        assert lake.newest_day(spark, f"{root}/fact_transactions") == "2024-01-03"
        paths = lake.write_star({"fact_transactions": fact.limit(1), "agg_daily_revenue": agg.limit(1)}, root)
        assert {spark.read.parquet(p).count() for p in paths.values()} == {1}
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert lake.newest_day(spark, f"{root}/none") is None


def test_clustered_tables_skip_row_groups(spark):
    import glob

    import pyarrow.parquet as pq
    path = session.work_path(spark, "test-clustered")
    df = spark.range(60000).selectExpr("hash(id) % 1000 as k", "id", "repeat(cast(id as string), 20) as pad")
    lake.write_clustered(df, path, ["k"], group_bytes=256 << 10)
    groups = [g for f in sorted(glob.glob(f"{path}/part-*")) for m in [pq.ParquetFile(f).metadata]
              for g in [m.row_group(i).column(0).statistics for i in range(m.num_row_groups)]]
    hit = [g for g in groups if g.min <= 10 and g.max >= 5]
    assert len(groups) >= 6 and len(hit) <= len(groups) / 2
    assert spark.read.parquet(path).filter("k between 5 and 10").count() == df.filter("k between 5 and 10").count()
    back = [r.k for r in spark.read.parquet(path).filter("k > 990").select("k").distinct().orderBy(F.desc("k")).collect()]
    assert back == sorted(back, reverse=True)


def test_bucketed_join_shuffles_nothing_and_days_are_pruned(spark):
    from paylake.plans.catalog import REGISTRY
    from tests.conftest import SF_SMALL
    plan = REGISTRY["refunds_to_reconcile_bucketed"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in join and join.count("Bucketed: true") == 2
    plan = REGISTRY["daily_volume_pruned"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_stored_types(spark):
    kind = schemas.schema("transactions", "bigint")
    row = (1, 2, 3, 1, "EUR", 12.34, "success", None, None, float("nan"), dt.datetime(2024, 1, 1))
    df = spark.createDataFrame([row], "id bigint, customer_id bigint, merchant_id bigint, payment_method_id int, currency_code string, "
                               "amount double, status string, device_type string, ip_country string, fraud_score double, created_at timestamp_ntz")
    path = session.work_path(spark, "test-typed")
    lake.write_table(lake.conform(df, kind), path)
    back = lake.read_table(spark, path, kind)
    assert back.schema == kind and back.first()["fraud_score"] is None and str(back.first()["amount"]) == "12.34"


def test_stream_repeats_come_out_once_and_state_stays_bounded(spark):
    listener = monitor.watch(spark)
    root = session.work_path(spark, "test-dedup")
    t0, seen, state = dt.datetime(2024, 1, 1), [], []
    for b in range(4):  # each run lies two hours after the one before; the delay is one hour
        rows = [("transactions", f"{b}-{i}", "v", t0 + dt.timedelta(hours=2 * b, minutes=i), b * 100 + i) for i in range(50)]
        repeats = rows[:10] + [("transactions", f"{max(b - 1, 0)}-{i}", "v", t0 + dt.timedelta(hours=2 * max(b - 1, 0), minutes=i), 0) for i in range(5)]
        spark.createDataFrame(rows + repeats, consumer.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/source")
        q = (dedup.deduplicated(consumer.file_source(spark, f"{root}/source", 9), ["key"], "1 hour").writeStream.format("parquet")
             .option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt").queryName(f"dedup{b}").trigger(availableNow=True).start())
        q.awaitTermination()
        state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        seen = [r.key for r in spark.read.parquet(f"{root}/out").collect()]
        assert len(seen) == len(set(seen)) == 50 * (b + 1)
    assert max(state) <= 60 and len(seen) == 200
    spark.streams.removeListener(listener)
    reports = listener.frame(spark)
    assert reports.filter("query like 'dedup%'").agg(F.sum("num_input_rows")).first()[0] == 4 * 65 and not listener.errors


def test_model_registry_versions(spark):
    from paylake.operators import model as ML

    class Fitted:  # what a registry needs of a model
        class _Stage:
            class featureImportances:  # noqa: N801
                toArray = staticmethod(lambda: [1 / 14] * 14)
        stages = [_Stage]

        def write(self):
            return self

        def save(self, path):
            spark.range(1).write.parquet(path)

    reg = ML.Registry(spark, session.work_path(spark, "test-registry"))
    with ThreadPoolExecutor(3) as pool:
        got = sorted(pool.map(lambda i: reg.save("m", Fitted(), 0.5 + i, ML.run_parameters({"numTrees": i}), {"roc_auc": 0.9},
                                                 {"cv_roc_auc_mean": 0.8, "cv_roc_auc_std": 0.01}), range(3)))
    assert got == [1, 2, 3] and reg.latest("m")["version"] == 3 and reg.latest("other") is None
    runs = {(r.version, r.kind, r.name): r.value for r in reg.runs("m").collect()}
    assert runs[1, "metrics", "cv_roc_auc_std"] == "0.01" and runs[2, "params", "random_state"] == "42" and runs[3, "params", "maxDepth"] == "10"
    assert len([k for k in runs if k[0] == 1 and k[2].startswith("fi_")]) == 14
    with pytest.raises(FileNotFoundError):
        reg.load("other")
