"""Plan shape: pushdown, pruning, broadcast only for fixed tables, no Python UDFs."""

import re

from paylake import session
from paylake.plans.catalog import REGISTRY
from paylake.sources import fixtures as fx
from paylake.sources import lake
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_any_batch_query(spark):
    skip = {"export_partition_counts", "snapshot_roundtrip", "upsert_current", "stream_quarantine", "stream_dispatch",
            "alert_log", "stream_upsert", "train_model", "cv_folds", "feature_importance", "score_batch",
            "risk_band_counts", "model_roundtrip", "stream_score"}
    for name, q in REGISTRY.items():
        if name in skip:
            continue
        p = _plan(q(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_filters_reach_the_scan(spark):
    p = _plan(REGISTRY["suspicious_transactions"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    path = session.work_path(spark, "test-day")
    fx.transactions(spark, SF_SMALL).write.parquet(path)
    p = _plan(lake.read_day_slice(spark.read.parquet(path), "1998-01-10"))
    assert "GreaterThanOrEqual(created_at" in p and "LessThan(created_at" in p


def test_column_pruning_on_orders(spark):
    p = _plan(REGISTRY["revenue_by_currency"](spark, SF_SMALL))
    scan = [line for line in p.split("\n") if "FileScan parquet" in line and "orders" in line][0]
    assert "o_orderpriority" in scan and "o_orderstatus" in scan    # status needs both
    assert "o_custkey" not in scan and "o_orderdate" not in scan    # unused columns are pruned
    p = _plan(REGISTRY["pseudonymise"](spark, SF_SMALL))
    scan = [line for line in p.split("\n") if "FileScan parquet" in line][0]
    assert "c_acctbal" not in scan and "c_mktsegment" not in scan


def test_iso_lookup_is_broadcast(spark):
    p = _plan(REGISTRY["fraud_by_country_iso3"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_no_unpartitioned_window_over_rows(spark):
    for name in ("eval_auc", "features", "audit_snapshot_diff", "upsert_patch"):
        p = _plan(REGISTRY[name](spark, SF_SMALL))
        for line in p.split("\n"):
            if "Window [" in line and "rid" not in line:
                raise AssertionError(f"{name}: unexpected window {line}")


def test_partition_pruning_on_export(spark):
    from pyspark.sql import functions as F

    path = session.work_path(spark, "test-export")
    tx = fx.transactions(spark, SF_SMALL)
    lake.export_partition(tx, path, "1998-01-01", "1998-02-01")
    df = lake.read_partitions(spark, path, "1998-01-10", "1998-01-20")
    p = _plan(df.select(F.count("*")))
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", p)[1]
    assert "year" in filters and "month" in filters
    want = tx.filter((F.col("created_at") >= "1998-01-10") & (F.col("created_at") < "1998-01-20")).count()
    assert df.count() == want
