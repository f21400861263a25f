"""Lake readers and writers on literal frames."""

import datetime as dt

from paylake import session
from paylake.sources import lake

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _tx(spark, rows):
    return spark.createDataFrame(rows, "id bigint, created_at timestamp_ntz, amount double")


def test_read_since_is_tie_safe_and_next_mark(spark):
    df = _tx(spark, [(1, T0, 1.0), (2, T0, 2.0), (3, T0 + dt.timedelta(seconds=1), 3.0),
                     (0, T0 - dt.timedelta(seconds=1), 4.0)])
    got = sorted(r.id for r in lake.read_since(df, "2024-01-01 12:00:00", 1).collect())
    assert got == [2, 3]                                   # same timestamp, larger id is kept
    look = sorted(r.id for r in lake.read_since(df, "2024-01-01 12:00:00", 1, lookback_seconds=5).collect())
    assert look == [0, 1, 2, 3]
    m = lake.next_mark(lake.read_since(df, "2024-01-01 12:00:00", 1)).first()
    assert (m.ts, m.id) == (T0 + dt.timedelta(seconds=1), 3)


def test_insert_if_absent_keeps_existing_rows(spark):
    existing = _tx(spark, [(1, T0, 1.0), (2, T0, 2.0)])
    incoming = _tx(spark, [(2, T0, 99.0), (3, T0, 3.0), (3, T0, 3.0)])
    got = {r.id: r.amount for r in lake.insert_if_absent(existing, incoming, "id").collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 3.0}


def test_export_is_idempotent_and_skips_empty_slices(spark):
    rows = [(i, T0 + dt.timedelta(hours=7 * i), float(i)) for i in range(12)]
    df = _tx(spark, rows)
    path = session.work_path(spark, "test-lake-export")
    assert lake.export_partition(df, path)
    before = sorted((r.day, r["count"]) for r in spark.read.parquet(path).groupBy("day").count().collect())
    assert lake.export_partition(df, path, "2024-01-02", "2024-01-03")          # re-run one day
    after = sorted((r.day, r["count"]) for r in spark.read.parquet(path).groupBy("day").count().collect())
    assert before == after and sum(c for _, c in after) == 12
    assert not lake.export_partition(df, path, "2030-01-01", "2030-01-02")      # nothing to write
    assert spark.read.parquet(path).count() == 12


def test_snapshot_pointer_moves_last(spark):
    root = session.work_path(spark, "test-lake-snapshot")
    lake.export_snapshot(_tx(spark, [(1, T0, 1.0)]), root, "1")
    lake.export_snapshot(_tx(spark, [(1, T0, 1.0), (2, T0, 2.0)]), root, "2")
    assert lake.read_snapshot(spark, root).count() == 2
    assert spark.read.parquet(f"{root}/data/version=1").count() == 1            # old version kept


def test_day_slice_is_a_range(spark):
    df = _tx(spark, [(1, dt.datetime(2024, 1, 1, 0, 0), 1.0), (2, dt.datetime(2024, 1, 1, 23, 59, 59), 1.0),
                     (3, dt.datetime(2024, 1, 2, 0, 0), 1.0)])
    assert sorted(r.id for r in lake.read_day_slice(df, "2024-01-01").collect()) == [1, 2]
    plan = lake.read_day_slice(df, "2024-01-01")._jdf.queryExecution().optimizedPlan().toString()
    # the column itself is compared with constants (no cast of created_at), so the filter can be pushed down
    assert "created_at" in plan and "cast(created_at" not in plan


def test_write_star_materialises_every_table(spark):
    from paylake.operators import star
    from paylake.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    tables = star.build(fx.transactions(spark, SF_SMALL), fx.customers(spark, SF_SMALL), fx.merchants(spark, SF_SMALL))
    root = session.work_path(spark, "test-star")
    paths = lake.write_star(tables, root)
    assert set(paths) == set(tables)
    for name, path in paths.items():
        assert spark.read.parquet(path).count() == tables[name].count(), name
    # create-or-replace: writing again replaces, it does not append
    lake.write_table(tables["dim_time"], paths["dim_time"], sort_by=["date_key"], small=True)
    assert spark.read.parquet(paths["dim_time"]).count() == tables["dim_time"].count()
    assert len(spark.read.parquet(paths["dim_time"]).inputFiles()) == 1
