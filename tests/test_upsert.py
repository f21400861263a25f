"""Field-level upsert: patch semantics, merge, bucketed table, replay."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from paylake import session
from paylake.operators import upsert as U

FIELDS = ["a", "b"]
SCHEMA = "id bigint, a string, b string"


def _changes(spark, rows):
    # id, ts, a, a_present, b, b_present
    return spark.createDataFrame(rows, "id bigint, ts int, a string, a__p boolean, b string, b__p boolean")


def _fold(df):
    return U.fold(df, "id", FIELDS, ["ts"], {"a": "a__p", "b": "b__p"})


def test_fold_absent_keeps_and_null_overwrites(spark):
    ch = _changes(spark, [
        (1, 1, "x", True, "y", True),
        (1, 2, None, True, None, False),     # a explicitly NULL, b absent
        (2, 1, None, False, "z", True),      # a never present
    ])
    got = {r.id: (r.a, r.b) for r in U.flatten(_fold(ch), "id", FIELDS).collect()}
    assert got == {1: (None, "y"), 2: (None, "z")}
    folded = {r.id: r.r_a for r in _fold(ch).collect()}
    assert folded[1] is not None and folded[1]["a"] is None      # present NULL
    assert folded[2] is None                                      # never present


def test_merge_patch_and_ops(spark):
    state = _fold(_changes(spark, [(1, 1, "old_a", True, "old_b", True), (3, 9, "k", True, "k", True)]))
    patch = _fold(_changes(spark, [(1, 5, "new_a", True, None, False), (2, 5, "n", True, "n", True), (3, 8, "late", True, "late", True)]))
    want = {1: ("new_a", "old_b", "update"), 2: ("n", "n", "insert"), 3: ("k", "k", "update")}
    got = U.flatten(U.merge(state, patch, "id", with_op=True), "id", [*FIELDS, "op"])
    assert {r.id: (r.a, r.b, r.op) for r in got.collect()} == want
    swapped = U.flatten(U.merge(patch, state, "id"), "id", FIELDS)       # the order of merging decides nothing
    assert {r.id: (r.a, r.b) for r in swapped.collect()} == {k: v[:2] for k, v in want.items()}


def _table(spark, name):
    return U.UpsertTable(spark, session.work_path(spark, name), "id", SCHEMA, "ts int", {"a": "a__p", "b": "b__p"})


def test_any_cut_and_any_order_of_batches_give_the_same_table(spark):
    rng = random.Random(5)
    # equal orders within a key too: they are settled by their values
    rows = [(rng.choice([None, 0, 0, 0, 1, 2, 3]), rng.randrange(12), f"a{rng.randrange(9)}", rng.random() < .6,
             None if rng.random() < .2 else f"b{rng.randrange(9)}", rng.random() < .5) for _ in range(120)]
    want = None
    for n_batches in (1, 3, 7):
        rng.shuffle(rows)
        table = _table(spark, "test-any-cut")
        parts = [rows[i::n_batches] for i in range(n_batches)]
        for b, part in enumerate(parts):
            table.apply(table.fold(_changes(spark, part)), b)
        table.apply(table.fold(_changes(spark, parts[0])), n_batches)   # delivered once more
        got = sorted(map(tuple, table.read().select("id", *FIELDS).collect()), key=str)
        want = want or got
        assert got == want and len(got) == 5


def test_layers_stay_few_and_vacuum_keeps_the_state(spark):
    table = _table(spark, "test-layers")
    for b in range(9):
        table.apply(table.fold(_changes(spark, [(b, b, "x", True, "y", True), (0, b, f"v{b}", True, None, False)])), b)
        assert len(table.layers.layers()) <= 4
    before = sorted(map(tuple, table.read().collect()))
    assert dict((r[0], r[1]) for r in before)[0] == "v8" and len(before) == 9
    assert table.layers.vacuum() and sorted(map(tuple, table.read().collect())) == before
    table.apply(table.fold(_changes(spark, [(0, 8, "v8", True, None, False), (8, 8, "x", True, "y", True)])), 8)  # a replay
    assert sorted(map(tuple, table.read().collect())) == before


def test_changed_rows_of_a_batch(spark):
    table = _table(spark, "test-changed")
    table.apply(table.fold(_changes(spark, [(1, 1, "a", True, "b", True), (2, 1, "c", True, None, True), (None, 1, "n", True, "n", True)])), 0)
    patch = table.fold(_changes(spark, [(1, 2, "A", True, None, False), (3, 2, "d", True, "d", True), (2, 0, "late", True, None, False),
                                        (None, 2, "N", True, None, False)]))
    got = {r["id"]: (tuple(r["old"]) if r["old"] else None, tuple(r["new"])) for r in table.changed(patch, 1).collect()}
    assert got == {1: (("a", "b"), ("A", "b")), 3: (None, ("d", "d")), 2: (("c", None), ("c", None)), None: (("n", "n"), ("N", "n"))}


def test_table_batches_equal_single_fold_and_replay_is_idempotent(spark):
    rows = [(i % 7, t, f"a{t}", t % 2 == 0, f"b{t}", t % 3 == 0) for t in range(30) for i in [t, t + 1]]
    ch = _changes(spark, rows)
    expected = sorted(tuple(r) for r in U.flatten(_fold(ch), "id", FIELDS).collect())
    for n_batches in (1, 3, 7):
        table = _table(spark, "test-upsert")
        step = 30 // n_batches + 1
        for b in range(n_batches):
            part = ch.filter((F.col("ts") >= b * step) & (F.col("ts") < (b + 1) * step))
            table.apply(_fold(part), b)
        got = sorted(tuple(r) for r in table.read().select("id", *FIELDS).collect())
        assert got == expected, n_batches
        # replaying the last batch leaves the state unchanged
        last = n_batches - 1
        part = ch.filter((F.col("ts") >= last * step) & (F.col("ts") < (last + 1) * step))
        table.apply(_fold(part), last)
        assert sorted(tuple(r) for r in table.read().select("id", *FIELDS).collect()) == expected


def test_a_null_key_is_one_row_over_batches(spark):
    table = _table(spark, "test-null")
    for b in range(3):
        table.apply(_fold(_changes(spark, [(None, b, f"a{b}", True, None, False), (1, b, "x", True, "y", True)])), b)
    assert sorted(map(tuple, table.read().select("id", *FIELDS).collect()), key=str) == [(1, "x", "y"), (None, "a2", None)]


def test_unreadable_manifest_is_an_error(spark):
    root = session.work_path(spark, "test-broken")
    session.write_text(spark, f"{root}/manifest/batch=0.json", "x")
    table = U.UpsertTable(spark, root, "id", SCHEMA, "ts int")
    with pytest.raises(Exception):  # noqa: B017  whichever error the reader gives, it is not an empty table
        table.read().count()


def test_empty_table_reads_empty(spark):
    table = _table(spark, "test-empty")
    assert table.read().count() == 0


def test_hot_key_is_folded_without_collecting_a_group(spark):
    # a third of all changes hit one key: the fold is a partial + final hash aggregate
    n = 3000
    rows = [((0 if i % 3 == 0 else i), i, str(i), True, None, False) for i in range(n)]
    ch = _changes(spark, rows)
    plan = _fold(ch)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan
    got = {r.id: r.a for r in U.flatten(_fold(ch), "id", FIELDS).collect()}
    assert got[0] == str(max(i for i in range(n) if i % 3 == 0))
    assert dt is not None


def test_snapshot_diff_insert_update_delete(spark):
    from paylake.operators import quality as Q
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], SCHEMA)
    new = spark.createDataFrame([(1, "a", None), (2, "b", "z"), (4, "d", "w")], SCHEMA)
    got = {(r.operation, r.record_id) for r in Q.snapshot_diff(old, new, "id", "t").collect()}
    assert got == {("UPDATE", 2), ("DELETE", 3), ("INSERT", 4)}


def test_diff_as_of_equals_two_snapshot_diff(spark):
    from paylake.operators import quality as Q
    rows = [(i % 9, t, f"a{t % 4}", t % 2 == 0, f"b{t % 3}", t % 3 == 0) for t in range(40) for i in [t, 2 * t]]
    ch = _changes(spark, rows)
    before = F.col("ts") < 20
    one = {(r.operation, r.record_id) for r in
           U.diff_as_of(ch, "id", FIELDS, ["ts"], {"a": "a__p", "b": "b__p"}, before, "t").collect()}
    old = U.flatten(_fold(ch.filter(before)), "id", FIELDS)
    new = U.flatten(_fold(ch), "id", FIELDS)
    two = {(r.operation, r.record_id) for r in Q.snapshot_diff(old, new, "id", "t").collect()}
    assert one == two and len(one) > 0


def test_a_batch_beside_the_state_moves_each_row_once(spark):
    table = _table(spark, "test-beside")
    first = _changes(spark, [(1, 1, "a", True, "b", True), (2, 1, "c", True, None, True), (None, 1, "n", True, "n", True)])
    table.apply(table.beside(table.register_rows(first), 0), 0)
    patch = _changes(spark, [(1, 2, "A", True, None, False), (1, 3, "AA", True, None, False), (3, 2, "d", True, "d", True),
                             (2, 0, "late", True, None, False), (None, 2, "N", True, None, False)])
    both = table.beside(table.register_rows(patch), 1)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    got = {r["id"]: (tuple(r["old"]) if r["old"] else None, tuple(r["new"])) for r in table.old_and_new(both).collect()}
    want = {r["id"]: (tuple(r["old"]) if r["old"] else None, tuple(r["new"])) for r in table.changed(table.fold(patch), 1).collect()}
    assert got == want == {1: (("a", "b"), ("AA", "b")), 2: (("c", None), ("c", None)), 3: (None, ("d", "d")), None: (("n", "n"), ("N", "n"))}
    table.apply(both, 1)
    assert {r["id"]: (r["a"], r["b"]) for r in table.read().collect()} == {k: v[1] for k, v in want.items()}


def test_layers_hold_one_order_a_row(spark):
    table = _table(spark, "test-packed")
    rows = [(1, 1, "a", True, "b", True), (1, 2, "A", True, None, False), (2, None, "x", True, None, False), (2, 1, None, True, "y", True),
            (None, 4, None, False, None, False), (3, None, None, True, "z", False)]
    folded = table.fold(_changes(spark, rows))
    packed = table._pack(folded)
    assert packed.schema.fieldNames() == table.layers.form[0].fieldNames() and packed.filter("_at_r_b is not null").count() == 1
    assert sorted(map(str, table._unpack(packed).collect())) == sorted(map(str, folded.collect()))
    table.apply(folded, 0)
    assert sorted(map(str, table.layers.read().collect())) == sorted(map(str, folded.collect()))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
