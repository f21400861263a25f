"""Change-stream consumer: validation, quarantine, dispatch, replay, batch equivalence."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from paylake import session
from paylake.plans import replay
from paylake.streaming import cdc, consumer


def _msg(i, topic, value, ts_min):
    return (topic, str(i), value, dt.datetime(2024, 1, 1, 0, ts_min), i)


def _messages(spark):
    ev = lambda i, **kw: json.dumps({"id": str(i), "customer_id": "c", "merchant_id": "m", "amount": 10.0 + i,
                                     "currency_code": "EUR", **kw})
    rows = [
        _msg(1, "transactions", ev(1, status="success"), 1),
        _msg(2, "fraud_alerts", ev(2, fraud_score=0.9), 2),
        _msg(3, "transactions", "{bad", 3),                          # malformed
        _msg(4, "transactions", "[1]", 4),                           # not an object
        _msg(5, "transactions", json.dumps({"test": "ok"}), 5),      # missing keys
        _msg(6, "transactions", json.dumps({"id": "6", "customer_id": None, "merchant_id": "m",
                                            "amount": None, "currency_code": "EUR"}), 6),  # nulls are present
        _msg(7, "transactions", ev(1, status="failed"), 7),          # update of id 1, status changes
        _msg(8, "transactions", json.dumps({"id": "1", "customer_id": "c", "merchant_id": "m", "amount": 99.0,
                                            "currency_code": "EUR"}), 8),  # status absent: kept
    ]
    return spark.createDataFrame(rows, consumer.MESSAGE_SCHEMA)


def test_validate_reasons(spark):
    v = {r.key: (r.is_valid, r.reason) for r in consumer.validate(_messages(spark)).collect()}
    assert v["3"] == (False, "malformed") and v["4"] == (False, "malformed")
    assert v["5"] == (False, "missing_keys")
    assert v["6"] == (True, None) and v["1"] == (True, None)


def _state(sink):
    return {r.id: (r.amount, r.status) for r in sink.transactions.read().collect()}


def test_bad_timestamp_does_not_fail_the_batch(spark):
    bad = json.dumps({"id": "9", "customer_id": "c", "merchant_id": "m", "amount": 1.0, "currency_code": "EUR",
                      "created_at": "garbage"})
    good = json.dumps({"id": "8", "customer_id": "c", "merchant_id": "m", "amount": 1.0, "currency_code": "EUR",
                       "created_at": "2024-01-01T00:00:07.179575"})
    msgs = spark.createDataFrame([_msg(9, "transactions", bad, 1), _msg(8, "transactions", good, 2)],
                                 consumer.MESSAGE_SCHEMA)
    got = {r.id: r.created_at for r in consumer.parse(consumer.validate(msgs)).collect()}
    assert got == {"9": None, "8": dt.datetime(2024, 1, 1, 0, 0, 7, 179575)}


def test_sink_dispatch_quarantine_and_replay(spark):
    msgs = _messages(spark)
    sink = consumer.ConsumerSink(spark, session.work_path(spark, "test-sink"))
    sink(msgs, 0)
    state = _state(sink)
    assert state == {"1": (99.0, "failed"), "6": (None, None)}
    assert {r.id for r in sink.alerts.read().collect()} == {"2"}
    assert sink.logs().count() == 1
    q = sink.quarantine()
    assert q.count() == 3
    valid = consumer.validate(msgs).filter("is_valid").count()
    assert valid + q.count() == msgs.count()
    sink(msgs, 0)                                   # replay of the same batch id
    assert _state(sink) == state and sink.logs().count() == 1 and sink.quarantine().count() == 3


def test_every_delivered_alert_is_logged_once(spark):
    """The same alert delivered twice is two log rows, in one batch or two; a replay adds none."""
    ev = json.dumps({"id": "5", "customer_id": "c", "merchant_id": "m", "amount": 7.5, "currency_code": "EUR",
                     "fraud_score": 0.95})
    rows = [_msg(1, "fraud_alerts", ev, 1), _msg(2, "fraud_alerts", ev, 2)]
    whole = consumer.ConsumerSink(spark, session.work_path(spark, "test-relog"))
    whole(spark.createDataFrame(rows, consumer.MESSAGE_SCHEMA), 0)
    apart = consumer.ConsumerSink(spark, session.work_path(spark, "test-relog"))
    for i, r in enumerate(rows + rows[1:]):
        apart(spark.createDataFrame([r], consumer.MESSAGE_SCHEMA), min(i, 1))
    for sink in (whole, apart):
        logs = sink.logs().collect()
        assert sorted(r.event_seq for r in logs) == [1, 2]
        assert {(r.transaction_id, r.amount, r.currency) for r in logs} == {("5", 7.5, "EUR")}


def _late_and_null(spark):
    """A late event, a NULL id, a NULL event time, in shuffled order."""
    ev = lambda i, **kw: json.dumps({"id": i, "customer_id": "c", "merchant_id": "m", "amount": 1.0,
                                     "currency_code": "EUR", **kw})
    rows = [_msg(1, "transactions", ev("1", status="success"), 30), _msg(2, "transactions", ev("1", status="failed"), 10),
            _msg(3, "transactions", ev(None, status="a"), 3), _msg(4, "transactions", ev(None, status="b"), 2),
            ("transactions", "7", ev("7", status="x"), None, 5), _msg(6, "transactions", ev("6"), 1),
            _msg(7, "fraud_alerts", ev("9"), 4)]
    return spark.createDataFrame([rows[i] for i in (5, 2, 0, 6, 3, 1, 4)], consumer.MESSAGE_SCHEMA)


def test_stream_batches_equivalent(spark):
    for msgs, want in ((_messages(spark), {"1": (99.0, "failed"), "6": (None, None)}),
                       (_late_and_null(spark), {"1": (1.0, "failed"), None: (1.0, "b"), "7": (1.0, "x"), "6": (1.0, None)})):
        for batches in (1, 3, 7):
            root = session.work_path(spark, f"test-stream-{batches}")
            per_slice = replay.write_slices(msgs, f"{root}/source", batches, 2)
            assert spark.read.parquet(f"{root}/source").count() == msgs.count()
            sink = consumer.ConsumerSink(spark, f"{root}/sink")
            q = consumer.start(spark, consumer.file_source(spark, f"{root}/source", per_slice), sink, f"{root}/ckpt",
                               {"availableNow": True})
            q.awaitTermination()
            prog = consumer.progress(q)
            assert prog["batch_id"] is not None and prog["num_input_rows"] is not None
            assert sink.transactions.read().count() == len(want)
            assert _state(sink) == want, batches
            reports = sink.metrics().collect()
            assert sum(r.n_messages for r in reports) == msgs.count() and sum(r.n_invalid for r in reports) == sink.quarantine().count()
            assert sum(r.n_alerts for r in reports) == sink.logs().count()


def test_order_of_arrival_decides_nothing(spark):
    """The same messages in batches of any order end in the same table (more cuts: test_upsert)."""
    rng, batches = random.Random(3), 3
    for msgs, want in ((_messages(spark), {"1": (99.0, "failed"), "6": (None, None)}),
                       (_late_and_null(spark), {"1": (1.0, "failed"), None: (1.0, "b"), "7": (1.0, "x"), "6": (1.0, None)})):
        rows = msgs.collect()
        rng.shuffle(rows)
        sink = consumer.ConsumerSink(spark, session.work_path(spark, "test-arrival"))
        for b in range(batches):
            sink(spark.createDataFrame(rows[b::batches], consumer.MESSAGE_SCHEMA), b)
        assert _state(sink) == want
        sink(spark.createDataFrame(rows[:2], consumer.MESSAGE_SCHEMA), batches)  # delivered again, in a new batch
        assert _state(sink) == want


def test_one_json_parse_a_message(spark):
    plan = consumer.parse(consumer.validate(_messages(spark)).filter("is_valid"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json") + plan.count("parse_json") == 1, plan
    assert "from_json" not in plan and "json_object_keys" not in plan


def test_repeated_keys_and_odd_values(spark):
    base = '"customer_id": "c", "merchant_id": "m", "currency_code": "EUR"'
    texts = ['{"id": "1", "amount": 1, "amount": 2.5, %s}' % base, '{"id": 7, "amount": "3.25", %s}' % base,
             '{"id": "3", "amount": {"x": 1}, %s}' % base, '{"id": null, "amount": null, %s}' % base, "null", "", None, '"x"', "{}"]
    msgs = spark.createDataFrame([_msg(i, "transactions", t, i) for i, t in enumerate(texts)], consumer.MESSAGE_SCHEMA)
    checked = consumer.validate(msgs)
    assert [r.reason for r in checked.orderBy("event_seq").collect()] == [None] * 4 + ["malformed"] * 4 + ["missing_keys"]
    got = [(r.id, r.amount, r.amount__present, r.status__present) for r in consumer.parse(checked.filter("is_valid")).orderBy("event_seq").collect()]
    assert got == [("1", 2.5, True, False), ("7", 3.25, True, False), ("3", None, True, False), (None, None, True, False)]


def test_offsets_of_timestamps_are_honoured(spark):
    ev = lambda t: json.dumps({"id": t, "customer_id": "c", "merchant_id": "m", "amount": 1.0, "currency_code": "EUR",
                               "created_at": t})
    texts = {"2024-01-01T03:00:00.123456+02:00": dt.datetime(2024, 1, 1, 1, 0, 0, 123456),
             "2024-01-01T03:00:00Z": dt.datetime(2024, 1, 1, 3), "2024-01-01 03:00:00": dt.datetime(2024, 1, 1, 3)}
    msgs = spark.createDataFrame([_msg(i, "transactions", ev(t), i) for i, t in enumerate(texts)], consumer.MESSAGE_SCHEMA)
    assert {r.id: r.created_at for r in consumer.parse(consumer.validate(msgs)).collect()} == texts


def test_cdc_messages_roundtrip_and_nulls(spark):
    tx = spark.createDataFrame(
        [(1, 2, 3, 10.5, "EUR", "success", None, None, None, dt.datetime(2024, 1, 1, 12, 0, 5)),
         (2, 2, 3, 20.0, "USD", "failed", 0.9, "mobile", "NG", dt.datetime(2024, 1, 2, 3, 0, 0, 123456)),
         (3, 2, 3, 20.0, "USD", "failed", float("nan"), None, None, None)],
        "id bigint, customer_id bigint, merchant_id bigint, amount double, currency_code string, status string, "
        "fraud_score double, device_type string, ip_country string, created_at timestamp_ntz")
    m = {r.key: r for r in cdc.to_messages(tx).collect()}
    assert m["1"].topic == "transactions" and m["2"].topic == "fraud_alerts"
    body = json.loads(m["1"].value)
    assert body["fraud_score"] is None and body["id"] == "1" and body["created_at"] == "2024-01-01T12:00:05.000000+00:00"
    assert json.loads(m["2"].value)["created_at"] == "2024-01-02T03:00:00.123456+00:00"
    assert m["3"].topic == "transactions" and json.loads(m["3"].value)["created_at"] is None
    mirrored = cdc.to_messages(tx, mirror_alerts=True)
    assert mirrored.filter(F.col("key") == "2").count() == 2


def test_a_batch_is_kept_in_files_not_in_executors(spark, monkeypatch):
    """Nothing of a stream is persisted, so a batch's size is not held in memory; the files aside are gone after it."""
    frame = type(spark.range(1))
    kept = []
    for name in ("persist", "cache"):
        monkeypatch.setattr(frame, name, lambda self, *a, f=getattr(frame, name), **b: kept.append(self.columns) or f(self, *a, **b))
    msgs, root = _messages(spark), session.work_path(spark, "test-kept")
    replay.write_slices(msgs, f"{root}/source", 3, 2)
    sink = consumer.ConsumerSink(spark, f"{root}/sink")
    sink(spark.read.schema(consumer.MESSAGE_SCHEMA).parquet(f"{root}/source"), 0)
    assert kept == []
    assert _state(sink) == {"1": (99.0, "failed"), "6": (None, None)}
    bad = {(r.topic, r.key, r.value, r.reason) for r in sink.quarantine().collect()}
    assert bad == {("transactions", "3", "{bad", "malformed"), ("transactions", "4", "[1]", "malformed"),
                   ("transactions", "5", json.dumps({"test": "ok"}), "missing_keys")}
    assert session.children(spark, f"{root}/sink/parsed") == []
