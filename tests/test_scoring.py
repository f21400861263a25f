"""Scoring records given as dicts: defaults, bands, single = batch path."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paylake import session
from paylake.operators import features as FE
from paylake.operators import model as ML
from paylake.plans import catalog
from paylake.sources import fixtures as fx
from tests.conftest import SF_SMALL

# At the edges of the amount tiers, with unusual devices and countries, and with nulls.
BATCH = [
    {"id": "edge-4000", "amount": 4000.01, "currency_code": "GBP", "device_type": "mobile", "ip_country": "NG", "status": "failed"},
    {"id": "edge-2000", "amount": 2000.0, "currency_code": "EUR", "device_type": "tablet", "ip_country": "BR", "status": "refunded"},
    {"id": "edge-1000", "amount": 1000.0, "currency_code": "USD", "device_type": None, "ip_country": None, "status": "success"},
    {"id": "cent", "amount": 0.01, "currency_code": "EUR", "device_type": "desktop", "ip_country": "IT", "status": "success"},
]


def test_records_frame_keeps_missing_fields_absent(spark):
    df = FE.records_frame(spark, BATCH)
    assert "created_at" not in df.columns and "fraud_score" not in df.columns
    d = FE.score_defaults(df, as_of="2024-01-01 03:00:00")
    r = d.filter(F.col("id") == "cent").first()
    assert r.fraud_score == 0.0 and r.created_at == dt.datetime(2024, 1, 1, 3, 0)


def test_score_batch_and_single_records(spark):
    model, _, thr = ML.train(fx.transactions(spark, SF_SMALL), {"numTrees": 10})
    out = {r.id: r for r in ML.score(model, FE.records_frame(spark, BATCH), thr, as_of="2024-01-01 03:00:00").collect()}
    assert set(out) == {r["id"] for r in BATCH}
    for r in out.values():
        assert 0.0 <= r.fraud_proba <= 1.0 and r.risk_level in ("LOW", "MEDIUM", "HIGH")
        assert r.is_fraud == (r.fraud_proba > 0.5)
    assert out["edge-4000"].fraud_proba > out["cent"].fraud_proba
    single = {"id": "night", "amount": 1999.99, "currency_code": "USD", "device_type": "desktop", "ip_country": "PL",
              "status": "failed", "created_at": dt.datetime(2024, 2, 29, 4, 59), "fraud_score": 0.7}
    one = ML.score(model, FE.records_frame(spark, [single]), thr).collect()
    assert len(one) == 1 and one[0].id == "night"
    # a record with a NULL feature is kept with a NULL probability
    miss = ML.score(model, FE.records_frame(spark, [{"id": "x", "amount": None, "currency_code": "EUR"}]), thr,
                    as_of="2024-01-01 03:00:00").first()
    assert miss.fraud_proba is None and miss.risk_level is None


def test_registry_latest_version(spark):
    model, _, thr = ML.train(fx.transactions(spark, SF_SMALL), {"numTrees": 5})
    reg = ML.Registry(spark, session.work_path(spark, "test-registry"))
    assert reg.save("m", model, thr, {"numTrees": 5}, {"roc_auc": 1.0}) == 1
    assert reg.save("m", model, thr, {"numTrees": 5}, {"roc_auc": 1.0}) == 2
    loaded, thr2 = reg.load("m")
    assert thr2 == thr and reg.latest("m")["version"] == 2
    assert loaded.transform(FE.with_weights(FE.build(fx.transactions(spark, SF_SMALL)))).count() > 0


def test_forest_does_not_depend_on_the_input_layout(spark):
    tx = fx.transactions(spark, SF_SMALL)
    got = [ML.train(tx.repartition(n), {"numTrees": 5})[0].stages[-1].featureImportances for n in (2, 7)]
    assert got[0] == got[1]


def test_a_fit_keeps_each_rows_node_between_levels():
    forest = ML.forest_pipeline().getStages()[-1]
    assert forest.getCacheNodeIds() and forest.getCheckpointInterval() == -1


def test_bundles_hold_every_row_with_its_weight(spark):
    feats = FE.with_weights(FE.build(fx.transactions(spark, SF_SMALL), 0.0))
    feats = feats.unionByName(feats).unionByName(feats).unionByName(feats).unionByName(feats).unionByName(feats)
    binned = ML.binner(feats).transform(feats)
    assert max(r[0] for r in binned.select("amount_bin").distinct().collect()) <= ML.BINS - 1
    same = [c for c in ML.bundles(binned, 5).columns if c not in ("weight", "part")]

    def sums(df):
        return {tuple(r)[:-1]: round(r["w"], 6) for r in df.groupBy(*same).agg(F.sum("weight").alias("w")).collect()}

    got = ML.bundles(binned, 5)
    assert sums(got) == sums(binned)
    most = binned.groupBy(*same).count().join(got.groupBy(*same).agg(F.count(F.lit(1)).alias("made")), same)
    assert most.filter("made != greatest(ceil(count / 5), least(count, 4))").count() == 0
    assert got.count() < feats.count()


def test_a_bundled_fit_scores_as_one_of_single_rows_does(spark):
    tx = fx.transactions(spark, "/root/testdata/sf0.01")
    auc = [ML.M.roc_pr(ML.train(tx, {"numTrees": 20}, limit=n)[1], "fraud_proba", ML.LABEL).first()["roc_auc"] for n in (1 << 20, 4000)]
    assert min(auc) > 0.97 and abs(auc[0] - auc[1]) < 0.02
    model, pred, thr = ML.train(tx, {"numTrees": 5}, limit=4000)
    assert model.stages[0].getInputCols() == list(ML.BINNED) and len(model.stages[-1].featureImportances) == 14
    miss = ML.score(model, FE.records_frame(spark, [{"id": "x", "amount": None, "currency_code": "EUR"}]), thr, as_of="2024-01-01 03:00:00").first()
    assert miss.fraud_proba is None


def test_folds_over_bundles_are_whole(spark):
    tx = fx.transactions(spark, SF_SMALL)
    one, more = (ML.cross_validate(tx, {"numTrees": 5}, limit=n).orderBy("fold").collect() for n in (1 << 20, 300))
    assert [(r.fold, r.n_rows, r.n_fraud) for r in one] == [(r.fold, r.n_rows, r.n_fraud) for r in more]
    assert all(0.5 < r.roc_auc <= 1 for r in more)


def _over_a_million(spark):
    """2^20 + 1 transactions."""
    i = F.col("id")
    return spark.range((1 << 20) + 1).select(
        "id", (i * 7919 % 500000 / 100).alias("amount"), F.lit("EUR").alias("currency_code"), F.lit("success").alias("status"),
        F.when(i % 3 == 0, "mobile").otherwise("desktop").alias("device_type"), F.when(i % 5 == 0, "NG").otherwise("FR").alias("ip_country"),
        F.when((i % 15 == 0) | (i % 97 == 0), 0.9).otherwise(0.1).alias("fraud_score"),
        F.timestamp_add("SECOND", i % 604800, F.lit("2024-01-01").cast("timestamp_ntz")).alias("created_at"))


@pytest.mark.parametrize("name", ["train_model", "feature_importance", "risk_band_counts", "cv_folds"])
def test_a_query_fits_every_row_by_itself_at_any_size(spark, monkeypatch, name):
    """Over a million rows too: the forest's trees have a count for each training row, not for bundles of them."""
    seen = []

    def fit(params=None, inputs=FE.D.FEATURE_COLUMNS, pipeline=ML.forest_pipeline):
        p = pipeline({"numTrees": 1, "maxDepth": 1}, inputs)
        fit_rows = p.fit
        p.fit = lambda rows: seen.append(rows.count()) or fit_rows(rows)
        return p

    monkeypatch.setattr(ML, "forest_pipeline", fit)
    monkeypatch.setattr(catalog, "_tx", lambda spark, d: _over_a_million(spark))
    out = catalog.REGISTRY[name](spark, None).collect()
    n = (1 << 20) + 1
    if name == "cv_folds":
        assert len(seen) == len(out) and sum(seen) == n * (len(out) - 1) and sum(r.n_rows for r in out) == n
    else:
        assert len(seen) == 1 and abs(seen[0] - (n - n * FE.D.TEST_FRACTION)) <= 1
    if name == "risk_band_counts":
        assert sum(r.n for r in out) == n
