"""Whole-table properties of the operators on the sf0.001 test data."""

from pyspark.sql import functions as F

from paylake.operators import features as FE
from paylake.operators import model as ML
from paylake.operators import star
from paylake.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _star(spark):
    return star.build(fx.transactions(spark, SF_SMALL), fx.customers(spark, SF_SMALL), fx.merchants(spark, SF_SMALL))


def test_fact_and_daily_revenue_cover_all_rows(spark):
    t = _star(spark)
    n = fx.transactions(spark, SF_SMALL).count()
    assert t["fact_transactions"].count() == n
    assert t["agg_daily_revenue"].agg(F.sum("nb_transactions")).first()[0] == n
    assert t["agg_merchant_performance"].agg(F.sum("nb_transactions")).first()[0] == n
    with_ip = fx.transactions(spark, SF_SMALL).filter(F.col("ip_country").isNotNull()).count()
    assert t["agg_fraud_by_country"].agg(F.sum("total")).first()[0] == with_ip


def test_rates_are_percentages(spark):
    rates = _star(spark)["agg_fraud_by_country"].select("fraud_rate_pct").collect()
    assert all(r[0] is None or 0.0 <= r[0] <= 100.0 for r in rates)


def test_split_is_deterministic_and_folds_partition_the_input(spark):
    f = FE.build(fx.transactions(spark, SF_SMALL))
    a = {r.id: r.split for r in ML.with_split(f).collect()}
    b = {r.id: r.split for r in ML.with_split(f.repartition(7)).collect()}
    assert a == b
    folds = ML.with_folds(f)
    assert folds.filter(~F.col("fold").between(0, 4)).count() == 0
    assert folds.count() == f.count() == folds.select("id").distinct().count()
    share = sum(1 for v in a.values() if v == "test") / len(a)
    assert 0.15 < share < 0.25


def test_trained_model_separates_classes(spark):
    model, pred, _ = ML.train(fx.transactions(spark, SF_SMALL), {"numTrees": 20})
    m = {r.metric: r.value for r in ML.evaluate(pred).collect()}
    assert m["roc_auc"] > 0.9
    cm_total = pred.groupBy(ML.LABEL, "prediction").count().agg(F.sum("count")).first()[0]
    assert cm_total == pred.count()


def test_decision_threshold_is_strict(spark):
    from paylake.functions import domains as D
    df = spark.createDataFrame([(0.5,), (0.5000001,)], "p double")
    got = [r[0] for r in df.select((F.col("p") > D.DECISION_THRESHOLD).alias("f")).collect()]
    assert got == [False, True]
