"""Exact ROC-AUC / average precision against brute force on small inputs."""

import random

from paylake.operators import metrics as M


def _brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    auc = wins / (len(pos) * len(neg))
    # step-wise average precision over distinct thresholds, descending
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 1)
        fp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 0)
        r = tp / len(pos)
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return auc, ap


def test_roc_pr_matches_brute_force(spark):
    rnd = random.Random(7)
    scores = [round(rnd.random(), 2) for _ in range(400)]          # many ties
    labels = [1 if rnd.random() < s * 0.6 else 0 for s in scores]
    df = spark.createDataFrame(list(zip(scores, labels)), "score double, label int")
    for ranges in (1, 4, 16):
        r = M.roc_pr(df, ranges=ranges).first()
        auc, ap = _brute(scores, labels)
        assert abs(r.roc_auc - auc) < 1e-12
        assert abs(r.average_precision - ap) < 1e-8
        assert r.n_pos == sum(labels) and r.n_neg == len(labels) - sum(labels)


def test_one_class_and_large_counts(spark):
    one = M.roc_pr(spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")).first()
    assert one.roc_auc is None and one.average_precision is None and (one.n_pos, one.n_neg) == (2, 0)
    none = M.roc_pr(spark.createDataFrame([], "score double, label int")).first()
    assert none.roc_auc is None and (none.n_pos, none.n_neg) == (0, 0)


def test_average_precision_does_not_overflow(spark, monkeypatch):
    big = spark.createDataFrame([(0.5, 4 * 10**9, 10**9)], "score double, pos long, neg long")
    monkeypatch.setattr(M, "histogram", lambda *a: big)
    r = M.roc_pr(big).first()
    assert abs(r.average_precision - 0.8) < 1e-12 and r.roc_auc == 0.5


def test_exact_quantile(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 500):
        v = [float(x) for x in rng.integers(0, 60, n)]
        df = spark.createDataFrame([(x,) for x in v] + [(None,), (float("nan"),)], "amount double")
        for q in (0.0, 0.5, 0.95, 1.0):
            for ranges in (1, 5, 64):
                assert abs(M.exact_quantile(df, "amount", q, ranges) - np.quantile(v, q)) < 1e-9
    assert M.exact_quantile(spark.createDataFrame([], "amount double"), "amount", 0.5) is None


def test_split_and_folds_are_exact_per_class(spark):
    from paylake.operators import model as ML
    rows = [(i, int(i % 19 == 0)) for i in range(1013)]
    df = spark.createDataFrame(rows, f"id long, {ML.LABEL} int")
    n = {y: sum(1 for r in rows if r[1] == y) for y in (0, 1)}
    got = {(r["split"], r[ML.LABEL]): r["count"] for r in ML.with_split(df).groupBy("split", ML.LABEL).count().collect()}
    assert {y: got[("test", y)] for y in (0, 1)} == {y: int(n[y] * 0.2 + 0.5) for y in (0, 1)}
    folds = ML.with_folds(df).groupBy("fold", ML.LABEL).count().collect()
    assert len(folds) == 10 and all(abs(r["count"] - n[r[ML.LABEL]] / 5) < 1 for r in folds)


def test_confusion_and_report(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "label int, prediction int")
    cm = {(r.label, r.prediction): r.n for r in M.confusion_matrix(df).collect()}
    assert cm == {(1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 4}
    rep = {r["class"]: r for r in M.classification_report(df).collect()}
    assert rep[1].precision == 3 / 5 and rep[1].recall == 3 / 4 and rep[1].support == 4
    assert abs(rep[1].f1 - 2 * 0.6 * 0.75 / 1.35) < 1e-12
    assert sum(cm.values()) == len(rows)
