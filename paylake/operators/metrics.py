"""Exact binary-classification metrics without a global sort.

``roc_pr`` aggregates scores into a histogram ``(score, pos, neg)``, splits
the histogram into score ranges (boundaries from ``percentile_approx``, a
bounded array), takes per-range totals (one row per range) to build offsets,
and computes running sums inside each range with a window partitioned by the
range.  No window ever runs over all rows in one partition.

* ROC-AUC: sum over scores of ``neg * (2 * TP_above + pos) / (2 P N)``, ties
  sharing one ROC point (trapezoid).  The numerator is an exact integer.
* Average precision (step sum, not trapezoid): sum of
  ``pos / P * TP_cum / (TP_cum + FP_cum)`` over descending thresholds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.functions import rules as R


def histogram(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("neg"))


def cumulative_desc(hist: DataFrame, ranges: int = 64) -> DataFrame:
    """Add ``tp``/``fp``: positives / negatives with score >= this score."""
    probs = [i / ranges for i in range(1, ranges)]
    # ranges-1 boundaries: a bounded list, fetched once and used as a literal
    bounds = hist.select(F.percentile_approx("score", probs, 10000)).first()[0] or []
    bounds = sorted(set(float(b) for b in bounds))
    # range id grows with the score; the highest range comes first in desc order
    rid = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>"),
                          lambda b: b < F.col("score")))
    h = hist.withColumn("rid", rid)
    totals = h.groupBy("rid").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))   # <= ranges rows
    w_off = Window.orderBy(F.col("rid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("rid",
                            F.coalesce(F.sum("rp").over(w_off), F.lit(0)).alias("op"),
                            F.coalesce(F.sum("rn").over(w_off), F.lit(0)).alias("on"))
    w_in = Window.partitionBy("rid").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return (h.join(F.broadcast(offsets), "rid")
            .select("score", "pos", "neg",
                    (F.col("op") + F.sum("pos").over(w_in)).alias("tp"),
                    (F.col("on") + F.sum("neg").over(w_in)).alias("fp")))


def exact_quantile(df: DataFrame, col: str, q: float, ranges: int = 64) -> float | None:
    """The exact quantile of a numeric column with linear interpolation; NULL and NaN are left out."""
    return exact_quantiles(df, col, [q], ranges)[0]


def exact_quantiles(df: DataFrame, col: str, qs: list[float], ranges: int = 64) -> list[float | None]:
    """Several exact quantiles of one column from one histogram.

    Values are counted by a distributed histogram; running counts inside value ranges place
    every value in the whole order, and the two values at each rank are picked by one
    aggregation.  No task holds more than its range of distinct values.
    """
    x = F.col(col).cast("double")
    counts = df.filter(x.isNotNull() & ~F.isnan(x)).select(x.alias("score"))
    hist = counts.groupBy("score").agg(F.count(F.lit(1)).alias("pos")).withColumn("neg", F.lit(0)).checkpoint()
    n = hist.agg(F.sum("pos")).first()[0]
    if not n:
        return [None] * len(qs)
    places = [(n - 1) * q for q in qs]
    before = F.lit(n) - F.col("tp")  # rows with a smaller value
    ends = [F.max(F.when(before <= k, F.col("score"))) for at in places for k in (int(at), min(int(at) + 1, n - 1))]
    found = cumulative_desc(hist, ranges).agg(*ends).first()
    return [low if low == high else (int(at) + 1 - at) * low + (at - int(at)) * high
            for at, low, high in zip(places, found[::2], found[1::2], strict=True)]


def roc_pr(scored: DataFrame, score: str = "score", label: str = "label", ranges: int = 64) -> DataFrame:
    """One row: ``roc_auc``, ``average_precision``, ``n_pos``, ``n_neg``; both NULL where a class is absent.

    ``ranges`` is the number of tasks that the running sums may use; raise it with the histogram.
    """
    # the histogram (one row per distinct score) is used three times: compute
    # it once and cut the lineage so the scored input is not scanned again
    hist = histogram(scored, score, label).checkpoint()
    c = cumulative_desc(hist, ranges)
    big = lambda x: F.col(x).cast("decimal(38,0)")  # noqa: E731  N * P can pass 2^63 at scale
    agg = c.agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(big("neg") * (2 * (big("tp") - big("pos")) + big("pos"))).alias("auc_num"),
        F.sum(F.col("pos").cast("double") * F.col("tp").cast("double")
              / (F.col("tp") + F.col("fp")).cast("double")).alias("ap_num"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return agg.select(
        F.when(both, F.col("auc_num").cast("double") / (F.lit(2.0) * F.col("P").cast("double") * F.col("N").cast("double")))
        .alias("roc_auc"),
        F.when(both, F.col("ap_num") / F.col("P").cast("double")).alias("average_precision"),
        F.coalesce("P", F.lit(0)).cast("bigint").alias("n_pos"), F.coalesce("N", F.lit(0)).cast("bigint").alias("n_neg"))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(F.col(label).cast("int").alias("label"),
                        F.col(prediction).cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class (0 when undefined, as sklearn).

    Each confusion cell ``(label, prediction, n)`` is credited to its true
    class (support, true positives) and to its predicted class (predicted
    positives); one small aggregation then gives every class.
    """
    cm = confusion_matrix(pred, label, prediction)
    same = F.col("label") == F.col("prediction")
    credit = F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"),
                 F.when(same, F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("bigint").alias("pred_pos")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                 F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("pred_pos"))))
    agg = (cm.select(credit.alias("c")).select("c.*")
           .groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("pred_pos").alias("pred_pos"),
                               F.sum("support").alias("support")))
    p = F.when(F.col("pred_pos") > 0, F.col("tp").cast("double") / F.col("pred_pos")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp").cast("double") / F.col("support")).otherwise(0.0)
    out = agg.select(F.col("cls").alias("class"), p.alias("precision"), r.alias("recall"),
                     F.col("support").cast("bigint").alias("support"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return out.withColumn("f1", f1)


def risk_band_counts(scored: DataFrame, proba: str = "fraud_proba") -> DataFrame:
    return (scored.select(R.risk_level(proba).alias("risk_level"))
            .groupBy("risk_level").agg(F.count(F.lit(1)).alias("n")))
