"""Fraud features, label, class balance and weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions import domains as D
from paylake.functions import rules as R
from paylake.operators import metrics as M


def amount_threshold(tx: DataFrame, q: float = 0.95) -> Column:
    """The exact quantile of ``amount`` as a literal (NULL without amounts).

    It is computed here, by jobs over a histogram, since ``percentile`` would merge
    every distinct amount in one reducer.
    """
    return F.lit(M.exact_quantile(tx, "amount", q)).cast("double")


NULLABLE_FEATURES = ["amount", "amount_log", "hour", "day_of_week"]


def build(tx: DataFrame, threshold=None, keep_id: bool = True, drop_incomplete: bool = True,
          passthrough: list[str] | None = None) -> DataFrame:
    """14 features + ``is_fraud``; rows with a NULL feature are dropped.

    ``drop_incomplete=False`` keeps them (scoring keeps every record);
    ``passthrough`` columns are carried along unchanged.

    ``threshold`` is the ``is_high_amount`` cut.  ``None`` uses the 95th
    percentile of ``tx`` itself (the original's per-input rule); scoring should
    pass the value fitted on the training data.
    """
    thr = amount_threshold(tx) if threshold is None else (
        F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold)
    amount = F.col("amount").cast("double")
    hour = F.hour("created_at")
    dow = R.day_of_week_mon0("created_at")
    cols = [
        amount.alias("amount"),
        F.log1p(amount).alias("amount_log"),
        F.coalesce(amount > thr, F.lit(False)).cast("int").alias("is_high_amount"),
        R.one_hot("device_type", "mobile").alias("device_mobile"),
        R.one_hot("device_type", "desktop").alias("device_desktop"),
        R.one_hot("device_type", "tablet").alias("device_tablet"),
        R.one_hot("status", "success").alias("status_success"),
        R.one_hot("status", "failed").alias("status_failed"),
        R.one_hot("status", "refunded").alias("status_refunded"),
        hour.alias("hour"),
        dow.alias("day_of_week"),
        (dow >= 5).cast("int").alias("is_weekend"),
        R.is_night(hour).cast("int").alias("is_night"),
        R.in_set("ip_country", D.HIGH_RISK_COUNTRIES).alias("high_risk_country"),
        R.is_suspected("fraud_score").cast("int").alias(D.LABEL_COLUMN),
    ]
    out = tx.select(*(["id"] if keep_id else []), *(passthrough or []), *cols)
    # Only these features can be NULL (the flags are coalesced to 0/1), so
    # checking them drops exactly the rows a check of all 14 would drop.
    return out.dropna(subset=NULLABLE_FEATURES) if drop_incomplete else out


def label_balance(features: DataFrame, label: str = D.LABEL_COLUMN) -> DataFrame:
    return features.agg(F.count(F.lit(1)).alias("n_samples"),
                        F.sum(label).cast("bigint").alias("n_fraud")).select(
        "n_samples", "n_fraud",
        (F.col("n_fraud").cast("double") * 100 / F.col("n_samples")).alias("fraud_rate_pct"))


def class_weights(features: DataFrame, label: str = D.LABEL_COLUMN) -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` per class (k = number of classes).

    The result has one row per class, so it is bounded and safe to broadcast.
    """
    per = features.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_class"))
    n_total = per.select(F.sum("n_class")).scalar()
    n_classes = per.select(F.count(F.lit(1))).scalar()
    return per.select(
        "label", "n_class",
        (n_total.cast("double") / (n_classes * F.col("n_class"))).alias("weight"))


def with_weights(features: DataFrame, label: str = D.LABEL_COLUMN, weight_col: str = "weight") -> DataFrame:
    """Add balanced class weights as a column.

    The class counts are one row per class (bounded), fetched in one
    aggregation and turned into a CASE expression: no join, and the features
    are read once more only for the counts (persist them first).
    """
    counts = {r[0]: r[1] for r in features.groupBy(label).count().collect()}
    n, k = sum(counts.values()), len(counts)
    w = None
    for cls, n_c in sorted(counts.items()):
        val = F.lit(float(n) / (k * n_c))
        w = F.when(F.col(label) == cls, val) if w is None else w.when(F.col(label) == cls, val)
    return features.withColumn(weight_col, w if w is not None else F.lit(1.0))


def score_defaults(records: DataFrame, as_of=None) -> DataFrame:
    """Add the columns a scoring record lacks, with their default value.

    Column-level rule: a column that exists keeps its values (NULLs included).
    ``created_at`` defaults to ``as_of`` (default: now).
    """
    add = {}
    for col, val in D.SCORING_DEFAULTS.items():
        if col not in records.columns:
            add[col] = F.lit(val)
    if "created_at" not in records.columns:
        add["created_at"] = (F.current_timestamp().cast("timestamp_ntz") if as_of is None
                             else F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of)
    return records.withColumns(add) if add else records


# Types of the raw scoring record fields.
RECORD_TYPES = {
    "id": "string", "customer_id": "string", "merchant_id": "string", "amount": "double",
    "currency_code": "string", "status": "string", "device_type": "string", "ip_country": "string",
    "fraud_score": "double", "created_at": "timestamp_ntz",
}


def read_records(spark, path: str) -> DataFrame:
    """Scoring records from JSON lines; a field that a record lacks is NULL there."""
    schema = ", ".join(f"{c} {t}" for c, t in RECORD_TYPES.items())
    return spark.read.schema(schema).json(path)


def records_frame(spark, records: list[dict]) -> DataFrame:
    """A DataFrame from scoring records given as dicts (one or many).

    Only fields that occur in at least one record become columns, so a field
    missing everywhere is absent and gets its default in ``score_defaults``;
    a field missing in some records is NULL there.
    """
    present = [c for c in RECORD_TYPES if any(c in r for r in records)]
    extra = sorted({k for r in records for k in r} - set(RECORD_TYPES))
    cols = present + extra
    schema = ", ".join(f"{c} {RECORD_TYPES.get(c, 'string')}" for c in cols)
    def conv(c, v):
        if v is not None and RECORD_TYPES.get(c) == "double":
            return float(v)
        return v
    rows = [tuple(conv(c, r.get(c)) for c in cols) for r in records]
    return spark.createDataFrame(rows, schema)
