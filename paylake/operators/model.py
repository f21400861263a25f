"""Fraud model: split, class-weighted random forest, evaluation, registry, scoring.

* Split and CV folds order each class by a SHA-256 hash of ``(id, seed)`` and cut it at
  exact counts: deterministic, independent of partitioning (unlike ``randomSplit``), and
  stratified exactly.
* The forest is ``pyspark.ml``'s ``RandomForestClassifier`` with balanced
  class weights (``weightCol``).  ``min_samples_split`` has no Spark
  counterpart; ``minInstancesPerNode`` carries ``min_samples_leaf``.  Every row is a training
  row of its own, however many there are; only a caller's ``limit`` fits ``bundles`` instead.
* Registry: a ``PipelineModel`` in a folder of its own and a numbered commit with
  the parameters, metrics, importances and the ``is_high_amount`` threshold fitted on
  the training data.  "latest" is the newest commit.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.functions import domains as D
from paylake.functions import rules as R
from paylake.operators import features as FE
from paylake.operators import metrics as M
from paylake.sources.commits import CommitLog

LABEL = D.LABEL_COLUMN


#: Leading bits of the 60-bit hash by which the cuts are first located.
CUT_BITS = 16


def _hash(id_col: str, seed: int):
    """60 bits of the SHA-256 of ``"<id>:<seed>"``, which any SQL engine computes alike."""
    key = F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.sha2(key, 256), 1, 15), 16, 10).cast("bigint")


def stratified_cuts(df: DataFrame, shares: list[float], seed: int, id_col: str = "id", label: str = LABEL) -> dict:
    """``{class: [(hash, id), ...]}``: the last row of each share of the class, in (hash, id) order.

    A class of n rows is cut after exactly ``floor(n * share + 0.5)`` rows (``None``: before the
    first).  Rows are counted per class and leading hash bits; only the bucket in which a cut
    falls (one row in 2^16) is ranked.  What reaches the driver is a row per class and share.
    """
    rows = df.select(F.col(label).cast("int").alias("y"), F.col(id_col).cast("bigint").alias("id"), _hash(id_col, seed).alias("h"))
    rows = rows.withColumn("bucket", F.shiftright("h", 60 - CUT_BITS)).checkpoint()  # every row is hashed once
    hist = rows.groupBy("y", "bucket").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("y").orderBy("bucket"))
    total = F.sum("c").over(Window.partitionBy("y"))
    want = F.floor(F.col("n") * F.col("share") + 0.5)
    edges = (hist.withColumns({"upto": upto, "n": total})
             .select("*", F.posexplode(F.array(*[F.lit(float(s)) for s in shares])).alias("k", "share"))
             .withColumn("need", want - (F.col("upto") - F.col("c"))).filter("need >= 1 and need <= c").select("y", "bucket", "k", "need"))
    near = rows.join(F.broadcast(edges), ["y", "bucket"])  # a row per class and share
    rank = F.row_number().over(Window.partitionBy("y", "k").orderBy("h", "id"))
    found = {(r["y"], r["k"]): (r["h"], r["id"]) for r in near.withColumn("rank", rank).filter("rank = need").collect()}
    classes = [r["y"] for r in hist.select("y").distinct().collect()]
    return {y: [found.get((y, k)) for k in range(len(shares))] for y in classes}


def _place(cuts: dict, seed: int, id_col: str, label):
    """How many cuts of its class lie before a row."""
    h, i, out = _hash(id_col, seed), F.col(id_col).cast("bigint"), F.lit(None).cast("int")
    for y, ends in cuts.items():
        beyond = [F.lit(1) if e is None else F.when((h > e[0]) | ((h == e[0]) & (i > e[1])), 1).otherwise(0) for e in ends]
        out = F.when(label == y, sum(beyond, F.lit(0))).otherwise(out)
    return out


def with_split(df: DataFrame, test_fraction: float = D.TEST_FRACTION, seed: int = D.SPLIT_SEED,
               id_col: str = "id", cuts: dict | None = None, label=None) -> DataFrame:
    """Add ``split``: exactly the rounded share of each class is ``test``.

    ``cuts`` and ``label`` (a column) apply a split that was cut on another frame of the same ids.
    """
    cuts = cuts if cuts is not None else stratified_cuts(df, [test_fraction], seed, id_col)
    place = _place(cuts, seed, id_col, F.col(LABEL) if label is None else label)
    return df.withColumn("split", F.when(place == 0, "test").otherwise("train"))


def with_folds(df: DataFrame, k: int = D.CV_FOLDS, seed: int = D.SPLIT_SEED, id_col: str = "id") -> DataFrame:
    """Add ``fold``: each class is dealt evenly over the folds (sizes differ by one at most)."""
    cuts = stratified_cuts(df, [f / k for f in range(1, k)], seed + 1, id_col)
    return df.withColumn("fold", _place(cuts, seed + 1, id_col, F.col(LABEL)).cast("int"))


#: Partitions of the training table, whatever the cluster: bagging draws per partition, so the
#: layout is part of the model.
TRAINING_PARTITIONS = 64


def spread(feats: DataFrame, id_col: str = "id", partitions: int = TRAINING_PARTITIONS) -> DataFrame:
    """Deal the training rows by id into a fixed number of sorted partitions.

    Tree training runs one task per partition and level.  The layout depends on the ids and
    ``partitions`` only, not on files or cores, so the same data and seed give the same forest;
    for larger training sets raise ``partitions``.
    """
    return feats.repartition(partitions, id_col).sortWithinPartitions(id_col)


#: Bins of a continuous feature, as many as the forest itself makes (``maxBins``).
BINS = 32
#: Continuous features and their bins in a fit on bundles.
BINNED = {"amount": "amount_bin", "amount_log": "amount_log_bin"}


def training_table(feats: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows one by one, ``spread`` and persisted, whatever their number."""
    return spread(feats, id_col).persist()


def bundle_size(rows: DataFrame, limit: int) -> int:
    """How many equal rows a bundle may hold for about ``limit`` bundles."""
    return max(1, -(-rows.count() // limit))


def binner(feats: DataFrame) -> Bucketizer:
    """Bins of equal counts for the continuous features, cut at exact quantiles of ``feats``."""
    edges = sorted({e for e in M.exact_quantiles(feats, "amount", [i / BINS for i in range(1, BINS)]) if e is not None})
    cuts = [edges, sorted({math.log1p(e) for e in edges})]
    return Bucketizer(splitsArray=[[-math.inf, *c, math.inf] for c in cuts], inputCols=list(BINNED),
                      outputCols=list(BINNED.values()), handleInvalid="keep")


def bundles(rows: DataFrame, k: int, count: Column | None = None, partitions: int = TRAINING_PARTITIONS) -> DataFrame:
    """Binned training rows with equal features, class and weight together, at most ``k`` in a bundle.

    The forest sees no more of a row than its bins, and the other features take few values, so
    the combinations are bounded.  Every row counts: a bundle has the weight of its rows.  A
    combination of n rows makes at least min(n, 4) bundles, since ``minInstancesPerNode`` counts
    bundles; what differs from single rows is that a tree's bag draws a bundle's rows together.
    ``count``: rows that each row stands for.
    """
    same = [*[BINNED.get(c, c) for c in D.FEATURE_COLUMNS], LABEL, "weight"]
    of = rows.groupBy(*same).agg(F.sum(F.lit(1) if count is None else count).alias("n"))
    made = F.greatest(F.ceil(F.col("n") / k), F.least("n", F.lit(4))).cast("long")
    parts = of.withColumn("made", made).withColumn("part", F.explode(F.sequence(F.lit(1).cast("long"), "made")))
    size = F.floor(F.col("n") / F.col("made")) + F.when(F.col("part") <= F.col("n") % F.col("made"), 1).otherwise(0)
    return (parts.withColumn("weight", F.col("weight") * size).repartition(partitions, *same[:-1], "part")
            .sortWithinPartitions(*same[:-1], "part").drop("n", "made"))


def forest_pipeline(params: dict | None = None, inputs: list[str] = D.FEATURE_COLUMNS) -> Pipeline:
    p = dict(D.FOREST_PARAMS)
    p.update(params or {})
    p.setdefault("maxMemoryInMB", 1024)  # more tree nodes a pass, so fewer passes over the rows
    # each row's node is kept from level to level, not sought from the root again (the same trees);
    # ten levels need no checkpoints in between
    p.setdefault("cacheNodeIds", True)
    p.setdefault("checkpointInterval", -1)
    asm = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    rf = RandomForestClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight",
                                featureSubsetStrategy="sqrt", **p)
    return Pipeline(stages=[asm, rf])


def fit_bundles(binning: Bucketizer, bundled: DataFrame, params: dict | None = None) -> PipelineModel:
    """The forest of a table of bundles; the model bins the continuous features itself."""
    inputs = [BINNED.get(c, c) for c in D.FEATURE_COLUMNS]
    return PipelineModel([binning, *forest_pipeline(params, inputs).fit(bundled).stages])


def predict(model: PipelineModel, feats: DataFrame) -> DataFrame:
    """Adds ``fraud_proba`` (NULL when a feature is NULL) and ``prediction``."""
    out = model.transform(feats)
    complete = F.lit(True)
    for c in D.FEATURE_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    proba = F.when(complete, vector_to_array("probability")[1])
    return (out.withColumn("fraud_proba", proba)
            .drop("features", "rawPrediction", "probability", "prediction", *BINNED.values())
            .withColumn("prediction", (F.col("fraud_proba") > D.DECISION_THRESHOLD).cast("int")))


def train(tx: DataFrame, params: dict | None = None, test_fraction: float = D.TEST_FRACTION,
          seed: int = D.SPLIT_SEED, limit: int | None = None):
    """Fit on the train split; returns ``(model, test_predictions, threshold)``.

    The ``is_high_amount`` threshold is fitted on the training rows only and
    returned so scoring can reuse it.  The forest sees every row by itself at any size;
    a ``limit`` asks for a fit on ``bundles``, about that many of them.
    """
    cuts = stratified_cuts(FE.build(tx, 0.0), [test_fraction], seed)  # which rows and classes: no threshold needed
    split = with_split(tx, test_fraction, seed, cuts=cuts, label=R.is_suspected("fraud_score").cast("int"))
    threshold = M.exact_quantile(split.filter(F.col("split") == "train"), "amount", 0.95)
    base = training_table(with_split(FE.build(tx, threshold), test_fraction, seed, cuts=cuts))
    try:
        feats = FE.with_weights(base)
        rows = feats.filter(F.col("split") == "train")
        if limit is None:
            model = forest_pipeline(params).fit(rows)
        else:
            binning = binner(rows)
            model = fit_bundles(binning, bundles(binning.transform(rows), bundle_size(base, limit)), params)
        test_pred = predict(model, feats.filter(F.col("split") == "test")).checkpoint()
    finally:
        base.unpersist()
    return model, test_pred, threshold


def evaluate(test_pred: DataFrame) -> DataFrame:
    """``(metric, value)``: ROC-AUC, average precision, class-1 precision/recall/F1."""
    auc = M.roc_pr(test_pred, "fraud_proba", LABEL)
    rep = M.classification_report(test_pred, LABEL, "prediction").filter(F.col("class") == 1)
    a = F.explode(F.array(
        F.struct(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")),
        F.struct(F.lit("pr_auc").alias("metric"), F.col("average_precision").alias("value"))))
    b = F.explode(F.array(
        F.struct(F.lit("precision").alias("metric"), F.col("precision").alias("value")),
        F.struct(F.lit("recall").alias("metric"), F.col("recall").alias("value")),
        F.struct(F.lit("f1_score").alias("metric"), F.col("f1").alias("value"))))
    return auc.select(a.alias("m")).select("m.*").unionByName(rep.select(b.alias("m")).select("m.*"))


def cross_validate(tx: DataFrame, params: dict | None = None, k: int = D.CV_FOLDS,
                   seed: int = D.SPLIT_SEED, parallelism: int = 2, limit: int | None = None) -> DataFrame:
    """k-fold CV on ROC-AUC with hash folds.

    Returns one row per fold: ``fold, n_rows, n_fraud, roc_auc`` (exact AUC of
    the model fitted on the other folds) plus ``cv_roc_auc_mean`` and the
    population ``cv_roc_auc_std`` over the folds.  Each fit is a distributed
    ``pyspark.ml`` job; ``parallelism`` folds are fitted at the same time
    (independent, fixed seeds: the result does not depend on it).  Every row is fitted by itself at
    any size; a ``limit`` asks for fits on ``bundles``, about that many of them.
    """
    spark = tx.sparkSession
    base = training_table(with_folds(FE.build(tx), k, seed))
    cells = None
    try:
        feats = FE.with_weights(base)
        if limit is not None:  # the combinations of features are counted once by fold
            binning, most = binner(feats), bundle_size(base, limit)
            same = [*[BINNED.get(c, c) for c in D.FEATURE_COLUMNS], LABEL, "weight"]
            cells = binning.transform(feats).groupBy("fold", *same).agg(F.count(F.lit(1)).alias("n")).persist()
        counts = feats.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.sum(LABEL).cast("bigint").alias("n_fraud"))
        def fold_auc(f: int) -> tuple[int, float]:
            if cells is None:
                model = forest_pipeline(params).fit(feats.filter(F.col("fold") != f))
            else:
                model = fit_bundles(binning, bundles(cells.filter(F.col("fold") != f), most, F.col("n")), params)
            pred = predict(model, feats.filter(F.col("fold") == f))
            return f, float(M.roc_pr(pred, "fraud_proba", LABEL).first()["roc_auc"])

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            aucs = sorted(pool.map(fold_auc, range(k)))
        per_fold = spark.createDataFrame(aucs, "fold int, roc_auc double")      # k rows
        summary = per_fold.agg(F.avg("roc_auc").alias("m"), F.stddev_pop("roc_auc").alias("s")).first()
        out = (counts.join(per_fold, "fold")
               .withColumns({"cv_roc_auc_mean": F.lit(summary["m"]), "cv_roc_auc_std": F.lit(summary["s"])})
               .checkpoint())
    finally:
        base.unpersist()
        if cells is not None:
            cells.unpersist()
    return out


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """14-row table (one row per feature), most important first."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(c, float(v)) for c, v in zip(D.FEATURE_COLUMNS, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


# --- registry ------------------------------------------------------------------

def run_parameters(params: dict | None = None, test_fraction: float = D.TEST_FRACTION, seed: int = D.SPLIT_SEED) -> dict:
    """The parameters a run was made with, defaults included."""
    return {**D.FOREST_PARAMS, **(params or {}), "test_size": test_fraction, "random_state": seed}


class Registry:
    """Fitted models with the record of their run, numbered by a commit log for each name.

    A record holds the parameters, the metrics (with the mean and deviation of the folds where
    they were cross-validated), the feature importances (``fi_<feature>``) and the
    ``is_high_amount`` threshold.  Model files are written aside first; the commit gives the
    version, so two savers get different ones and a version that shows is whole.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{name}/_versions")

    def latest(self, name: str) -> dict | None:
        found = self._log(name).newest()
        return {"version": found[0], **found[1]} if found else None

    def save(self, name: str, model: PipelineModel, threshold: float, params: dict, metrics: dict[str, float],
             cross_validation: dict[str, float] | None = None) -> int:
        folder = f"{name}/{uuid.uuid4().hex}"
        model.write().save(f"{self.root}/{folder}")
        importance = {f"fi_{c}": float(v) for c, v in zip(D.FEATURE_COLUMNS, model.stages[-1].featureImportances.toArray())}
        return self._log(name).commit({"name": name, "folder": folder, "threshold": float(threshold), "params": params,
                                       "metrics": {**metrics, **(cross_validation or {}), **importance}})

    def runs(self, name: str) -> DataFrame:
        """``(version, kind, name, value)``: parameters, metrics and importances of every run, as text."""
        rows = [(v, kind, k, str(x)) for v in self._log(name).numbers() for kind in ("params", "metrics")
                for k, x in sorted(self._log(name).get(v)[kind].items())]
        return self.spark.createDataFrame(rows, "version int, kind string, name string, value string")

    def load(self, name: str, version: int | str = "latest") -> tuple[PipelineModel, float]:
        info = self.latest(name) if version == "latest" else self._log(name).get(int(version))
        if info is None:
            raise FileNotFoundError(f"no model named {name}")
        return PipelineModel.load(f"{self.root}/{info['folder']}"), info["threshold"]


def score_records(scored: DataFrame) -> DataFrame:
    """Scores as the records a caller gets; a record without id is called ``unknown``."""
    return scored.select(F.coalesce(F.col("id").cast("string"), F.lit("unknown")).alias("transaction_id"), "amount",
                         F.col("currency_code").alias("currency"), F.round("fraud_proba", 4).alias("fraud_proba"),
                         (F.col("fraud_proba") > D.DECISION_THRESHOLD).alias("is_fraud"), R.risk_level("fraud_proba").alias("risk_level"))


def write_score_records(scored: DataFrame, path: str) -> None:
    """Score records as JSON lines, NULL fields written out."""
    score_records(scored).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def score(model: PipelineModel, records: DataFrame, threshold: float, as_of=None) -> DataFrame:
    """Score any number of records: ``id, amount, currency_code, fraud_proba, is_fraud, risk_level``.

    Missing columns get their defaults; a record with a NULL feature is kept
    with a NULL probability and band.  Narrow: no shuffle.
    """
    rec = FE.score_defaults(records, as_of)
    feats = FE.build(rec, threshold, keep_id=True, drop_incomplete=False, passthrough=["currency_code"])
    return predict(model, feats).select(
        "id", "amount", "currency_code",
        F.round("fraud_proba", 4).alias("fraud_proba"),
        (F.col("fraud_proba") > D.DECISION_THRESHOLD).alias("is_fraud"),
        R.risk_level("fraud_proba").alias("risk_level"))
