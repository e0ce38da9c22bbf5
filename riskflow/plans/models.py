"""Supervised and clustering models on the feature sets (C3), with ``pyspark.ml``.

Training is distributed by MLlib (tree aggregation of gradients / histograms /
cluster sums). Missing features (a transaction with no feature row) are mean
imputed with statistics of the training set only. What reaches the driver is
bounded by the model size: coefficients, trees, k centres, feature importances.

Differences from the reference service, stated plainly:
* logistic regression stops at the first iteration whose loss falls by less
  than 1 % of the loss before (``stop_iteration``), with an iteration cap;
* boosted trees have no L1/L2 leaf penalties in MLlib: ``fit_penalised_trees``
  fits the leaf values of the ensemble again with them; column sampling is per
  node (``featureSubsetStrategy``), not per tree; early stopping uses a
  deterministic 10 % hash split of the training rows as validation set;
* k-means starts from k-means++ centres (``kmeans.plus_plus``);
* the service evaluates on rows it held back itself; here evaluation takes an
  explicit data set (the prediction set by default).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.metrics import classification_metrics, davies_bouldin_arrays, squared_distance
from riskflow.operators.ordered import exact_quantile
from riskflow.plans import features as fe
from riskflow.plans import kmeans
from riskflow.plans.attribution import SEEDS, permutation_importance
from riskflow.plans.leaf_refit import RefittedTrees, refit_leaves
from riskflow.session import materialize

LABEL = "tx_fraud"
ID_COLUMNS = ["timestamp", "customer_id", "terminal_id"]
FEATURES = ["tx_amount", *fe.CUSTOMER_COUNT_COLS, *fe.CUSTOMER_AVG_COLS,
            *fe.TERMINAL_COUNT_COLS, *fe.TERMINAL_RISK_COLS]

# Fixed values of the reference model settings.
CLASS_WEIGHTS = {1: 0.02, 0: 1.0}
LOGREG = {"min_rel_progress": 0.01, "maxIter": 20}
GBT = {"maxDepth": 6, "maxIter": 50, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
PENALTIES = {"l1": 0.1, "l2": 0.1}
KMEANS_K = 8
CONTAMINATION = 0.02
VALIDATION_SHARE = 10  # percent of training rows held out for early stopping
SEED = 42


def class_weight_column(label: str = LABEL, weights: dict | None = None):
    """Label -> weight expression (reference default: fraud 0.02, non-fraud 1)."""
    weights = weights or CLASS_WEIGHTS
    expr = None
    for k, v in weights.items():
        expr = (F.when(F.col(label) == F.lit(k), F.lit(float(v))) if expr is None
                else expr.when(F.col(label) == F.lit(k), F.lit(float(v))))
    return expr.otherwise(F.lit(1.0))


def _as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _validation_flag(df: DataFrame) -> DataFrame:
    # by time and ids alone: other columns (weights) do not change the split
    ids = [c for c in ID_COLUMNS if c in df.columns] or [c for c in df.columns if not c.startswith("_")]
    h = F.pmod(F.xxhash64(*[F.col(c) for c in ids]), F.lit(100))
    return df.withColumn("_is_validation", h < F.lit(VALIDATION_SHARE))


def _front(features: Sequence[str], scale: bool) -> list:
    imputed = [f"{f}__imputed" for f in features]
    stages = [Imputer(strategy="mean", inputCols=list(features), outputCols=imputed),
              VectorAssembler(inputCols=imputed, outputCol="raw_features", handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return stages


def stop_iteration(losses: Sequence[float], min_rel_progress: float) -> int:
    """The first iteration whose loss is lower than the one before by less than this share of it; the last if none is.
    ``losses`` starts with the loss before the first iteration."""
    for i in range(1, len(losses)):
        if losses[i - 1] - losses[i] < min_rel_progress * abs(losses[i - 1]):
            return i
    return len(losses) - 1


def fit_logistic(data: DataFrame, features: Sequence[str], label: str, max_iter: int,
                 min_rel_progress: float = LOGREG["min_rel_progress"], validation: DataFrame | None = None) -> tuple[PipelineModel, list[float]]:
    """(model of the iteration at which progress stopped, losses up to it).

    The losses are those of the training rows, which one fit reports for all its iterations; the model is the same fit
    cut off at the stopping iteration. With ``validation`` they are the log losses of those rows, for which the model of
    each iteration is fitted, up to the one that stops."""
    front = Pipeline(stages=_front(features, scale=False)).fit(data)
    rows = front.transform(data).select(F.col(label), "raw_features").persist()

    def cut(n: int):
        return LogisticRegression(featuresCol="raw_features", labelCol=label, tol=0.0, maxIter=n, standardization=True).fit(rows)

    def with_front(model) -> PipelineModel:
        return PipelineModel(stages=[*front.stages, model])

    try:
        if validation is None:
            full = cut(max_iter)
            losses = list(full.summary.objectiveHistory)
            n = stop_iteration(losses, min_rel_progress)
            return with_front(full if n == len(losses) - 1 else cut(n)), losses[:n + 1]
        losses, model = [], None
        for n in range(max_iter + 1):
            model = with_front(cut(n))
            losses.append(evaluate_with(model, validation, features, label).first()["log_loss"])
            if n and stop_iteration(losses[-2:], min_rel_progress) == 1 and losses[-2] - losses[-1] < min_rel_progress * abs(losses[-2]):
                break
        return model, losses
    finally:
        rows.unpersist()


def fit_classifier(train: DataFrame, kind: str = "logreg", features: Sequence[str] = FEATURES,
                   label: str = LABEL, class_weights: dict | bool | None = None, early_stop: bool = True,
                   max_iter: int | None = None, seed: int = SEED) -> PipelineModel:
    """Fit ``logreg`` or ``gbt`` on labelled rows; returns a PipelineModel.

    The rows are stored first: a fit runs hundreds of jobs over them, whose tasks then are as many as the files' splits
    (not the shuffle partitions of ``train``) and report the figures of a scan (not of the plan behind ``train``)."""
    return _fit_stored(_stored_rows(train, features, label), kind, features, label, class_weights, early_stop, max_iter, seed)


def _stored_rows(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return materialize(_as_double(train.where(F.col(label).isNotNull()), [*features, label]), "train")


def _fit_stored(data: DataFrame, kind: str, features: Sequence[str], label: str, class_weights: dict | bool | None,
                early_stop: bool, max_iter: int | None, seed: int) -> PipelineModel:
    if kind == "logreg":
        return fit_logistic(data, features, label, max_iter or LOGREG["maxIter"])[0]
    elif kind == "gbt":
        params = dict(GBT, maxIter=max_iter or GBT["maxIter"])
        gbt = GBTClassifier(featuresCol="raw_features", labelCol=label, seed=seed, **params)
        if class_weights:
            weights = CLASS_WEIGHTS if class_weights is True else class_weights
            data = data.withColumn("_weight", class_weight_column(label, weights))
            gbt.setWeightCol("_weight")
        if early_stop:
            data = _validation_flag(data)
            gbt.setValidationIndicatorCol("_is_validation")
        stages = _front(features, scale=False) + [gbt]
    else:
        raise ValueError(f"unknown classifier {kind!r}")
    return Pipeline(stages=stages).fit(data)


def fit_penalised_trees(train: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL, l1: float = PENALTIES["l1"],
                        l2: float = PENALTIES["l2"], class_weights: dict | bool | None = None, early_stop: bool = True,
                        max_iter: int | None = None, seed: int = SEED) -> RefittedTrees:
    """Boosted trees with L1 and L2 penalties on their leaf values; the rows held out for early stopping stay out."""
    data = _stored_rows(train, features, label)
    model = _fit_stored(data, "gbt", features, label, class_weights, early_stop, max_iter, seed)
    if early_stop:
        data = _validation_flag(data).where(~F.col("_is_validation"))
    weight = class_weight_column(label, CLASS_WEIGHTS if class_weights is True else class_weights) if class_weights else None
    return refit_leaves(model, data, label, l1, l2, GBT["stepSize"], weight)


def predict(model: PipelineModel | RefittedTrees, data: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Adds ``predicted_tx_fraud`` and ``fraud_probability`` (probability of class 1)."""
    if isinstance(model, RefittedTrees):
        scored = model.probability(_as_double(data, list(features)), "fraud_probability")
        return scored.withColumn("predicted_tx_fraud", (F.col("fraud_probability") > 0.5).cast("int"))
    scored = model.transform(_as_double(data, list(features)))
    extra = [c for c in scored.columns if c not in data.columns]
    return (scored.withColumn("fraud_probability", vector_to_array(F.col("probability")).getItem(1))
            .withColumn("predicted_tx_fraud", F.col("prediction").cast("int"))
            .drop(*extra))


def evaluate(model: PipelineModel, data: DataFrame, label: str = LABEL) -> DataFrame:
    return classification_metrics(predict(model, data), label, "fraud_probability")


def evaluate_with(model: PipelineModel, data: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """``evaluate`` for a model fitted on a custom feature list."""
    return classification_metrics(predict(model, data, features), label, "fraud_probability")


def global_explain(spark: SparkSession, model: PipelineModel, features: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, attribution) from the tree ensemble's importances, highest first."""
    importances = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(features, importances), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame(rows, "feature string, attribution double")


def permutation_explain(model: PipelineModel | RefittedTrees, data: DataFrame, features: Sequence[str] = FEATURES,
                        label: str = LABEL, seeds: Sequence[int] = SEEDS) -> DataFrame:
    """(feature, attribution, attribution_sd, baseline): the mean rise of the log loss when the feature is shuffled."""
    return permutation_importance(lambda df: predict(model, df, features), data, features, label, "fraud_probability", seeds)


# --- k-means ---------------------------------------------------------------------------------------------------------

def fit_kmeans(train: DataFrame, k: int = KMEANS_K, features: Sequence[str] = FEATURES, seed: int = SEED,
               max_iter: int = 50) -> PipelineModel:
    """Imputed and scaled features, k-means++ centres, rounds of assignment and means until the centres rest."""
    data = _as_double(train, list(features))
    front = Pipeline(stages=_front(features, scale=True)).fit(data)
    points = kmeans.weighted_points(front.transform(data), "features")
    centres = kmeans.lloyd(points, kmeans.plus_plus(points, k, seed), max_iter)
    return PipelineModel(stages=[*front.stages, kmeans.as_model(train.sparkSession, centres, "features", "_cluster")])


def _kmeans_parts(model: PipelineModel):
    scaler, km = model.stages[-2], model.stages[-1]
    return scaler, km


def assign_clusters(model: PipelineModel, data: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Adds ``centroid_id`` (1-based), ``x`` (scaled features array) and ``distance`` to the nearest centre."""
    _, km = _kmeans_parts(model)
    centers = [c.tolist() for c in km.clusterCenters()]
    out = model.transform(_as_double(data, list(features)))
    x = vector_to_array(F.col("features"))
    own = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])[F.col("_cluster")]  # k centres, a literal
    extra = [c for c in out.columns if c not in data.columns]
    n = range(len(features))
    out = out.withColumn("x", x).withColumn("_own", own)
    return (out.withColumn("centroid_id", F.col("_cluster") + F.lit(1))  # the model has found the nearest centre
            .withColumn("distance", F.sqrt(squared_distance([F.col("x")[i] for i in n], [F.col("_own")[i] for i in n])))
            .drop("_own", *extra))


def centroids_table(spark: SparkSession, model: PipelineModel, features: Sequence[str] = FEATURES) -> DataFrame:
    """(centroid_id, feature, numerical_value) in the original units of the features."""
    scaler, km = _kmeans_parts(model)
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    rows = [(i + 1, f, float(c[j] * std[j] + mean[j]))
            for i, c in enumerate(km.clusterCenters()) for j, f in enumerate(features)]
    return spark.createDataFrame(rows, "centroid_id int, feature string, numerical_value double")


# The reference's profile query shows three terminal risk centres under avg-amount names;
# ``reference_names=True`` reproduces that labelling.
REFERENCE_PROFILE_NAMES = {
    "terminal_id_risk_15min_window": "terminal_id_avg_amount_15min_window",
    "terminal_id_risk_30min_window": "terminal_id_avg_amount_30min_window",
    "terminal_id_risk_60min_window": "terminal_id_avg_amount_60min_window",
}


def cluster_profile(centroids_long: DataFrame, features: Sequence[str] = FEATURES, digits: int = 1,
                    reference_names: bool = False) -> DataFrame:
    """One row per centre: ``Cluster#<id>`` and each feature's centre value rounded to ``digits``,
    sorted by centre id. Input: (centroid_id, feature, numerical_value)."""
    from riskflow.operators.aggregates import pivot_values

    long = centroids_long.withColumn("numerical_value", F.round("numerical_value", digits))
    rename = REFERENCE_PROFILE_NAMES if reference_names else None
    wide = pivot_values(long, "centroid_id", "feature", "numerical_value", list(features), rename)
    cols = [rename.get(f, f) for f in features] if rename else list(features)
    return (wide.orderBy("centroid_id")
            .select(F.concat(F.lit("Cluster#"), F.col("centroid_id").cast("string")).alias("centroid"), *cols))


def save_model(model: PipelineModel, base_path: str, name: str, version: str) -> str:
    """Store a fitted model under ``<base>/<name>/<version>`` (the path carries the version)."""
    path = f"{base_path.rstrip('/')}/{name}/{version}"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def evaluate_kmeans(model: PipelineModel, data: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Davies-Bouldin index and mean squared distance to the nearest centre, in the scaled
    space the model uses."""
    assigned = assign_clusters(model, data, features)
    msd = assigned.agg(F.avg(F.col("distance") * F.col("distance"))).first()[0]  # one scalar
    return (davies_bouldin_arrays(assigned, "centroid_id", "x", len(features))
            .select("davies_bouldin_index", F.lit(msd).cast("double").alias("mean_squared_distance")))


def anomaly_threshold(train_distances: DataFrame, contamination: float = CONTAMINATION,
                      value: str = "distance") -> DataFrame:
    """(n, threshold): the exact (1 - contamination) discrete percentile of training distances."""
    return exact_quantile(train_distances, value, 1.0 - contamination).withColumnRenamed("quantile", "threshold")


class AnomalyRule:
    """Radius of each cluster (mean distance of its training rows; k values) and the threshold on distances in units of
    it that flags ``contamination`` of the training rows (exact discrete percentile)."""

    def __init__(self, model: PipelineModel, train: DataFrame, contamination: float = CONTAMINATION,
                 features: Sequence[str] = FEATURES):
        self.model, self.features = model, features
        assigned = materialize(assign_clusters(model, train, features).select("centroid_id", "distance"), "assigned")
        self.radius = {r["centroid_id"]: r["radius"] for r in assigned.groupBy("centroid_id").agg(F.avg("distance").alias("radius")).collect()}
        self.train = self._normalized(assigned)
        self.threshold = anomaly_threshold(self.train, contamination, "normalized_distance").first()["threshold"]

    def _normalized(self, df: DataFrame) -> DataFrame:
        radius = F.create_map(*[x for cid, rad in sorted(self.radius.items()) for x in (F.lit(cid), F.lit(float(rad)))])
        return df.withColumn("normalized_distance", F.try_divide(F.col("distance"), radius[F.col("centroid_id")]))

    def flagged(self, assigned: DataFrame) -> DataFrame:
        return assigned.withColumn("is_anomaly", F.col("normalized_distance") > F.lit(self.threshold))

    def apply(self, data: DataFrame) -> DataFrame:
        """``data`` plus centroid_id, distance, normalized_distance and is_anomaly."""
        return self.flagged(self._normalized(assign_clusters(self.model, data, self.features).drop("x")))


def detect_anomalies(model: PipelineModel, train: DataFrame, data: DataFrame,
                     contamination: float = CONTAMINATION, features: Sequence[str] = FEATURES) -> DataFrame:
    """``data`` plus centroid_id, distance, normalized_distance and ``is_anomaly``; see ``AnomalyRule``."""
    return AnomalyRule(model, train, contamination, features).apply(data)
