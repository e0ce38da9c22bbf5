"""Independent recomputation of model outputs, for the checked model queries.

SQL cannot train a model, but what a fitted model says can be recomputed from its parameters: the sigmoid of the
coefficients, the weighted sum of the trees, the distance to the nearest centre. These expressions use none of the
code that scores (``PipelineModel.transform``); the queries report, row by row, whether both agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLOSE = 1e-6


def close(a: Column, b: Column, tolerance: float = CLOSE) -> Column:
    return F.coalesce(F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.lit(1.0), F.abs(b)), a.isNull() & b.isNull())


def imputed(model: PipelineModel, features: Sequence[str]) -> list[Column]:
    """The features with the training means for missing values (one row of the imputer)."""
    means = model.stages[0].surrogateDF.first()
    value = lambda f: F.col(f).cast("double")
    return [F.when(value(f).isNull() | F.isnan(value(f)), F.lit(float(means[f]))).otherwise(value(f)) for f in features]


def logistic_probability(model: PipelineModel, features: Sequence[str]) -> Column:
    lr = model.stages[-1]
    z = F.lit(float(lr.intercept))
    for w, x in zip(lr.coefficients.toArray().tolist(), imputed(model, features)):
        z = z + F.lit(w) * x
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _tree_sql(node, x: str, values=None) -> str:
    """``values``: an iterator over other leaf values, from the left."""
    if node.getClass().getSimpleName() == "LeafNode":
        return f"CAST('{node.prediction() if values is None else next(values)!r}' AS DOUBLE)"
    split = node.split()
    return (f"CASE WHEN {x}{split.featureIndex()} <= CAST('{split.threshold()!r}' AS DOUBLE) "
            f"THEN {_tree_sql(node.leftChild(), x, values)} ELSE {_tree_sql(node.rightChild(), x, values)} END")


def tree_importances(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    """Each feature's share of the impurity that the splits of all trees take away, weighted by their rows."""
    total = dict.fromkeys(features, 0.0)

    def walk(node):
        if node.getClass().getSimpleName() != "LeafNode":
            total[features[node.split().featureIndex()]] += node.gain() * node.impurityStats().count()
            walk(node.leftChild())
            walk(node.rightChild())

    for t in model.stages[-1].trees:
        walk(t._call_java("rootNode"))
    whole = sum(total.values())
    return {f: v / whole if whole else 0.0 for f, v in total.items()}


def penalised_probability(refitted, data: DataFrame, features: Sequence[str], name: str) -> DataFrame:
    """``data`` plus column ``name``: the sigmoid of the refitted leaf values that the trees' splits lead to."""
    rows = data.select("*", *[c.alias(f"_x{i}") for i, c in enumerate(imputed(refitted.model, features))])
    trees = [F.expr(_tree_sql(t._call_java("rootNode"), "_x", iter(v))).alias(f"_t{i}")
             for i, (t, v) in enumerate(zip(refitted.model.stages[-1].trees, refitted.values))]
    rows = rows.select(*data.columns, *trees)
    total = F.lit(0.0)
    for i in range(len(trees)):
        total = total + F.col(f"_t{i}")
    return rows.select(*data.columns, (F.lit(1.0) / (F.lit(1.0) + F.exp(-total))).alias(name))


def boosted_probability(model: PipelineModel, data: DataFrame, features: Sequence[str], name: str) -> DataFrame:
    """``data`` plus column ``name``: the sigmoid of twice the weighted sum of the trees."""
    gbt = model.stages[-1]
    rows = data.select("*", *[c.alias(f"_x{i}") for i, c in enumerate(imputed(model, features))])
    trees = [F.expr(_tree_sql(t._call_java("rootNode"), "_x")).alias(f"_t{i}") for i, t in enumerate(gbt.trees)]
    rows = rows.select(*data.columns, *trees)
    total = F.lit(0.0)
    for i, w in enumerate(gbt.treeWeights):
        total = total + F.lit(float(w)) * F.col(f"_t{i}")
    return rows.select(*data.columns, (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))).alias(name))


def nearest_distance(model: PipelineModel, features: Sequence[str]) -> Column:
    """Distance to the nearest centre in the scaled space: the least over all centres."""
    scaler, km = model.stages[-2], model.stages[-1]
    mean, std = scaler.mean.toArray().tolist(), scaler.std.toArray().tolist()
    xs = [(x - F.lit(m)) / F.lit(s) if s else F.lit(0.0) for x, m, s in zip(imputed(model, features), mean, std)]
    distances = []
    for c in km.clusterCenters():
        total = F.lit(0.0)
        for x, v in zip(xs, c.tolist()):
            total = total + (x - F.lit(v)) * (x - F.lit(v))
        distances.append(F.sqrt(total))
    return F.least(*distances)


def library_metrics(scored: DataFrame, label: str, prob: str) -> dict[str, float]:
    """The same measures from MLlib's evaluators (exact curve: no bins)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    p = F.col(prob)
    rows = scored.select(F.col(label).cast("double").alias("y"), p.alias("p"), (p > 0.5).cast("double").alias("c"),
                         array_to_vector(F.array(F.lit(1.0) - p, p)).alias("v")).persist()
    try:
        many = lambda name, **k: MulticlassClassificationEvaluator(labelCol="y", predictionCol="c", probabilityCol="v", metricName=name, **k).evaluate(rows)
        return {
            "roc_auc": BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="p", metricName="areaUnderROC", numBins=0).evaluate(rows),
            "accuracy": many("accuracy"), "precision": many("precisionByLabel", metricLabel=1.0),
            "recall": many("recallByLabel", metricLabel=1.0), "f1_score": many("fMeasureByLabel", metricLabel=1.0),
            "log_loss": many("logLoss", eps=1e-15)}
    finally:
        rows.unpersist()


def davies_bouldin_of_clusters(assigned: DataFrame, cluster: str, x: str, dim: int) -> float:
    """The index from per-cluster means and scatters (k rows) gathered on the driver."""
    means = {r[0]: list(r)[1:] for r in assigned.groupBy(cluster).agg(*[F.avg(F.col(x)[i]) for i in range(dim)]).collect()}
    centre = F.create_map(*[c for k, m in means.items() for c in (F.lit(k), F.array(*[F.lit(v) for v in m]))])
    rows = assigned.withColumn("_c", centre[F.col(cluster)])
    d = F.sqrt(F.aggregate(F.zip_with(x, "_c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v))
    scatter = {r[0]: r[1] for r in rows.groupBy(cluster).agg(F.avg(d)).collect()}
    apart = lambda a, b: sum((p - q) ** 2 for p, q in zip(means[a], means[b])) ** 0.5
    return sum(max((scatter[a] + scatter[b]) / apart(a, b) for b in means if b != a) for a in means) / len(means)
