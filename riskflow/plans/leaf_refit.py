"""L1 and L2 penalties for boosted trees (M2): the leaf values of a fitted ensemble, fitted again.

MLlib's boosted trees have no leaf penalties. Their splits are kept; the values of the leaves are set anew, tree after
tree, to the penalised second-order step of the logistic loss: with G and H the sums of the gradients and second
derivatives of a leaf's rows at the margin of the trees before, the value is

    - step * sign(G) * max(|G| - l1, 0) / (H + l2)

One grouped aggregation per tree gives the sums of all its leaves (at most 2 ** depth rows meet the driver). The rows'
leaves are computed once by the fitted model and stored as arrays; the margin is a sum of look-ups in literal arrays,
stored again every ``STORE_EVERY`` trees so that neither the expression nor the lineage grows with the ensemble.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.session import materialize

STORE_EVERY = 10


def leaves(model: PipelineModel, data: DataFrame, name: str = "_leaves") -> DataFrame:
    """``data`` plus the number of the row's leaf in each tree (array<int>; leaves are numbered from the left)."""
    trees = model.stages[-1].copy().setLeafCol(name)
    out = trees.transform(PipelineModel(model.stages[:-1]).transform(data))
    return out.select(*data.columns, vector_to_array(F.col(name)).cast("array<int>").alias(name))


def leaf_value(g: float, h: float, l1: float, l2: float, step: float) -> float:
    shrunk = max(abs(g) - l1, 0.0)
    return -step * (shrunk if g > 0 else -shrunk) / (h + l2) if h + l2 > 0 else 0.0


def _looked_up(values: Sequence[float], leaf: Column) -> Column:
    return F.expr("array(" + ",".join(f"CAST('{v!r}' AS DOUBLE)" for v in values) + ")")[leaf]


def margin(values: Sequence[Sequence[float]], trees: Column, first: int = 0) -> Column:
    """The sum of the leaf values of the trees from ``first`` on."""
    total = F.lit(0.0)
    for t in range(first, len(values)):
        total = total + _looked_up(values[t], trees[t])
    return total


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


class RefittedTrees:
    """A fitted ensemble with leaf values of its own: ``values[tree][leaf]`` in units of the log odds."""

    def __init__(self, model: PipelineModel, values: list[list[float]]):
        self.model, self.values = model, values

    def probability(self, data: DataFrame, name: str) -> DataFrame:
        rows = leaves(self.model, data)
        return rows.select(*data.columns, sigmoid(margin(self.values, F.col("_leaves"))).alias(name))

    def save(self, path: str) -> str:
        spark = SparkSession.active()
        self.model.write().overwrite().save(f"{path}/trees")
        rows = [(t, i, v) for t, own in enumerate(self.values) for i, v in enumerate(own)]
        spark.createDataFrame(rows, "tree int, leaf int, value double").write.mode("overwrite").parquet(f"{path}/leaves")
        return path

    @staticmethod
    def load(path: str) -> RefittedTrees:
        spark = SparkSession.active()
        values: list[list[float]] = []
        for r in spark.read.parquet(f"{path}/leaves").orderBy("tree", "leaf").collect():  # the model's own size
            if r["tree"] == len(values):
                values.append([])
            values[-1].append(r["value"])
        return RefittedTrees(PipelineModel.load(f"{path}/trees"), values)


def leaf_sums(rows: DataFrame, tree: Column, at: Column, weight: Column, label: str) -> DataFrame:
    """(leaf, g, h): gradient and second derivative of the logistic loss at margin ``at``, summed by leaf."""
    p = sigmoid(at)
    return rows.select(tree.alias("leaf"), (weight * (p - F.col(label))).alias("g"), (weight * p * (F.lit(1.0) - p)).alias("h")) \
        .groupBy("leaf").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def refit_leaves(model: PipelineModel, train: DataFrame, label: str, l1: float, l2: float, step: float,
                 weight: Column | None = None) -> RefittedTrees:
    """``train``: rows with the columns the model reads and a label of 0 or 1."""
    weight = F.lit(1.0) if weight is None else weight
    rows = leaves(model, train.withColumn("_w", weight)).select(F.col(label).cast("double").alias(label), "_w", "_leaves",
                                                                 F.lit(0.0).alias("_margin"))
    rows = materialize(rows, "leaves")
    values: list[list[float]] = []
    stored = 0
    for t, tree in enumerate(model.stages[-1].trees):
        at = F.col("_margin") + margin(values, F.col("_leaves"), stored)
        own = [0.0] * ((tree.numNodes + 1) // 2)  # leaves of a binary tree; one without rows adds nothing
        for r in leaf_sums(rows, F.col("_leaves")[t], at, F.col("_w"), label).collect():
            own[r["leaf"]] = leaf_value(r["g"], r["h"], l1, l2, step)
        values.append(own)
        if len(values) - stored == STORE_EVERY:
            at = F.col("_margin") + margin(values, F.col("_leaves"), stored)
            rows = materialize(rows.withColumn("_margin", at), "leaves")
            stored = len(values)
    return RefittedTrees(model, values)
