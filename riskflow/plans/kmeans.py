"""k-means with k-means++ seeding (M3) as DataFrame aggregations.

Seeding draws each next centre with a probability in proportion to the squared distance from the nearest centre so far.
The draw is one aggregation: every point gets the key log(u) / weight with u from a hash of point, seed and round, and
the point with the largest key is a draw with exactly these weights, so no prefix sums or ordering are needed. Equal
points are counted first (a draw would see them as one); the count multiplies the weight, and rounds work on fewer rows.

The rounds are one grouped aggregation each, over the points as MLlib's own model assigns them; only the k centres meet
the driver. MLlib's k-means takes no start in Python, so models are made from centres (``as_model``).
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.session import materialize

TOLERANCE = 1e-4


def weighted_points(rows: DataFrame, vector: str) -> DataFrame:
    """x (array<double>) and n: every different point and how many rows have it, stored."""
    points = rows.select(vector_to_array(F.col(vector)).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    return materialize(points, "kmeans-points")


def draw(points: DataFrame, weight: Column, seed: int, turn: int) -> list[float] | None:
    """A point drawn with a probability in proportion to ``weight``; None where all weights are 0."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(turn), "x"), 11).cast("double")
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
    return points.select("x", weight.alias("w")).where("w > 0").agg(F.max_by("x", F.log(u) / F.col("w")).alias("x")).first()["x"]


def squared_distance_to(centre: list[float]) -> Column:
    c = F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in centre) + ")")
    return F.aggregate(F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, v: total + v)


def plus_plus(points: DataFrame, k: int, seed: int) -> list[list[float]]:
    """At most ``k`` centres (fewer where there are fewer different points): one aggregation each."""
    centres: list[list[float]] = []
    for turn in range(k):
        apart = [squared_distance_to(c) for c in centres]
        nearest = F.least(*apart) if len(apart) > 1 else apart[0] if apart else F.lit(1.0)
        x = draw(points, F.col("n") * nearest, seed, turn)
        if x is None:
            break
        centres.append(list(x))
    return centres


def as_model(spark: SparkSession, centres: list[list[float]], vector: str, cluster: str) -> KMeansModel:
    """The model whose cluster i has ``centres[i]``."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    vectors = jvm.java.util.ArrayList()
    for c in centres:
        values = gateway.new_array(jvm.double, len(c))
        for i, v in enumerate(c):
            values[i] = float(v)
        vectors.add(jvm.org.apache.spark.mllib.linalg.Vectors.dense(values))
    plain = jvm.org.apache.spark.mllib.clustering.KMeansModel(vectors)
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"kmeans_{abs(hash(tuple(map(tuple, centres)))):x}", plain))
    model._resetUid(model._java_obj.uid())
    return model.setFeaturesCol(vector).setPredictionCol(cluster)


def lloyd(points: DataFrame, centres: list[list[float]], max_iter: int, tolerance: float = TOLERANCE) -> list[list[float]]:
    """Rounds of assignment and means, until no centre moves by more than ``tolerance``; an empty centre stays."""
    rows = points.select(array_to_vector("x").alias("v"), F.col("n").cast("double").alias("n")).persist()
    try:
        for _ in range(max_iter if centres else 0):
            assigned = as_model(points.sparkSession, centres, "v", "c").transform(rows)
            moved = [list(c) for c in centres]
            for r in assigned.groupBy("c").agg(Summarizer.mean(F.col("v"), F.col("n")).alias("mean")).collect():
                moved[r["c"]] = r["mean"].toArray().tolist()
            step = max(sum((a - b) ** 2 for a, b in zip(p, q)) for p, q in zip(centres, moved))
            centres = moved
            if step <= tolerance ** 2:
                break
        return centres
    finally:
        rows.unpersist()
