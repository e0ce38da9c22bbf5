"""Model evaluation as plain DataFrame aggregates.

* ``classification_metrics``: precision, recall, accuracy, F1, log loss and an
  exact ROC AUC (Mann-Whitney form: ties count one half) from a label and a
  probability column. AUC needs, per positive, the number of negatives with a
  lower score: rows are reduced to one per distinct score and the running
  count comes from ``ordered.running_totals`` (no single-partition sort).
* ``davies_bouldin``: mean over clusters of max_j (s_i + s_j) / d(c_i, c_j), with
  s_i the mean Euclidean distance of cluster i's points to its centroid.
  Centroids are one aggregation; the k x k comparison runs on one row holding
  the k centroids (bounded by k) with higher-order array functions -- no join
  of points with points or clusters with clusters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions import safe_divide
from riskflow.operators.ordered import running_totals

LOG_LOSS_EPS = 1e-15


def classification_metrics(df: DataFrame, label: str = "tx_fraud", prob: str = "fraud_probability",
                           threshold: float = 0.5) -> DataFrame:
    """One row: precision, recall, accuracy, f1_score, log_loss, roc_auc, n (rows with label and score).

    Everything is computed from one row per distinct score (positives and
    negatives at that score): the confusion counts, the summed log loss and the
    AUC credit are sums over that table, in one aggregation.
    """
    scored = (df.where(F.col(label).isNotNull() & F.col(prob).isNotNull())
              .select(F.col(label).cast("double").alias("y"), F.col(prob).cast("double").alias("p")))
    per_score = scored.groupBy("p").agg(F.sum("y").alias("pos"), F.sum(F.lit(1.0) - F.col("y")).alias("neg"))
    cum = running_totals(per_score, "p", ["neg"])
    above = F.col("p") > F.lit(threshold)
    pc = F.least(F.greatest(F.col("p"), F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    zero = F.lit(0.0)
    sums = cum.agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        F.sum(F.when(above, F.col("pos")).otherwise(zero)).alias("tp"),
        F.sum(F.when(above, F.col("neg")).otherwise(zero)).alias("fp"),
        F.sum(F.when(above, zero).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(above, zero).otherwise(F.col("neg"))).alias("tn"),
        F.sum(-(F.col("pos") * F.log(pc) + F.col("neg") * F.log(F.lit(1.0) - pc))).alias("loss"),
        # negatives strictly below the score, plus half of the tied ones
        F.sum(F.col("pos") * (F.col("neg_cum") - F.lit(0.5) * F.col("neg"))).alias("credit"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return sums.select(
        safe_divide(tp, tp + fp).alias("precision"),
        safe_divide(tp, tp + fn).alias("recall"),
        safe_divide(tp + tn, F.col("n")).alias("accuracy"),
        safe_divide(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn).alias("f1_score"),
        safe_divide(F.col("loss"), F.col("n")).alias("log_loss"),
        safe_divide(F.col("credit"), F.col("n_pos") * F.col("n_neg")).alias("roc_auc"),
        F.col("n").cast("long").alias("n"))


def squared_distance(xs: Sequence[Column], cs: Sequence[Column]) -> Column:
    """Squared distance of two points given as columns: one expression, inside generated code."""
    total = F.lit(0.0)
    for x, c in zip(xs, cs):
        total = total + (x - c) * (x - c)
    return total


def davies_bouldin(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """One row ``davies_bouldin_index`` (and ``k``) for the given assignment and features.

    Points meet their centre in an equi-join; the pairs of clusters, which the index is about, are a table of k * k
    rows."""
    n = range(len(features))
    pts = df.select(F.col(cluster).alias("_id"), *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    cents = pts.groupBy("_id").agg(*[F.avg(f"_x{i}").alias(f"_c{i}") for i in n])
    spread = F.sqrt(squared_distance([F.col(f"_x{i}") for i in n], [F.col(f"_c{i}") for i in n]))
    scatter = pts.join(cents, "_id").groupBy("_id").agg(F.avg(spread).alias("_s"))
    table = cents.join(scatter, "_id")
    other = table.select(*[F.col(c).alias(f"_o{c}") for c in table.columns])
    apart = F.sqrt(squared_distance([F.col(f"_c{i}") for i in n], [F.col(f"_o_c{i}") for i in n]))
    worst = (table.join(other, F.col("_id") != F.col("_o_id"), "left").groupBy("_id")
             .agg(F.max(F.try_divide(F.col("_s") + F.col("_o_s"), apart)).alias("_r")))
    return worst.agg(F.avg("_r").alias("davies_bouldin_index"), F.count(F.lit(1)).alias("k"))


def davies_bouldin_arrays(df: DataFrame, cluster: str, x: str, dim: int) -> DataFrame:
    """As ``davies_bouldin`` for points given as one double-array column ``x`` of length ``dim``."""
    pts = df.select(F.col(cluster), *[F.col(x)[i].alias(f"_d{i}") for i in range(dim)])
    return davies_bouldin(pts, cluster, [f"_d{i}" for i in range(dim)])
