"""Registered model, metric and cluster-profile queries (C3).

Oracle-checked keys use deterministic inputs that SQL can express: a fixed
score column for the classification metrics, the label as cluster assignment
for Davies-Bouldin and the anomaly threshold, per-label feature means as the
centroid table. Queries that train a model report agreement with an independent recomputation.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.aggregates import collect_structs, render_structs
from riskflow.operators.metrics import classification_metrics, davies_bouldin, squared_distance
from riskflow.plans import attribution as at
from riskflow.plans import datasets as ds
from riskflow.plans import features as fe
from riskflow.plans import kmeans
from riskflow.plans import leaf_refit as lr
from riskflow.plans import model_checks as mc
from riskflow.plans import models as mo
from riskflow.plans.queries_joins import dataset_sql
from riskflow.plans.registry import AS_OF, fixture, r, register
from riskflow.session import materialize

SCORE = "terminal_id_risk_1day_window"


def _sets(spark, sf_dir):
    """(training set, prediction set) over one stored labelled history."""
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    history = ds.labelled_history(tx, lb, AS_OF)
    return ds.training_set(tx, lb, AS_OF, history=history), ds.prediction_set(tx, lb, AS_OF, history=history)


def _train(spark, sf_dir):
    return _sets(spark, sf_dir)[0]


def _pred(spark, sf_dir):
    return _sets(spark, sf_dir)[1]


def _fitted(train, kind):
    """A model fitted on ``train`` with the reference's settings; every query fits its own."""
    if kind == "kmeans":
        return mo.fit_kmeans(train)
    return mo.fit_classifier(train, kind, class_weights=kind == "gbt")


def _ds_cte(start, end, select) -> str:
    return f"ds AS ({dataset_sql(start, end, select)})"


# --- deterministic metrics ---------------------------------------------------------------------------------------------

@register("metrics_classification", f"""WITH {_ds_cte(5, 0, f"gt.tx_fraud, tf.{SCORE}")},
sc AS (SELECT CAST(tx_fraud AS DOUBLE) AS y, CAST(COALESCE({SCORE}, 0) AS DOUBLE) AS p FROM ds),
cl AS (SELECT y, p, CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END AS yhat,
              least(greatest(p, 1e-15), 1 - 1e-15) AS pc FROM sc),
base AS (SELECT COUNT(*) AS n, SUM(yhat * y) AS tp, SUM(yhat * (1 - y)) AS fp, SUM((1 - yhat) * y) AS fn,
                SUM((1 - yhat) * (1 - y)) AS tn, AVG(-(y * ln(pc) + (1 - y) * ln(1 - pc))) AS log_loss FROM cl),
ps AS (SELECT p, SUM(y) AS pos, SUM(1 - y) AS neg FROM sc GROUP BY p),
cum AS (SELECT pos, neg, SUM(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM ps),
auc AS (SELECT SUM(pos * (neg_cum - neg + 0.5 * neg)) / NULLIF(SUM(pos) * SUM(neg), 0) AS roc_auc FROM cum)
SELECT {r('tp / NULLIF(tp + fp, 0)')} AS precision, {r('tp / NULLIF(tp + fn, 0)')} AS recall,
       {r('(tp + tn) / NULLIF(n, 0)')} AS accuracy, {r('2 * tp / NULLIF(2 * tp + fp + fn, 0)')} AS f1_score,
       {r('log_loss')} AS log_loss, {r('roc_auc')} AS roc_auc, n
FROM base, auc""")
def q_metrics_classification(spark, sf_dir):
    pred = _pred(spark, sf_dir)
    scored = pred.select("tx_fraud", F.coalesce(F.col(SCORE), F.lit(0.0)).alias("score"))
    return classification_metrics(scored, "tx_fraud", "score")


def _sum_sq(a: str, b: str) -> str:
    return " + ".join(f"({a}{c} - {b}{c}) * ({a}{c} - {b}{c})" for c in mo.FEATURES)


# all 25 features, missing values replaced by their mean over the set
_LABEL_CENTROIDS = f"""{_ds_cte(15, 5, "gt.tx_amount, gt.tx_fraud, " + ", ".join("cf." + c for c in mo.FEATURES[1:13])
                                  + ", " + ", ".join("tf." + c for c in mo.FEATURES[13:]))},
im AS (SELECT tx_fraud, {', '.join(f'COALESCE(CAST({c} AS DOUBLE), AVG(CAST({c} AS DOUBLE)) OVER ()) AS {c}' for c in mo.FEATURES)} FROM ds),
cen AS (SELECT tx_fraud, {', '.join(f'AVG({c}) AS {c}' for c in mo.FEATURES)} FROM im GROUP BY tx_fraud),
dist AS (SELECT im.tx_fraud, sqrt({_sum_sq('im.', 'cen.')}) AS d FROM im JOIN cen USING (tx_fraud))"""


def _imputed(train):
    """The label and all features as doubles, missing values replaced by their mean over the set."""
    means = train.select(*[F.avg(F.col(c).cast("double")).alias(c) for c in mo.FEATURES]).first()
    return train.select("tx_fraud", *[F.coalesce(F.col(c).cast("double"), F.lit(means[c]).cast("double")).alias(c) for c in mo.FEATURES])


@register("metrics_davies_bouldin", f"""WITH {_LABEL_CENTROIDS},
sc AS (SELECT tx_fraud, AVG(d) AS s FROM dist GROUP BY tx_fraud),
pair AS (SELECT a.tx_fraud, MAX((sa.s + sb.s) / sqrt({_sum_sq('a.', 'b.')})) AS ratio
         FROM cen a JOIN cen b ON a.tx_fraud <> b.tx_fraud
         JOIN sc sa ON sa.tx_fraud = a.tx_fraud JOIN sc sb ON sb.tx_fraud = b.tx_fraud GROUP BY a.tx_fraud)
SELECT {r('AVG(ratio)')} AS davies_bouldin_index, COUNT(*) AS k FROM pair""")
def q_metrics_davies_bouldin(spark, sf_dir):
    return davies_bouldin(_imputed(_train(spark, sf_dir)), "tx_fraud", mo.FEATURES)


@register("anomaly_threshold", f"""WITH {_LABEL_CENTROIDS},
ranked AS (SELECT d, ROW_NUMBER() OVER (ORDER BY d) AS rn, COUNT(*) OVER () AS n FROM dist)
SELECT n, {r('d')} AS threshold FROM ranked WHERE rn = CAST(greatest(ceil({1 - mo.CONTAMINATION} * n), 1) AS BIGINT)""")
def q_anomaly_threshold(spark, sf_dir):
    train = materialize(_train(spark, sf_dir).select("tx_fraud", *mo.FEATURES), "train")  # read for means, centres and distances
    rows = _imputed(train)
    cents = rows.groupBy("tx_fraud").agg(*[F.avg(c).alias(f"_c_{c}") for c in mo.FEATURES])
    dist = rows.join(cents, "tx_fraud").select(F.sqrt(squared_distance(
        [F.col(c) for c in mo.FEATURES], [F.col(f"_c_{c}") for c in mo.FEATURES])).alias("distance"))
    return mo.anomaly_threshold(dist)


@register("class_weights", f"""WITH {_ds_cte(15, 5, "gt.timestamp, cf.customer_id, tf.terminal_id, gt.tx_fraud")}
SELECT timestamp, customer_id, terminal_id, tx_fraud,
       {r(f"CASE WHEN tx_fraud = 1 THEN {mo.CLASS_WEIGHTS[1]} WHEN tx_fraud = 0 THEN {mo.CLASS_WEIGHTS[0]} ELSE 1.0 END")} AS weight
FROM ds""")
def q_class_weights(spark, sf_dir):
    train = _train(spark, sf_dir)
    return train.select("timestamp", "customer_id", "terminal_id", "tx_fraud",
                        mo.class_weight_column().alias("weight"))


# --- centroid table -> arrays of structs -> pivot ------------------------------------------------------------------

def label_centroids_long(train: DataFrame) -> DataFrame:
    """(centroid_id, feature, numerical_value): per-label feature means, label + 1 as id."""
    means = train.groupBy((F.col("tx_fraud") + 1).cast("int").alias("centroid_id")).agg(
        *[F.avg(F.col(c).cast("double")).alias(c) for c in mo.FEATURES])
    return means.unpivot("centroid_id", mo.FEATURES, "feature", "numerical_value")


_LONG = f"""{_ds_cte(15, 5, "gt.tx_amount, gt.tx_fraud, " + ", ".join("cf." + c for c in mo.FEATURES[1:13])
                     + ", " + ", ".join("tf." + c for c in mo.FEATURES[13:]))},
means AS (SELECT CAST(tx_fraud + 1 AS INTEGER) AS centroid_id,
                 {', '.join(f'AVG(CAST({c} AS DOUBLE)) AS {c}' for c in mo.FEATURES)} FROM ds GROUP BY 1),
long AS (UNPIVOT means ON {', '.join(mo.FEATURES)} INTO NAME feature VALUE numerical_value),
rl AS (SELECT centroid_id, feature, round(numerical_value, 1) AS v FROM long)"""


@register("agg_collect_structs", f"""WITH {_LONG}
SELECT centroid_id, CAST(COUNT(*) AS INTEGER) AS n_features,
       string_agg(feature || '=' || printf('%.1f', v), ';' ORDER BY feature) AS cluster
FROM rl GROUP BY centroid_id""")
def q_agg_collect_structs(spark, sf_dir):
    train = _train(spark, sf_dir)
    arr = collect_structs(label_centroids_long(train), "centroid_id")
    return arr.select("centroid_id", F.size("cluster").alias("n_features"), render_structs("cluster").alias("cluster"))


@register("cluster_profile_pivot", f"""WITH {_LONG}
SELECT 'Cluster#' || CAST(centroid_id AS VARCHAR) AS centroid,
       {', '.join(f"{r(f'MAX(CASE WHEN feature = {chr(39)}{c}{chr(39)} THEN v END)')} AS {c}" for c in mo.FEATURES)}
FROM rl GROUP BY centroid_id ORDER BY centroid_id""")
def q_cluster_profile_pivot(spark, sf_dir):
    train = _train(spark, sf_dir)
    return mo.cluster_profile(label_centroids_long(train))


# --- trained models ----------------------------------------------------------------------------------------------------
# SQL cannot train: each query compares, row by row, what the fitted model says with an independent recomputation from
# its parameters (model_checks) and returns ids, labels and whether both agree, which SQL states as TRUE.

_IDS = "gt.timestamp, cf.customer_id, tf.terminal_id, gt.tx_fraud"
_ID_COLUMNS = [*mo.ID_COLUMNS, "tx_fraud"]
_PREDICTED = f"WITH {_ds_cte(5, 0, _IDS)} SELECT *, TRUE AS probability_agrees, TRUE AS class_agrees FROM ds"
_METRICS = ("precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc")
_EVALUATED = f"WITH {_ds_cte(5, 0, _IDS)} SELECT COUNT(*) AS n, {', '.join(f'TRUE AS {m}_agrees' for m in _METRICS)} FROM ds"
_FEATURE_ROWS = ", ".join(f"('{f}')" for f in mo.FEATURES)
_K_ROWS = ", ".join(f"({i})" for i in range(1, mo.KMEANS_K + 1))


def _agreement(rows, probability):
    return rows.select(*_ID_COLUMNS, mc.close(F.col("fraud_probability"), probability).alias("probability_agrees"),
                       (F.col("predicted_tx_fraud") == (probability > 0.5).cast("int")).alias("class_agrees"))


@register("predict_logreg", _PREDICTED)
def q_predict_logreg(spark, sf_dir):
    train, pred = _sets(spark, sf_dir)
    model = _fitted(train, "logreg")
    return _agreement(mo.predict(model, pred), mc.logistic_probability(model, mo.FEATURES))


@register("predict_gbt", _PREDICTED)
def q_predict_gbt(spark, sf_dir):
    train, pred = _sets(spark, sf_dir)
    model = _fitted(train, "gbt")
    return _agreement(mc.boosted_probability(model, mo.predict(model, pred), mo.FEATURES, "_own"), F.col("_own"))


def _evaluation(spark, sf_dir, kind):
    train, pred = _sets(spark, sf_dir)
    model = _fitted(train, kind)
    pred = materialize(pred, "prediction-set")  # scored for either side
    own, other = mo.evaluate(model, pred), mc.library_metrics(mo.predict(model, pred), "tx_fraud", "fraud_probability")
    # no positive prediction: precision is NULL here and 0 in the library
    return own.select("n", *[mc.close(F.coalesce(F.col(m), F.lit(0.0)), F.lit(float(other[m]))).alias(f"{m}_agrees") for m in _METRICS])


@register("evaluate_logreg", _EVALUATED)
def q_evaluate_logreg(spark, sf_dir):
    return _evaluation(spark, sf_dir, "logreg")


@register("evaluate_gbt", _EVALUATED)
def q_evaluate_gbt(spark, sf_dir):
    return _evaluation(spark, sf_dir, "gbt")


@register("explain_gbt", f"SELECT feature, TRUE AS is_share, TRUE AS sums_to_one, TRUE AS agrees FROM (VALUES {_FEATURE_ROWS}) t(feature)", fixture_cte=False)
def q_explain_gbt(spark, sf_dir):
    """Each attribution against the impurity that the splits of the trees take away."""
    model = _fitted(_train(spark, sf_dir), "gbt")
    rows = mo.global_explain(spark, model)
    total = rows.agg(F.sum("attribution").alias("total"))
    own = spark.createDataFrame(list(mc.tree_importances(model, mo.FEATURES).items()), "feature string, own double")
    return rows.join(total, F.lit(True)).join(own, "feature").select(
        "feature", F.col("attribution").between(0, 1).alias("is_share"), mc.close(F.col("total"), F.lit(1.0)).alias("sums_to_one"),
        mc.close(F.col("attribution"), F.col("own")).alias("agrees"))


@register("explain_gbt_permutation", f"""WITH {_ds_cte(5, 0, _IDS)}
SELECT feature, (SELECT COUNT(*) FROM ds WHERE tx_fraud IS NOT NULL) AS n, TRUE AS same_values, TRUE AS loss_agrees
FROM (VALUES {_FEATURE_ROWS}) t(feature)""")
def q_explain_gbt_permutation(spark, sf_dir):
    """Per feature: the shuffled column holds the values of the column, and the loss equals that of the trees evaluated
    as SQL on the same shuffled rows."""
    train, pred = _sets(spark, sf_dir)
    model = mo.fit_classifier(train, "gbt", class_weights=True, max_iter=10)
    rows = at.numbered_rows(pred, mo.FEATURES, "tx_fraud")
    shuffled = materialize(at.permuted(rows, mo.FEATURES, 1, ["tx_fraud"]), "shuffled")
    both = mc.boosted_probability(model, mo.predict(model, shuffled), mo.FEATURES, "_own")
    y = F.col("tx_fraud")
    losses = both.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.avg(at.log_loss(y, F.col("fraud_probability"))).alias("a"),
                                         F.avg(at.log_loss(y, F.col("_own"))).alias("b"),
                                         *[F.sum(F.xxhash64(f).cast("decimal(38,0)")).alias(f) for f in mo.FEATURES])
    sums = rows.agg(*[F.sum(F.xxhash64(f).cast("decimal(38,0)")).alias(f"_{f}") for f in mo.FEATURES])
    same = F.lit(True)
    for f in mo.FEATURES:
        same = same & (F.col(f) == F.col(f"_{f}"))
    return losses.join(sums, F.lit(True)).select("feature", "n", same.alias("same_values"), mc.close(F.col("a"), F.col("b")).alias("loss_agrees"))


@register("predict_gbt_penalised", _PREDICTED)
def q_predict_gbt_penalised(spark, sf_dir):
    train, pred = _sets(spark, sf_dir)
    model = mo.fit_penalised_trees(train, class_weights=True, max_iter=20)
    return _agreement(mc.penalised_probability(model, mo.predict(model, pred), mo.FEATURES, "_own"), F.col("_own"))


@register("refit_gbt_leaves", f"""WITH {_ds_cte(15, 5, _IDS)}
SELECT CAST(t AS INTEGER) AS tree, (SELECT COUNT(*) FROM ds WHERE tx_fraud IS NOT NULL) AS n, TRUE AS leaves_agree FROM range(10) r(t)""")
def q_refit_gbt_leaves(spark, sf_dir):
    """Per tree: the value of every leaf against the penalised step of its rows, summed in one pass over all trees."""
    train = _train(spark, sf_dir)
    model = mo.fit_penalised_trees(train, class_weights=True, early_stop=False, max_iter=10)
    rows = lr.leaves(model.model, mo._as_double(train.where("tx_fraud IS NOT NULL"), [*mo.FEATURES, "tx_fraud"])
                     .withColumn("_w", mo.class_weight_column()))
    steps, z = [], F.lit(0.0)
    for t, own in enumerate(model.values):
        p = lr.sigmoid(z)
        steps.append(F.struct(F.lit(t).alias("tree"), F.col("_leaves")[t].alias("leaf"), (F.col("_w") * (p - F.col("tx_fraud"))).alias("g"),
                              (F.col("_w") * p * (1 - p)).alias("h")))
        z = z + lr.margin([own], F.array(F.col("_leaves")[t]))
    sums = rows.select(F.explode(F.array(*steps)).alias("s")).select("s.*").groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h"))
    values = spark.createDataFrame([(t, i, v) for t, own in enumerate(model.values) for i, v in enumerate(own)], "tree int, leaf int, value double")
    g, l1, l2 = F.col("g"), mo.PENALTIES["l1"], mo.PENALTIES["l2"]
    step = F.lit(-mo.GBT["stepSize"]) * F.signum(g) * F.greatest(F.abs(g) - F.lit(l1), F.lit(0.0)) / (F.col("h") + F.lit(l2))
    return sums.join(values, ["tree", "leaf"]).groupBy("tree").agg(F.sum("n").alias("n"), F.every(mc.close(step, F.col("value"))).alias("leaves_agree"))


@register("logreg_stop", f"""WITH {_ds_cte(15, 5, _IDS)}
SELECT COUNT(*) AS n, TRUE AS loss_agrees, TRUE AS stops_by_rule FROM ds WHERE tx_fraud IS NOT NULL""")
def q_logreg_stop(spark, sf_dir):
    """The loss of the model that was kept, from its coefficients, and the rule on the losses."""
    data = mo._as_double(_train(spark, sf_dir).where("tx_fraud IS NOT NULL"), [*mo.FEATURES, "tx_fraud"])
    model, losses = mo.fit_logistic(data, mo.FEATURES, "tx_fraud", mo.LOGREG["maxIter"])
    least = mo.LOGREG["min_rel_progress"]
    progress = [(a - b) / abs(a) for a, b in zip(losses, losses[1:])]
    ruled = all(p >= least for p in progress[:-1]) and (progress[-1] < least or len(progress) == mo.LOGREG["maxIter"])
    loss = at.log_loss(F.col("tx_fraud"), mc.logistic_probability(model, mo.FEATURES))
    return data.agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("loss")).select(
        "n", mc.close(F.col("loss"), F.lit(losses[-1])).alias("loss_agrees"), F.lit(ruled).alias("stops_by_rule"))


@register("kmeans_seeds", f"""WITH {_ds_cte(15, 5, _IDS)}
SELECT CAST(k - 1 AS INTEGER) AS turn, (SELECT COUNT(*) FROM ds) AS n, TRUE AS is_row, TRUE AS is_apart FROM (VALUES {_K_ROWS}) a(k)""")
def q_kmeans_seeds(spark, sf_dir):
    """k-means++ centres: rows of the training set, none drawn twice."""
    train = mo._as_double(_train(spark, sf_dir), mo.FEATURES)
    front = Pipeline(stages=mo._front(mo.FEATURES, scale=True)).fit(train)
    points = kmeans.weighted_points(front.transform(train), "features")
    seeds = kmeans.plus_plus(points, mo.KMEANS_K, mo.SEED)
    drawn = spark.createDataFrame([(t, s) for t, s in enumerate(seeds)], "turn int, x array<double>")
    n = points.agg(F.sum("n")).first()[0]
    return drawn.join(points, "x", "left").select("turn", F.lit(n).cast("long").alias("n"), F.col("n").isNotNull().alias("is_row"),
                                                  (F.lit(len({tuple(s) for s in seeds})) == mo.KMEANS_K).alias("is_apart"))


@register("kmeans_centroids", f"""SELECT CAST(k AS INTEGER) AS centroid_id, feature, TRUE AS mean_agrees
FROM (VALUES {_K_ROWS}) a(k), (VALUES {_FEATURE_ROWS}) b(feature)""", fixture_cte=False)
def q_kmeans_centroids(spark, sf_dir):
    """Every centre against the mean of the training rows that are assigned to it (missing values imputed)."""
    train = _train(spark, sf_dir)
    model = mo.fit_kmeans(train, max_iter=200)  # until the centres rest
    cents = mo.centroids_table(spark, model)
    assigned = mo.assign_clusters(model, train)
    means = assigned.groupBy("centroid_id").agg(*[F.avg(c).alias(f) for f, c in zip(mo.FEATURES, mc.imputed(model, mo.FEATURES))])
    means = means.unpivot("centroid_id", mo.FEATURES, "feature", "mean")
    return cents.join(means, ["centroid_id", "feature"], "left").select(
        "centroid_id", "feature", mc.close(F.col("numerical_value"), F.col("mean"), 1e-3).alias("mean_agrees"))


@register("evaluate_kmeans", f"WITH {_ds_cte(15, 5, _IDS)} SELECT COUNT(*) AS n, TRUE AS distance_agrees, TRUE AS index_agrees FROM ds")
def q_evaluate_kmeans(spark, sf_dir):
    """Mean squared distance against the least of all distances; the index against one over collected centres."""
    train = _train(spark, sf_dir)
    model = _fitted(train, "kmeans")
    own = mo.evaluate_kmeans(model, train).first()
    d = mc.nearest_distance(model, mo.FEATURES)
    plain = train.agg(F.count(F.lit(1)).alias("n"), F.avg(d * d).alias("msd"))
    index = mc.davies_bouldin_of_clusters(mo.assign_clusters(model, train), "centroid_id", "x", len(mo.FEATURES))
    return plain.select("n", mc.close(F.col("msd"), F.lit(own["mean_squared_distance"])).alias("distance_agrees"),
                        mc.close(F.lit(index), F.lit(own["davies_bouldin_index"])).alias("index_agrees"))


@register("detect_anomalies", f"WITH {_ds_cte(5, 0, _IDS)} SELECT *, TRUE AS distance_agrees, TRUE AS share_agrees FROM ds")
def q_detect_anomalies(spark, sf_dir):
    """Per row: the distance against the least of all distances; per set: the flagged training rows against the
    contamination (at most n - ceil((1 - c) n), fewer only for ties)."""
    train, pred = _sets(spark, sf_dir)
    model = _fitted(train, "kmeans")
    rule = mo.AnomalyRule(model, train)
    flagged = rule.flagged(rule.train).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anomaly").alias("flagged")).first()
    most = flagged["n"] - math.ceil((1 - mo.CONTAMINATION) * flagged["n"])
    out = rule.apply(pred)
    return out.select(*_ID_COLUMNS, mc.close(F.col("distance"), mc.nearest_distance(model, mo.FEATURES)).alias("distance_agrees"),
                      F.lit(0 < flagged["flagged"] <= most).alias("share_agrees"))


@register("kmeans_cluster_profile", f"""SELECT 'Cluster#' || k AS centroid, TRUE AS values_agree FROM (VALUES {_K_ROWS}) a(k)""", fixture_cte=False)
def q_kmeans_cluster_profile(spark, sf_dir):
    """The reference's cluster profile over the trained k-means centres, each value against the centre it rounds."""
    cents = mo.centroids_table(spark, _fitted(_train(spark, sf_dir), "kmeans"))
    long = mo.cluster_profile(cents).unpivot("centroid", mo.FEATURES, "feature", "rounded")
    both = long.join(cents.withColumn("centroid", F.concat(F.lit("Cluster#"), F.col("centroid_id").cast("string"))), ["centroid", "feature"])
    return both.groupBy("centroid").agg((F.every(F.abs(F.col("rounded") - F.col("numerical_value")) <= 0.05 + 1e-9) & (F.count(F.lit(1)) == len(mo.FEATURES))).alias("values_agree"))
