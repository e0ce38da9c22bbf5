"""Models on the planted fixture signal (fixed seeds)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from riskflow.plans import attribution, kmeans, leaf_refit
from riskflow.plans import datasets as ds
from riskflow.plans import models as mo
from riskflow.sources.fixtures import load_fixture

AS_OF = "2024-01-31 00:00:00"


@pytest.fixture(scope="module")
def sets(spark):
    tx, lb = load_fixture(spark, SF_MID)
    train = ds.training_set(tx, lb, AS_OF).checkpoint()
    pred = ds.prediction_set(tx, lb, AS_OF).checkpoint()
    return train, pred


def _with_signal(df):
    # The fixture's planted label rule (event type, user id) is not visible in the
    # features, so AUC on them is ~0.5. A feature that carries the label (plus hash
    # noise) checks that fitting works and that the class-1 probability is used.
    noise = (F.abs(F.xxhash64("timestamp", "tx_amount")) % 1000) / 1000.0
    return df.withColumn("signal", F.col("tx_fraud") * 0.6 + noise)


def test_logreg_learns_a_real_signal(spark, sets):
    train, pred = sets
    feats = [*mo.FEATURES, "signal"]
    model = mo.fit_classifier(_with_signal(train), "logreg", features=feats)
    m = mo.evaluate_with(model, _with_signal(pred), feats).collect()[0]
    assert m["roc_auc"] > 0.9 and m["n"] == pred.count()


def test_validation_split_ignores_weights(spark, sets):
    train, _ = sets
    plain = mo._validation_flag(train).select("timestamp", "customer_id", "terminal_id", "_is_validation")
    weighted = mo._validation_flag(train.withColumn("_weight", F.lit(7.0))).select("timestamp", "customer_id", "terminal_id", "_is_validation")
    assert plain.exceptAll(weighted).count() == 0
    share = plain.where("_is_validation").count() / plain.count()
    assert 0.06 < share < 0.14


def test_gbt_with_class_weights_and_explain(spark, sets):
    train, pred = sets
    model = mo.fit_classifier(train, "gbt", class_weights=True, max_iter=5)
    scored = mo.predict(model, pred)
    assert scored.count() == pred.count()
    assert scored.where((F.col("fraud_probability") < 0) | (F.col("fraud_probability") > 1)).count() == 0
    imp = mo.global_explain(spark, model).collect()
    assert len(imp) == len(mo.FEATURES) and abs(sum(r["attribution"] for r in imp) - 1.0) < 1e-6


def test_class_weight_column(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "tx_fraud int")
    got = [r[0] for r in df.select(mo.class_weight_column()).collect()]
    assert got == [0.02, 1.0, 1.0]


def test_kmeans_centroids_anomalies(spark, sets):
    train, pred = sets
    model = mo.fit_kmeans(train)
    cents = mo.centroids_table(spark, model)
    assert cents.count() == mo.KMEANS_K * len(mo.FEATURES)
    db = mo.evaluate_kmeans(model, train).collect()[0]["davies_bouldin_index"]
    assert db > 0
    flagged = mo.detect_anomalies(model, train, train)
    share = flagged.where("is_anomaly").count() / flagged.count()
    assert 0.0 < share <= mo.CONTAMINATION + 1e-9


def test_cluster_profile_names_and_model_round_trip(spark, sets):
    from riskflow.session import scratch_path

    train, pred = sets
    model = mo.fit_kmeans(train, k=3)
    long = mo.centroids_table(spark, model)
    prof = mo.cluster_profile(long)
    assert prof.count() == 3 and prof.columns[0] == "centroid" and "terminal_id_risk_15min_window" in prof.columns
    ref = mo.cluster_profile(long, reference_names=True)
    assert "terminal_id_avg_amount_15min_window" in ref.columns and "terminal_id_risk_15min_window" not in ref.columns
    path = mo.save_model(model, scratch_path(spark, "models"), "kmeans", "v1")
    again = mo.load_model(path)
    a = mo.assign_clusters(model, pred).select("centroid_id")
    b = mo.assign_clusters(again, pred).select("centroid_id")
    assert a.exceptAll(b).count() == 0


# --- penalties, attribution, stopping, seeding ---------------------------------------------------------------------------

def _boost_by_hand(leaves, y, w, l1, l2, step):
    """Leaf values and margins tree after tree, with NumPy."""
    z, values = np.zeros(len(y)), []
    for t in range(leaves.shape[1]):
        p = 1 / (1 + np.exp(-z))
        g, h = w * (p - y), w * p * (1 - p)
        own = {}
        for leaf in np.unique(leaves[:, t]):
            m = leaves[:, t] == leaf
            own[int(leaf)] = -step * np.sign(g[m].sum()) * max(abs(g[m].sum()) - l1, 0) / (h[m].sum() + l2)
        z = z + np.array([own[int(v)] for v in leaves[:, t]])
        values.append(own)
    return values, z


def test_penalised_leaves_follow_the_formula(spark):
    """12 trees, so that the margin is stored on the way; weights; strong penalties set small leaves to zero."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, tx_fraud int")
    for l1, l2 in ((0.1, 0.1), (0.0, 0.0), (1000.0, 0.0)):
        model = mo.fit_penalised_trees(df, ["a", "b"], l1=l1, l2=l2, class_weights={1: 0.5, 0: 1.0}, early_stop=False, max_iter=12)
        rows = leaf_refit.leaves(model.model, df).collect()
        leaves = np.array([r["_leaves"] for r in rows])
        label = np.array([r["tx_fraud"] for r in rows])
        values, z = _boost_by_hand(leaves, label, np.where(label == 1, 0.5, 1.0), l1, l2, mo.GBT["stepSize"])
        for t, own in enumerate(values):
            for leaf, v in own.items():
                assert abs(model.values[t][leaf] - v) < 1e-9
        got = mo.predict(model, df.select("a", "b", "tx_fraud"), ["a", "b"]).collect()
        assert np.allclose([r["fraud_probability"] for r in got], 1 / (1 + np.exp(-z)))
        if l1 == 1000.0:
            assert all(v == 0 for own in model.values for v in own)
        elif l1 == 0.1:
            assert mo.evaluate_with(model, df, ["a", "b"]).first()["roc_auc"] > 0.9


def test_penalised_trees_round_trip_and_pure_leaves(spark):
    from riskflow.session import scratch_path

    df = spark.createDataFrame([(float(i), int(i > 10)) for i in range(40)], "a double, tx_fraud int")
    model = mo.fit_penalised_trees(df, ["a"], early_stop=False, max_iter=5)
    again = leaf_refit.RefittedTrees.load(model.save(scratch_path(spark, "trees")))
    assert again.values == model.values
    a, b = (mo.predict(m, df, ["a"]).select("a", "fraud_probability").exceptAll(mo.predict(model, df, ["a"]).select("a", "fraud_probability")) for m in (model, again))
    assert a.count() == b.count() == 0


def test_permutation_ranks_the_planted_feature_first(spark, sets):
    train, pred = sets
    feats = ["tx_amount", "customer_id_nb_tx_7day_window", "signal"]
    model = mo.fit_classifier(_with_signal(train), "gbt", features=feats, max_iter=5)
    got = mo.permutation_explain(model, _with_signal(pred), feats, seeds=(1, 2, 3)).orderBy(F.desc("attribution")).collect()
    assert got[0]["feature"] == "signal" and got[0]["attribution"] > 10 * abs(got[1]["attribution"]) and got[0]["attribution_sd"] > 0
    assert len({r["baseline"] for r in got}) == 1


def test_permutation_is_a_permutation(spark):
    df = spark.createDataFrame([(i % 2, float(i), float(-i) if i % 5 else None) for i in range(200)], "tx_fraud int, a double, b double")
    rows = attribution.numbered_rows(df, ["a", "b"], "tx_fraud")
    assert sorted(r[0] for r in rows.select("_number").collect()) == list(range(200))
    orders = []
    for seed in (1, 2):
        out = attribution.permuted(rows, ["a", "b"], seed, ["_number"]).collect()
        one = {f: {r["_number"]: r for r in out if r["feature"] == f} for f in ("a", "b")}
        base = {r["_number"]: r for r in rows.collect()}
        for f, other in (("a", "b"), ("b", "a")):
            assert set(one[f]) == set(base)
            assert all(one[f][i][other] == base[i][other] for i in base)
            key = lambda v: (v is None, v or 0)
            assert sorted((r[f] for r in one[f].values()), key=key) == sorted((r[f] for r in base.values()), key=key)
        orders.append([one["a"][i]["a"] for i in sorted(base)])
    assert orders[0] != orders[1] != [base[i]["a"] for i in sorted(base)]


def test_stop_iteration():
    assert mo.stop_iteration([1.0, 0.5, 0.499, 0.1], 0.01) == 2
    assert mo.stop_iteration([1.0, 0.5, 0.25], 0.01) == 2
    assert mo.stop_iteration([1.0, 1.2], 0.01) == 1  # a rise is no progress
    assert mo.stop_iteration([1.0], 0.01) == 0


def test_logistic_keeps_the_model_of_the_stopping_iteration(spark, sets):
    train, pred = sets
    feats = ["tx_amount", "signal"]
    data = mo._as_double(_with_signal(train), [*feats, "tx_fraud"])
    model, losses = mo.fit_logistic(data, feats, "tx_fraud", 20)
    longer, all_losses = mo.fit_logistic(data, feats, "tx_fraud", 20, min_rel_progress=0.0)
    n = len(losses) - 1
    assert 0 < n < len(all_losses) - 1 and np.allclose(losses, all_losses[:n + 1])
    assert model.stages[-1].summary.totalIterations == n
    loss = attribution.log_loss(F.col("tx_fraud"), F.col("fraud_probability"))
    assert abs(mo.predict(model, data, feats).agg(F.avg(loss)).first()[0] - losses[-1]) < 1e-9
    held, curve = mo.fit_logistic(data, feats, "tx_fraud", 6, validation=_with_signal(pred))
    assert mo.stop_iteration(curve, 0.01) == len(curve) - 1
    assert abs(mo.evaluate_with(held, _with_signal(pred), feats).first()["log_loss"] - curve[-1]) < 1e-9


def test_seeds_are_drawn_by_their_weights(spark):
    """2,000 draws of the second centre against the exact weights (chi-squared), copies counted."""
    values = [0.0] * 3 + [1.0] * 5 + [2.0, 4.0, 4.0]
    df = spark.createDataFrame([([v],) for v in values], "x array<double>").groupBy("x").agg(F.count(F.lit(1)).alias("n")).persist()
    weights = {0.0: 0.0, 1.0: 5 * 1.0, 2.0: 4.0, 4.0: 2 * 16.0}
    trials = 2000
    many = df.crossJoin(spark.range(trials).withColumnRenamed("id", "turn"))  # the draws of ``kmeans.draw``, all turns at once
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(7), F.col("turn").cast("int"), "x"), 11).cast("double") + 0.5) / float(1 << 53)
    w = F.col("n") * kmeans.squared_distance_to([0.0])
    drawn = many.where(w > 0).groupBy("turn").agg(F.max_by("x", F.log(u) / w).alias("x")).groupBy("x").count().collect()
    total = sum(weights.values())
    chi = sum((r["count"] - trials * weights[r["x"][0]] / total) ** 2 / (trials * weights[r["x"][0]] / total) for r in drawn)
    assert len(drawn) == 3 and chi < 13.8  # two degrees of freedom, one in a thousand
    same = [many.where(f"turn = {t}").where(w > 0).agg(F.max_by("x", F.log(u) / w)).first()[0] for t in range(5)]
    assert same == [kmeans.draw(df, w, 7, t) for t in range(5)]


def test_plus_plus_and_rounds(spark):
    df = spark.createDataFrame([([float(a + i / 100), float(a)],) for a in (0, 50, 100) for i in range(20)] * 2, "x array<double>")
    points = df.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    seeds = kmeans.plus_plus(points, 3, 5)
    assert {round(s[1]) for s in seeds} == {0, 50, 100}  # far groups are drawn before near points
    centres = kmeans.lloyd(points, seeds, 10)
    assert np.allclose(sorted(centres), [[a + 0.095, a] for a in (0, 50, 100)])
    model = kmeans.as_model(spark, centres, "v", "c")
    assert np.allclose(model.clusterCenters(), centres)
    assert len(kmeans.plus_plus(points.limit(2), 5, 1)) == 2  # fewer points than centres
    assert kmeans.plus_plus(points.limit(0), 5, 1) == []


def test_anomaly_rule_flags_once(spark, sets):
    train, pred = sets
    model = mo.fit_kmeans(train, k=3)
    rule = mo.AnomalyRule(model, train)
    a = rule.apply(pred).where("is_anomaly").count()
    assert a == mo.detect_anomalies(model, train, pred).where("is_anomaly").count()
    assert rule.flagged(rule.train).where("is_anomaly").count() <= mo.CONTAMINATION * train.count()


def test_fits_run_over_few_stored_splits(spark, monkeypatch):
    """A fit's jobs have as many tasks as the stored rows have splits, not as the plan before has partitions."""
    from pyspark.ml import Pipeline

    n = 40 * spark.sparkContext.defaultParallelism
    train = spark.range(2000).select(F.rand(3).alias("a"), F.when(F.col("id") % 7 > 0, F.rand(4)).alias("b"),
                                     (F.col("id") % 5 == 0).cast("int").alias("tx_fraud")).repartition(n)
    parts, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, data: parts.append(data.rdd.getNumPartitions()) or fit(self, data))
    for make in (lambda: mo.fit_classifier(train, "gbt", ["a", "b"], max_iter=1), lambda: mo.fit_classifier(train, "logreg", ["a", "b"], max_iter=1),
                 lambda: mo.fit_penalised_trees(train, ["a", "b"], max_iter=1)):
        make()
    assert len(parts) == 3 and max(parts) < n / 4, parts
