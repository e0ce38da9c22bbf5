"""Distributed metrics against brute-force computations on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.operators.metrics import classification_metrics, davies_bouldin
from riskflow.operators.ordered import exact_quantile, running_totals


def _scores(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    p = np.clip(np.round(rng.normal(0.4 + 0.2 * y, 0.2), 2), 0, 1)  # rounded: many ties
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double"), y, p


def test_auc_equals_pairwise_count(spark):
    df, y, p = _scores(spark)
    pos, neg = p[y == 1], p[y == 0]
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    got = classification_metrics(df, "y", "p").collect()[0]
    assert got["roc_auc"] == pytest.approx(brute, abs=1e-12)


def test_threshold_metrics(spark):
    df, y, p = _scores(spark)
    yhat = (p > 0.5).astype(int)
    tp = int(((yhat == 1) & (y == 1)).sum())
    fp = int(((yhat == 1) & (y == 0)).sum())
    fn = int(((yhat == 0) & (y == 1)).sum())
    got = classification_metrics(df, "y", "p").collect()[0]
    assert got["precision"] == pytest.approx(tp / (tp + fp))
    assert got["recall"] == pytest.approx(tp / (tp + fn))
    assert got["accuracy"] == pytest.approx((yhat == y).mean())
    pc = np.clip(p, 1e-15, 1 - 1e-15)
    assert got["log_loss"] == pytest.approx(float(-(y * np.log(pc) + (1 - y) * np.log(1 - pc)).mean()))


def test_probability_exactly_half_is_not_fraud(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.2)], "y int, p double")
    got = classification_metrics(df, "y", "p").collect()[0]
    assert got["recall"] == 0.0 and got["precision"] is None


def test_running_totals_many_buckets(spark):
    vals = list(range(1000))
    df = spark.createDataFrame([(float(v), 1) for v in vals], "v double, n int")
    out = running_totals(df, "v", ["n"], buckets=16).orderBy("v").collect()
    assert [r["n_cum"] for r in out] == list(range(1, 1001))


@pytest.mark.parametrize("q", [0.5, 0.98, 1.0, 0.001])
def test_exact_quantile_is_discrete_percentile(spark, q):
    rng = np.random.default_rng(7)
    x = np.round(rng.exponential(2.0, 777), 3)
    df = spark.createDataFrame([(float(v),) for v in x], "d double")
    got = exact_quantile(df, "d", q, buckets=8).collect()[0]
    k = max(1, math.ceil(q * len(x)))
    assert got["n"] == len(x)
    assert got["quantile"] == sorted(x)[k - 1]


def test_davies_bouldin_matches_numpy(spark):
    rng = np.random.default_rng(11)
    pts = np.vstack([rng.normal(0, 1, (50, 3)), rng.normal(4, 1, (60, 3)), rng.normal([0, 6, 0], 1, (40, 3))])
    lab = np.array([0] * 50 + [1] * 60 + [2] * 40)
    df = spark.createDataFrame([(int(c), *map(float, r)) for c, r in zip(lab, pts)], "c int, a double, b double, d double")
    got = davies_bouldin(df, "c", ["a", "b", "d"]).collect()[0]["davies_bouldin_index"]
    cents = np.array([pts[lab == i].mean(0) for i in range(3)])
    s = np.array([np.linalg.norm(pts[lab == i] - cents[i], axis=1).mean() for i in range(3)])
    exp = np.mean([max((s[i] + s[j]) / np.linalg.norm(cents[i] - cents[j]) for j in range(3) if j != i)
                   for i in range(3)])
    assert got == pytest.approx(exp)


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_running_totals_do_not_depend_on_the_ranges(spark, buckets):
    vals = [float(v * v % 997) for v in range(400)]
    df = spark.createDataFrame([(v,) for v in sorted(set(vals))], "v double").selectExpr("v", "cast(v as long) n")
    out = {r["v"]: r["n_cum"] for r in running_totals(df, "v", ["n"], buckets).collect()}
    assert out == {v: sum(int(x) for x in set(vals) if x <= v) for v in set(vals)}


def test_metrics_of_empty_tables(spark):
    empty = spark.createDataFrame([], "y int, p double")
    assert classification_metrics(empty, "y", "p").collect()[0]["roc_auc"] is None
    assert exact_quantile(empty.select("p"), "p", 0.5).collect()[0]["n"] == 0


@pytest.mark.parametrize("most", [7, 100_000])
def test_selection_by_bracket_equals_sorting(spark, most):
    import random

    rng = random.Random(6)
    tables = {"normal": [rng.gauss(0, 1) for _ in range(5000)], "few": [float(rng.randrange(3)) for _ in range(3000)],
              "hot": [5.0] * 3000 + [rng.random() * 10 for _ in range(2000)], "one": [2.5], "negative zero": [-0.0, 0.0, 1.0]}
    for values in tables.values():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "d double").repartition(4)
        for q in (0.0, 0.5, 0.98):
            got = exact_quantile(df, "d", q, most=most).collect()[0]
            want = sorted(values)[max(1, math.ceil(q * len(values))) - 1]
            assert (got["n"], got["quantile"]) == (len(values), want)


def test_numbers_follow_the_global_order(spark):
    from riskflow.operators.ordered import numbered

    df = spark.range(0, 5000).select(F.pmod(F.xxhash64("id"), F.lit(300)).alias("k"), "id").union(spark.createDataFrame([(None, -1)], "k long, id long"))
    out = [(r["k"], r["id"], r["at"]) for r in numbered(df, ["k", "id"], "at").collect()]
    assert [r[:2] for r in sorted(out, key=lambda r: r[2])] == sorted((r[:2] for r in out), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(r[2] for r in out) == list(range(5001))
    assert numbered(df.limit(0), ["k", "id"], "at").collect() == []
