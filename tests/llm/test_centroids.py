"""Orchard clustering against plain loops over all centroids."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors, k, rounds, scale=256, length=64, seed=2):
    """(vec_id, cluster, distance) in the order of ``vectors``, and the centroids, by exhaustive search in Python integers."""
    kept = [(i, [math.floor(scale * float(np.float32(v))) for v in x]) for i, x in vectors
            if x is not None and len(x) == length and all(v is not None and math.isfinite(v) for v in x)]
    order = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    c = [x for _, x in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), n) for n, y in enumerate(c))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(near(x)[1], []).append(x)
        c = [[sum(v) // len(groups[n]) for v in zip(*groups[n])] if n in groups else y for n, y in enumerate(c)]
    return [(i, *reversed(near(x))) for i, x in kept], c


def some_vectors(n, length=64, seed=1):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(8)]
    return [(i, [rng.gauss(v, 0.1) for v in rng.choice(middles)]) for i in range(n)]


def test_search_equals_exhaustive_search_with_ties():
    rng = np.random.default_rng(3)
    for k, low in ((1, 3), (7, 2), (40, 3), (40, 50)):
        c = rng.integers(-low, low, (k, 6))
        x = rng.integers(-low, low, (500, 6))
        number, distance = centroids.nearest(x, c, *centroids.neighbour_lists(c))
        gaps = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (number == gaps.argmin(axis=1)).all() and (distance == gaps.min(axis=1)).all()


def test_search_computes_few_distances_where_groups_are_apart():
    """The walk stops early: hardly any row of a well separated group computes all distances."""
    rng = np.random.default_rng(4)
    c = rng.integers(-10_000, 10_000, (50, 8))
    x = np.repeat(c, 20, axis=0) + rng.integers(-5, 5, (1000, 8))
    order, gaps = centroids.neighbour_lists(c)
    looked = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            out = super().__getitem__(key)
            if isinstance(key, np.ndarray) and out.ndim == 2:  # centroids that rows are compared with
                looked.append(out.shape[0])
            return out
    number, _ = centroids.nearest(x, c.view(Counting), order, gaps)
    assert (number == np.repeat(np.arange(50), 20)).all()
    assert sum(looked) < 0.6 * 50 * len(x)


def test_clusters_equal_plain_rounds_with_awkward_rows(spark):
    good = some_vectors(150)
    nan, inf = float("nan"), float("inf")
    awkward = [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [nan] + [0.0] * 63), (905, [inf] + [0.0] * 63),
               (906, [None] + [0.0] * 63), (None, [0.25] * 64), (3, [-0.3] * 64), (3, [-0.3] * 64), (907, [0.0] * 64)]
    rows = [*good, *awkward]
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)
    for c in ("x", "cluster", "distance", "s", "n", "h"):
        df = df.withColumn(c, F.lit("x"))
    want, centres = plain(rows, 40, 5)
    got = centroids.op11(df.repartition(5)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["cluster"], r["distance"]) for r in got) \
        == sorted((i is None, i or 0, c, d) for i, c, d in want)
    total = sum(d for _, _, d in want)
    for r in got:
        assert r["inertia"] == total
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_few_equal_and_very_large_vectors(spark):
    assert centroids.op11(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(i, [0.5] * 64, 1) for i in range(60)], SCHEMA)
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in centroids.op11(same).collect()} == {(0, 0, 0)}
    far = [(i, [1e6 * (i + 1)] * 64) for i in range(50)]  # squares beyond 53 bits, still longs
    want, _ = plain(far, 40, 5)
    got = centroids.op11(spark.createDataFrame([(i, x, 0) for i, x in far], SCHEMA)).collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == sorted(want)
    beyond = spark.createDataFrame([(i, [1e15 * (i + 1)] * 64, 0) for i in range(50)], SCHEMA)  # distances beyond a long
    got = centroids.op11(beyond).collect()
    assert len(got) == 50 and any(r["distance"] is None for r in got) and all(r["inertia"] is None for r in got)


def test_other_sizes(spark):
    vectors = [(i, x[:3]) for i, x in some_vectors(80)]
    df = spark.createDataFrame([(i, x, 0) for i, x in vectors], SCHEMA)
    found, centres = centroids.cluster(df, k=5, rounds=3, seed=7, length=3, scale=1000)
    want, c = plain(vectors, 5, 3, scale=1000, length=3, seed=7)
    assert centres == c and sorted(map(tuple, found.collect())) == sorted(want)
    with pytest.raises(ValueError):
        centroids.cluster(df, k=centroids.MOST_CENTROIDS + 1)
