"""Centroid clustering with Orchard's search (operator 11).

Vectors become integer vectors, so that distances, sums and centroids are exact and do not depend on the order of rows.
Each round gives every vector its nearest centroid and replaces each non-empty centroid by the floor of its vectors'
mean. The nearest centroid is found by Orchard's search: every centroid has the list of all centroids by their distance
from it. From the current centroid c at distance d the list of c is walked; a member closer to the vector (or as close,
with a smaller number) becomes the current one and its own list is walked from the start; members whose distance has been
computed are marked and skipped; the walk stops at the first member that is strictly farther from c than 2 d, since by
the triangle inequality none behind it can be closer or as close.

A round is one pass over the stored integer vectors: a task adds up its vectors by centroid (map-side), the partial sums
are added by a grouped aggregation, and only the centroids (``k`` rows) meet the driver, which sends them with the next
pass. ``k`` is at most ``MOST_CENTROIDS``, as a task holds k x k list entries.

Defined results: vectors that are null, of another length or with a null, NaN or infinite component are left out. Ids may
be null (they hash as the empty text) or repeated; equal hashes are ordered by the vector. With fewer vectors than ``k``
there are fewer centroids; equal centroids are separate, and ties go to the smaller number. Components are longs (larger
ones saturate); a distance or sum of distances beyond a long is null. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import materialize, shipped, slices

LENGTH, SCALE, CENTROIDS, ROUNDS, SEED, MOST_CENTROIDS = 64, 256, 40, 5, 2, 2048
#: Rows searched at a time; a task holds this many rows of marks, one for each centroid.
SLICE = 2048
_LONG = 1 << 63


def integer_vectors(vectors: DataFrame, length: int = LENGTH, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """vec_id, x array<long>: the floor of ``scale`` times each component, of the vectors that are whole and finite."""
    x = F.col(column).cast("array<double>")
    whole = (F.size(x) == length) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    return (vectors.filter(x.isNotNull() & whole)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))).alias("x")))


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors whose id has the smallest sha256, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [r["x"] for r in rows.select(order.alias("h"), "x").orderBy("h", "x").limit(k).collect()]


def _exact(x: np.ndarray, largest: int) -> np.ndarray:
    """``x``, as Python integers where four squared distances of such components can exceed a long."""
    return x if 16 * x.shape[1] * largest ** 2 < _LONG else x.astype(object)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid the numbers of all centroids by squared distance from it (then by number), and the distances."""
    gaps = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
    order = np.argsort(gaps, axis=1, kind="stable")
    return order, np.take_along_axis(gaps, order, axis=1)


def nearest(x: np.ndarray, centroids: np.ndarray, lists: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row of ``x``; all rows walk their lists in step."""
    n, k = len(x), len(centroids)
    at, step = np.zeros(n, np.int64), np.zeros(n, np.int64)
    best = ((x - centroids[0]) ** 2).sum(axis=1)
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    active = np.arange(n)
    while len(active):
        c, p = at[active], step[active]
        inside = (gaps[c, p] <= 4 * best[active]).astype(bool)
        active, member = active[inside], lists[c, p][inside]
        step[active] += 1
        fresh = ~seen[active, member]
        row, member = active[fresh], member[fresh]
        seen[row, member] = True
        d = ((x[row] - centroids[member]) ** 2).sum(axis=1)
        closer = ((d < best[row]) | ((d == best[row]) & (member < at[row]))).astype(bool)
        moved = row[closer]
        at[moved], best[moved], step[moved] = member[closer], d[closer], 0
        active = active[step[active] < k]
    return at, best


def _searcher(centroids: list[list[int]]):
    """A function from rows of vectors to (numbers, distances); the lists are made once per task."""
    plain = np.array(centroids, np.int64)
    made = {}

    def search(x: np.ndarray):
        small = _exact(x, max(_largest(x), _largest(plain)))
        kind = small.dtype
        if kind not in made:
            c = plain.astype(kind)
            made[kind] = (c, *neighbour_lists(c))
        return nearest(small, *made[kind])
    return search


def _rows(batch: pa.RecordBatch, column: int, length: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, length)


def _partial_sums(centroids: list[list[int]]):
    length, k = len(centroids[0]), len(centroids)

    def run(batches):
        search, n, total = _searcher(centroids), [0] * k, [[0] * length for _ in range(k)]
        for batch in batches:
            for part in slices(batch, SLICE):
                x = _rows(part, 0, length)
                number, _ = search(x)
                x = _exact(x, _largest(x) * len(x))  # sums of the slice
                for c in np.unique(number).tolist():
                    mine = x[number == c]
                    n[c] += len(mine)
                    total[c] = [a + int(b) for a, b in zip(total[c], mine.sum(axis=0))]
        used = [c for c in range(k) if n[c]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([n[c] for c in used], pa.int64()),
             pa.array([[Decimal(v) for v in total[c]] for c in used], pa.list_(pa.decimal128(38, 0)))], names=["cluster", "n", "s"])
    return run


def moved_centroids(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid that has vectors, replaced by the componentwise floor of their mean."""
    length = len(centroids[0])
    sums = (shipped(rows).select("x").mapInArrow(_partial_sums(centroids), "cluster int, n long, s array<decimal(38,0)>")
            .groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]).cast("decimal(38,0)") for i in range(length)]).alias("s")))
    out = [list(c) for c in centroids]
    for r in sums.collect():
        out[r["cluster"]] = [int(v) // r["n"] for v in r["s"]]
    return out


def assign(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance (squared) of every row."""
    length = len(centroids[0])

    def run(batches):
        search = _searcher(centroids)
        for batch in batches:
            for part in slices(batch, SLICE):
                number, distance = search(_rows(part, 1, length))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(number, pa.int32()), pa.array([d if d < _LONG else None for d in distance.tolist()], pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return shipped(rows).select("vec_id", "x").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, length: int = LENGTH,
            scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every kept vector; the centroids) after ``rounds`` rounds."""
    if not 1 <= k <= MOST_CENTROIDS:
        raise ValueError(f"k must be between 1 and {MOST_CENTROIDS}")
    rows = materialize(integer_vectors(vectors, length, scale), "vectors")
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = moved_centroids(rows, centroids)
    return materialize(assign(rows, centroids), "clusters"), centroids


def op11(vectors: DataFrame) -> DataFrame:
    found, centroids = cluster(vectors)
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    # null, as documented, where a distance of the cluster is null
    totals = {r["cluster"]: int(r["t"]) if r["whole"] else None
              for r in found.groupBy("cluster").agg(total.alias("t"), (F.count("distance") == F.count(F.lit(1))).alias("whole")).collect()}
    inertia = sum(totals.values()) if None not in totals.values() else None
    fits = lambda v: v if v is not None and v < _LONG else None
    per_cluster = found.sparkSession.createDataFrame(
        [(c, fits(t), fits(inertia), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, t in totals.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(length: int = LENGTH, scale: int = SCALE, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """Every vector against every centroid, round after round. A vector is told by its row number."""
    def nearest_of(centroids: str) -> str:
        return f"""SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT rid, c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
            FROM v, {centroids} m) GROUP BY rid"""

    steps = []
    for i in range(rounds):
        steps.append(f"n{i} AS MATERIALIZED ({nearest_of(f'm{i}')})")
        steps.append(f"""m{i + 1} AS MATERIALIZED (SELECT c, coalesce(y, m{i}.x) AS x FROM m{i} LEFT JOIN (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS y FROM (
                SELECT c, j, sum(v.x[j])::BIGINT AS s, count(*) AS n FROM n{i} JOIN v USING (rid), range(1, {length + 1}) r(j) GROUP BY c, j)
            GROUP BY c) USING (c))""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {length}
), m0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
    FROM (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v) ORDER BY h, x LIMIT {k}
), {", ".join(steps)}, last AS MATERIALIZED ({nearest_of(f"m{rounds}")})
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m{rounds}.x, ',')) AS centroid_sha256
FROM last JOIN v USING (rid) JOIN m{rounds} USING (c)
"""


ORACLE = _oracle()
