"""As-of and exact point-in-time joins against brute force."""

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_tx
from riskflow.operators.asof import asof_join, point_in_time_join
from riskflow.plans import features as fe
from riskflow.sources.fixtures import load_fixture


def asof_join_by_max(left, right, left_key, left_ts, right_key, right_ts, columns):
    """Brute-force reference: pair every probe with every earlier right row of its key, keep the newest."""
    probes = left.select(F.col(left_key).alias("_k"), F.col(left_ts).alias("_t")).distinct()
    r = right.select(F.col(right_key).alias("_rk"), F.col(right_ts).alias("_rt"),
                     F.struct(*[F.col(c) for c in columns]).alias("_p"))
    best = (probes.join(r, (F.col("_k") == F.col("_rk")) & (F.col("_rt") <= F.col("_t")))
            .groupBy("_k", "_t").agg(F.max_by("_p", F.struct("_rt", "_p")).alias("_hit")))
    joined = left.join(best, (left[left_key] == best["_k"]) & (left[left_ts] == best["_t"]), "left")
    return joined.select(*[left[c] for c in left.columns], *[F.col(f"_hit.{c}").alias(c) for c in columns])


def _features(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts string, v double")
    return df.select("k", F.col("ts").cast("timestamp").alias("feature_ts"), "v")


def test_asof_picks_latest_not_later(spark):
    feats = _features(spark, [("c1", "2024-01-10 00:00:00", 1.0), ("c1", "2024-01-12 00:00:00", 2.0),
                              ("c2", "2024-01-11 00:00:00", 5.0)])
    probes = make_tx(spark, [("x", "2024-01-09 00:00:00", "c1", "t", 1.0),    # before any: NULL
                             ("y", "2024-01-12 00:00:00", "c1", "t", 1.0),    # equal instant counts
                             ("z", "2024-01-11 12:00:00", "c1", "t", 1.0),
                             ("w", "2024-01-20 00:00:00", "c3", "t", 1.0),    # unknown key
                             ("q", "2024-01-12 00:00:00.500", "c1", "t", 1.0)])  # sub-second probe
    out = {r["TX_ID"]: r["v"] for r in
           asof_join(probes, feats, "CUSTOMER_ID", "TX_TS", "k", "feature_ts").collect()}
    assert out == {"x": None, "y": 2.0, "z": 1.0, "w": None, "q": 2.0}
    filled = {r["TX_ID"]: r["v"] for r in
              asof_join(probes, feats, "CUSTOMER_ID", "TX_TS", "k", "feature_ts", fill=0.0).collect()}
    assert filled["x"] == 0.0 and filled["w"] == 0.0


def test_asof_keeps_every_left_row(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    feats = fe.customer_per_second(tx, lb, "2024-01-20 00:00:00").drop("n_tx")
    out = asof_join(tx, feats, "CUSTOMER_ID", "TX_TS", "customer_id", "feature_ts")
    assert out.count() == tx.count()


def test_asof_union_form_equals_max_by_form(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    feats = fe.customer_per_second(tx, lb, "2024-01-20 00:00:00").drop("n_tx")
    cols = ["feature_ts", *fe.CUSTOMER_COUNT_COLS]
    a = asof_join(tx, feats, "CUSTOMER_ID", "TX_TS", "customer_id", "feature_ts", cols).select("TX_ID", *cols)
    b = asof_join_by_max(tx, feats, "CUSTOMER_ID", "TX_TS", "customer_id", "feature_ts", cols).select("TX_ID", *cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_asof_matches_pandas_merge_asof(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    feats = fe.terminal_per_second(tx, lb, "2024-01-20 00:00:00").drop("n_tx")
    got = (asof_join(tx, feats, "TERMINAL_ID", "TX_TS", "terminal_id", "feature_ts", ["feature_ts"])
           .select("TX_ID", "feature_ts").toPandas().set_index("TX_ID")["feature_ts"])
    left = tx.select("TX_ID", "TX_TS", "TERMINAL_ID").toPandas().sort_values("TX_TS")
    right = feats.select("terminal_id", "feature_ts").toPandas().sort_values("feature_ts")
    exp = pd.merge_asof(left, right, left_on="TX_TS", right_on="feature_ts", left_by="TERMINAL_ID",
                        right_by="terminal_id", direction="backward").set_index("TX_ID")["feature_ts"]
    exp = exp.reindex(got.index)
    assert ((got == exp) | (got.isna() & exp.isna())).all()


def test_point_in_time_subsecond_gets_no_features(spark):
    feats = _features(spark, [("c1", "2024-01-10 00:00:00", 1.0)])
    probes = make_tx(spark, [("a", "2024-01-10 00:00:00", "c1", "t", 1.0),
                             ("b", "2024-01-10 00:00:00.250", "c1", "t", 1.0)])
    out = {r["TX_ID"]: r["v"] for r in
           point_in_time_join(probes, feats, ["CUSTOMER_ID", "TX_TS"], ["k", "feature_ts"]).collect()}
    assert out == {"a": 1.0, "b": None}


def test_asof_uncompacted_left_equals_compacted(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    feats = fe.terminal_per_second(tx, lb, "2024-01-20 00:00:00").drop("n_tx")
    a = asof_join(tx, feats, "TERMINAL_ID", "TX_TS", "terminal_id", "feature_ts")
    b = asof_join(tx, feats, "TERMINAL_ID", "TX_TS", "terminal_id", "feature_ts", right_unique=True,
                  compact_left=False)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_null_keys_match_nothing_and_gaps_of_many_days(spark):
    left = spark.createDataFrame([("a", "2024-03-01 00:00:00", 1), (None, "2024-03-01 00:00:00", 2), ("a", "2023-12-31 00:00:00", 3), ("b", "2024-02-02 12:00:00", 4)],
                                 "k string, ts string, n int").selectExpr("k", "cast(ts as timestamp) ts", "n")
    right = spark.createDataFrame([("a", "2024-01-01 00:00:00", 5), (None, "2024-01-01 00:00:00", 6), ("a", "2024-01-02 07:00:00", 7), ("b", "2024-02-02 12:00:00", 8), ("b", "2024-02-02 12:00:01", 9)],
                                  "k string, ts string, v int").selectExpr("k as rk", "cast(ts as timestamp) rts", "v")
    for compact in (True, False):
        got = {r["n"]: r["v"] for r in asof_join(left, right, "k", "ts", "rk", "rts", compact_left=compact).collect()}
        assert got == {1: 7, 2: None, 3: None, 4: 8}
