"""Window frames and feature views on hand-made edge rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_labels, make_tx
from riskflow.operators.windows import compact_by_second, frame_totals, replicate_rows
from riskflow.plans import features as fe
from riskflow.sources.fixtures import load_fixture

AS_OF = "2024-01-31 00:00:00"


def _by_ts(df, ts="feature_ts"):
    return {r[ts].strftime("%Y-%m-%d %H:%M:%S"): r for r in df.collect()}


def test_same_second_peers_see_each_other(spark):
    tx = make_tx(spark, [("a", "2024-01-30 10:00:00", "c1", "t1", 10.0),
                         ("b", "2024-01-30 10:00:00", "c1", "t1", 20.0)])
    lb = make_labels(spark, [("a", 0), ("b", 1)])
    rows = fe.customer_features(tx, lb, AS_OF).collect()
    assert len(rows) == 2  # one row per transaction, like the view
    for r in rows:
        assert r["customer_id_nb_tx_15min_window"] == 2
        assert r["customer_id_avg_amount_15min_window"] == pytest.approx(15.0)


def test_frame_edges_900_and_901_seconds(spark):
    tx = make_tx(spark, [("a", "2024-01-30 10:00:00", "c1", "t1", 10.0),
                         ("b", "2024-01-30 10:15:00", "c1", "t1", 20.0),   # 900 s later: inside
                         ("c", "2024-01-30 10:30:01", "c1", "t1", 40.0)])  # 901 s after b: outside
    lb = make_labels(spark, [("a", 0), ("b", 0), ("c", 0)])
    got = _by_ts(fe.customer_per_second(tx, lb, AS_OF))
    assert got["2024-01-30 10:15:00"]["customer_id_nb_tx_15min_window"] == 2
    assert got["2024-01-30 10:30:01"]["customer_id_nb_tx_15min_window"] == 1
    assert got["2024-01-30 10:30:01"]["customer_id_avg_amount_15min_window"] == pytest.approx(40.0)
    assert got["2024-01-30 10:30:01"]["customer_id_nb_tx_60min_window"] == 3


def test_unlabelled_rows_count_in_average_not_in_count(spark):
    tx = make_tx(spark, [("a", "2024-01-30 10:00:00", "c1", "t1", 10.0),
                         ("b", "2024-01-30 10:01:00", "c1", "t1", 30.0)])
    lb = make_labels(spark, [("a", 1)])
    got = _by_ts(fe.customer_per_second(tx, lb, AS_OF))["2024-01-30 10:01:00"]
    assert got["customer_id_nb_tx_15min_window"] == 1
    assert got["customer_id_avg_amount_15min_window"] == pytest.approx(20.0)


def test_delay_edges_and_null_risk(spark):
    d = fe.DELAY_SECONDS
    # t0 labelled fraud; t1 = t0 + 604800 (still inside the delay -> not counted),
    # t2 = t0 + 604801 (just past the delay -> counted in the 15 min delayed window)
    tx = make_tx(spark, [("a", "2024-01-20 00:00:00", "c1", "t1", 1.0),
                         ("b", "2024-01-27 00:00:00", "c2", "t1", 1.0),
                         ("c", "2024-01-27 00:00:01", "c3", "t1", 1.0),
                         ("u", "2024-01-27 00:00:01", "c4", "t2", 1.0)])
    lb = make_labels(spark, [("a", 1), ("b", 0), ("c", 0)])
    rows = fe.terminal_per_second(tx, lb, AS_OF).collect()
    got = {(r["terminal_id"], r["feature_ts"].strftime("%d %H:%M:%S")): r for r in rows}
    assert d == 604800
    assert got[("t1", "27 00:00:00")]["terminal_id_nb_tx_15min_window"] == 0
    r2 = got[("t1", "27 00:00:01")]
    assert r2["terminal_id_nb_tx_15min_window"] == 1
    assert r2["terminal_id_risk_15min_window"] == pytest.approx(1 / 1.0001)
    # terminal t2: its only transaction is unlabelled -> risk NULL although counts are 0
    r3 = got[("t2", "27 00:00:01")]
    assert r3["terminal_id_nb_tx_1day_window"] == 0
    assert r3["terminal_id_risk_1day_window"] is None


@pytest.mark.parametrize("form", ["sliding", "subtract"])
def test_terminal_forms_agree(spark, form):
    tx, lb = load_fixture(spark, SF_SMALL)
    a = fe.terminal_per_second(tx, lb, AS_OF, form="prefix")
    b = fe.terminal_per_second(tx, lb, AS_OF, form=form)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_customer_prefix_equals_sliding(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    a = fe.customer_per_second(tx, lb, AS_OF, form="prefix")
    b = fe.customer_per_second(tx, lb, AS_OF, form="sliding")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_history_clip_15_days(spark):
    tx = make_tx(spark, [("old", "2024-01-15 23:59:59", "c1", "t1", 5.0),
                         ("new", "2024-01-16 00:00:00", "c1", "t1", 7.0)])
    lb = make_labels(spark, [("old", 1), ("new", 1)])
    rows = fe.customer_features(tx, lb, AS_OF).collect()
    assert len(rows) == 1 and rows[0]["customer_id_nb_tx_14day_window"] == 1


def test_counts_grow_with_frame_length(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    df = fe.customer_per_second(tx, lb, AS_OF)
    cols = fe.CUSTOMER_COUNT_COLS
    bad = df.where(" OR ".join(f"{a} > {b}" for a, b in zip(cols, cols[1:])))
    assert bad.count() == 0


def test_risk_bounds(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    df = fe.terminal_per_second(tx, lb, AS_OF)
    bad = df.where(" OR ".join(f"({c} < 0 OR {c} >= 1)" for c in fe.TERMINAL_RISK_COLS))
    assert bad.count() == 0


def test_frame_totals_rejects_forward_frames(spark):
    df = spark.createDataFrame([("k", 1, 1)], "k string, _sec long, v long")
    with pytest.raises(ValueError):
        frame_totals(df, "k", ["v"], {"bad": (-5, 3)})


def test_compact_bounds_rows_per_key(spark):
    # 1,000 copies of one (key, second) become one row
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"))
    c = compact_by_second(df, "k", "ts", {"n": F.count(F.lit(1))})
    assert c.collect()[0]["n"] == 1000 and c.count() == 1


def test_replicate_rows_in_chunks(spark):
    df = spark.createDataFrame([("a", 5), ("b", 0), ("c", 2)], "k string, n long")
    out = replicate_rows(df, "n", chunk=2)
    counts = {r["k"]: r["count"] for r in out.groupBy("k").count().collect()}
    assert counts == {"a": 5, "c": 2}


def test_features_do_not_depend_on_as_of_with_full_history(spark):
    # 36 days = 15-day horizon + 21-day longest delayed window: rows of the last 15 days
    # get their true windows, so moving as_of by a day changes none of them.
    tx, lb = load_fixture(spark, SF_SMALL)
    a = fe.terminal_per_second(tx, lb, "2024-01-30 00:00:00", days=36)
    b = fe.terminal_per_second(tx, lb, "2024-01-31 00:00:00", days=36)
    window = F.col("feature_ts").between(F.lit("2024-01-15 00:00:00").cast("timestamp"),
                                         F.lit("2024-01-30 00:00:00").cast("timestamp"))
    a, b = a.where(window), b.where(window)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_key_with_copies_matches_brute_force(spark):
    import numpy as np

    # one customer holds a third of the rows, ten copies per second, plus cold customers
    n_hot, n_cold = 30000, 60000
    base = F.lit("2024-01-30 00:00:00").cast("timestamp")
    hot = spark.range(n_hot).select(F.lit("hot").alias("CUSTOMER_ID"), (F.col("id") % 3000).alias("s"), "id")
    cold = spark.range(n_cold).select((F.col("id") % 500).cast("string").alias("CUSTOMER_ID"),
                                      ((F.col("id") * 7919) % 80000).alias("s"), (F.col("id") + n_hot).alias("id"))
    rows = hot.unionByName(cold)
    tx = rows.select(F.col("id").cast("string").alias("TX_ID"),
                     (base + F.make_interval(secs=F.col("s"))).alias("TX_TS"), "CUSTOMER_ID",
                     F.lit("t").alias("TERMINAL_ID"), F.lit(1.0).alias("TX_AMOUNT"))
    lb = tx.select("TX_ID", F.lit(0).alias("TX_FRAUD"))
    got = (fe.customer_per_second(tx, lb, AS_OF).where("customer_id = 'hot'")
           .select(F.unix_seconds("feature_ts").alias("t"), "customer_id_nb_tx_15min_window", "n_tx").toPandas())
    secs = np.sort(np.repeat(np.arange(3000), 10)) + int(got["t"].min())
    exp = np.searchsorted(secs, got["t"].to_numpy(), side="right") - \
        np.searchsorted(secs, got["t"].to_numpy() - 900, side="left")
    assert len(got) == 3000 and (got["n_tx"] == 10).all()
    assert (got["customer_id_nb_tx_15min_window"].to_numpy() == exp).all()
    assert fe.customer_features(tx, lb, AS_OF).count() == n_hot + n_cold


def test_output_days_keeps_recent_rows_with_full_windows(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    full = fe.terminal_features(tx, lb, AS_OF, days=36, output_days=15)
    assert full.count() == fe.terminal_features(tx, lb, AS_OF).count()  # same rows (the last 15 days)
    assert full.where(F.col("feature_ts") < F.lit("2024-01-16 00:00:00").cast("timestamp")).count() == 0


def test_replicate_rows_beyond_one_chunk(spark):
    from riskflow.operators.windows import REPLICATE_CHUNK

    n = 3 * REPLICATE_CHUNK + 1234  # one hot (key, second) needing four chunks
    df = spark.createDataFrame([("hot", n), ("cold", 3)], "k string, n long")
    out = replicate_rows(df, "n")
    counts = {r["k"]: r["count"] for r in out.groupBy("k").count().collect()}
    assert counts == {"hot": n, "cold": 3}


def test_frames_by_span_equal_frames_over_the_whole_key(spark):
    import random

    rng = random.Random(5)
    rows = sorted({("k%d" % rng.randint(0, 2), rng.randint(-500, 4000)) for _ in range(900)})
    df = spark.createDataFrame([(k, s, rng.randint(0, 9)) for k, s in rows], "k string, _sec long, n long")
    frames = {"a": (-30, 0), "b": (-200, -51)}
    whole = frame_totals(df, "k", ["n"], frames)
    spans = frame_totals(df, "k", ["n"], frames, by_span=True)
    sliding = frame_totals(df, "k", ["n"], frames, form="sliding", by_span=True)
    assert whole.count() == spans.count() == len(rows) and whole.columns == spans.columns
    assert whole.exceptAll(spans).count() == 0 and whole.exceptAll(sliding.select(*whole.columns)).count() == 0


def test_unbounded_history_is_windowed_by_key_and_span(spark):
    from riskflow.plans import features as fe
    from riskflow.sources.fixtures import load_fixture

    tx, lb = load_fixture(spark, "/root/testdata/sf0.001")
    plan = fe.customer_per_second(tx, lb, days=None)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(CUSTOMER_ID" in plan and "_span" in plan


def test_average_amounts_keep_their_decimals(spark):
    from pyspark.sql import functions as F

    from conftest import make_labels, make_tx
    from riskflow.plans import eda
    from riskflow.plans import features as fe

    def averages(amounts):
        tx = make_tx(spark, [(str(i), f"2024-01-20 00:00:{i:02d}", "c", "t", a) for i, a in enumerate(amounts)])
        per_tx = fe.customer_features(tx, make_labels(spark, [("0", 1)]), "2024-01-31 00:00:00")
        last = per_tx.orderBy(F.col("feature_ts").desc()).first()["customer_id_avg_amount_15min_window"]
        return eda.overview(tx).first()["AVG_TX_AMOUNT"], last

    assert averages([0.004, 0.004]) == (0.004, 0.004)
    assert averages([1e18, 2.0]) == (5e17 + 1, 5e17 + 1)
    assert averages([None, 3.0]) == (3.0, 3.0)
    for bad in (float("nan"), float("inf")):
        a, b = averages([bad, 1.0])
        assert (a != a or a == float("inf")) and b != b
