"""Training/prediction split edges and the no-fan-out rule."""

from conftest import SF_SMALL, make_labels, make_tx
from riskflow.plans import datasets as ds
from riskflow.sources.fixtures import load_fixture

AS_OF = "2024-01-31 00:00:00"


def test_row_at_split_point_in_both_sets(spark):
    tx = make_tx(spark, [("a", "2024-01-26 00:00:00", "c1", "t1", 5.0),   # exactly as_of - 5d
                         ("b", "2024-01-20 00:00:00", "c1", "t1", 6.0),
                         ("u", "2024-01-27 00:00:00", "c1", "t1", 7.0)])  # unlabelled: in no set
    lb = make_labels(spark, [("a", 1), ("b", 0)])
    train = {r["tx_amount"] for r in ds.training_set(tx, lb, AS_OF).collect()}
    pred = {r["tx_amount"] for r in ds.prediction_set(tx, lb, AS_OF).collect()}
    assert train == {5.0, 6.0} and pred == {5.0}


def test_same_second_peers_do_not_fan_out(spark):
    tx = make_tx(spark, [("a", "2024-01-20 00:00:00", "c1", "t1", 5.0),
                         ("b", "2024-01-20 00:00:00", "c1", "t1", 6.0)])
    lb = make_labels(spark, [("a", 1), ("b", 0)])
    rows = ds.training_set(tx, lb, AS_OF).collect()
    assert len(rows) == 2
    assert all(r["customer_id_nb_tx_15min_window"] == 2 for r in rows)


def test_subsecond_transaction_has_null_features(spark):
    tx = make_tx(spark, [("a", "2024-01-20 00:00:00.400", "c1", "t1", 5.0)])
    lb = make_labels(spark, [("a", 1)])
    r = ds.training_set(tx, lb, AS_OF).collect()[0]
    assert r["customer_id"] is None and r["customer_id_nb_tx_1day_window"] is None


def test_fixture_sizes(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    assert ds.training_set(tx, lb, AS_OF).count() == 262
    assert ds.prediction_set(tx, lb, AS_OF).count() == 117


def test_model_input_drops_ids(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    cols = ds.model_input(ds.training_set(tx, lb, AS_OF)).columns
    assert "timestamp" not in cols and "customer_id" not in cols and "tx_fraud" in cols
    assert len(cols) == 26
    assert "tx_fraud" not in ds.model_input(ds.training_set(tx, lb, AS_OF), supervised=False).columns


def test_shared_history_gives_the_same_sets(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    h = ds.labelled_history(tx, lb, AS_OF)
    for make in (ds.training_set, ds.prediction_set):
        a = make(tx, lb, AS_OF)
        b = make(tx, lb, AS_OF, history=h)
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_overview_approx_distinct_close_to_exact(spark):
    from riskflow.plans import eda

    tx, _ = load_fixture(spark, SF_SMALL)
    exact = eda.overview(tx).collect()[0]
    approx = eda.overview(tx, approx=True).collect()[0]
    assert approx["NUM_TX"] == exact["NUM_TX"]
    for c in ("NUM_CUSTOMERS", "NUM_TERMINALS"):
        assert abs(approx[c] - exact[c]) <= max(2, 0.05 * exact[c])


def test_ground_truth_older_than_the_feature_history(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    got = ds.training_set(tx, lb, AS_OF, days=(30, 5))
    want = tx.join(lb, "TX_ID").where(f"TX_TS between timestamp '{AS_OF}' - interval 30 days and timestamp '{AS_OF}' - interval 5 days")
    assert got.count() == want.count() > ds.training_set(tx, lb, AS_OF).count()
    old = got.where(f"timestamp < timestamp '{AS_OF}' - interval 15 days")
    assert old.count() > 0 and old.where("customer_id is not null").count() == 0  # beyond the feature history
    history = ds.labelled_history(tx, lb, AS_OF)  # a stored history that is too short does not cut the set
    assert ds.training_set(tx, lb, AS_OF, days=(30, 5), history=history).count() == want.count()
