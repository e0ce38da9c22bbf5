"""Views and tables by name, one as-of time, released scratch."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskflow.functions import as_timestamp
from riskflow.plans import features as fe
from riskflow.plans import views
from riskflow.session import materialize, release_scratch, scratch_path, unique_name
from riskflow.sources.fixtures import load_fixture

AS_OF = "2024-01-31 00:00:00"


def test_views_are_queried_by_name(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    views.create_feature_views(tx, lb, AS_OF)
    for name, direct in (("customer_spending_features", fe.customer_features), ("terminal_risk_features", fe.terminal_features)):
        assert spark.sql(f"SELECT * FROM {name} LIMIT 10").count() == 10
        assert spark.table(name).exceptAll(direct(tx, lb, AS_OF)).count() == 0


def test_data_sets_are_stored_by_name(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    db = unique_name("sets")
    train, predict = views.store_data_sets(spark, tx, lb, db, AS_OF, scratch_path(spark, "warehouse"))
    assert (spark.table(train).count(), spark.table(predict).count()) == (262, 117)
    assert spark.sql(f"SELECT * FROM {db}.train_data LIMIT 10").count() == 10
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_aware_times_and_one_as_of(spark):
    aware = dt.datetime(2024, 1, 20, 5, 0, tzinfo=dt.timezone(dt.timedelta(hours=5)))
    got = spark.range(1).select(F.date_format(as_timestamp(aware), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert got == "2024-01-20 00:00:00"
    assert fe.resolve_as_of(AS_OF) == AS_OF and fe.resolve_as_of(None).tzinfo is dt.timezone.utc


def test_released_scratch_is_gone(spark, monkeypatch):
    import riskflow.session as session

    monkeypatch.setattr(session, "_scratch", {})
    df = materialize(spark.range(5), "gone")
    assert df.count() == 5 and release_scratch(spark) == 1 and release_scratch(spark) == 0


def test_stored_functions_and_views_outlive_the_session(spark):
    from riskflow.plans import sql_functions
    from riskflow.sources import tables

    tx, lb = load_fixture(spark, SF_SMALL)
    odd = spark.createDataFrame([("n1", "2024-01-30 10:00:00", "1", "1", float("nan")), ("n2", "2024-01-30 10:00:00", "1", "1", 5.0),
                                 ("n3", "2024-01-30 10:00:01", "1", None, None), ("n4", "2024-01-30 10:00:00", None, "1", 1.0)],
                                "TX_ID string, ts string, CUSTOMER_ID string, TERMINAL_ID string, TX_AMOUNT double")
    tx = tx.unionByName(odd.withColumn("TX_TS", F.col("ts").cast("timestamp")).drop("ts"))
    db = unique_name("functions")
    tables.create_namespace(spark, db, scratch_path(spark, "warehouse"))
    tables.save_table(tx, f"{db}.tx")
    tables.save_table(lb, f"{db}.txlabels")
    names = sql_functions.create_feature_functions(spark, db)
    assert spark.catalog.currentDatabase() == "default"
    for as_of in (AS_OF, "2024-01-20 00:00:00"):  # the time is a parameter
        for name, direct in zip(names, (fe.customer_features, fe.terminal_features)):
            got, want = sql_functions.features_at(spark.newSession(), db, name, as_of), direct(tx, lb, as_of)
            assert got.columns == want.columns
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    other = spark.newSession()
    for view in (views.CUSTOMER_VIEW, views.TERMINAL_VIEW):  # nothing is that recent
        assert other.sql(f"SELECT * FROM {db}.{view} LIMIT 10").count() == 0
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_totals_are_refreshed_by_day(spark):
    """Equal to the full computation; a refreshed day replaces its totals (late labels); other days are not read."""
    from riskflow.plans.feature_totals import FeatureTotals
    from riskflow.sources import tables

    tx, lb = load_fixture(spark, SF_SMALL)
    path = scratch_path(spark, "store")
    tables.write_transactions(tx, path)
    store = tables.read_transactions(spark, path)
    totals = FeatureTotals(spark, scratch_path(spark, "totals"))
    early = lb.limit(0)  # no label has arrived yet
    totals.refresh(store, early, "2024-01-01", "2024-01-31")
    for labels in (early, lb):
        if labels is lb:
            totals.refresh(store, lb, "2024-01-01", "2024-01-31")
        for as_of in (AS_OF, "2024-01-21 12:34:56"):
            for got, want in ((totals.customer_features(as_of), fe.customer_features(tx, labels, as_of)),
                              (totals.terminal_features(as_of), fe.terminal_features(tx, labels, as_of))):
                assert got.columns == want.columns
                assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # one more day with one more transaction: that day's folders alone are read and written
    more = spark.createDataFrame([("x", "2024-01-30 23:00:00", "c-new", "1", 2.5)], "TX_ID string, ts string, CUSTOMER_ID string, TERMINAL_ID string, TX_AMOUNT double")
    more = more.withColumn("TX_TS", F.col("ts").cast("timestamp")).drop("ts")
    tables.write_transactions(tx.where("to_date(TX_TS) = DATE '2024-01-30'").unionByName(more), (day := scratch_path(spark, "day")))
    totals.refresh(tables.read_transactions(spark, day), lb, "2024-01-30")
    want = fe.customer_features(tx.unionByName(more), lb, AS_OF)
    got = totals.customer_features(AS_OF)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = totals.totals("customer", AS_OF, 15)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tx_date" in plan


def test_labels_of_other_transactions_are_not_shuffled(spark):
    from riskflow.operators.keyfilter import bitmap_bits, possible_matches

    tx, lb = load_fixture(spark, SF_SMALL)
    many = lb.unionByName(spark.range(10 ** 6, 10 ** 6 + 20_000).select(F.col("id").cast("string").alias("TX_ID"), F.lit(1).alias("TX_FRAUD"))) \
        .unionByName(spark.createDataFrame([(None, 1)], "TX_ID string, TX_FRAUD int"))
    recent = fe.recent_window(tx, AS_OF)
    kept = possible_matches(many, "TX_ID", recent, "TX_ID")
    assert kept.columns == many.columns
    need = many.join(recent, "TX_ID", "left_semi")
    assert need.exceptAll(kept.select(*need.columns)).count() == 0  # none that matters is lost
    assert kept.count() < need.count() + 0.1 * 20_000
    a, b = (fe.labelled_recent(tx, many, AS_OF, filter_labels=f) for f in (True, False))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    tight = possible_matches(many, "TX_ID", recent, "TX_ID", bits=1 << 15)
    assert need.exceptAll(tight.select(*need.columns)).count() == 0
    assert bitmap_bits(0) == 1 << 15 and bitmap_bits(10 ** 12) == 1 << 29
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "BroadcastHashJoin" in plan
    assert possible_matches(many, "TX_ID", recent.limit(0), "TX_ID").count() == 0


def test_parameterised_lookup_reaches_the_scan(spark):
    from riskflow.plans import sql_functions
    from riskflow.streaming import scoring as sc

    tx, lb = load_fixture(spark, SF_SMALL)
    snap = sc.read_snapshot(spark, sc.materialize_features(spark, tx, lb, "2024-01-20 00:00:00", scratch_path(spark, "feat")))
    for one in [*tx.orderBy("TX_ID").limit(3).collect()]:
        got = sql_functions.lookup(spark, one.asDict(), snap["customer"], snap["terminal"])
        want = sc.enrich_with(tx.where(F.col("TX_ID") == one["TX_ID"]), snap)
        assert [r.asDict() for r in got.select(*want.columns).collect()] == [r.asDict() for r in want.collect()]
    hostile = {"TX_ID": "1", "TX_TS": "2024-01-25 00:00:00", "CUSTOMER_ID": "x' OR '1'='1", "TERMINAL_ID": None, "TX_AMOUNT": 1.0}
    row = sql_functions.lookup(spark, hostile, snap["customer"], snap["terminal"]).collect()
    assert len(row) == 1 and all(row[0][c] == 0.0 for c in sc.ENRICHED_FEATURES)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_id" in plan and "EqualTo(terminal_id" in plan
