"""Registered queries over the named views and tables."""

from __future__ import annotations

from riskflow.plans import features as fe
from riskflow.plans import sql_functions, views
from riskflow.plans.feature_totals import FeatureTotals
from riskflow.plans.queries_features import customer_sql, terminal_sql
from riskflow.plans.queries_joins import dataset_sql
from riskflow.plans.registry import AS_OF, fixture, register
from riskflow.session import scratch_path, unique_name
from riskflow.sources import tables


@register("view_customer_features", customer_sql())
def q_view_customer_features(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    views.create_feature_views(tx, lb, AS_OF)
    return spark.sql(f"SELECT * FROM {views.CUSTOMER_VIEW}")


@register("view_terminal_features", terminal_sql())
def q_view_terminal_features(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    views.create_feature_views(tx, lb, AS_OF)
    return spark.sql(f"SELECT * FROM {views.TERMINAL_VIEW}")


def _stored(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    return views.store_data_sets(spark, tx, lb, unique_name("riskflow_sets"), AS_OF, scratch_path(spark, "warehouse"))


@register("table_train_data", dataset_sql(15, 5))
def q_table_train_data(spark, sf_dir):
    return spark.table(_stored(spark, sf_dir)[0])


@register("table_predict_data", dataset_sql(5, 0))
def q_table_predict_data(spark, sf_dir):
    return spark.table(_stored(spark, sf_dir)[1])


def _feature_database(spark, sf_dir):
    """A database with the fixture's tables and the feature functions over them."""
    tx, lb = fixture(spark, sf_dir)
    db = unique_name("riskflow_features")
    tables.create_namespace(spark, db, scratch_path(spark, "warehouse"))
    tables.save_table(tx, f"{db}.tx")
    tables.save_table(lb, f"{db}.txlabels")
    return db, *sql_functions.create_feature_functions(spark, db)


@register("function_customer_features", customer_sql())
def q_function_customer_features(spark, sf_dir):
    db, customer, _ = _feature_database(spark, sf_dir)
    return sql_functions.features_at(spark, db, customer, AS_OF)


@register("function_terminal_features", terminal_sql())
def q_function_terminal_features(spark, sf_dir):
    db, _, terminal = _feature_database(spark, sf_dir)
    return sql_functions.features_at(spark, db, terminal, AS_OF)


def _totals(spark, sf_dir):
    """Totals of the whole month but its last day, and then that day."""
    tx, lb = fixture(spark, sf_dir)
    totals = FeatureTotals(spark, scratch_path(spark, "totals"))
    totals.refresh(tx, lb, "2024-01-01", "2024-01-30")
    totals.refresh(tx, lb, "2024-01-31")
    return totals


@register("feat_customer_incremental", customer_sql())
def q_feat_customer_incremental(spark, sf_dir):
    return _totals(spark, sf_dir).customer_features(AS_OF)


@register("feat_terminal_incremental", terminal_sql())
def q_feat_terminal_incremental(spark, sf_dir):
    return _totals(spark, sf_dir).terminal_features(AS_OF)
