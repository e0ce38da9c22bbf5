"""The feature views and data sets under the names users query them by.

``create_feature_views`` registers ``customer_spending_features`` and ``terminal_risk_features`` in the session, so that
``spark.sql("SELECT * FROM customer_spending_features LIMIT 10")`` works; the views are evaluated when queried.
``store_data_sets`` stores ``train_data`` and ``predict_data`` as tables of a database, computed once from one history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskflow.plans import datasets as ds
from riskflow.plans import features as fe
from riskflow.sources import tables

CUSTOMER_VIEW, TERMINAL_VIEW = "customer_spending_features", "terminal_risk_features"


def create_feature_views(tx: DataFrame, labels: DataFrame, as_of=None) -> tuple[str, str]:
    """Both views over ``tx`` and ``labels``, as of one time."""
    as_of = fe.resolve_as_of(as_of)
    fe.customer_features(tx, labels, as_of).createOrReplaceTempView(CUSTOMER_VIEW)
    fe.terminal_features(tx, labels, as_of).createOrReplaceTempView(TERMINAL_VIEW)
    return CUSTOMER_VIEW, TERMINAL_VIEW


def store_data_sets(spark: SparkSession, tx: DataFrame, labels: DataFrame, database: str, as_of=None,
                    location: str | None = None) -> tuple[str, str]:
    """Tables ``train_data`` and ``predict_data`` of ``database``; returns their full names."""
    as_of = fe.resolve_as_of(as_of)
    tables.create_namespace(spark, database, location)
    history = ds.labelled_history(tx, labels, as_of)
    return (tables.save_table(ds.training_set(tx, labels, as_of, history=history), f"{database}.train_data"),
            tables.save_table(ds.prediction_set(tx, labels, as_of, history=history), f"{database}.predict_data"))
