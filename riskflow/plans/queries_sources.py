"""Registered source/sink queries (S1-S9, S14): every one writes below the shared
checkpoint folder and reads the written table back."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.plans import eda
from riskflow.plans.queries_eda import _RATE
from riskflow.plans.queries_features import AS_OF_SQL
from riskflow.plans.registry import AS_OF, fixture, r, register
from riskflow.session import scratch_path, unique_name
from riskflow.sources import tables
from riskflow.sources.fixtures import load_table

TX_SELECT = f"TX_ID, TX_TS, CUSTOMER_ID, TERMINAL_ID, {r('TX_AMOUNT')} AS TX_AMOUNT"


def _wide(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.with_labels(tx, lb, "left")


@register("src_transactions", f"SELECT {TX_SELECT}, CAST(TX_TS AS DATE) AS tx_date FROM tx")
def q_src_transactions(spark, sf_dir):
    path = scratch_path(spark, "tx")
    tables.write_transactions(tables.split_transactions(_wide(spark, sf_dir)), path)
    return tables.read_transactions(spark, path)


@register("src_labels", "SELECT TX_ID, TX_FRAUD FROM tx LEFT JOIN txlabels USING (TX_ID)")
def q_src_labels(spark, sf_dir):
    return tables.snapshot(tables.split_labels(_wide(spark, sf_dir)), scratch_path(spark, "txlabels"))


@register("scan_recent_partitions", f"""
SELECT {TX_SELECT}, CAST(TX_TS AS DATE) AS tx_date FROM tx
WHERE TX_TS BETWEEN {AS_OF_SQL} - INTERVAL 15 DAY AND {AS_OF_SQL}""")
def q_scan_recent_partitions(spark, sf_dir):
    tx, _ = fixture(spark, sf_dir)
    path = scratch_path(spark, "tx")
    tables.write_transactions(tx, path)
    return tables.read_transactions(spark, path, F.expr(f"TIMESTAMP '{AS_OF}' - INTERVAL 15 DAYS"), AS_OF)


@register("src_dimension_snapshot", f"""
SELECT c_custkey, c_name, c_nationkey, {r('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer""",
          fixture_cte=False)
def q_src_dimension_snapshot(spark, sf_dir):
    return tables.snapshot(load_table(spark, sf_dir, "customer"), scratch_path(spark, "customers"))


@register("src_profiles_csv", f"""
SELECT s_suppkey, s_name, s_nationkey, {r('s_acctbal')} AS s_acctbal FROM supplier""", fixture_cte=False)
def q_src_profiles_csv(spark, sf_dir):
    profiles = load_table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "terminal_profiles")
    tables.write_profiles(profiles, path)
    return tables.read_profiles(spark, path, profiles.schema)


@register("src_history_text", f"""
SELECT CUSTOMER_ID AS value FROM tx LEFT JOIN txlabels USING (TX_ID) GROUP BY CUSTOMER_ID HAVING {_RATE} > 0.5""")
def q_src_history_text(spark, sf_dir):
    """Customers with a fraud rate above one half, written as a history file and read back."""
    tx, lb = fixture(spark, sf_dir)
    hacked = eda.customer_metrics(tx, lb).where(F.col("PCT_TX_FRAUD") > 0.5).select("CUSTOMER_ID")
    path = scratch_path(spark, "hacked_customers_history")
    tables.write_history(hacked, path, "CUSTOMER_ID")
    return tables.read_history(spark, path)


@register("src_history_text_terminals", f"""
SELECT TERMINAL_ID AS value FROM tx LEFT JOIN txlabels USING (TX_ID) GROUP BY TERMINAL_ID HAVING {_RATE} > 0.3""")
def q_src_history_text_terminals(spark, sf_dir):
    """Terminals with a fraud rate above 0.3, written as a history file and read back."""
    tx, lb = fixture(spark, sf_dir)
    hacked = eda.terminal_metrics(tx, lb).where(F.col("PCT_TX_FRAUD") > 0.3).select("TERMINAL_ID")
    path = scratch_path(spark, "hacked_terminals_history")
    tables.write_history(hacked, path, "TERMINAL_ID")
    return tables.read_history(spark, path)


@register("src_dimension_snapshot_terminals", f"""
SELECT s_suppkey, s_name, s_nationkey, {r('s_acctbal')} AS s_acctbal FROM supplier""", fixture_cte=False)
def q_src_dimension_snapshot_terminals(spark, sf_dir):
    return tables.snapshot(load_table(spark, sf_dir, "supplier"), scratch_path(spark, "terminals"))


@register("src_dimension_snapshot_links", "SELECT DISTINCT CUSTOMER_ID, TERMINAL_ID FROM tx")
def q_src_dimension_snapshot_links(spark, sf_dir):
    """Which customers use which terminals."""
    tx, _ = fixture(spark, sf_dir)
    return tables.snapshot(tx.select("CUSTOMER_ID", "TERMINAL_ID").distinct(), scratch_path(spark, "customers_terminals"))


@register("src_profiles_csv_customers", f"""
SELECT c_custkey, c_name, c_nationkey, {r('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer""", fixture_cte=False)
def q_src_profiles_csv_customers(spark, sf_dir):
    profiles = load_table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer_profiles")
    tables.write_profiles(profiles, path)
    return tables.read_profiles(spark, path, profiles.schema)


@register("src_profiles_csv_links", "SELECT DISTINCT CUSTOMER_ID, TERMINAL_ID FROM tx")
def q_src_profiles_csv_links(spark, sf_dir):
    tx, _ = fixture(spark, sf_dir)
    links = tx.select("CUSTOMER_ID", "TERMINAL_ID").distinct()
    path = scratch_path(spark, "customer_terminal_profiles")
    tables.write_profiles(links, path)
    return tables.read_profiles(spark, path, links.schema)


@register("src_namespace_table", f"SELECT {TX_SELECT} FROM tx")
def q_src_namespace_table(spark, sf_dir):
    """``CREATE SCHEMA IF NOT EXISTS`` + ``CREATE OR REPLACE TABLE AS``: a catalog table whose
    location is in the shared folder, bucketed by customer so later per-customer
    work can skip the shuffle."""
    tx, _ = fixture(spark, sf_dir)
    db = unique_name("riskflow_tx")
    tables.create_namespace(spark, db, scratch_path(spark, "warehouse"))
    name = tables.save_table(tx, f"{db}.tx", bucket_by="CUSTOMER_ID", buckets=8)
    return spark.table(name)


@register("join_labels_co_bucketed", f"SELECT {TX_SELECT}, TX_FRAUD FROM tx LEFT JOIN txlabels USING (TX_ID)")
def q_join_labels_co_bucketed(spark, sf_dir):
    """The label join over tables stored co-bucketed by TX_ID (no exchange in the join)."""
    tx, lb = fixture(spark, sf_dir)
    t, l_ = tables.store_co_bucketed(tx, lb, unique_name("riskflow_co_bucketed"), 8, scratch_path(spark, "warehouse"))
    return eda.with_labels(spark.table(t), spark.table(l_))
