"""Physical plans: one Window node per feature view, no Python UDF in hot paths,
filters and partition pruning reach the scan."""

import re

from conftest import SF_SMALL
from riskflow.plans import datasets as ds
from riskflow.plans import features as fe
from riskflow.session import scratch_path
from riskflow.sources import tables
from riskflow.sources.fixtures import load_fixture

AS_OF = "2024-01-31 00:00:00"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _count(pattern, text):
    return len(re.findall(pattern, text))


def test_customer_features_single_window(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    p = plan(fe.customer_per_second(tx, lb, AS_OF))
    assert _count(r"\bWindow \[", p) == 1
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_terminal_features_single_window(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    p = plan(fe.terminal_per_second(tx, lb, AS_OF))
    assert _count(r"\bWindow \[", p) == 1


def test_recent_filter_pushed_to_parquet(spark):
    # On the stored transaction table TX_TS is a physical column: the 15-day filter
    # reaches the parquet reader. (On the fixture view TX_TS is date_trunc(ts), an
    # expression Catalyst cannot push into the scan.)
    tx, lb = load_fixture(spark, SF_SMALL)
    path = scratch_path(spark, "tx")
    tables.write_transactions(tx, path)
    p = plan(fe.labelled_recent(spark.read.parquet(path), lb, AS_OF))
    assert re.search(r"PushedFilters: \[IsNotNull\(TX_TS\), GreaterThanOrEqual\(TX_TS", p), p


def test_scan_prunes_partitions(spark):
    tx, _ = load_fixture(spark, SF_SMALL)
    path = scratch_path(spark, "tx")
    tables.write_transactions(tx, path)
    df = tables.read_transactions(spark, path, "2024-01-25 00:00:00", "2024-01-26 00:00:00")
    p = plan(df)
    m = re.search(r"PartitionFilters: \[([^\]]*)\]", p)
    pf = re.sub(r"#\d+", "", m.group(1)) if m else ""
    assert "tx_date >= 2024-01-25" in pf and "tx_date <= 2024-01-26" in pf, p
    expected = tx.where("TX_TS BETWEEN TIMESTAMP '2024-01-25 00:00:00' AND TIMESTAMP '2024-01-26 00:00:00'")
    assert df.count() == expected.count() > 0


def test_training_set_reads_stored_history_once_per_consumer(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    p = plan(ds.training_set(tx, lb, AS_OF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    # ground truth, customer totals, terminal totals: three pruned reads of the stored
    # labelled history, no TX_ID column and no label join left in this plan
    assert len(schemas) == 3 and all("TX_ID" not in s for s in schemas)
    assert len(set(schemas)) == 3  # each consumer reads its own columns of the stored history
    assert "BatchEvalPython" not in p


def test_training_set_unmaterialized_prunes_scan(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    p = plan(ds.training_set(tx, lb, AS_OF, materialize=False))
    for s in re.findall(r"ReadSchema: struct<([^>]*)>", p):
        assert set(x.split(":")[0] for x in s.split(",")) <= {"event_id", "ts", "user_id", "value", "props",
                                                              "event_type"}


def test_co_bucketed_tables_join_without_shuffle(spark):
    from riskflow.plans import eda

    tx, lb = load_fixture(spark, SF_SMALL)
    t, l_ = tables.store_co_bucketed(tx, lb, "riskflow_bucketed", 4, scratch_path(spark, "wh"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the plan a large input gets
    try:
        joined = eda.with_labels(spark.table(t), spark.table(l_))
        p = plan(joined)
        assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
        assert "Exchange" not in p, p
        assert joined.count() == tx.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_recent_views_push_their_time_range_into_the_scan(spark):
    import __spark_entry__ as E

    queries = E.queries()
    for name in ("feat_customer", "feat_terminal", "view_customer_features"):
        plan = queries[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.split("\n") if "FileScan parquet" in x]
        assert scans and all("GreaterThanOrEqual(ts," in x and "LessThan(ts," in x for x in scans)


def test_no_exchange_after_the_window_of_a_view(spark):
    from riskflow.plans import features as fe

    tx, lb = load_fixture(spark, SF_SMALL)
    plan = fe.customer_features(tx, lb, "2024-01-31 00:00:00")._jdf.queryExecution().executedPlan().toString()
    above_window = plan[:plan.index("Window [")]
    assert "Exchange" not in above_window and "Generate" in above_window
