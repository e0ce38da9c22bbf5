"""Time-split training and prediction sets, and model input views (C3 data).

``training_set`` covers labelled transactions in ``[as_of - 15d, as_of - 5d]``,
``prediction_set`` those in ``[as_of - 5d, as_of]`` (both ends inclusive, so a
row exactly at ``as_of - 5d`` is in both). Each row gets the customer and
terminal features of its own second by an exact (key, timestamp) join, as in
the reference; a transaction with a sub-second timestamp matches no feature row
and keeps NULL features.

Feature rows are joined in their per-second form (unique per key and second),
so every transaction appears once. The reference joins the per-transaction
views and therefore repeats a transaction once per same-second peer and
feature table (n x n rows for n same-second transactions of one key); that
all-pairs blow-up is deliberately not reproduced.

Features at time t depend only on rows at or before t, so the training set
reads no transaction after ``as_of - 5d``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.asof import point_in_time_join
from riskflow.plans import features as fe
from riskflow.session import materialize as write_table

LABEL = "tx_fraud"
TRAIN_DAYS = (15, 5)
PREDICT_DAYS = (5, 0)
ID_COLUMNS = ["timestamp", "customer_id", "terminal_id"]


def labelled_history(tx: DataFrame, labels: DataFrame, as_of=None, history_days: int = fe.HISTORY_DAYS,
                     materialize: bool = True) -> DataFrame:
    """The labelled transactions of the last ``history_days`` days, stored once below the
    shared checkpoint folder; pass it as ``history`` to both data sets of one ``as_of``."""
    base = fe.labelled_recent(tx, labels, as_of, history_days)
    return write_table(base, "labelled_history") if materialize else base


def labelled_feature_set(tx: DataFrame, labels: DataFrame, as_of=None, start_days: int = 15,
                         end_days_before: int = 0, history_days: int = fe.HISTORY_DAYS,
                         materialize: bool = True, history: DataFrame | None = None) -> DataFrame:
    """Labelled transactions of ``[as_of - start_days, as_of - end_days_before]`` with all 24 features.

    Columns: timestamp, tx_amount, tx_fraud, customer_id + 12, terminal_id + 12.

    The labelled history feeds three consumers (ground truth, customer and
    terminal totals) with different column sets, so Spark would repeat the
    scan and the TX_ID join for each; ``materialize`` writes it once to the
    shared checkpoint folder instead, or ``history`` (see ``labelled_history``)
    supplies a stored one. Features at t use rows up to t only, so a history
    that extends past the set's end changes no value. Transactions older than
    ``history_days`` are in the set if ``start_days`` reaches them, with NULL features.
    """
    as_of = fe.resolve_as_of(as_of)
    rows = history
    if rows is None or start_days > history_days:  # the ground truth may reach further back than the feature history
        rows = fe.labelled_recent(tx, labels, as_of, max(start_days, history_days), end_days_before)
        if materialize:
            rows = write_table(rows, "labelled_history")
    base = rows
    if start_days > history_days:
        base = rows.where(F.col("TX_TS") >= fe.as_of_col(as_of) - F.expr(f"INTERVAL {int(history_days)} DAYS"))
    start = fe.as_of_col(as_of) - F.expr(f"INTERVAL {int(start_days)} DAYS")
    end = fe.as_of_col(as_of) - F.expr(f"INTERVAL {int(end_days_before)} DAYS")
    in_set = F.col("TX_TS").between(start, end)
    gt = (rows.where(in_set & F.col("TX_FRAUD").isNotNull())
          .select(F.col("TX_TS").alias("timestamp"), F.col("CUSTOMER_ID").alias("customer"),
                  F.col("TERMINAL_ID").alias("terminal"), F.col("TX_AMOUNT").alias("tx_amount"),
                  F.col("TX_FRAUD").alias(LABEL)))
    # only seconds that can match a ground-truth row (the filter stays above the window)
    in_range = F.col("feature_ts").between(start, end)
    cust = fe.customer_per_second(tx, labels, base=base).drop("n_tx").where(in_range)
    term = fe.terminal_per_second(tx, labels, base=base).drop("n_tx").where(in_range)
    out = point_in_time_join(gt, cust, ["customer", "timestamp"], ["customer_id", "feature_ts"])
    out = point_in_time_join(out, term.withColumnRenamed("feature_ts", "terminal_feature_ts"),
                             ["terminal", "timestamp"], ["terminal_id", "terminal_feature_ts"])
    return out.select("timestamp", "tx_amount", LABEL, "customer_id", *fe.CUSTOMER_COUNT_COLS,
                      *fe.CUSTOMER_AVG_COLS, "terminal_id", *fe.TERMINAL_COUNT_COLS, *fe.TERMINAL_RISK_COLS)


def training_set(tx: DataFrame, labels: DataFrame, as_of=None, days: tuple[int, int] = TRAIN_DAYS,
                 materialize: bool = True, history: DataFrame | None = None) -> DataFrame:
    return labelled_feature_set(tx, labels, as_of, days[0], days[1], materialize=materialize, history=history)


def prediction_set(tx: DataFrame, labels: DataFrame, as_of=None, days: tuple[int, int] = PREDICT_DAYS,
                   materialize: bool = True, history: DataFrame | None = None) -> DataFrame:
    return labelled_feature_set(tx, labels, as_of, days[0], days[1], materialize=materialize, history=history)


def model_input(data: DataFrame, supervised: bool = True) -> DataFrame:
    """Drop time and ids (``* EXCEPT``); k-means input also drops the label."""
    drop = ID_COLUMNS + ([] if supervised else [LABEL])
    return data.drop(*drop)
