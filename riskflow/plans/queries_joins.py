"""Registered join and data-set queries (J1-J4, D1-D3, P2) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.operators.asof import asof_join, point_in_time_join
from riskflow.plans import datasets as ds
from riskflow.plans import eda
from riskflow.plans import features as fe
from riskflow.plans.queries_features import AS_OF_SQL, feature_ctes
from riskflow.plans.registry import AS_OF, fixture, r, register

# Feature snapshot date used by the as-of join queries: probes run over the whole
# month, so they see exact hits, older rows and no row at all.
SNAPSHOT_AS_OF = "2024-01-20 00:00:00"
SNAPSHOT_SQL = f"TIMESTAMP '{SNAPSHOT_AS_OF}'"

TX_COLS = "TX_ID, TX_TS, CUSTOMER_ID, TERMINAL_ID, " + r("TX_AMOUNT") + " AS TX_AMOUNT"


def _feature_select(prefix: str, cols: list[str], round_cols: list[str]) -> str:
    return ", ".join(f"{r(prefix + c)} AS {c}" if c in round_cols else f"{prefix}{c}" for c in cols)


CUST_COLS = ["customer_id", *fe.CUSTOMER_COUNT_COLS, *fe.CUSTOMER_AVG_COLS]
TERM_COLS = ["terminal_id", *fe.TERMINAL_COUNT_COLS, *fe.TERMINAL_RISK_COLS]


@register("join_inner_labels", f"SELECT {TX_COLS}, TX_FRAUD FROM tx JOIN txlabels USING (TX_ID)")
def q_join_inner_labels(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.with_labels(tx, lb, "inner")


@register("join_left_labels", f"SELECT {TX_COLS}, TX_FRAUD FROM tx LEFT JOIN txlabels USING (TX_ID)")
def q_join_left_labels(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.with_labels(tx, lb, "left")


@register("join_point_in_time", f"""WITH {feature_ctes()}
SELECT t.TX_ID, t.TX_TS, t.CUSTOMER_ID AS customer, {_feature_select('cf.', CUST_COLS, fe.CUSTOMER_AVG_COLS)}
FROM tx t LEFT JOIN cf ON t.CUSTOMER_ID = cf.customer_id AND t.TX_TS = cf.feature_ts""")
def q_join_point_in_time(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    cust = fe.customer_per_second(tx, lb, AS_OF).drop("n_tx")
    gt = tx.select("TX_ID", "TX_TS", F.col("CUSTOMER_ID").alias("customer"))
    out = point_in_time_join(gt, cust, ["customer", "TX_TS"], ["customer_id", "feature_ts"])
    return out.select("TX_ID", "TX_TS", "customer", *CUST_COLS)


def _snapshot_ctes() -> str:
    return feature_ctes().replace(AS_OF_SQL, SNAPSHOT_SQL)


@register("join_asof_customer", f"""WITH {_snapshot_ctes()}
SELECT t.TX_ID, t.TX_TS, t.CUSTOMER_ID, cf.feature_ts, {_feature_select('cf.', CUST_COLS[1:], fe.CUSTOMER_AVG_COLS)}
FROM tx t ASOF LEFT JOIN cf ON t.CUSTOMER_ID = cf.customer_id AND t.TX_TS >= cf.feature_ts""")
def q_join_asof_customer(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    cust = fe.customer_per_second(tx, lb, SNAPSHOT_AS_OF).drop("n_tx")
    out = asof_join(tx.select("TX_ID", "TX_TS", "CUSTOMER_ID"), cust, "CUSTOMER_ID", "TX_TS", "customer_id",
                    "feature_ts", right_unique=True, by_span=False)  # 15 days of features
    return out.select("TX_ID", "TX_TS", "CUSTOMER_ID", "feature_ts", *CUST_COLS[1:])


@register("join_asof_terminal", f"""WITH {_snapshot_ctes()}
SELECT t.TX_ID, t.TX_TS, t.TERMINAL_ID, tf.feature_ts, {_feature_select('tf.', TERM_COLS[1:], fe.TERMINAL_RISK_COLS)}
FROM tx t ASOF LEFT JOIN tf ON t.TERMINAL_ID = tf.terminal_id AND t.TX_TS >= tf.feature_ts""")
def q_join_asof_terminal(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    term = fe.terminal_per_second(tx, lb, SNAPSHOT_AS_OF).drop("n_tx")
    out = asof_join(tx.select("TX_ID", "TX_TS", "TERMINAL_ID"), term, "TERMINAL_ID", "TX_TS", "terminal_id",
                    "feature_ts", right_unique=True, by_span=False)  # 15 days of features
    return out.select("TX_ID", "TX_TS", "TERMINAL_ID", "feature_ts", *TERM_COLS[1:])


def dataset_sql(start_days: int, end_days: int, select: str | None = None) -> str:
    lo = f"{AS_OF_SQL} - INTERVAL {start_days} DAY"
    hi = f"{AS_OF_SQL} - INTERVAL {end_days} DAY" if end_days else AS_OF_SQL
    cols = select or (f"gt.timestamp, {r('gt.tx_amount')} AS tx_amount, gt.tx_fraud, "
                      f"{_feature_select('cf.', CUST_COLS, fe.CUSTOMER_AVG_COLS)}, "
                      f"{_feature_select('tf.', TERM_COLS, fe.TERMINAL_RISK_COLS)}")
    return f"""WITH {feature_ctes()},
gt AS (SELECT t.TX_TS AS timestamp, t.CUSTOMER_ID AS customer, t.TERMINAL_ID AS terminal,
              t.TX_AMOUNT AS tx_amount, l.TX_FRAUD AS tx_fraud
       FROM tx t LEFT JOIN txlabels l ON t.TX_ID = l.TX_ID)
SELECT {cols}
FROM gt LEFT JOIN cf ON gt.customer = cf.customer_id AND gt.timestamp = cf.feature_ts
        LEFT JOIN tf ON gt.terminal = tf.terminal_id AND gt.timestamp = tf.feature_ts
WHERE gt.timestamp BETWEEN {lo} AND {hi} AND gt.tx_fraud IS NOT NULL"""


@register("train_data", dataset_sql(15, 5))
def q_train_data(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    return ds.training_set(tx, lb, AS_OF)


@register("predict_data", dataset_sql(5, 0))
def q_predict_data(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    return ds.prediction_set(tx, lb, AS_OF)


_ROUNDED = {"tx_amount", *fe.CUSTOMER_AVG_COLS, *fe.TERMINAL_RISK_COLS}
_INPUT_COLS = ["tx_amount", "tx_fraud", *fe.CUSTOMER_COUNT_COLS, *fe.CUSTOMER_AVG_COLS,
               *fe.TERMINAL_COUNT_COLS, *fe.TERMINAL_RISK_COLS]


def _input_col(c: str) -> str:
    src = f"gt.{c}" if c in ("tx_amount", "tx_fraud") else c
    return f"{r(src)} AS {c}" if c in _ROUNDED else src


@register("model_input", dataset_sql(15, 5, ", ".join(_input_col(c) for c in _INPUT_COLS)))
def q_model_input(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    return ds.model_input(ds.training_set(tx, lb, AS_OF))


_STAR_EXCEPT = ("* EXCLUDE (customer, terminal, feature_ts) REPLACE ("
                + ", ".join(f"{r(c)} AS {c}" for c in ["tx_amount", *fe.CUSTOMER_AVG_COLS, *fe.TERMINAL_RISK_COLS]) + ")")


@register("proj_star_except", dataset_sql(15, 5, _STAR_EXCEPT))
def q_proj_star_except(spark, sf_dir):
    """``SELECT * EXCEPT (customer, terminal, feature_ts)`` over the ground truth joined to
    both feature tables; drops every column so named (both ``feature_ts``)."""
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    base = fe.labelled_recent(tx, lb, AS_OF, 15, 5)
    gt = (base.where(F.col("TX_FRAUD").isNotNull())
          .select(F.col("TX_TS").alias("timestamp"), F.col("CUSTOMER_ID").alias("customer"),
                  F.col("TERMINAL_ID").alias("terminal"), F.col("TX_AMOUNT").alias("tx_amount"),
                  F.col("TX_FRAUD").alias("tx_fraud")))
    cust = fe.customer_per_second(tx, lb, base=base).drop("n_tx")
    term = fe.terminal_per_second(tx, lb, base=base).drop("n_tx")
    joined = point_in_time_join(gt, cust, ["customer", "timestamp"], ["customer_id", "feature_ts"])
    joined = point_in_time_join(joined, term, ["terminal", "timestamp"], ["terminal_id", "feature_ts"])
    return joined.drop("customer", "terminal", "feature_ts")
