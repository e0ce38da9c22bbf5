"""Registered window / feature queries (C2) with oracles in the reference's own form
(sliding RANGE frames over UNIX seconds; delayed windows as a subtraction)."""

from __future__ import annotations

from riskflow.operators.windows import replicate_rows
from riskflow.plans import features as fe
from riskflow.plans.registry import AS_OF, fixture, r, register

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def _base_sql(days: int | None = fe.HISTORY_DAYS) -> str:
    where = "" if days is None else \
        f"WHERE t.TX_TS BETWEEN {AS_OF_SQL} - INTERVAL {days} DAY AND {AS_OF_SQL}"
    return f"""raw AS (SELECT t.TX_TS, t.TX_ID, t.CUSTOMER_ID, t.TERMINAL_ID, t.TX_AMOUNT, l.TX_FRAUD
             FROM tx t LEFT JOIN txlabels l ON t.TX_ID = l.TX_ID {where}),
s AS (SELECT *, CAST(epoch(TX_TS) AS BIGINT) AS sec FROM raw)"""


def _frame(key: str, n: int) -> str:
    return f"(PARTITION BY {key} ORDER BY sec RANGE BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _customer_select(counts: bool, avgs: bool, rounded: bool = True) -> str:
    rr = r if rounded else (lambda e: e)
    cols = []
    if counts:
        cols += [f"COUNT(TX_FRAUD) OVER {_frame('CUSTOMER_ID', n)} AS customer_id_nb_tx_{w}_window"
                 for w, n in fe.WINDOWS.items()]
    if avgs:
        # AVG(TX_AMOUNT) with a sum that does not depend on the order of the rows
        cols += [rr(f"CAST(SUM(CAST(TX_AMOUNT AS DECIMAL(27,8))) OVER {_frame('CUSTOMER_ID', n)} AS DOUBLE)"
                    f" / CAST(NULLIF(COUNT(TX_AMOUNT) OVER {_frame('CUSTOMER_ID', n)}, 0) AS DOUBLE)")
                 + f" AS customer_id_avg_amount_{w}_window" for w, n in fe.WINDOWS.items()]
    return f"SELECT TX_TS AS feature_ts, CUSTOMER_ID AS customer_id, {', '.join(cols)} FROM s"


def customer_sql(days: int | None = fe.HISTORY_DAYS, counts: bool = True, avgs: bool = True) -> str:
    return f"""WITH {_base_sql(days)}
{_customer_select(counts, avgs)}"""


def _terminal_delay_cte(days: int | None) -> str:
    d = fe.DELAY_SECONDS
    cols = [f"SUM(TX_FRAUD) OVER {_frame('TERMINAL_ID', d)} AS nb_fraud_delay",
            f"COUNT(TX_FRAUD) OVER {_frame('TERMINAL_ID', d)} AS nb_tx_delay"]
    for w, n in fe.WINDOWS.items():
        cols.append(f"SUM(TX_FRAUD) OVER {_frame('TERMINAL_ID', d + n)} AS nb_fraud_{w}_delay_window")
        cols.append(f"COUNT(TX_FRAUD) OVER {_frame('TERMINAL_ID', d + n)} AS nb_tx_{w}_delay_window")
    return f"""{_base_sql(days)},
dw AS (SELECT TX_TS, TERMINAL_ID, {', '.join(cols)} FROM s)"""


def _terminal_select(counts: bool = True, risks: bool = True, rounded: bool = True) -> str:
    rr = r if rounded else (lambda e: e)
    cols = []
    if counts:
        cols += [f"CAST(nb_tx_{w}_delay_window - nb_tx_delay AS BIGINT) AS terminal_id_nb_tx_{w}_window"
                 for w in fe.WINDOWS]
    if risks:
        cols += [rr(f"CAST(nb_fraud_{w}_delay_window - nb_fraud_delay AS DOUBLE) / "
                    f"(CAST(nb_tx_{w}_delay_window - nb_tx_delay AS DOUBLE) + CAST({fe.RISK_EPSILON} AS DOUBLE))")
                 + f" AS terminal_id_risk_{w}_window" for w in fe.WINDOWS]
    return f"SELECT TX_TS AS feature_ts, TERMINAL_ID AS terminal_id, {', '.join(cols)} FROM dw"


def terminal_sql(days: int | None = fe.HISTORY_DAYS, counts: bool = True, risks: bool = True) -> str:
    return f"""WITH {_terminal_delay_cte(days)}
{_terminal_select(counts, risks)}"""


def feature_ctes(days: int | None = fe.HISTORY_DAYS) -> str:
    """CTEs ``cf`` and ``tf``: the two views in per-second (distinct) form, unrounded."""
    return f"""{_terminal_delay_cte(days)},
cf AS (SELECT DISTINCT * FROM ({_customer_select(True, True, False)})),
tf AS (SELECT DISTINCT * FROM ({_terminal_select(True, True, False)}))"""


def _per_tx(per_sec, key):
    return replicate_rows(per_sec, "n_tx").drop("n_tx")


@register("feat_base", f"""WITH {_base_sql()}
SELECT TX_TS, TX_ID, CUSTOMER_ID, TERMINAL_ID, {r('TX_AMOUNT')} AS TX_AMOUNT, TX_FRAUD FROM raw""")
def q_feat_base(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    return fe.labelled_recent(tx, lb, AS_OF).select("TX_TS", "TX_ID", "CUSTOMER_ID", "TERMINAL_ID",
                                                    "TX_AMOUNT", "TX_FRAUD")


@register("feat_base_filtered_labels", f"""WITH {_base_sql()}
SELECT TX_TS, TX_ID, CUSTOMER_ID, TERMINAL_ID, {r('TX_AMOUNT')} AS TX_AMOUNT, TX_FRAUD FROM raw""")
def q_feat_base_filtered_labels(spark, sf_dir):
    """All labels of the month, of which a bitmap of the recent ids keeps those that can matter."""
    tx, lb = fixture(spark, sf_dir)
    return fe.labelled_recent(tx, lb, AS_OF, filter_labels=True).select("TX_TS", "TX_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "TX_FRAUD")


@register("filter_recent", f"""
SELECT TX_ID, TX_TS, CUSTOMER_ID, TERMINAL_ID, {r('TX_AMOUNT')} AS TX_AMOUNT FROM tx
WHERE TX_TS BETWEEN {AS_OF_SQL} - INTERVAL 15 DAY AND {AS_OF_SQL}""")
def q_filter_recent(spark, sf_dir):
    tx, _ = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    return fe.recent_window(tx, AS_OF, 15)


@register("feat_customer", customer_sql())
def q_feat_customer(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    return fe.customer_features(tx, lb, AS_OF)


@register("feat_terminal", terminal_sql())
def q_feat_terminal(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir, fe.HISTORY_DAYS)
    return fe.terminal_features(tx, lb, AS_OF)


# Window operators on their own, over the whole history (no 15-day clip).

@register("window_customer_counts", customer_sql(None, avgs=False))
def q_window_customer_counts(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    ps = fe.customer_per_second(tx, lb, days=None)
    return _per_tx(ps.select("feature_ts", "customer_id", *fe.CUSTOMER_COUNT_COLS, "n_tx"), "customer_id")


@register("window_customer_averages", customer_sql(None, counts=False))
def q_window_customer_averages(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    ps = fe.customer_per_second(tx, lb, days=None)
    return _per_tx(ps.select("feature_ts", "customer_id", *fe.CUSTOMER_AVG_COLS, "n_tx"), "customer_id")


def _delay_cols(kind: str) -> list[str]:
    return [f"{kind}_delay"] + [f"{kind}_{w}_delay_window" for w in fe.WINDOWS]


@register("window_terminal_fraud", f"""WITH {_terminal_delay_cte(None)}
SELECT TX_TS AS feature_ts, TERMINAL_ID AS terminal_id, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in _delay_cols('nb_fraud'))}
FROM dw""")
def q_window_terminal_fraud(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    ps = fe.terminal_delay_frames(tx, lb, days=None)
    return _per_tx(ps.select("feature_ts", "terminal_id", *_delay_cols("nb_fraud"), "n_tx"), "terminal_id")


@register("window_terminal_counts", f"""WITH {_terminal_delay_cte(None)}
SELECT TX_TS AS feature_ts, TERMINAL_ID AS terminal_id, {', '.join(_delay_cols('nb_tx'))} FROM dw""")
def q_window_terminal_counts(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    ps = fe.terminal_delay_frames(tx, lb, days=None)
    return _per_tx(ps.select("feature_ts", "terminal_id", *_delay_cols("nb_tx"), "n_tx"), "terminal_id")


@register("window_delayed_offset", terminal_sql(None))
def q_window_delayed_offset(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return _per_tx(fe.terminal_per_second(tx, lb, days=None), "terminal_id")


@register("window_latest_feature", f"""WITH {_base_sql()},
f AS ({_customer_select(True, True)}),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY feature_ts DESC) AS rn FROM f)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""")
def q_window_latest_feature(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return fe.latest_per_key(fe.customer_per_second(tx, lb, AS_OF).drop("n_tx"), "customer_id")
