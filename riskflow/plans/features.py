"""Customer spending features and delayed terminal risk features (C2).

Both views read the transactions of the ``history_days`` days up to ``as_of``
(inclusive at both ends), left-joined to their labels, and compute trailing
RANGE frames over whole seconds per key:

* customer: number of *labelled* transactions and the average amount of *all*
  transactions in the last 15 min / 30 min / 60 min / 1 / 7 / 14 days;
* terminal: the same counts and a risk ratio fraud / (count + 0.0001), both over
  a window that ends ``delay`` seconds (7 days) before the transaction, since
  labels arrive late. The ratio is NULL when no labelled transaction lies in the
  last ``delay`` seconds (the reference's SUM over an unlabelled frame).

Frames are evaluated on per-(key, second) totals with prefix differences (see
``riskflow.operators.windows``). ``per_second()`` variants return one row per
(key, feature_ts) -- the form joins and lookups use. The view functions return
one row per transaction like the reference views (no TX_ID, so same-second
transactions of a key give identical rows).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions import as_timestamp, exact_amount, inexact_amount
from riskflow.operators.keyfilter import possible_matches
from riskflow.operators.windows import SEC, compact_by_second, frame_totals, replicate_rows

# Fixed values of the feature definitions (seconds).
WINDOWS = {
    "15min": 900,
    "30min": 1800,
    "60min": 3600,
    "1day": 86400,
    "7day": 604800,
    "14day": 1209600,
}
DELAY_SECONDS = 604800
RISK_EPSILON = 0.0001
HISTORY_DAYS = 15

CUSTOMER_COUNT_COLS = [f"customer_id_nb_tx_{w}_window" for w in WINDOWS]
CUSTOMER_AVG_COLS = [f"customer_id_avg_amount_{w}_window" for w in WINDOWS]
CUSTOMER_FEATURES = [c for w in WINDOWS for c in (f"customer_id_nb_tx_{w}_window", f"customer_id_avg_amount_{w}_window")]
TERMINAL_COUNT_COLS = [f"terminal_id_nb_tx_{w}_window" for w in WINDOWS]
TERMINAL_RISK_COLS = [f"terminal_id_risk_{w}_window" for w in WINDOWS]
TERMINAL_FEATURES = [c for w in WINDOWS for c in (f"terminal_id_nb_tx_{w}_window", f"terminal_id_risk_{w}_window")]


def recent_window(tx: DataFrame, as_of=None, days: int | None = HISTORY_DAYS, end_days_before: int = 0) -> DataFrame:
    """Rows with ``as_of - days <= TX_TS <= as_of - end_days_before`` (both inclusive).

    ``days=None`` keeps the whole history (no time filter at all).
    """
    if days is None:
        return tx
    end = as_of_col(as_of)
    lo = end - F.expr(f"INTERVAL {int(days)} DAYS")
    hi = end - F.expr(f"INTERVAL {int(end_days_before)} DAYS") if end_days_before else end
    return tx.where(F.col("TX_TS").between(lo, hi))


def resolve_as_of(as_of):
    """``as_of`` itself, or the present moment: one time for all jobs of a computation."""
    return _dt.datetime.now(_dt.timezone.utc) if as_of is None else as_of


def as_of_col(as_of) -> Column:
    return as_timestamp(as_of)


def labelled_recent(tx: DataFrame, labels: DataFrame, as_of=None, days: int | None = HISTORY_DAYS,
                    end_days_before: int = 0, filter_labels: bool = False) -> DataFrame:
    """Recent transactions left-joined to their label (NULL when unlabelled).

    ``filter_labels``: for a label table that holds far more than the recent transactions, drop the labels of others
    before the join's shuffle, by a bitmap of the recent ids (two more passes over the ids; same result)."""
    recent = recent_window(tx, as_of, days, end_days_before)
    if filter_labels:
        labels = possible_matches(labels, "TX_ID", recent, "TX_ID")
    return recent.join(labels.select("TX_ID", "TX_FRAUD"), on="TX_ID", how="left")


# --- customer -------------------------------------------------------------------------------------------------------

def customer_per_second(tx: DataFrame, labels: DataFrame, as_of=None, days: int | None = HISTORY_DAYS,
                        end_days_before: int = 0, form: str = "prefix", windows: dict | None = None,
                        base: DataFrame | None = None) -> DataFrame:
    """Customer features, one row per (customer_id, feature_ts) plus ``n_tx`` (transactions in that second).

    ``base`` (optional) is an already filtered ``labelled_recent`` frame, so a caller
    that needs the same rows elsewhere shares one scan and label join.
    """
    if base is None:
        base = labelled_recent(tx, labels, as_of, days, end_days_before)
    return customer_from_totals(customer_totals(base), form, windows, by_span=days is None)


def customer_totals(base: DataFrame) -> DataFrame:
    """What the customer features are sums of, per (customer, second)."""
    return compact_by_second(base, "CUSTOMER_ID", "TX_TS", {
        "n_lab": F.count("TX_FRAUD"),
        "n_amt": F.count("TX_AMOUNT"),
        "amt": F.coalesce(F.sum(exact_amount("TX_AMOUNT")), F.lit(0).cast("decimal(37,8)")),
        "n_odd": F.count(inexact_amount("TX_AMOUNT")),  # NaN, infinities: the average of their frames is NaN
        "n_tx": F.count(F.lit(1)),
    })


def customer_from_totals(compact: DataFrame, form: str = "prefix", windows: dict | None = None, by_span: bool = False) -> DataFrame:
    """Customer features per (customer_id, feature_ts) from ``customer_totals``."""
    windows = windows or WINDOWS
    frames = {w: (-n, 0) for w, n in windows.items()}
    t = frame_totals(compact, "CUSTOMER_ID", ["n_lab", "n_amt", "amt", "n_odd"], frames, form=form, by_span=by_span)
    cols = [F.timestamp_seconds(F.col(SEC)).alias("feature_ts"), F.col("CUSTOMER_ID").alias("customer_id")]
    for w in windows:
        cols.append(F.col(f"n_lab__{w}").cast("long").alias(f"customer_id_nb_tx_{w}_window"))
    for w in windows:
        avg = F.try_divide(F.col(f"amt__{w}").cast("double"), F.col(f"n_amt__{w}").cast("double"))
        avg = F.when(F.col(f"n_odd__{w}") > 0, F.lit(float("nan"))).otherwise(avg)
        cols.append(avg.alias(f"customer_id_avg_amount_{w}_window"))
    cols.append(F.col("n_tx"))
    return t.select(*cols)


def _output_window(per_sec: DataFrame, as_of, output_days: int | None) -> DataFrame:
    if output_days is None:
        return per_sec
    return per_sec.where(F.col("feature_ts") >= as_of_col(as_of) - F.expr(f"INTERVAL {int(output_days)} DAYS"))


def customer_features(tx: DataFrame, labels: DataFrame, as_of=None, days: int = HISTORY_DAYS,
                      form: str = "prefix", output_days: int | None = None) -> DataFrame:
    """The customer spending feature view: one row per recent transaction, 14 columns.

    ``days`` is the history read (the reference clips it to 15, so early rows see
    short windows); ``output_days`` keeps only the rows of the last n days, e.g.
    ``days=36, output_days=15`` gives every output row its full windows.
    """
    per_sec = _output_window(customer_per_second(tx, labels, as_of, days, form=form), as_of, output_days)
    return replicate_rows(per_sec, "n_tx").drop("n_tx")


# --- terminal -------------------------------------------------------------------------------------------------------

def terminal_per_second(tx: DataFrame, labels: DataFrame, as_of=None, days: int | None = HISTORY_DAYS,
                        end_days_before: int = 0, delay: int = DELAY_SECONDS, form: str = "prefix",
                        windows: dict | None = None, base: DataFrame | None = None) -> DataFrame:
    """Terminal risk features, one row per (terminal_id, feature_ts) plus ``n_tx``.

    ``form``: ``prefix`` (default) or ``sliding`` evaluate the delayed window as
    the single frame ``[t - delay - w, t - delay - 1]``; ``subtract`` evaluates it
    as the reference writes it, ``[t - delay - w, t] - [t - delay, t]``.
    """
    if base is None:
        base = labelled_recent(tx, labels, as_of, days, end_days_before)
    return terminal_from_totals(terminal_totals(base), delay, form, windows, by_span=days is None)


def terminal_totals(base: DataFrame) -> DataFrame:
    """What the terminal features are sums of, per (terminal, second)."""
    return compact_by_second(base, "TERMINAL_ID", "TX_TS", {
        "n_lab": F.count("TX_FRAUD"),
        "n_fraud": F.coalesce(F.sum("TX_FRAUD"), F.lit(0)).cast("long"),
        "n_tx": F.count(F.lit(1)),
    })


def terminal_from_totals(compact: DataFrame, delay: int = DELAY_SECONDS, form: str = "prefix", windows: dict | None = None,
                         by_span: bool = False) -> DataFrame:
    """Terminal features per (terminal_id, feature_ts) from ``terminal_totals``."""
    windows = windows or WINDOWS
    guard_frame = {"recent": (-delay, 0)}
    if form == "subtract":
        frames = {**guard_frame, **{w: (-delay - n, 0) for w, n in windows.items()}}
        t = frame_totals(compact, "TERMINAL_ID", ["n_lab", "n_fraud"], frames, form="sliding", by_span=by_span)
        counts = {w: F.col(f"n_lab__{w}") - F.col("n_lab__recent") for w in windows}
        frauds = {w: F.col(f"n_fraud__{w}") - F.col("n_fraud__recent") for w in windows}
    else:
        frames = {**guard_frame, **{w: (-delay - n, -delay - 1) for w, n in windows.items()}}
        t = frame_totals(compact, "TERMINAL_ID", ["n_lab", "n_fraud"], frames, form=form, by_span=by_span)
        counts = {w: F.col(f"n_lab__{w}") for w in windows}
        frauds = {w: F.col(f"n_fraud__{w}") for w in windows}
    labelled_recently = F.col("n_lab__recent") > 0
    cols = [F.timestamp_seconds(F.col(SEC)).alias("feature_ts"), F.col("TERMINAL_ID").alias("terminal_id")]
    for w in windows:
        cols.append(counts[w].cast("long").alias(f"terminal_id_nb_tx_{w}_window"))
    for w in windows:
        risk = frauds[w].cast("double") / (counts[w].cast("double") + F.lit(RISK_EPSILON))
        cols.append(F.when(labelled_recently, risk).alias(f"terminal_id_risk_{w}_window"))
    cols.append(F.col("n_tx"))
    return t.select(*cols)


def terminal_delay_frames(tx: DataFrame, labels: DataFrame, as_of=None, days: int | None = HISTORY_DAYS,
                          delay: int = DELAY_SECONDS, windows: dict | None = None) -> DataFrame:
    """The reference's intermediate sums, one row per (terminal_id, feature_ts) plus ``n_tx``:
    ``nb_fraud_delay`` / ``nb_tx_delay`` over ``[t - delay, t]`` and ``nb_fraud_{w}_delay_window`` /
    ``nb_tx_{w}_delay_window`` over ``[t - delay - w, t]``. Fraud sums are NULL when the frame
    holds no labelled transaction (SQL SUM semantics); counts count labelled rows.
    """
    windows = windows or WINDOWS
    base = labelled_recent(tx, labels, as_of, days)
    compact = terminal_totals(base)
    frames = {"delay": (-delay, 0), **{w: (-delay - n, 0) for w, n in windows.items()}}
    t = frame_totals(compact, "TERMINAL_ID", ["n_lab", "n_fraud"], frames, by_span=days is None)
    cols = [F.timestamp_seconds(F.col(SEC)).alias("feature_ts"), F.col("TERMINAL_ID").alias("terminal_id")]
    for name in frames:
        suffix = "delay" if name == "delay" else f"{name}_delay_window"
        cols.append(F.when(F.col(f"n_lab__{name}") > 0, F.col(f"n_fraud__{name}")).alias(f"nb_fraud_{suffix}"))
        cols.append(F.col(f"n_lab__{name}").cast("long").alias(f"nb_tx_{suffix}"))
    cols.append(F.col("n_tx"))
    return t.select(*cols)


def terminal_features(tx: DataFrame, labels: DataFrame, as_of=None, days: int = HISTORY_DAYS,
                      delay: int = DELAY_SECONDS, form: str = "prefix", output_days: int | None = None) -> DataFrame:
    """The terminal risk feature view: one row per recent transaction, 14 columns
    (``days`` / ``output_days`` as for ``customer_features``; 36 = 15 + 21 covers the
    longest delayed window)."""
    per_sec = _output_window(terminal_per_second(tx, labels, as_of, days, delay=delay, form=form), as_of,
                             output_days)
    return replicate_rows(per_sec, "n_tx").drop("n_tx")


def latest_per_key(features: DataFrame, key: str, ts: str = "feature_ts") -> DataFrame:
    """The newest feature row of every key (the reference's ROW_NUMBER() = 1).

    An aggregation rather than a window: ``max_by`` is combined map-side, so a
    hot key never lands in one task as a whole. Per-second feature rows are
    unique per (key, ts), hence the pick is deterministic.
    """
    others = [c for c in features.columns if c != key]
    latest = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(ts)).alias("_latest")
    return features.groupBy(key).agg(latest).select(key, *[F.col(f"_latest.{c}").alias(c) for c in others])
