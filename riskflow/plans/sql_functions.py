"""The feature views as SQL that outlives a session (S7), and the parameterised lookup of one transaction (P7).

``create_feature_functions`` stores two table functions of the catalog, each with the time as its parameter,
``customer_spending_features_at(as_of)`` and ``terminal_risk_features_at(as_of)``, over the tables ``tx`` and
``txlabels`` of the same database, and two views of the functions at the time of the query. The text follows the library's form:
totals per key and second, growing frames and their differences, rows repeated by the number of their transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskflow.plans import features as fe
from riskflow.plans.views import CUSTOMER_VIEW, TERMINAL_VIEW
from riskflow.session import configure

CUSTOMER_FUNCTION, TERMINAL_FUNCTION = f"{CUSTOMER_VIEW}_at", f"{TERMINAL_VIEW}_at"


def _history(database: str, days: int) -> str:
    return f"""history AS (
    SELECT t.*, l.TX_FRAUD FROM (
        SELECT TX_ID, unix_seconds(TX_TS) AS sec, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT FROM {database}.tx
        WHERE TX_TS BETWEEN as_of - INTERVAL {days} DAYS AND as_of) t
    LEFT JOIN {database}.txlabels l ON t.TX_ID = l.TX_ID)"""


def _until(column: str, key: str, seconds: int) -> str:
    """The sum of ``column`` up to ``seconds`` before the row's second."""
    end = f"{seconds} PRECEDING" if seconds else "CURRENT ROW"
    return f"coalesce(sum({column}) OVER (PARTITION BY {key} ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND {end}), 0)"


#: Rows repeated by their number of transactions, at most 65,536 copies at a time.
_COPIES = """chunks AS (SELECT *, explode(sequence(0, (n_tx - 1) div 65536)) AS chunk FROM framed),
copies AS (SELECT *, explode(sequence(1, least(65536, n_tx - chunk * 65536))) AS copy FROM chunks)"""


def customer_text(database: str, days: int = fe.HISTORY_DAYS) -> str:
    frames = []
    for w, n in fe.WINDOWS.items():
        for c in ("n_lab", "n_amt", "amt", "n_odd"):
            frames.append(f"{_until(c, 'CUSTOMER_ID', 0)} - {_until(c, 'CUSTOMER_ID', n + 1)} AS {c}_{w}")
    counts = [f"CAST(n_lab_{w} AS BIGINT) AS customer_id_nb_tx_{w}_window" for w in fe.WINDOWS]
    averages = [f"CASE WHEN n_odd_{w} > 0 THEN double('NaN') ELSE try_divide(double(amt_{w}), double(n_amt_{w})) END AS customer_id_avg_amount_{w}_window"
                for w in fe.WINDOWS]
    exact = "try_cast(TX_AMOUNT AS DECIMAL(27,8))"  # null for NaN and infinities
    return f"""WITH {_history(database, days)}, totals AS (
    SELECT CUSTOMER_ID, sec, count(TX_FRAUD) AS n_lab, count(TX_AMOUNT) AS n_amt, count(*) AS n_tx,
           coalesce(sum({exact}), 0) AS amt, count_if(TX_AMOUNT IS NOT NULL AND {exact} IS NULL) AS n_odd
    FROM history GROUP BY CUSTOMER_ID, sec
), framed AS (SELECT CUSTOMER_ID, sec, n_tx, {', '.join(frames)} FROM totals),
{_COPIES}
SELECT timestamp_seconds(sec) AS feature_ts, CUSTOMER_ID AS customer_id, {', '.join(counts)}, {', '.join(averages)} FROM copies"""


def terminal_text(database: str, days: int = fe.HISTORY_DAYS, delay: int = fe.DELAY_SECONDS) -> str:
    frames = [f"{_until('n_lab', 'TERMINAL_ID', 0)} - {_until('n_lab', 'TERMINAL_ID', delay + 1)} AS recent"]
    for w, n in fe.WINDOWS.items():
        for c in ("n_lab", "n_fraud"):
            frames.append(f"{_until(c, 'TERMINAL_ID', delay + 1)} - {_until(c, 'TERMINAL_ID', delay + n + 1)} AS {c}_{w}")
    counts = [f"CAST(n_lab_{w} AS BIGINT) AS terminal_id_nb_tx_{w}_window" for w in fe.WINDOWS]
    risks = [f"CASE WHEN recent > 0 THEN double(n_fraud_{w}) / (double(n_lab_{w}) + {fe.RISK_EPSILON}D) END AS terminal_id_risk_{w}_window" for w in fe.WINDOWS]
    return f"""WITH {_history(database, days)}, totals AS (
    SELECT TERMINAL_ID, sec, count(TX_FRAUD) AS n_lab, coalesce(sum(TX_FRAUD), 0) AS n_fraud, count(*) AS n_tx
    FROM history GROUP BY TERMINAL_ID, sec
), framed AS (SELECT TERMINAL_ID, sec, n_tx, {', '.join(frames)} FROM totals),
{_COPIES}
SELECT timestamp_seconds(sec) AS feature_ts, TERMINAL_ID AS terminal_id, {', '.join(counts)}, {', '.join(risks)} FROM copies"""


def _session_in(spark: SparkSession, database: str) -> SparkSession:
    """A session of the same application whose current database is ``database``: Spark finds stored table functions in
    the current database only, and the caller's is left as it is."""
    session = configure(spark.newSession())
    session.sql(f"USE {database}")
    return session


def create_feature_functions(spark: SparkSession, database: str) -> tuple[str, str]:
    """The two functions and the two views in ``database``, which has the tables ``tx`` and ``txlabels``; returns the
    names of the functions, which are called by ``features_at`` or after ``USE``. The views can be named from anywhere."""
    session = _session_in(spark, database)
    for function, view, text, key, own in (
            (CUSTOMER_FUNCTION, CUSTOMER_VIEW, customer_text(database), "customer_id", (*fe.CUSTOMER_COUNT_COLS, *fe.CUSTOMER_AVG_COLS)),
            (TERMINAL_FUNCTION, TERMINAL_VIEW, terminal_text(database), "terminal_id", (*fe.TERMINAL_COUNT_COLS, *fe.TERMINAL_RISK_COLS))):
        columns = ["feature_ts TIMESTAMP", f"{key} STRING", *[f"{c} {'BIGINT' if '_nb_tx_' in c else 'DOUBLE'}" for c in own]]
        session.sql(f"CREATE OR REPLACE FUNCTION {function}(as_of TIMESTAMP) RETURNS TABLE ({', '.join(columns)}) RETURN {text}")
        session.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {function}(current_timestamp())")
    return CUSTOMER_FUNCTION, TERMINAL_FUNCTION


def features_at(spark: SparkSession, database: str, function: str, as_of) -> DataFrame:
    """What a stored function gives for the time ``as_of``."""
    return _session_in(spark, database).sql(f"SELECT * FROM {function}(CAST(:as_of AS TIMESTAMP))", args={"as_of": str(as_of)})


def _newest(table: str, key: str, features: list[str]) -> str:
    picked = ", ".join(f"'{c}', {c}" for c in features)
    return f"SELECT max_by(named_struct({picked}), feature_ts) AS f FROM {{{table}}} WHERE {key} = :{key} AND feature_ts <= CAST(:tx_ts AS TIMESTAMP)"


def lookup(spark: SparkSession, transaction: dict, customer: DataFrame, terminal: DataFrame) -> DataFrame:
    """One statement with named parameters: the transaction and the newest feature row of its customer and of its
    terminal not later than it, 0 for what is missing.

    ``transaction``: TX_ID, TX_TS (text or time), CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT. The conditions compare with
    parameters alone, so that they reach the scans of the feature tables."""
    columns = [f"double(coalesce({a}.f.{c}, 0)) AS {c}" for a, own in (("c", fe.CUSTOMER_FEATURES), ("t", fe.TERMINAL_FEATURES)) for c in own]
    text = f"""
WITH given AS (
    SELECT :tx_id AS TX_ID, CAST(:tx_ts AS TIMESTAMP) AS TX_TS, :customer_id AS CUSTOMER_ID, :terminal_id AS TERMINAL_ID, double(:tx_amount) AS tx_amount
), c AS ({_newest('customer', 'customer_id', fe.CUSTOMER_FEATURES)}
), t AS ({_newest('terminal', 'terminal_id', fe.TERMINAL_FEATURES)})
SELECT given.*, {', '.join(columns)} FROM given LEFT JOIN c ON true LEFT JOIN t ON true"""
    args = {"tx_id": transaction["TX_ID"], "tx_ts": str(transaction["TX_TS"]), "customer_id": transaction["CUSTOMER_ID"],
            "terminal_id": transaction["TERMINAL_ID"], "tx_amount": transaction["TX_AMOUNT"]}
    return spark.sql(text, args=args, customer=customer, terminal=terminal)
