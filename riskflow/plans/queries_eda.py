"""Registered EDA queries (C1) with their oracles."""

from __future__ import annotations

from riskflow.plans import eda
from riskflow.plans.registry import AS_OF, fixture, r, register

_RATE = "SUM(COALESCE(TX_FRAUD, 0))::DOUBLE / NULLIF(COUNT(TX_FRAUD), 0)"
# AVG(TX_AMOUNT) with a sum that does not depend on the order of the rows
_AVG = "CAST(SUM(CAST(TX_AMOUNT AS DECIMAL(27,8))) AS DOUBLE) / CAST(NULLIF(COUNT(TX_AMOUNT), 0) AS DOUBLE)"

# Fixed query parameters (chosen for the fixture scale, see FIXTURES.md).
REPEATED_MIN_FREQUENCY = 3
TERMINAL_MIN_RATE = 0.35


@register("eda_overview", f"""
SELECT COUNT(*) AS NUM_TX, MIN(TX_TS) AS MIN_TX_DATE, MAX(TX_TS) AS MAX_TX_DATE,
       COUNT(DISTINCT CUSTOMER_ID) AS NUM_CUSTOMERS, COUNT(DISTINCT TERMINAL_ID) AS NUM_TERMINALS,
       {r('MIN(TX_AMOUNT)')} AS MIN_TX_AMOUNT, {r(_AVG)} AS AVG_TX_AMOUNT,
       {r('MAX(TX_AMOUNT)')} AS MAX_TX_AMOUNT
FROM tx""")
def q_overview(spark, sf_dir):
    tx, _ = fixture(spark, sf_dir)
    return eda.overview(tx)


@register("eda_fraud_distribution", f"""
SELECT TX_FRAUD, COUNT(*) AS NUM_TX, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS OVR_TOTAL_TX,
       {r('COUNT(*) / SUM(COUNT(*)) OVER ()')} AS PCT_TOTAL_TX
FROM txlabels GROUP BY TX_FRAUD ORDER BY TX_FRAUD""")
def q_fraud_distribution(spark, sf_dir):
    _, lb = fixture(spark, sf_dir)
    return eda.fraud_distribution(lb)


@register("eda_amount_histogram", f"""
SELECT {r('ROUND(TX_AMOUNT, 0)')} AS ROUNDED_TX_AMOUNT, COUNT(*) AS NUM_TX
FROM tx GROUP BY ROUNDED_TX_AMOUNT ORDER BY ROUNDED_TX_AMOUNT""")
def q_amount_histogram(spark, sf_dir):
    tx, _ = fixture(spark, sf_dir)
    return eda.amount_histogram(tx)


@register("eda_amount_by_fraud", f"""
SELECT TX_FRAUD, {r('MIN(TX_AMOUNT)')} AS MIN_TX_AMOUNT, {r(_AVG)} AS AVG_TX_AMOUNT,
       {r('MAX(TX_AMOUNT)')} AS MAX_TX_AMOUNT, COUNT(*) AS NUM_TX
FROM tx JOIN txlabels USING (TX_ID) GROUP BY TX_FRAUD""")
def q_amount_by_fraud(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.amount_by_fraud(tx, lb)


def _metrics_sql(key: str) -> str:
    return f"""
SELECT {key}, COUNT(*) AS NUM_TX, {r(_AVG)} AS AVG_TX_AMOUNT, {r(_RATE)} AS PCT_TX_FRAUD
FROM tx LEFT JOIN txlabels USING (TX_ID) GROUP BY {key}"""


@register("eda_customer_metrics", _metrics_sql("CUSTOMER_ID"))
def q_customer_metrics(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.customer_metrics(tx, lb)


@register("eda_terminal_metrics", _metrics_sql("TERMINAL_ID"))
def q_terminal_metrics(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.terminal_metrics(tx, lb)


def _high_risk_sql(key: str, min_rate: float) -> str:
    return f"""
SELECT {key}, num_transactions, {r('PCT_TX_FRAUD')} AS PCT_TX_FRAUD, {r('AVG_TX_AMOUNT')} AS AVG_TX_AMOUNT
FROM (SELECT {key}, COUNT(*) AS num_transactions, {_RATE} AS PCT_TX_FRAUD, {_AVG} AS AVG_TX_AMOUNT
      FROM tx LEFT JOIN txlabels USING (TX_ID) GROUP BY {key}
      HAVING {_RATE} > {min_rate})
ORDER BY PCT_TX_FRAUD DESC, {key} ASC LIMIT 10"""


@register("eda_high_risk_customers", _high_risk_sql("CUSTOMER_ID", 0.5))
def q_high_risk_customers(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.high_risk(tx, lb, "CUSTOMER_ID", 0.5, 10)


@register("eda_high_risk_terminals", _high_risk_sql("TERMINAL_ID", TERMINAL_MIN_RATE))
def q_high_risk_terminals(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.high_risk(tx, lb, "TERMINAL_ID", TERMINAL_MIN_RATE, 10)


@register("eda_hourly_pattern", f"""
SELECT CAST(EXTRACT(HOUR FROM TX_TS) AS INTEGER) AS hour, COUNT(*) AS NUM_TX, {r(_RATE)} AS PCT_TX_FRAUD
FROM tx LEFT JOIN txlabels USING (TX_ID) GROUP BY 1 ORDER BY 1""")
def q_hourly_pattern(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.hourly_pattern(tx, lb)


@register("eda_daily_pattern", f"""
SELECT CAST(TX_TS AS DATE) AS day, COUNT(*) AS NUM_TX, {r(_RATE)} AS PCT_TX_FRAUD
FROM tx LEFT JOIN txlabels USING (TX_ID) GROUP BY 1 ORDER BY 1""")
def q_daily_pattern(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.daily_pattern(tx, lb)


@register("eda_weekday_pattern", f"""
SELECT CAST(dayofweek(TX_TS) + 1 AS INTEGER) AS day_of_week, COUNT(*) AS NUM_TX, {r(_RATE)} AS PCT_TX_FRAUD
FROM tx LEFT JOIN txlabels USING (TX_ID) GROUP BY 1 ORDER BY 1""")
def q_weekday_pattern(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.weekday_pattern(tx, lb)


@register("eda_repeated_amounts", f"""
SELECT {r('TX_AMOUNT')} AS TX_AMOUNT, frequency, {r('PCT_TX_FRAUD')} AS PCT_TX_FRAUD
FROM (SELECT TX_AMOUNT, COUNT(*) AS frequency, {_RATE} AS PCT_TX_FRAUD
      FROM tx LEFT JOIN txlabels USING (TX_ID) GROUP BY TX_AMOUNT HAVING COUNT(*) > {REPEATED_MIN_FREQUENCY})
ORDER BY frequency DESC, TX_AMOUNT ASC LIMIT 10""")
def q_repeated_amounts(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.repeated_amounts(tx, lb, REPEATED_MIN_FREQUENCY, 10)


@register("scalar_functions", f"""
SELECT TX_ID, {r('TX_AMOUNT / NULLIF(CAST(TX_FRAUD AS DOUBLE), 0)')} AS amount_per_fraud,
       CASE WHEN TX_FRAUD IS NOT NULL THEN TX_FRAUD ELSE 0 END AS fraud_or_zero,
       TX_FRAUD IS NOT NULL AS is_labelled,
       {r('ROUND(TX_AMOUNT, 0)')} AS amount_round0,
       {r('ROUND(EXTRACT(HOUR FROM TX_TS) / 4.0, 1)')} AS hour_quarter_round1,
       CAST(EXTRACT(HOUR FROM TX_TS) AS INTEGER) AS hour,
       date_trunc('day', TX_TS) AS day_start,
       CAST(dayofweek(TX_TS) + 1 AS INTEGER) AS day_of_week,
       TX_TS - INTERVAL 7 DAY AS week_before,
       CAST(epoch(TX_TS) AS BIGINT) AS epoch_seconds,
       date_trunc('second', TX_TS) AS ts_second,
       CAST(strftime(TX_TS, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_parsed,
       CAST(TX_TS AS DATE) AS tx_date,
       CAST(ROUND(TX_AMOUNT) AS BIGINT) AS amount_int,
       CAST(CAST(CUSTOMER_ID AS BIGINT) AS VARCHAR) AS customer_text,
       CONCAT('Customer#', CUSTOMER_ID) AS customer_label,
       COALESCE(TX_FRAUD, -1) AS fraud_or_missing,
       TX_TS BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 15 DAY AND TIMESTAMP '{AS_OF}' AS in_last_15_days,
       {r('TX_AMOUNT * 2 - 1')} AS amount_affine,
       EXTRACT(HOUR FROM TX_TS) / 23.0 > 0.5 AS late_hour
FROM tx LEFT JOIN txlabels USING (TX_ID)""")
def q_scalar_functions(spark, sf_dir):
    tx, lb = fixture(spark, sf_dir)
    return eda.scalar_projection(tx, lb, AS_OF)
