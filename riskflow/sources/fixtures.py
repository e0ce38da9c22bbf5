"""Map the driver's ``events`` table onto the transaction/label contract.

``tx``:       TX_ID string, TX_TS timestamp (whole seconds), CUSTOMER_ID string,
              TERMINAL_ID string, TX_AMOUNT double
``txlabels``: TX_ID string, TX_FRAUD int in {0, 1}

``signup`` events stay unlabelled. The label rule is the fixture's planted one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions import as_timestamp, trunc_second
from riskflow.session import configure

# Fixed values of the fixture mapping.
UNLABELLED_EVENT = "signup"
FRAUD_EVENTS = ("click", "purchase")
ERROR_EVENT = "error"
FRAUD_USER_MODULUS = 10
AS_OF = "2024-01-31 00:00:00"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions_from_events(events: DataFrame, *more: Column) -> DataFrame:
    """``more``: columns that go along."""
    return events.select(
        F.col("event_id").cast("string").alias("TX_ID"),
        trunc_second("ts").alias("TX_TS"),
        F.col("user_id").cast("string").alias("CUSTOMER_ID"),
        F.get_json_object("props", "$.k").alias("TERMINAL_ID"),
        F.col("value").cast("double").alias("TX_AMOUNT"),
        *more,
    )


def labels_from_events(events: DataFrame) -> DataFrame:
    fraud = (F.col("event_type") == ERROR_EVENT) | (
        ((F.col("user_id") % FRAUD_USER_MODULUS) == 0) & F.col("event_type").isin(*FRAUD_EVENTS))
    return (events.where(F.col("event_type") != UNLABELLED_EVENT)
            .select(F.col("event_id").cast("string").alias("TX_ID"),
                    F.when(fraud, 1).otherwise(0).cast("int").alias("TX_FRAUD")))


def load_fixture(spark: SparkSession, sf_dir: str, start=None, end=None) -> tuple[DataFrame, DataFrame]:
    """(tx, txlabels) from ``events.parquet`` under ``sf_dir``.

    ``start`` / ``end`` (whole seconds, inclusive) bound TX_TS by a predicate on the raw ``ts``, which reaches the
    parquet scan (one on the truncated TX_TS does not); the labels are then those of the same events.
    """
    configure(spark)
    events = load_table(spark, sf_dir, "events")
    if start is not None:
        events = events.where(F.col("ts") >= as_timestamp(start))
    if end is not None:
        events = events.where(F.col("ts") < as_timestamp(end) + F.expr("INTERVAL 1 SECOND"))
    return transactions_from_events(events), labels_from_events(events)


# DuckDB text of the same mapping, inlined as WITH items by the oracles.
DUCKDB_FIXTURE_CTE = """tx AS (SELECT CAST(event_id AS VARCHAR) AS TX_ID, date_trunc('second', ts) AS TX_TS,
              CAST(user_id AS VARCHAR) AS CUSTOMER_ID,
              json_extract_string(props, '$.k') AS TERMINAL_ID, value AS TX_AMOUNT FROM events),
txlabels AS (SELECT CAST(event_id AS VARCHAR) AS TX_ID,
              CAST(CASE WHEN event_type = 'error'
                     OR (user_id % 10 = 0 AND event_type IN ('click','purchase')) THEN 1 ELSE 0 END AS INTEGER) AS TX_FRAUD
             FROM events WHERE event_type <> 'signup')"""


def messages_from_events(events: DataFrame) -> DataFrame:
    """The message topic of the fixture: every non-signup event as a transaction message, every signup as one that
    cannot be scored, of each kind in turn: no TX_ID, malformed, unreadable time, no amount, no customer or terminal."""
    from riskflow.streaming.messages import message_text

    # one pass over the events for both kinds
    dead = F.col("event_type") == UNLABELLED_EVENT
    tx = transactions_from_events(events.where(F.col("event_type").isNotNull()), dead.alias("_dead"), F.expr(DEAD_MESSAGE).alias("_text"))
    return tx.select(F.when(F.col("_dead"), F.col("_text")).otherwise(message_text()).alias("value"))


# The text of a signup's message, in SQL that both engines read alike.
DEAD_MESSAGE = """CASE event_id % 5
    WHEN 0 THEN props
    WHEN 1 THEN concat('{"TX_ID": ', event_id, ', oops')
    WHEN 2 THEN concat('{"TX_ID":"', event_id, '","TX_TS":"yesterday","CUSTOMER_ID":"c","TERMINAL_ID":"t","TX_AMOUNT":1.0}')
    WHEN 3 THEN concat('{"TX_ID":"', event_id, '","TX_TS":"2024-01-20 10:00:00","CUSTOMER_ID":"c","TERMINAL_ID":"t"}')
    ELSE concat('{"TX_ID":"', event_id, '","TX_TS":"2024-01-20 10:00:00","TX_AMOUNT":1.0}') END"""
