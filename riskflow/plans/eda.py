"""Exploratory aggregates over transactions and labels (C1).

All of these are one scan plus, where labels are needed, one equi-join on
TX_ID followed by a partially aggregated ``groupBy`` (map-side combine, so a hot
key costs no more than a cold one). Results are small; only top-k reports
limit their output, with a deterministic tie-breaker. Average amounts are
summed as exact decimals, so they do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions import avg_amount, fraud_rate, safe_divide


def with_labels(tx: DataFrame, labels: DataFrame, how: str = "left") -> DataFrame:
    """``tx JOIN txlabels USING (TX_ID)``; ``how='left'`` keeps unlabelled rows."""
    return tx.join(labels.select("TX_ID", "TX_FRAUD"), on="TX_ID", how=how)


def overview(tx: DataFrame, approx: bool = False) -> DataFrame:
    """One row: counts, time range, distinct customers/terminals, amount range."""
    distinct = F.approx_count_distinct if approx else F.countDistinct
    return tx.agg(
        F.count(F.lit(1)).alias("NUM_TX"),
        F.min("TX_TS").alias("MIN_TX_DATE"),
        F.max("TX_TS").alias("MAX_TX_DATE"),
        distinct("CUSTOMER_ID").alias("NUM_CUSTOMERS"),
        distinct("TERMINAL_ID").alias("NUM_TERMINALS"),
        F.min("TX_AMOUNT").alias("MIN_TX_AMOUNT"),
        avg_amount("TX_AMOUNT").alias("AVG_TX_AMOUNT"),
        F.max("TX_AMOUNT").alias("MAX_TX_AMOUNT"),
    )


def fraud_distribution(labels: DataFrame) -> DataFrame:
    """Per label value: count, overall total and share of the total.

    The total is a window over the already aggregated rows (one per label
    value), so its single-partition exchange moves a handful of rows.
    """
    per_label = labels.groupBy("TX_FRAUD").agg(F.count(F.lit(1)).alias("NUM_TX"))
    total = F.sum("NUM_TX").over(Window.partitionBy())
    return (per_label
            .withColumn("OVR_TOTAL_TX", total)
            .withColumn("PCT_TOTAL_TX", safe_divide("NUM_TX", "OVR_TOTAL_TX"))
            .orderBy("TX_FRAUD"))


def amount_histogram(tx: DataFrame, digits: int = 0) -> DataFrame:
    """Transaction count per amount rounded to ``digits`` places."""
    return (tx.groupBy(F.round("TX_AMOUNT", digits).alias("ROUNDED_TX_AMOUNT"))
            .agg(F.count(F.lit(1)).alias("NUM_TX"))
            .orderBy("ROUNDED_TX_AMOUNT"))


def amount_by_fraud(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Amount statistics per label over labelled transactions (inner join)."""
    return (with_labels(tx, labels, "inner")
            .groupBy("TX_FRAUD")
            .agg(F.min("TX_AMOUNT").alias("MIN_TX_AMOUNT"),
                 avg_amount("TX_AMOUNT").alias("AVG_TX_AMOUNT"),
                 F.max("TX_AMOUNT").alias("MAX_TX_AMOUNT"),
                 F.count(F.lit(1)).alias("NUM_TX")))


def key_metrics(tx: DataFrame, labels: DataFrame, key: str = "CUSTOMER_ID") -> DataFrame:
    """Per key: all transactions, average amount, fraud rate among labelled ones."""
    return (with_labels(tx, labels)
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("NUM_TX"),
                 avg_amount("TX_AMOUNT").alias("AVG_TX_AMOUNT"),
                 fraud_rate().alias("PCT_TX_FRAUD")))


def customer_metrics(tx: DataFrame, labels: DataFrame) -> DataFrame:
    return key_metrics(tx, labels, "CUSTOMER_ID")


def terminal_metrics(tx: DataFrame, labels: DataFrame) -> DataFrame:
    return key_metrics(tx, labels, "TERMINAL_ID")


def high_risk(tx: DataFrame, labels: DataFrame, key: str = "CUSTOMER_ID", min_rate: float = 0.5,
              k: int = 10) -> DataFrame:
    """Keys whose fraud rate exceeds ``min_rate``, top ``k`` by rate (ties: key ascending)."""
    m = (with_labels(tx, labels)
         .groupBy(key)
         .agg(F.count(F.lit(1)).alias("num_transactions"),
              fraud_rate().alias("PCT_TX_FRAUD"),
              avg_amount("TX_AMOUNT").alias("AVG_TX_AMOUNT")))
    return (m.where(F.col("PCT_TX_FRAUD") > F.lit(min_rate))
            .orderBy(F.col("PCT_TX_FRAUD").desc(), F.col(key).asc())
            .limit(k))


def hourly_pattern(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Transactions and fraud rate per hour of day (session time zone, UTC)."""
    return (with_labels(tx, labels)
            .groupBy(F.hour("TX_TS").alias("hour"))
            .agg(F.count(F.lit(1)).alias("NUM_TX"), fraud_rate().alias("PCT_TX_FRAUD"))
            .orderBy("hour"))


def daily_pattern(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Transactions and fraud rate per calendar day."""
    return (with_labels(tx, labels)
            .groupBy(F.to_date("TX_TS").alias("day"))
            .agg(F.count(F.lit(1)).alias("NUM_TX"), fraud_rate().alias("PCT_TX_FRAUD"))
            .orderBy("day"))


def weekday_pattern(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Transactions and fraud rate per day of week (1 = Sunday ... 7 = Saturday)."""
    return (with_labels(tx, labels)
            .groupBy(F.dayofweek("TX_TS").alias("day_of_week"))
            .agg(F.count(F.lit(1)).alias("NUM_TX"), fraud_rate().alias("PCT_TX_FRAUD"))
            .orderBy("day_of_week"))


def repeated_amounts(tx: DataFrame, labels: DataFrame, min_frequency: int = 10, k: int = 10) -> DataFrame:
    """Amounts seen more than ``min_frequency`` times, top ``k`` by frequency (ties: amount)."""
    return (with_labels(tx, labels)
            .groupBy("TX_AMOUNT")
            .agg(F.count(F.lit(1)).alias("frequency"), fraud_rate().alias("PCT_TX_FRAUD"))
            .where(F.col("frequency") > F.lit(min_frequency))
            .orderBy(F.col("frequency").desc(), F.col("TX_AMOUNT").asc())
            .limit(k))


def scalar_projection(tx: DataFrame, labels: DataFrame, as_of) -> DataFrame:
    """One projection over every scalar function the analyses use (SAFE_DIVIDE, IF / IS NOT NULL,
    ROUND, EXTRACT(HOUR), day truncation and weekday, INTERVAL arithmetic, UNIX_SECONDS,
    format-then-parse, TIMESTAMP(text), DATE, casts, CONCAT, COALESCE, BETWEEN, threshold)."""
    from riskflow.functions import as_timestamp, epoch_seconds, trunc_second

    end = as_timestamp(as_of)
    hour = F.hour("TX_TS")
    text_ts = F.date_format("TX_TS", "yyyy-MM-dd HH:mm:ss")
    return with_labels(tx, labels).select(
        "TX_ID",
        F.try_divide(F.col("TX_AMOUNT"), F.col("TX_FRAUD").cast("double")).alias("amount_per_fraud"),
        F.when(F.col("TX_FRAUD").isNotNull(), F.col("TX_FRAUD")).otherwise(F.lit(0)).alias("fraud_or_zero"),
        F.col("TX_FRAUD").isNotNull().alias("is_labelled"),
        F.round("TX_AMOUNT", 0).alias("amount_round0"),
        F.round(hour / F.lit(4.0), 1).alias("hour_quarter_round1"),
        hour.alias("hour"),
        F.date_trunc("day", "TX_TS").alias("day_start"),
        F.dayofweek("TX_TS").alias("day_of_week"),
        (F.col("TX_TS") - F.expr("INTERVAL 7 DAYS")).alias("week_before"),
        epoch_seconds("TX_TS").alias("epoch_seconds"),
        trunc_second("TX_TS").alias("ts_second"),
        F.to_timestamp(text_ts).alias("ts_parsed"),
        F.to_date("TX_TS").alias("tx_date"),
        F.round("TX_AMOUNT").cast("long").alias("amount_int"),
        F.col("CUSTOMER_ID").cast("long").cast("string").alias("customer_text"),
        F.concat(F.lit("Customer#"), F.col("CUSTOMER_ID")).alias("customer_label"),
        F.coalesce(F.col("TX_FRAUD"), F.lit(-1)).alias("fraud_or_missing"),
        F.col("TX_TS").between(end - F.expr("INTERVAL 15 DAYS"), end).alias("in_last_15_days"),
        (F.col("TX_AMOUNT") * 2 - 1).alias("amount_affine"),
        (F.try_divide(hour.cast("double"), F.lit(23.0)) > F.lit(0.5)).alias("late_hour"),
    )
