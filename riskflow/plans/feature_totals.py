"""Feature views from maintained totals (F1, F2): a new day reads that day's transactions, not the history.

The features are sums over per-(key, second) totals of the history. These totals are stored by day, one folder for
customers and one for terminals. ``refresh`` writes days anew from their transactions and labels; late labels are
taken in by refreshing the days of their transactions. The views of any time are then windows over the stored totals of
the days that they look back to: as many rows as seconds with transactions, whatever the number of transactions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.windows import SEC, replicate_rows
from riskflow.plans import features as fe

DAY = "tx_date"


class FeatureTotals:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def refresh(self, tx: DataFrame, labels: DataFrame, first: dt.date | str, last: dt.date | str | None = None) -> None:
        """Store the totals of the days from ``first`` to ``last`` (that day alone) anew, in place of their earlier form;
        ``tx`` with a ``tx_date`` column (``sources.tables``) is read in the folders of these days only."""
        first, last = (dt.date.fromisoformat(str(d)) for d in (first, last or first))
        rows = tx.where((F.col("TX_TS") >= F.lit(f"{first} 00:00:00").cast("timestamp"))
                        & (F.col("TX_TS") < F.lit(f"{last + dt.timedelta(days=1)} 00:00:00").cast("timestamp")))
        if DAY in tx.columns:
            rows = rows.where(F.col(DAY).between(F.lit(first), F.lit(last)))
        base = rows.select("TX_ID", "TX_TS", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT").join(labels.select("TX_ID", "TX_FRAUD"), "TX_ID", "left").persist()
        try:
            for kind, totals in (("customer", fe.customer_totals(base)), ("terminal", fe.terminal_totals(base))):
                (totals.withColumn(DAY, F.to_date(F.timestamp_seconds(F.col(SEC)))).hint("rebalance", DAY)
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{self.path}/{kind}"))
        finally:
            base.unpersist()

    def totals(self, kind: str, as_of, days: int) -> DataFrame:
        """Totals of the seconds from ``days`` days before ``as_of`` to ``as_of``; other day folders are not read."""
        hi = fe.as_of_col(as_of)
        lo = hi - F.expr(f"INTERVAL {int(days)} DAYS")
        rows = self.spark.read.parquet(f"{self.path}/{kind}")
        rows = rows.where(F.col(DAY).between(F.to_date(lo), F.to_date(hi)))
        return rows.where(F.timestamp_seconds(F.col(SEC)).between(lo, hi)).drop(DAY)

    def customer_per_second(self, as_of, days: int = fe.HISTORY_DAYS) -> DataFrame:
        return fe.customer_from_totals(self.totals("customer", as_of, days))

    def terminal_per_second(self, as_of, days: int = fe.HISTORY_DAYS, delay: int = fe.DELAY_SECONDS) -> DataFrame:
        return fe.terminal_from_totals(self.totals("terminal", as_of, days), delay)

    def customer_features(self, as_of, days: int = fe.HISTORY_DAYS) -> DataFrame:
        """As ``features.customer_features``."""
        return replicate_rows(self.customer_per_second(as_of, days), "n_tx").drop("n_tx")

    def terminal_features(self, as_of, days: int = fe.HISTORY_DAYS, delay: int = fe.DELAY_SECONDS) -> DataFrame:
        """As ``features.terminal_features``."""
        return replicate_rows(self.terminal_per_second(as_of, days, delay), "n_tx").drop("n_tx")
